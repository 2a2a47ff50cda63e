"""Fitted models against direct solutions of the same objective."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimwright import vocabulary as V
from claimwright.operators import audit, boosting, importance, models
from claimwright.operators.features import Design, category_places
from claimwright.operators.importance import permutation_importance
from claimwright.plans import occurrence

N = 1_500
NUMBERS, TEXTS = ["x1", "x2"], ["t"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x1, x2 = rng.normal(size=N), rng.uniform(0, 10, N)
    t = rng.choice(["a", "b", "it's"], N)
    eta = 0.8 * x1 - 0.1 * x2 + 0.5 * (t == "b")
    w = rng.uniform(0.2, 1.0, N)
    y = (rng.random(N) < 1 / (1 + np.exp(-eta))).astype(int)
    n = rng.poisson(np.exp(0.5 * eta + 0.8 * np.sin(3 * x1) - 0.5) * w)
    c = rng.integers(1, 4, N)
    s = rng.gamma(3.0, np.exp(0.3 * eta + 6) / 3.0)
    rows = [
        (i, None if i % 50 == 0 else float(x1[i]), float(x2[i]), str(t[i]), int(y[i]),
         float(w[i]), int(n[i]), float(n[i] / w[i]), int(c[i]), float(s[i]))
        for i in range(N)]
    return spark.createDataFrame(
        rows, "IDpol long, x1 double, x2 double, t string, HasClaim int, Exposure double,"
        " ClaimNb long, ClaimFrequency double, Claims long, AverageClaimSeverity double"
    ).repartition(4, "IDpol").cache()


def matrix(data):
    design = Design.fit(data, NUMBERS, TEXTS)
    frame = design.frame(data, "IDpol", "HasClaim", "Exposure", "ClaimFrequency", "Claims",
                         "AverageClaimSeverity").toPandas()
    return frame, frame[names(design)].to_numpy(), design


def names(design):
    return [r["name"] for r in design.names().orderBy("position").collect()]


def newton(X, gradient, hessian, penalty):
    """Minimises sum of losses + penalty/2 |w|^2, the intercept unpenalised."""
    A = np.column_stack([np.ones(len(X)), X])
    beta, ridge = np.zeros(A.shape[1]), np.diag([0.0] + [penalty] * X.shape[1])
    for _ in range(60):
        eta = A @ beta
        step = np.linalg.solve(
            A.T @ (A * hessian(eta)[:, None]) + ridge, A.T @ gradient(eta) + ridge @ beta)
        beta -= step * min(1.0, 2.0 / max(abs(step).max(), 1e-12))
    return beta[1:]


def test_design_matches_its_definition(data):
    frame, X, design = matrix(data)
    assert names(design) == ["numeric__x1", "numeric__x2", "categorical__t_b", "categorical__t_it's"]
    assert np.allclose(X[:, :2].mean(axis=0), 0) and np.allclose(X[:, :2].std(axis=0), 1)
    assert set(np.unique(X[:, 2])) == {0.0, 1.0}


def test_unknown_and_missing_categories(spark, data):
    _, _, design = matrix(data)
    counts = {r["v"]: r["n"] for r in category_places(data, TEXTS).collect()}
    usual = min(counts, key=lambda v: (-counts[v], v))
    odd = spark.createDataFrame([(1.0, 1.0, "zzz"), (1.0, 1.0, None)], "x1 double, x2 double, t string")
    rows = design.frame(odd).collect()
    assert rows[0][2:] == (0.0, 0.0)
    assert rows[1][2:] == (float(usual == "b"), float(usual == "it's"))


def test_many_categories_are_not_collected(spark, monkeypatch):
    """100,000 categories: places in the order of values, sparse vectors, no collect of them."""
    rows = spark.range(0, 120_000, 1, 8).selectExpr(
        "id AS IDpol", "CAST(id % 7 AS DOUBLE) AS x",
        "CASE WHEN id < 100000 THEN concat('c', lpad(id, 6, '0')) WHEN id < 119000 THEN 'c000123' END AS t",
        "'only' AS u")
    collected = []
    real = type(rows).collect

    def counted(self):
        found = real(self)
        collected.append(len(found))
        return found

    monkeypatch.setattr(type(rows), "collect", counted)
    design = Design.fit(rows, ["x"], ["t", "u"])
    vectors = design.features(rows)
    assert max(collected) <= 2
    monkeypatch.undo()
    assert design.width() == 100_000 and design.texts["t"] == ("c000123", 100_000)
    sizes = {r["p"]: r["c"] for r in design.categories.filter("c = 't'").groupBy(
        F.col("place").alias("p")).agg(F.count("*").alias("c")).collect()}
    assert len(sizes) == 100_000 and set(sizes.values()) == {1}
    found = {r["IDpol"]: r["features"] for r in vectors.filter(
        "IDpol IN (0, 1, 99999, 110000, 119500)").collect()}
    assert all(v.size == 100_000 and len(v.indices) <= 2 for v in found.values())
    at = {i: [k for k in v.indices.tolist() if k] for i, v in found.items()}
    assert at == {0: [], 1: [1], 99999: [99999], 110000: [123], 119500: [123]}
    wanted = design.names().filter("position IN (0, 1, 123)").collect()
    assert {r["position"]: r["name"] for r in wanted} == {
        0: "numeric__x", 1: "categorical__t_c000001", 123: "categorical__t_c000123"}


def test_logistic(spark, data, tmp_path):
    model = models.fit_logistic(data, NUMBERS, TEXTS, tolerance=1e-10)
    frame, X, _ = matrix(data)
    y = frame["HasClaim"].to_numpy()

    def p(eta):
        return 1 / (1 + np.exp(-eta))

    wanted = newton(X, lambda e: p(e) - y, lambda e: p(e) * (1 - p(e)), 1.0)
    table = {r.Feature: r for r in model.coefficients("OddsRatio").collect()}
    found = [table[n].Coefficient for n in names(model.design)]
    assert np.allclose(found, wanted, atol=1e-4)
    assert table["numeric__x1"].OddsRatio == pytest.approx(np.exp(table["numeric__x1"].Coefficient))
    model.save(str(tmp_path / "m"))
    again = models.FittedModel.load(spark, str(tmp_path / "m"))
    assert names(again.design) == names(model.design)
    a = {r.IDpol: r.p for r in model.score(data, "p").collect()}
    b = {r.IDpol: r.p for r in again.score(data, "p").collect()}
    assert a == b and 0 < min(a.values()) < max(a.values()) < 1


def test_poisson(data):
    model = models.fit_poisson(data, 1e-2, NUMBERS, TEXTS)
    frame, X, _ = matrix(data)
    y, w = frame["ClaimFrequency"].to_numpy(), frame["Exposure"].to_numpy()
    w = w / w.sum()
    wanted = newton(X, lambda e: w * (np.exp(e) - y), lambda e: w * np.exp(e), 1e-2)
    assert np.allclose(model.fitted.coefficients.toArray(), wanted, atol=1e-4)


def test_gamma(data):
    rows = data.withColumn("ClaimNb", F.col("Claims"))
    model = models.fit_gamma(rows, 1e-2, NUMBERS, TEXTS)
    frame, X, _ = matrix(data)
    y, w = frame["AverageClaimSeverity"].to_numpy(), frame["Claims"].to_numpy()
    w = w / w.sum()
    start = np.log(np.average(y, weights=w))
    wanted = newton(
        X, lambda e: w * (1 - y / start_scale(e, start)), lambda e: w * y / start_scale(e, start),
        1e-2)
    assert np.allclose(model.fitted.coefficients.toArray(), wanted, atol=1e-3)


def start_scale(eta, start):
    return np.exp(np.clip(eta + start, -30, 30))


def test_strongest_coefficients(spark, data):
    table = spark.createDataFrame(
        [(f"f{i}", float(i - 20)) for i in range(41)], "Feature string, Coefficient double")
    assert [r.Feature for r in models.strongest(table, True, 2).collect()] == ["f40", "f39"]
    assert [r.Feature for r in models.strongest(table, False, 2).collect()] == ["f0", "f1"]


@pytest.mark.parametrize("loss, label, weight, settings", [
    ("poisson", "ClaimFrequency", "Exposure", boosting.FREQUENCY_SETTINGS),
    ("gamma", "AverageClaimSeverity", "Claims", boosting.SEVERITY_SETTINGS),
])
def test_boosting_learns_and_reloads(spark, data, tmp_path, loss, label, weight, settings):
    quick = replace(settings, rounds=12, rate=0.3, leaves=8, least_rows=20, checkpoint_every=4)
    model = boosting.fit_boosting(data, label, weight, NUMBERS, TEXTS, quick)
    assert len(model.trees) == 12 and all(1 < t.leaves <= 8 for t in model.trees)
    assert model.history[-1] < model.history[0]
    scored = model.score(data, "m")
    w, y, m = F.col(weight).cast("double"), F.col(label), F.col("m")
    unit = (m - y * F.log(m)) if loss == "poisson" else (F.log(m) + y / m)
    fitted = scored.agg(F.sum(w * unit) / F.sum(w)).first()[0]
    mean = data.agg(F.sum(w * y) / F.sum(w)).first()[0]
    flat = scored.withColumn("m", F.lit(mean)).agg(F.sum(w * unit) / F.sum(w)).first()[0]
    assert fitted < flat
    model.save(str(tmp_path / "b"))
    again = boosting.BoostedTrees.load(spark, str(tmp_path / "b"))
    a = {r.IDpol: r.m for r in scored.collect()}
    b = {r.IDpol: r.m for r in again.score(data, "m").collect()}
    assert a == pytest.approx(b)


def test_boosting_stops_without_improvement(data):
    quick = replace(
        boosting.FREQUENCY_SETTINGS, rounds=40, rate=3.0, leaves=8, least_rows=5, patience=2)
    model = boosting.fit_boosting(data, "ClaimFrequency", "Exposure", NUMBERS, TEXTS, quick)
    assert len(model.trees) < 40


def test_boosting_beats_poisson_beats_constant(data):
    rows = data.withColumn("Sample", F.lit("Test"))
    poisson = models.fit_poisson(data, 1e-4, NUMBERS, TEXTS)
    trees = boosting.fit_boosting(
        data, "ClaimFrequency", "Exposure", NUMBERS, TEXTS,
        replace(boosting.FREQUENCY_SETTINGS, rounds=25, rate=0.2, least_rows=20))
    base = models.portfolio_frequency(data)
    found = {}
    for name, scored in {
        "constant": rows.withColumn("PredictedFrequency", F.lit(base)),
        "poisson": poisson.score(rows, "PredictedFrequency"),
        "boosting": trees.score(rows, "PredictedFrequency"),
    }.items():
        metrics = audit.frequency_metrics(scored.withColumn("Model", F.lit(name)))
        found[name] = metrics.first().ExposureWeightedPoissonDeviance
    assert found["boosting"] < found["poisson"] < found["constant"]


def test_classifier_and_importance(spark, data, monkeypatch):
    settings = replace(
        boosting.OCCURRENCE_SETTINGS, rounds=10, rate=0.3, leaves=8, least_rows=20)
    model = boosting.fit_boosting(data, "HasClaim", None, NUMBERS, TEXTS, settings)
    scored = model.score(data, "p").select("HasClaim", "p").toPandas()
    assert 0 < scored["p"].min() < scored["p"].max() < 1
    assert scored["p"].mean() == pytest.approx(scored["HasClaim"].mean(), abs=0.03)
    rows = permutation_importance(model, data, [*NUMBERS, *TEXTS], size=800, repeats=2).collect()
    assert rows[0].Feature == "x1" and rows[0].ImportanceMean > 0.02
    assert len(rows) == 3
    # All rows by default, and the same however the order is cut into pieces.
    whole = permutation_importance(model, data, [*NUMBERS, *TEXTS], repeats=1).collect()
    monkeypatch.setattr(importance, "PIECE_ROWS", 100)
    assert permutation_importance(model, data, [*NUMBERS, *TEXTS], repeats=1).collect() == whole


def test_comparison_needs_the_saved_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="logistic"):
        occurrence.saved_logistic(spark, str(tmp_path / "none"))


def test_baselines(data):
    frame = data.toPandas()
    assert models.claim_rate(data) == pytest.approx(frame["HasClaim"].mean())
    assert models.portfolio_frequency(data) == pytest.approx(
        frame["ClaimNb"].sum() / frame["Exposure"].sum())
    severity = data.withColumn("ClaimNb", F.col("Claims"))
    assert models.mean_severity(severity) == pytest.approx(
        np.average(frame["AverageClaimSeverity"], weights=frame["Claims"]))
    assert V.EPSILON == 1e-12
