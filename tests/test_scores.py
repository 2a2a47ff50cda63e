"""Curves, capacity and audit tables against direct definitions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimwright import vocabulary as V
from claimwright.operators import audit, curves


def scored(spark, n=400, levels=40, seed=1, model="m"):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = rng.randrange(levels) / levels
        rows.append((model, i, int(rng.random() < 0.1 + 0.6 * p), p))
    return rows, spark.createDataFrame(rows, "Model string, IDpol long, HasClaim int, Score double")


def test_areas_by_definition(spark):
    rows, df = scored(spark)
    pos = [p for _, _, y, p in rows if y]
    neg = [p for _, _, y, p in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for t in sorted({p for *_, p in rows}, reverse=True):
        hits, chosen = sum(p >= t for p in pos), sum(r[3] >= t for r in rows)
        ap += (hits / len(pos) - last) * hits / chosen
        last = hits / len(pos)
    row = curves.ranking_areas(curves.score_steps(df)).first()
    assert row.ROCAUC == pytest.approx(auc) and row.PRAUC == pytest.approx(ap)


def test_one_class_has_no_roc_area(spark):
    df = spark.createDataFrame(
        [("m", i, 0, i / 10) for i in range(10)],
        "Model string, IDpol long, HasClaim int, Score double")
    assert curves.ranking_areas(curves.score_steps(df)).first().ROCAUC is None
    row = curves.confusion(df, F.lit(2.0)).first()
    assert (row.Precision, row.Recall, row.F2Score) == (0.0, 0.0, 0.0)
    assert row.Specificity == 1.0


def test_constant_score_is_random(spark):
    df = spark.createDataFrame(
        [("m", i, int(i % 4 == 0), 0.3) for i in range(100)],
        "Model string, IDpol long, HasClaim int, Score double")
    row = curves.ranking_areas(curves.score_steps(df)).first()
    assert (row.ROCAUC, row.PRAUC) == (0.5, 0.25)


def test_best_threshold_and_tie(spark):
    rows, df = scored(spark)
    best = None
    for t in sorted({p for *_, p in rows}):
        tp = sum(y and p >= t for _, _, y, p in rows)
        precision = tp / sum(p >= t for *_, p in rows)
        recall = tp / sum(y for _, _, y, _ in rows)
        f2 = 5 * precision * recall / (4 * precision + recall) if tp else 0.0
        if best is None or f2 > best[1] + 1e-15:
            best = (t, f2)
    found = curves.best_thresholds(curves.threshold_curve(curves.score_steps(df)))["m"]
    assert found == pytest.approx(best)
    flat = spark.createDataFrame(
        [("m", 0, 0, 0.1), ("m", 1, 0, 0.2)],
        "Model string, IDpol long, HasClaim int, Score double")
    assert curves.best_thresholds(curves.threshold_curve(curves.score_steps(flat)))["m"][0] == 0.1


def test_threshold_grid_by_definition(spark):
    rows, df = scored(spark)
    report = {r.Threshold: r for r in curves.threshold_report(df, 0.123).collect()}
    assert len(report) == 51
    for t in curves.threshold_grid(0.123):
        chosen = [y for _, _, y, p in rows if p >= t]
        assert report[t].PredictedPositiveRate == pytest.approx(len(chosen) / len(rows))
        assert report[t].Recall == pytest.approx(sum(chosen) / sum(r[2] for r in rows))


@pytest.mark.parametrize("n", [7, 19, 400])
def test_capacity_rounds_up_and_breaks_ties_by_id(spark, n):
    rows, df = scored(spark, n, levels=5)
    ordered = sorted(rows, key=lambda r: (-r[3], r[1]))
    found = {r.Capacity: r for r in curves.capacity_comparison(df, ["m"]).collect()}
    for c in V.CAPACITIES:
        k = max(1, math.ceil(n * c))
        assert found[c].SelectedPolicies == k
        assert found[c].SelectedClaims == sum(r[2] for r in ordered[:k])
        assert found[c].ThresholdAtCapacity == pytest.approx(ordered[k - 1][3])


def test_everything_is_captured_at_full_capacity(spark):
    _, df = scored(spark)
    row = curves.capacity_comparison(df, ["m"], (1.0,)).first()
    assert row.ClaimCaptureRate == 1.0 and row.Lift == 1.0


def test_calibration_bins(spark):
    rows, df = scored(spark, levels=1000)
    p = np.array([r[3] for r in rows])
    edges = np.percentile(p, np.linspace(0, 100, 11))[1:-1]
    bins = np.searchsorted(edges, p)
    found = {r.Bin: r for r in curves.quantile_calibration(df).collect()}
    for b in np.unique(bins):
        assert found[b].Policies == (bins == b).sum()
        assert found[b].MeanPredictedProbability == pytest.approx(p[bins == b].mean())


def test_frequency_metrics_by_definition(spark):
    rng = np.random.default_rng(2)
    w, n = rng.uniform(0.1, 1, 200), rng.poisson(0.4, 200)
    m = rng.uniform(0.05, 1, 200)
    df = spark.createDataFrame(
        [("m", "Test", i, float(a), int(b), float(c)) for i, (a, b, c) in enumerate(zip(w, n, m))],
        "Model string, Sample string, IDpol long, Exposure double, ClaimNb long,"
        " PredictedFrequency double")
    y = n / w

    def deviance(y, m, w):
        with np.errstate(divide="ignore", invalid="ignore"):
            log = np.where(y > 0, y * np.log(y / m), 0.0)
        return np.average(2 * (log - y + m), weights=w)

    row = audit.frequency_metrics(df).first()
    assert row.ExposureWeightedPoissonDeviance == pytest.approx(deviance(y, m, w))
    assert row.CountMeanPoissonDeviance == pytest.approx(deviance(n, m * w, np.ones(200)))
    null = deviance(y, np.full(200, np.average(y, weights=w)), w)
    assert row.D2Poisson == pytest.approx(1 - deviance(y, m, w) / null)
    assert row.PearsonDispersionDiagnostic == pytest.approx(np.mean((n - m * w) ** 2 / (m * w)))


def test_severity_metrics_by_definition(spark):
    rng = np.random.default_rng(4)
    w, y, m = rng.integers(1, 4, 150), rng.gamma(2, 500, 150), rng.uniform(400, 2000, 150)
    df = spark.createDataFrame(
        [("m", "Test", i, int(a), float(a * b), float(b), float(c))
         for i, (a, b, c) in enumerate(zip(w, y, m))],
        "Model string, Sample string, IDpol long, ClaimNb long,"
        " CompleteTotalClaimAmount double, AverageClaimSeverity double, PredictedSeverity double")

    def deviance(m):
        return np.average(2 * (np.log(m / y) + y / m - 1), weights=w)

    row = audit.severity_metrics(df).first()
    assert row.WeightedGammaDeviance == pytest.approx(deviance(m))
    assert row.D2Gamma == pytest.approx(
        1 - deviance(m) / deviance(np.full(150, np.average(y, weights=w))))
    assert row.WeightedRMSE == pytest.approx(math.sqrt(np.average((y - m) ** 2, weights=w)))
    assert row.Claims == w.sum()


def test_selection_rules(spark):
    frequency = spark.createDataFrame(
        [(V.BASELINE_FREQUENCY, 0.1, 0.0), (V.POISSON, 0.3, 0.1), (V.BOOSTING, 0.2, 0.2)],
        "Model string, ExposureWeightedPoissonDeviance double, D2Poisson double")
    assert audit.select_frequency(frequency).first().Model == V.BOOSTING
    severity = spark.createDataFrame(
        [(V.BASELINE_SEVERITY, 0.1, 0.0), (V.GAMMA, 0.3, 0.1)],
        "Model string, WeightedGammaDeviance double, D2Gamma double")
    assert audit.select_severity(severity).first().Model == V.BASELINE_SEVERITY
    occurrence = spark.createDataFrame(
        [("a", 0.2, 0.6), ("b", 0.2, 0.7)], "Model string, PRAUC double, ROCAUC double")
    assert audit.select_occurrence(occurrence).first().Model == "b"


def test_subgroups_drop_small_groups(spark):
    _, df = scored(spark, 300)
    rows = df.withColumn(
        "Area", F.when(F.col("IDpol") < 240, "A").when(F.col("IDpol") < 270, "B"))
    found = curves.subgroup_metrics(rows, F.lit(0.4), ["Area"], least_rows=5, least_claims=1)
    assert {r.GroupValue: r.Policies for r in found.collect()} == {"A": 240, "B": 30, "Missing": 30}
    large = curves.subgroup_metrics(rows, F.lit(0.4), ["Area"], least_rows=100, least_claims=30)
    assert [r.GroupValue for r in large.collect()] == ["A"]
    span = curves.recall_range(large).first()
    assert span.MinimumRecall == span.MaximumRecall
