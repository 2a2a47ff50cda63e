"""Order statistics, deciles, splits and samples against sorted lists."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimwright.operators import ranking, sampling
from verification import base


def scores(kind, n):
    rng = random.Random(n)
    if kind == "distinct":
        return [(rng.random(), i) for i in range(n)]
    if kind == "ties":
        return [(rng.randrange(5) / 4, i) for i in range(n)]
    if kind == "third":
        return [(0.25 if i % 3 == 0 else rng.random(), i) for i in range(n)]
    return [(0.5, i) for i in range(n)]


KINDS = ["distinct", "ties", "third", "constant"]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("n", [1, 11, 20, 997])
def test_rows_at_ranks(spark, kind, n):
    rows = scores(kind, n)
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "score double, id long").repartition(3)
    ranks = sorted({1, n, (n + 1) // 2, max(1, n - 1)})
    total, found = ranking.rows_at(df, "score", "id", lambda k: ranks, pieces=16)
    ordered = sorted(rows)
    assert total == n
    assert found == [ordered[r - 1] for r in ranks]


def pandas_decile(rank, n):
    """Bin of a rank among ten equal-width bins of 1..n, right edges included."""
    return max(1, -(-10 * (rank - 1) // (n - 1))) if n > 1 else 1


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("n", [1, 11, 20, 1003])
def test_deciles(spark, kind, n):
    rows = scores(kind, n)
    df = spark.createDataFrame(rows, "score double, id long")
    found = {r.id: r.RiskDecile for r in ranking.with_decile(df, "score", "id").collect()}
    wanted = {i: pandas_decile(k, n) for k, (_, i) in enumerate(sorted(rows), 1)}
    assert found == wanted


def test_decile_sizes_of_the_published_sample():
    cuts = [0, *ranking.decile_ranks(135_603), 135_603]
    sizes = [b - a for a, b in zip(cuts, cuts[1:])]
    assert sum(sizes) == 135_603
    assert sizes[:2] == [13_561, 13_560] and set(sizes) == {13_560, 13_561}


@pytest.mark.parametrize("kind", KINDS)
def test_running_totals(spark, kind):
    rows = scores(kind, 500)
    df = spark.createDataFrame(rows, "score double, id long")
    pieced = ranking.Pieces.fit(df, "score", "id", 16).assign(df, "score", "id")
    assert pieced.select("_piece").distinct().count() > 4
    before = ranking.offsets(pieced, {"n": F.lit(1)})
    out = ranking.accumulate(pieced, before, ["score", "id"], {"n": F.lit(1)}).collect()
    place = {r.id: r.n_before for r in out}
    assert [place[i] for _, i in sorted(rows)] == list(range(500))


def test_no_piece_holds_a_constant_score(spark):
    df = spark.range(4000).select(F.lit(0.1).alias("score"), "id")
    pieced = ranking.Pieces.fit(df, "score", "id", 16).assign(df, "score", "id")
    largest = pieced.groupBy("_piece").count().agg(F.max("count")).first()[0]
    assert largest < 4000 / 4


def test_long_ids_and_decimals_are_cut(spark):
    """Half of the rows have one id beyond 2^53, next to ids that share its double."""
    hot = 2**53 + 11
    df = spark.range(8000).selectExpr(
        f"IF(id % 2 = 0, {hot}L, {2**53}L + id % 40) AS IDpol", "CAST(id % 997 AS DOUBLE) AS ClaimAmount")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kinds = df.groupBy("IDpol", "ClaimAmount").agg(F.count("*").alias("n"))
        pieced = ranking.in_ranges(kinds, "IDpol", "ClaimAmount")
        sizes = [r["n"] for r in pieced.groupBy("_piece").agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / 4
        cut = pieced.filter(F.col("IDpol") == hot).select("_piece").distinct().count()
        exact = ranking.in_ranges(
            spark.range(4000).selectExpr("CAST(100000000000000000000 AS DECIMAL(38, 9)) + CAST(id AS DECIMAL(38, 9)) / 1000000 AS d"), "d")
        assert exact.groupBy("_piece").count().agg(F.max("count")).first()[0] < 2000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert cut >= 1
    found = sorted((r.n, r.IDpol, r.ClaimAmount) for r in ranking.numbered(
        df, "IDpol", "ClaimAmount", "n").collect())
    assert [f[0] for f in found] == list(range(1, 8001))
    assert [f[1:] for f in found] == sorted((r.IDpol, r.ClaimAmount) for r in df.collect())


def test_ranks_of_several_groups_at_once(spark):
    rows = [(g, *r) for g, kind in (("a", "ties"), ("b", "distinct"), ("c", "constant"))
            for r in scores(kind, 200 if g != "c" else 7)]
    df = spark.createDataFrame(rows, "g string, score double, id long").repartition(3)
    found = ranking.rows_at_in_groups(df, "g", "score", "id", lambda n: [1, n // 2, n, 2], pieces=16)
    for g in "abc":
        own = sorted(r[1:] for r in rows if r[0] == g)
        n = len(own)
        assert found[g] == (n, [own[k - 1] for k in (1, n // 2, n, 2)])
    assert ranking.rows_at_in_groups(df.limit(0), "g", "score", "id", lambda n: [1]) == {}


def test_quantiles_interpolate(spark):
    rng = np.random.default_rng(3)
    a, b = rng.lognormal(size=301), rng.integers(0, 6, 301).astype(float)
    df = spark.createDataFrame(
        [(float(x), float(y)) for x, y in zip(a, b)] + [(None, None)], "a double, b double")
    points = [(p, str(p)) for p in (0.0, 0.01, 0.25, 0.5, 0.995, 1.0)]
    rows = ranking.quantile_table(df, ["a", "b"], points).collect()
    for name, values in (("a", a), ("b", b)):
        found = [r.Value for r in sorted(rows, key=lambda r: r.Position) if r.Variable == name]
        assert np.allclose(found, np.quantile(values, [p for p, _ in points]))


def test_published_split_sizes():
    sizes = sampling.split_sizes({0: 643_953, 1: 34_060})
    assert sizes == {0: (128_791, 128_791), 1: (6_812, 6_812)}


@pytest.mark.parametrize("n", [7, 100, 1_001])
def test_split_is_exact_and_stable(spark, n):
    df = spark.range(n).select(
        F.col("id").alias("IDpol"),
        F.when(F.col("id") % 10 == 0, "few").when(F.col("id") % 97 == 1, "rare")
        .otherwise("many").alias("s"))
    counts = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    split = sampling.stratified_split(df, "s")
    found = {(r.s, r.Sample): r["count"] for r in split.groupBy("s", "Sample").count().collect()}
    for s, (test, validation) in sampling.split_sizes(counts).items():
        assert found.get((s, "Test"), 0) == test
        assert found.get((s, "Validation"), 0) == validation
    total = {k: sum(v for (_, m), v in found.items() if m == k) for k in ("Test", "Validation")}
    assert total["Test"] == math.ceil(0.2 * n)
    again = sampling.stratified_split(df.repartition(3), "s")
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, again.collect()))


def test_stratified_sample_size(spark):
    df = spark.range(1_000).selectExpr("id AS IDpol", "CAST(id % 20 = 0 AS INT) AS y")
    kept = sampling.stratified_sample(df, "y", 333)
    assert kept.count() == 333
    assert kept.filter("y = 1").count() in (16, 17)
    assert sampling.stratified_sample(df, "y", 5_000).count() == 1_000


@pytest.mark.parametrize("split, stratum", [
    (base.occurrence_split, "HasClaim"), (base.frequency_split, "ClaimCountStratum")])
def test_a_split_is_written_without_dealing_its_rows(spark, monkeypatch, split, stratum):
    """The policies are dealt by id already; a split labels each where it is read."""
    policies = spark.range(200).selectExpr(
        "id AS IDpol", "1D AS Exposure", "'A' AS Area", "4 AS VehPower", "1 AS VehAge",
        "30 AS DrivAge", "50 AS BonusMalus", "'B1' AS VehBrand", "'Diesel' AS VehGas",
        "100 AS Density", "'R' AS Region", "CAST(id % 4 = 0 AS INT) AS ClaimNb",
        "id % 4 = 0 AS HasClaim", "true AS FrequencyModelEligible")
    dealt = []

    def stage(df, label, spread_by=None, compression=None):
        dealt.append(spread_by)
        return df

    monkeypatch.setattr(base, "policy", lambda spark, folder: policies)
    monkeypatch.setattr(base, "stage", stage)
    monkeypatch.setattr(base, "_kept", {})
    found = split(spark, "own rows")
    assert dealt == [None]
    sizes = found.groupBy("Sample", F.col(stratum).cast("string")).count().collect()
    assert sorted((r["Sample"], r["count"]) for r in sizes) == [
        ("Test", 10), ("Test", 30), ("Training", 30), ("Training", 90),
        ("Validation", 10), ("Validation", 30)]
