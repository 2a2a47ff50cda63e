"""Casting, bands, ratios and cleaning on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from claimwright import vocabulary as V
from claimwright.functions import bands, casting, measures
from claimwright.operators import clean


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def test_lenient_numbers(spark):
    df = texts(spark, [
        " 1.5 ", "n/a", None, "NaN", "1.0f", "2d", "1e3", "-7", "9007199254740993", "4.0", "inf"])
    rows = df.select(
        casting.lenient_double(df, "x").alias("d"), casting.lenient_long(df, "x").alias("n")
    ).collect()
    assert [r.d for r in rows] == [
        1.5, None, None, None, None, None, 1000.0, -7.0, 9007199254740992.0, 4.0, None]
    assert [r.n for r in rows] == [
        None, None, None, None, None, None, 1000, -7, 9007199254740993, 4, None]


def test_truth(spark):
    df = texts(spark, [" True ", "FALSE", "1", "0", "yes", None])
    rows = df.select(
        casting.truth(df, "x").alias("k"), casting.lenient_truth(df, "x").alias("l")).collect()
    assert [r.k for r in rows] == [True, False, True, False, None, None]
    assert [r.l for r in rows] == [True, False, True, False, False, False]
    good = df.filter("x NOT IN ('yes')")
    assert good.select(casting.strict_truth(good, "x")).count() == 4
    with pytest.raises(Exception, match="yes"):
        df.select(casting.strict_truth(df, "x")).collect()


def test_bands_differ_outside_their_range(spark):
    edges, labels = V.DRIVER_AGE_EDGES, V.DRIVER_AGE_LABELS
    df = spark.createDataFrame(
        [(v,) for v in [None, -1.0, 0.0, 20.0, 20.99, 21.0, 24.0, 25.0, 79.0, 80.0, 120.0]],
        "x double")
    rows = df.select(
        bands.cut(F.col("x"), edges, labels).alias("cut"),
        bands.case_band(F.col("x"), edges, labels).alias("sql")).collect()
    assert [r.cut for r in rows] == [
        None, None, "Under 21", "Under 21", "Under 21", "21-24", "21-24", "25-29", "70-79",
        "80+", "80+"]
    assert [r.sql for r in rows][:2] == ["80+", "Under 21"]
    assert [r.sql for r in rows][2:] == [r.cut for r in rows][2:]


def test_every_edge_opens_its_band(spark):
    for source, edges, labels in V.BANDS.values():
        df = spark.createDataFrame([(float(e),) for e in edges], f"{source} double")
        found = [r[0] for r in df.select(bands.cut(F.col(source), edges, labels)).collect()]
        assert found == labels


def test_ratios_without_a_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    rows = df.select(
        measures.ratio(F.col("a"), F.col("b")).alias("r"),
        measures.ratio_or_zero(F.col("a"), F.col("b")).alias("z")).collect()
    assert [(r.r, r.z) for r in rows] == [(None, 0.0), (0.25, 0.25)]


def test_poisson_loss_without_claims(spark):
    df = spark.createDataFrame([(0.0, 0.5)], "y double, m double")
    assert df.select(measures.poisson_loss(F.col("y"), F.col("m"))).first()[0] == 1.0


def frequency(spark, **changes):
    row = {
        "IDpol": "1", "ClaimNb": "0", "Exposure": "0.5", "Area": " A ", "VehPower": "5",
        "VehAge": "1", "DrivAge": "40", "BonusMalus": "50", "VehBrand": "B1", "VehGas": "Diesel",
        "Density": "100", "Region": "R1"}
    row.update(changes)
    return spark.createDataFrame(
        [tuple(row[c] for c in V.FREQUENCY_COLUMNS)], V.RAW_FREQUENCY_SCHEMA)


@pytest.mark.parametrize("changes, core, issue", [
    ({}, True, False),
    ({"ClaimNb": "1.5"}, False, False),
    ({"ClaimNb": "-1"}, False, False),
    ({"ClaimNb": None}, False, False),
    ({"Exposure": "0"}, False, False),
    ({"IDpol": None}, False, False),
    ({"IDpol": "-4"}, False, False),
    ({"VehAge": None, "DrivAge": None, "BonusMalus": None, "Density": None}, True, False),
    ({"VehAge": "-1"}, True, True),
    ({"Density": "0"}, True, True),
])
def test_policy_flags(spark, changes, core, issue):
    row = clean.clean_frequency(frequency(spark, **changes)).first()
    assert row.CorePolicyRecordValid is core
    assert row.AnyPredictorValidityIssue is issue
    assert row.Area == "A"


def test_claim_flags(spark):
    df = spark.createDataFrame(
        [("1", "10"), ("1", "0"), (None, "5"), ("2", "x")], V.RAW_SEVERITY_SCHEMA)
    rows = clean.clean_severity(df).collect()
    assert [r.SeverityRecordValid for r in rows] == [True, False, False, False]


def test_long_ids_stay_apart_and_large_counts_do_not_raise(spark):
    from claimwright.operators import quality

    ids = ["9007199254740992", "9007199254740993"]
    frequency = spark.createDataFrame(
        [(ids[0], "1e300"), (ids[1], "1")], "IDpol string, ClaimNb string")
    severity = spark.createDataFrame([(ids[1], "5")], "IDpol string, ClaimAmount string")
    typed = quality.typed(frequency), quality.typed(severity)
    found = {r.IDpol: (r.ClaimNb, r.SeverityRowCount) for r in quality.raw_consistency(*typed).collect()}
    assert found[int(ids[1])] == (1, 1) and found[int(ids[0])][0] in (None, 0)


def test_histograms_of_no_rows_have_no_bins(spark):
    from claimwright.operators import explore

    nothing = spark.createDataFrame([], "DrivAge double, ClaimAmount double")
    assert explore.log_histogram(nothing, "ClaimAmount").count() == 0
    assert explore.driver_age_histogram(nothing).count() == 0


def test_review_sees_a_model_that_was_not_trained(spark):
    from claimwright.plans import review

    validation = spark.createDataFrame([("A",), ("B",)], "Model string")
    best = validation.filter("Model = 'A'")
    passed = [review._from_validation(m, validation, best).first()[1] for m in ("A", "B", "C")]
    assert passed == [True, False, False]


def test_a_broken_view_fails_the_reconciliation(spark, folder):
    from claimwright.operators import portfolio, reconcile
    from claimwright.plans import warehouse
    from verification import base

    policies = base.policy(spark, folder)
    typed = reconcile.policies_table(policies)
    kpis = portfolio.portfolio_kpis(policies)
    for rows, expected in ((typed, True), (typed.filter("ClaimNb < 3"), False)):
        warehouse.register({"policies": rows})
        compared = portfolio.kpi_reconciliation(kpis, spark.sql("SELECT * FROM v_portfolio_kpis"))
        assert all(r.Passed for r in compared.collect()) is expected
