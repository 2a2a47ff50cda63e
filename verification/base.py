"""What the registered queries share: prepared frames, staged tables, test scores."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from claimwright import vocabulary as V
from claimwright.operators import features, reconcile, sampling
from claimwright.plans import preparation, warehouse
from claimwright.session import stage
from claimwright.sources import fixtures

# The fixture holds a fraction of the portfolio the published floor is meant for.
REGION_EXPOSURE = 100
SEGMENT_EXPOSURE = 100
SUBGROUP_ROWS = 200

# Formula scores (see FIXTURES.md): they give every model table an exact SQL check.
FIRST_SCORE = "(BonusMalus - 40 + CASE WHEN COALESCE(DrivAge, 45) < 25 THEN 40 ELSE 0 END) / 400D"
SECOND_SCORE = "(BonusMalus - 30 + 6 * VehPower) / 800D"
FIRST_SEVERITY = "1000 + 10 * COALESCE(DrivAge, 45)"
SECOND_SEVERITY = "50000 + 100 * VehPower"

_kept: dict[tuple, DataFrame] = {}
_plans: dict[tuple, preparation.Prepared] = {}
_tables: dict[tuple, dict[str, DataFrame]] = {}


def shown(df: DataFrame) -> DataFrame:
    """Doubles rounded so that two engines adding in another order agree.

    A small amount is added first: ratios of amounts often lie exactly halfway.
    """
    def rounded(name):
        c = F.col(f"`{name}`")
        return F.when(F.abs(c) >= 1e5, F.round(c + 1.3e-5, 2)).otherwise(F.round(c + 1.3e-9, 6)) + 0.0

    return df.select(*[
        rounded(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def once(spark: SparkSession, folder: str, label: str, build,
         spread_by: str | None = "IDpol") -> DataFrame:
    """A table written once per application and input folder, then read."""
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _kept:
        _kept[key] = stage(build(), label, spread_by)
    return _kept[key]


def raw(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The two raw text tables, landed once as files, as raw data is: where they are made,
    as the steps that follow deal their rows anew."""
    return (
        once(spark, folder, "raw-frequency", lambda: fixtures.raw_frequency(spark, folder), None),
        once(spark, folder, "raw-severity", lambda: fixtures.raw_severity(spark, folder), None),
    )


def prepared(spark: SparkSession, folder: str) -> preparation.Prepared:
    """The lazy preparation plan, built once per application and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _plans:
        _plans[key] = preparation.prepare(*raw(spark, folder))
    return _plans[key]


def policy(spark: SparkSession, folder: str) -> DataFrame:
    """The policy-level fact as a written table, for queries that pass over it often."""
    return once(spark, folder, "policy", lambda: prepared(spark, folder).policy)


def claims(spark: SparkSession, folder: str) -> DataFrame:
    return once(spark, folder, "claims", lambda: prepared(spark, folder).claims)


def policy_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of the policy-level fact; a repeated one raises, as in the fact."""
    return once(spark, folder, "policy-ids", lambda: prepared(spark, folder).policy.select("IDpol"))


def known_claims(spark: SparkSession, folder: str) -> DataFrame:
    return once(spark, folder, "known-claims", lambda: reconcile.known_claims(
        claims(spark, folder), policy_ids(spark, folder)))


def relational(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The relational tables as written, for the checks that follow the writing."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _tables:
        found = prepared(spark, folder)
        planned = warehouse.relational_tables(found.policy, found.severity, found.audit)
        _tables[key] = {n: stage(df, n) for n, df in planned.items()}
    return _tables[key]


def orphans(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.orphan_claims(known_claims(spark, folder))


# The policies are dealt by id already, and a split only labels them, so it is written where
# they are read.
def occurrence_split(spark: SparkSession, folder: str) -> DataFrame:
    return once(spark, folder, "occurrence", lambda: sampling.stratified_split(
        features.check_occurrence(features.occurrence_sample(policy(spark, folder))),
        "HasClaim"), None)


def frequency_split(spark: SparkSession, folder: str) -> DataFrame:
    return once(spark, folder, "frequency", lambda: sampling.stratified_split(
        features.check_frequency(features.frequency_sample(policy(spark, folder))),
        "ClaimCountStratum"), None)


def severity_rows(spark: SparkSession, folder: str) -> DataFrame:
    return once(spark, folder, "severity-rows", lambda: features.severity_policies(
        policy(spark, folder)))


def severity_split(spark: SparkSession, folder: str) -> DataFrame:
    return once(spark, folder, "severity", lambda: sampling.stratified_split(
        features.check_severity(features.severity_sample(severity_rows(spark, folder))),
        "SeverityStratum"))


def _two(rows: DataFrame, first: tuple, second: tuple, column: str) -> DataFrame:
    parts = [
        rows.withColumns({"Model": F.lit(name), column: F.expr(text).cast("double")})
        for name, text in (first, second)
    ]
    return parts[0].unionByName(parts[1])


def occurrence_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled sample under two formula scores, as a comparison would hold it."""
    return once(spark, folder, "occurrence-scores", lambda: _two(
        occurrence_split(spark, folder), (V.LOGISTIC, FIRST_SCORE), (V.BOOSTING, SECOND_SCORE),
        "Score"))


def frequency_scores(spark: SparkSession, folder: str) -> DataFrame:
    return once(spark, folder, "frequency-scores", lambda: _two(
        frequency_split(spark, folder), (V.POISSON, FIRST_SCORE), (V.BOOSTING, SECOND_SCORE),
        "PredictedFrequency"))


def severity_scores(spark: SparkSession, folder: str) -> DataFrame:
    return once(spark, folder, "severity-scores", lambda: _two(
        severity_split(spark, folder), (V.GAMMA, FIRST_SEVERITY), (V.BOOSTING, SECOND_SEVERITY),
        "PredictedSeverity"))


class Formula:
    """A scorer like a fitted model, whose score is a SQL expression."""

    def __init__(self, text: str):
        self.text = text

    def score(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, F.expr(self.text).cast("double"))


#: The score that permutation importance is checked with: three features count, one does not.
PERMUTED_SCORE = ("(BonusMalus - 40 + CASE WHEN COALESCE(DrivAge, 45) < 25 THEN 40 ELSE 0 END"
                  " + CASE WHEN Area = 'A' THEN 7 ELSE 0 END) / 400D")
PERMUTED = ["BonusMalus", "DrivAge", "Area", "VehAge"]


def coefficients(spark: SparkSession, folder: str) -> DataFrame:
    """(Feature, Coefficient) as a fitted model would give them, from claim rates; some are
    beyond the range that effects are cut to."""
    rows = frequency_split(spark, folder).filter("Sample = 'Training'")
    whole = rows.agg((F.sum("ClaimNb") / F.sum("Exposure")).alias("_rate"))
    parts = [
        rows.groupBy(F.concat(F.lit(f"categorical__{c}_"), c).alias("Feature")).agg(
            (F.sum("ClaimNb") / F.sum("Exposure")).alias("_own"))
        for c in ("Area", "VehBrand", "Region")]
    each = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return each.join(F.broadcast(whole)).select(
        "Feature", (F.lit(100.0) * F.log(F.col("_own") / F.col("_rate"))).alias("Coefficient"))
