"""Data contracts: columns, keys, constraints, and pass/fail tables."""

from pyspark.sql import DataFrame, Window, functions as F

from claimwright import vocabulary as V
from claimwright.functions.measures import count_if
from claimwright.operators.shaping import long_report, stacked

# Constraints of the relational layer (fixed values): column -> rule every row keeps.
POLICY_RULES = {
    **{f"{c} is present": f"{c} IS NOT NULL" for c in [
        "IDpol", "ClaimNb", "Exposure", "HasClaim", "HasSeverityRecord", "SeverityRowCount",
        "SeverityTotalClaimAmount", "ClaimCountDifference", "ClaimCountMatch",
        "SeverityCompletenessStatus", "AnnualizedClaimFrequency", "FrequencyModelEligible",
        "SeverityModelEligible", "PurePremiumModelEligible", "AnyPredictorValidityIssue",
    ]},
    **{f"{c} is not negative": f"{c} >= 0" for c in [
        "ClaimNb", "SeverityRowCount", "SeverityTotalClaimAmount", "AnnualizedClaimFrequency",
    ]},
    "Exposure is positive": "Exposure > 0",
    **{f"{c} is zero or one": f"{c} IN (0, 1)" for c in V.POLICY_FLAGS},
}
CLAIM_RULES = {
    "IDpol is present": "IDpol IS NOT NULL",
    "ClaimAmount is present": "ClaimAmount IS NOT NULL",
    "ClaimAmount is positive": "ClaimAmount > 0",
}
ISSUE_RULES = {
    **{f"{c} is present": f"{c} IS NOT NULL" for c in V.ISSUE_COLUMNS},
    **{f"{c} is not negative": f"{c} >= 0" for c in ["ClaimNb", "SeverityRowCount"]},
    "ClaimCountMatch is zero or one": "ClaimCountMatch IN (0, 1)",
}
METADATA_RULES = {f"{c} is present": f"{c} IS NOT NULL" for c in ["MetadataKey", "MetadataValue"]}
TABLE_RULES = {
    "policies": POLICY_RULES,
    "claims": {"ClaimID is present": "ClaimID IS NOT NULL", **CLAIM_RULES},
    "orphan_claims": {"OrphanClaimID is present": "OrphanClaimID IS NOT NULL", **CLAIM_RULES},
    "claim_count_issues": ISSUE_RULES,
    "database_metadata": METADATA_RULES,
}
TABLE_KEYS = {
    "policies": "IDpol", "claims": "ClaimID", "orphan_claims": "OrphanClaimID",
    "claim_count_issues": "IDpol", "database_metadata": "MetadataKey",
}


def missing_columns(df: DataFrame, expected: list[str]) -> list[str]:
    return sorted(set(expected) - set(df.columns))


def unexpected_columns(df: DataFrame, expected: list[str]) -> list[str]:
    return sorted(set(df.columns) - set(expected))


def require_columns(df: DataFrame, expected: list[str], what: str) -> DataFrame:
    absent = missing_columns(df, expected)
    if absent:
        raise ValueError(f"{what} lacks the columns {absent}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def column_report(df: DataFrame, expected: list[str]) -> DataFrame:
    """Each expected or found column: its type, status, and the rows with a value."""
    found = dict(df.dtypes)
    names = [*df.columns, *missing_columns(df, expected)]
    row = df.agg(
        F.count("*").alias("Rows"), *[F.count(c).alias(c) for c in df.columns]
    )
    structs = [
        F.struct(
            F.lit(c).alias("Column"),
            F.lit(found.get(c, "")).alias("DataType"),
            F.lit(
                "missing" if c not in found else "expected" if c in expected else "unexpected"
            ).alias("Status"),
            (F.col(c) if c in found else F.lit(0)).cast("bigint").alias("Present"),
            F.col("Rows"),
        )
        for c in names
    ]
    return row.select(F.explode(F.array(*structs)).alias("c")).select("c.*")


def duplicate_ids(df: DataFrame, key: str = "IDpol") -> DataFrame:
    """Keys on more than one row."""
    return (
        df.groupBy(key).agg(F.count("*").alias("RowCount")).filter("RowCount > 1")
    )


def require_unique(df: DataFrame, what: str, key: str = "IDpol") -> DataFrame:
    repeated = duplicate_ids(df, key).count()
    if repeated:
        raise ValueError(f"{what} has {repeated} repeated values of {key}")
    return df


def one_per_key(df: DataFrame, what: str, key: str = "IDpol") -> DataFrame:
    """The same rows, lazily; the plan raises as soon as it meets a repeated key.

    For the sides of a one-to-one join: the rows are dealt and ordered by the key as the
    join wants them, so the guard is no pass of its own.
    """
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    repeated = F.raise_error(
        F.concat(F.lit(f"{what} has repeated values of {key}: "), F.col(key).cast("string")))
    return df.withColumn("_nth", nth).filter(
        F.when(F.col("_nth") > 1, repeated.cast("boolean")).otherwise(True)).drop("_nth")


def violations(df: DataFrame, table: str, rules: dict[str, str]) -> DataFrame:
    """Rows breaking each rule, in one pass. Like a CHECK, unknown breaks no rule,
    except that a rule of presence is never unknown."""
    row = df.agg(*[
        count_if(~F.coalesce(F.expr(rule), F.lit(True))).alias(f"r{i}")
        for i, rule in enumerate(rules.values())
    ])
    measures = [(name, F.col(f"r{i}")) for i, name in enumerate(rules)]
    return long_report(row, ("Rule", "Violations"), measures).select(
        F.lit(table).alias("TableName"), "Rule", "Violations"
    )


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Key values on more than one row, per table, from one grouped pass over all keys."""
    keys = stacked([
        tables[name].select(F.lit(name).alias("TableName"), F.col(key).cast("string").alias("_key"))
        for name, key in TABLE_KEYS.items()])
    repeated = keys.groupBy("TableName", "_key").agg(F.count("*").alias("n")).groupBy("TableName").agg(
        count_if((F.col("n") > 1) & F.col("_key").isNotNull()).alias("n"))
    row = repeated.groupBy().pivot("TableName", list(TABLE_KEYS)).agg(F.first("n"))
    return stacked([
        row.select(F.lit(name).alias("TableName"), F.lit(f"{key} is unique").alias("Rule"),
                   F.coalesce(name, F.lit(0)).cast("bigint").alias("Violations"))
        for name, key in TABLE_KEYS.items()])


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """All constraints of the five relational tables: columns and keys."""
    return stacked([
        *[violations(tables[name], name, rules) for name, rules in TABLE_RULES.items()],
        key_violations(tables)])


def foreign_key_violations(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Claims per id that no policy has; counted first, so no id is hot. The policies' ids
    are not broadcast, as in reconcile.known_claims."""
    counts = claims.groupBy("IDpol").agg(F.count("*").alias("ClaimRows"))
    return counts.join(policies.select("IDpol").hint("merge"), "IDpol", "left_anti")


def _passed(row: DataFrame, checks: list[tuple]) -> DataFrame:
    return long_report(row, ("Validation", "Passed"), checks)


def _unique_check(df: DataFrame) -> DataFrame:
    row = duplicate_ids(df).agg(F.count("*").alias("n"))
    return _passed(row, [("Policy IDs are unique", F.col("n") == 0)])


def preparation_checks(policy: DataFrame, audit: DataFrame) -> DataFrame:
    """The five named checks of the prepared tables."""
    facts = policy.agg(
        count_if(~F.coalesce(F.expr("Exposure > 0"), F.lit(False))).alias("exposure"),
        count_if(~F.coalesce(F.expr("ClaimNb >= 0"), F.lit(False))).alias("claims"),
        count_if(
            ~F.coalesce(F.expr("AnnualizedClaimFrequency >= 0"), F.lit(False))
        ).alias("frequency"),
    )
    open_rows = audit.agg(count_if(F.col("AuditStatus") == V.UNCLASSIFIED).alias("n"))
    return stacked([
        _unique_check(policy),
        _passed(facts, [
            ("All exposure values are positive", F.col("exposure") == 0),
            ("All claim counts are non-negative", F.col("claims") == 0),
            ("Annualized frequency is non-negative", F.col("frequency") == 0),
        ]),
        _passed(open_rows, [("No audit rows are unclassified", F.col("n") == 0)]),
    ])


def output_checks(policy: DataFrame, audit: DataFrame) -> DataFrame:
    """The gate before prepared tables are written."""
    zero = "ClaimNb = 0 AND ClaimCountMatch"
    facts = policy.agg(
        count_if(F.expr("Exposure <= 0")).alias("exposure"),
        count_if(
            F.expr("NOT ClaimCountMatch AND CompleteTotalClaimAmount IS NOT NULL")
        ).alias("incomplete"),
        count_if(
            F.expr(f"{zero} AND NOT coalesce(CompleteTotalClaimAmount = 0, false)")
        ).alias("zero"),
    )
    open_rows = audit.agg(count_if(F.col("AuditStatus") == V.UNCLASSIFIED).alias("n"))
    return stacked([
        _unique_check(policy),
        _passed(facts, [
            ("Exposure is positive", F.col("exposure") == 0),
            ("Incomplete policies carry no complete amount", F.col("incomplete") == 0),
            ("Complete zero-claim policies have amount zero", F.col("zero") == 0),
        ]),
        _passed(open_rows, [("No audit rows are unclassified", F.col("n") == 0)]),
    ])


def analysis_checks(policy: DataFrame) -> DataFrame:
    """The seven named checks before exploration."""
    facts = policy.agg(
        count_if(~F.coalesce(F.expr("Exposure > 0"), F.lit(False))).alias("exposure"),
        count_if(~F.coalesce(F.expr("ClaimNb >= 0"), F.lit(False))).alias("claims"),
        count_if(~F.coalesce(F.expr("HasClaim IN (0, 1)"), F.lit(False))).alias("flag"),
        count_if(~F.col("FrequencyModelEligible").cast("boolean")).alias("frequency"),
        count_if(F.col("SeverityModelEligible").cast("boolean")).alias("severity"),
        count_if(F.col("PurePremiumModelEligible").cast("boolean")).alias("premium"),
    )
    return stacked([
        _unique_check(policy),
        _passed(facts, [
            ("Exposure is positive", F.col("exposure") == 0),
            ("Claim counts are non-negative", F.col("claims") == 0),
            ("HasClaim contains only zero and one", F.col("flag") == 0),
            ("Frequency model eligibility is complete", F.col("frequency") == 0),
            ("Severity model sample is non-empty", F.col("severity") > 0),
            ("Pure premium model sample is non-empty", F.col("premium") > 0),
        ]),
    ])


def enforce(checks: DataFrame) -> None:
    """Raises when any check of a pass/fail table did not pass."""
    failed = [r["Validation"] for r in checks.filter("NOT Passed").collect()]
    if failed:
        raise ValueError(f"Checks that did not pass: {failed}")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    return stacked([
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ])


def require_counts(tables: dict[str, DataFrame], expected: dict[str, int]) -> None:
    """Raises when a table does not hold the expected number of rows."""
    found = {r["table_name"]: r["row_count"] for r in table_counts(tables).collect()}
    wrong = {n: (found.get(n), e) for n, e in expected.items() if found.get(n) != e}
    if wrong:
        raise ValueError(f"Row counts (found, expected) differ: {wrong}")


def problem_counts(df: DataFrame, problems: dict[str, str]) -> DataFrame:
    """Rows showing each named problem, from one pass."""
    row = df.agg(*[count_if(F.expr(rule)).alias(name) for name, rule in problems.items()])
    return long_report(row, ("Problem", "Rows"), [(name, F.col(name)) for name in problems])


def require_none(df: DataFrame, problems: dict[str, str], what: str) -> DataFrame:
    """Raises when any row shows one of the named problems."""
    bad = {r["Problem"]: r["Rows"] for r in problem_counts(df, problems).collect() if r["Rows"]}
    if bad:
        raise ValueError(f"{what} is unfit for modelling: {bad}")
    return df
