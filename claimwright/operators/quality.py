"""Data-quality reports on the raw tables and on the preparation run."""

from pyspark.sql import DataFrame, functions as F

from claimwright import vocabulary as V
from claimwright.functions.casting import holds, lenient_double, lenient_long, whole
from claimwright.functions.measures import count_if, percent, ratio
from claimwright.operators.portfolio import with_share_of_many
from claimwright.operators.ranking import quantile_table
from claimwright.operators.reconcile import claim_counts, outer_counts
from claimwright.operators.shaping import long_report, stacked


def typed(raw: DataFrame) -> DataFrame:
    """A raw table with its numbers parsed and its texts as they are.

    Ids are whole numbers, so that those beyond 2^53 stay apart.
    """
    numbers = {*V.FREQUENCY_NUMBERS, "ClaimAmount"}
    return raw.select(*[
        (lenient_long(raw, c) if c == "IDpol" else lenient_double(raw, c) if c in numbers
         else F.col(c)).alias(c)
        for c in raw.columns
    ])


def missing_values(df: DataFrame) -> DataFrame:
    """Missing count and percentage per column, most first; one aggregation."""
    row = df.agg(
        F.count("*").alias("_rows"),
        *[count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    return (
        long_report(
            row, ("column_name", "pair"),
            [(c, F.struct(F.col(c).alias("n"), percent(F.col(c), F.col("_rows")).alias("p")))
             for c in df.columns],
        )
        .select("column_name", F.col("pair.n").alias("missing_count"),
                F.col("pair.p").alias("missing_percentage"))
        .orderBy(F.desc("missing_count"), "column_name")
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column."""
    row = df.agg(*[
        F.struct(
            F.count(c).alias("count"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ).alias(c)
        for c in columns
    ])
    moments = long_report(row, ("Variable", "s"), [(c, F.col(c)) for c in columns])
    quartiles = quantile_table(df, columns, [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")])
    wide = quartiles.groupBy("Variable").agg(*[
        F.max(F.when(F.col("Point") == p, F.col("Value"))).alias(p) for p in ("p25", "p50", "p75")
    ])
    return moments.join(wide, "Variable", "left").select(
        "Variable", "s.count", "s.mean", "s.std", "s.min", "p25", "p50", "p75", "s.max"
    )


def review_percentiles(frequency: DataFrame, severity: DataFrame) -> DataFrame:
    """Nine percentiles of five policy variables and of the claim amount."""
    policy = quantile_table(
        frequency, ["Exposure", "VehAge", "DrivAge", "BonusMalus", "Density"], V.REVIEW_POINTS)
    return policy.unionByName(quantile_table(severity, ["ClaimAmount"], V.REVIEW_POINTS))


def claim_count_values(frequency: DataFrame) -> DataFrame:
    """Policies per exact claim count, a missing count included."""
    groups = frequency.groupBy("ClaimNb").agg(F.count("*").alias("PolicyCount"))
    return with_share_of_many(
        groups.withColumn("_part", F.lit(0)), "PolicyCount", "Percentage", "_part"
    ).drop("_part").orderBy("ClaimNb")


def category_values(frequency: DataFrame) -> DataFrame:
    """Rows per value of the four text columns, from one scan."""
    pairs = frequency.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("ColumnName"), F.col(c).alias("Value"))
        for c in V.FREQUENCY_TEXTS
    ])).alias("p")).select("p.*")
    groups = pairs.groupBy("ColumnName", "Value").agg(F.count("*").alias("Count"))
    return with_share_of_many(groups, "Count", "Percentage", "ColumnName").select(
        "ColumnName", "Value", "Count", "Percentage").orderBy(
        "ColumnName", F.desc("Count"), "Value")


def validity_checks(frequency: DataFrame, severity: DataFrame) -> DataFrame:
    """Twelve named checks and the rows failing each. A missing claim count is not
    a whole number; every comparison with a missing value fails no check."""
    c = F.col
    policy = frequency.agg(
        count_if(c("IDpol").isNull()).alias("a"),
        count_if(holds(c("IDpol") <= 0)).alias("b"),
        count_if(holds(c("ClaimNb") < 0)).alias("c"),
        count_if(~whole(c("ClaimNb"))).alias("d"),
        count_if(holds(c("Exposure") <= 0)).alias("e"),
        count_if(holds(c("VehAge") < 0)).alias("f"),
        count_if(holds(c("DrivAge") < 0)).alias("g"),
        count_if(holds(c("BonusMalus") < 0)).alias("h"),
        count_if(holds(c("Density") <= 0)).alias("i"),
    )
    claim = severity.agg(
        count_if(c("IDpol").isNull()).alias("a"),
        count_if(holds(c("IDpol") <= 0)).alias("b"),
        count_if(holds(c("ClaimAmount") <= 0)).alias("c"),
    )
    names = ("Check", "IssueCount")
    return stacked([
        long_report(policy, names, [
            ("Missing frequency policy IDs", c("a")),
            ("Non-positive frequency policy IDs", c("b")),
            ("Negative claim counts", c("c")),
            ("Non-integer claim counts", c("d")),
            ("Non-positive exposure", c("e")),
            ("Negative vehicle ages", c("f")),
            ("Negative driver ages", c("g")),
            ("Negative bonus-malus values", c("h")),
            ("Non-positive density", c("i")),
        ]),
        long_report(claim, names, [
            ("Missing severity policy IDs", c("a")),
            ("Non-positive severity policy IDs", c("b")),
            ("Non-positive claim amounts", c("c")),
        ]),
    ])


def raw_consistency(frequency: DataFrame, severity: DataFrame) -> DataFrame:
    """Raw ids of either table with their counts and difference.

    A count too large for a whole number counts as missing.
    """
    whole_counts = frequency.withColumn("ClaimNb", F.col("ClaimNb").try_cast("bigint"))
    return outer_counts(whole_counts, claim_counts(severity)).withColumn(
        "CountDifference", F.expr("ClaimNb - SeverityRowCount"))


def mismatches(consistency: DataFrame) -> DataFrame:
    return consistency.filter("CountDifference <> 0")


def _consistency_counts(consistency: DataFrame) -> DataFrame:
    return consistency.agg(
        count_if(F.expr("CountDifference <> 0")).alias("mismatched"),
        count_if(F.expr("ClaimNb > 0 AND SeverityRowCount = 0")).alias("silent"),
        count_if(F.expr("_merge = 'right_only'")).alias("orphan"),
        count_if(F.expr("SeverityRowCount > ClaimNb")).alias("more"),
        count_if(F.expr("SeverityRowCount < ClaimNb")).alias("fewer"),
    )


def consistency_summary(frequency: DataFrame, severity: DataFrame) -> DataFrame:
    names = ("Measure", "Count")
    reported = frequency.agg(F.sum("ClaimNb").cast("bigint").alias("n"))
    rows = severity.agg(F.count("*").alias("n"))
    counts = _consistency_counts(raw_consistency(frequency, severity))
    return stacked([
        long_report(reported, names, [("Claims reported in frequency table", F.col("n"))]),
        long_report(rows, names, [("Claim rows in severity table", F.col("n"))]),
        long_report(counts, names, [
            ("Policies with count mismatches", F.col("mismatched")),
            ("Claim policies without severity records", F.col("silent")),
            ("Severity policies without frequency records", F.col("orphan")),
            ("Policies with more severity rows than ClaimNb", F.col("more")),
            ("Policies with fewer severity rows than ClaimNb", F.col("fewer")),
        ]),
    ])


def _repeat_facts(df: DataFrame) -> DataFrame:
    """Distinct ids, rows repeating an earlier id, and rows repeating an earlier row.

    Equal rows are counted first and their counts added up per id, so the table is
    read once and a hot id or row is one group. A missing id is one value.
    """
    equal = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    per_id = equal.groupBy("IDpol").agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_again"))
    return per_id.agg(
        F.count("IDpol").alias("ids"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("id_repeats"),
        F.coalesce(F.sum("_again"), F.lit(0)).alias("row_repeats"),
    )


def duplicate_report(frequency: DataFrame, severity: DataFrame) -> DataFrame:
    names = ("Measure", "Count")
    return stacked([
        long_report(_repeat_facts(frequency), names, [
            ("Frequency duplicate rows", F.col("row_repeats")),
            ("Duplicate policy IDs in frequency", F.col("id_repeats")),
            ("Unique frequency policy IDs", F.col("ids")),
        ]),
        long_report(_repeat_facts(severity), names, [
            ("Severity duplicate rows", F.col("row_repeats")),
            ("Unique severity policy IDs", F.col("ids")),
        ]),
    ])


def _missing_total(df: DataFrame, *more) -> DataFrame:
    total = F.lit(0)
    for c in df.columns:
        total = total + count_if(F.col(c).isNull())
    return df.agg(F.count("*").alias("rows"), total.cast("bigint").alias("missing"), *more)


def quality_summary(frequency: DataFrame, severity: DataFrame) -> DataFrame:
    """Eighteen measures of the raw tables as one long report."""
    names = ("Measure", "Value")

    def rows(table, measures):
        return long_report(table, names, [(n, c.cast("double")) for n, c in measures])

    claims = _missing_total(
        frequency,
        count_if(holds(F.col("ClaimNb") > 0)).alias("with"),
        count_if(holds(F.col("ClaimNb") == 0)).alias("without"),
        F.sum("ClaimNb").cast("bigint").alias("reported"),
    )
    return stacked([
        rows(claims, [
            ("Frequency rows", F.col("rows")),
            ("Frequency columns", F.lit(len(frequency.columns))),
            ("Missing values in frequency", F.col("missing")),
            ("Policies with claims", F.col("with")),
            ("Policies without claims", F.col("without")),
            ("Observed policy claim rate", ratio(F.col("with"), F.col("rows"))),
            ("Claims reported in frequency table", F.col("reported")),
        ]),
        rows(_missing_total(severity), [
            ("Severity rows", F.col("rows")),
            ("Severity columns", F.lit(len(severity.columns))),
            ("Missing values in severity", F.col("missing")),
            ("Claim rows in severity table", F.col("rows")),
        ]),
        rows(_repeat_facts(frequency), [
            ("Unique frequency policy IDs", F.col("ids")),
            ("Duplicate policy IDs in frequency", F.col("id_repeats")),
            ("Frequency duplicate rows", F.col("row_repeats")),
        ]),
        rows(_repeat_facts(severity), [
            ("Unique severity policy IDs", F.col("ids")),
            ("Severity duplicate rows", F.col("row_repeats")),
        ]),
        # A claim id without a policy is a row of the right side only.
        rows(_consistency_counts(raw_consistency(frequency, severity)), [
            ("Policies with claim-count mismatches", F.col("mismatched")),
            ("Severity policy IDs missing from frequency", F.col("orphan")),
        ]),
    ])


def preparation_summary(frequency: DataFrame, severity: DataFrame, audit: DataFrame) -> DataFrame:
    """Seventeen measures of a preparation run, from the cleaned tables and the audit.

    Policy-level measures are read off the audit rows that have a policy, which are
    the same rows; the fact table need not be joined once more.
    """
    names = ("Measure", "Value")
    missing_f, missing_s = (
        sum((count_if(F.col(c).isNull()) for c in df.columns), F.lit(0)).cast("bigint")
        for df in (frequency, severity)
    )
    valid = F.col("CorePolicyRecordValid")
    policies = frequency.agg(
        F.count("*").alias("rows"), count_if(valid).alias("valid"),
        count_if(~valid).alias("invalid"), missing_f.alias("missing"),
        F.coalesce(F.sum(F.when(valid, F.col("ClaimNb"))), F.lit(0)).alias("reported"),
    )
    usable = F.col("SeverityRecordValid")
    claims = severity.agg(
        F.count("*").alias("rows"), count_if(usable).alias("valid"),
        count_if(~usable).alias("invalid"), missing_s.alias("missing"),
    )
    known = F.expr("_merge <> 'right_only'")
    match = F.col("ClaimCountMatch")
    ids = audit.agg(
        count_if(~match).alias("mismatched"),
        count_if(F.col("AuditStatus") == V.ORPHAN).alias("orphans"),
        count_if(known & ~match).alias("policy_mismatches"),
        count_if(known).alias("policies"),
        count_if(known & match & (F.col("ClaimNb") > 0)).alias("severity"),
        count_if(known & match).alias("premium"),
    )
    c = F.col
    return stacked([
        long_report(policies, names, [
            ("Raw frequency rows", c("rows")),
            ("Valid frequency rows", c("valid")),
            ("Invalid core frequency rows", c("invalid")),
            ("Cleaned frequency missing values", c("missing")),
            ("Claims reported by ClaimNb", c("reported")),
        ]),
        long_report(claims, names, [
            ("Raw severity rows", c("rows")),
            ("Valid severity rows", c("valid")),
            ("Invalid severity rows", c("invalid")),
            ("Cleaned severity missing values", c("missing")),
            ("Valid severity claim rows", c("valid")),
        ]),
        long_report(ids, names, [
            ("Cross-table mismatched policy IDs", c("mismatched")),
            ("Severity IDs without frequency record", c("orphans")),
            ("Frequency policies with count mismatch", c("policy_mismatches")),
            ("Final policy analytics rows", c("policies")),
            ("Frequency-model eligible policies", c("policies")),
            ("Severity-model eligible policies", c("severity")),
            ("Pure-premium-model eligible policies", c("premium")),
        ]),
    ])
