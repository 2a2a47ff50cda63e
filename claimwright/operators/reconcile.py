"""Reconciliation of policies with claims, and the policy-level fact."""

from pyspark.sql import Column, DataFrame, functions as F

from claimwright import vocabulary as V
from claimwright.functions.casting import strict_long, strict_truth
from claimwright.functions.measures import ratio
from claimwright.session import stage


def severity_by_policy(claims: DataFrame) -> DataFrame:
    """Claims to one row per policy; partial aggregates absorb a hot policy."""
    amount = F.col("ClaimAmount")
    return claims.groupBy("IDpol").agg(
        F.count("*").alias("SeverityRowCount"),
        F.sum(amount).alias("SeverityTotalClaimAmount"),
        F.avg(amount).alias("SeverityAverageClaimAmount"),
        F.min(amount).alias("SeverityMinimumClaimAmount"),
        F.max(amount).alias("SeverityMaximumClaimAmount"),
    )


def claim_counts(claims: DataFrame) -> DataFrame:
    """Claim rows per policy."""
    return claims.groupBy("IDpol").agg(F.count("*").alias("SeverityRowCount"))


def _status(unmatched: Column | None) -> Column:
    """First rule that fits names the status."""
    rules = [
        ("ClaimNb = 0 AND SeverityRowCount = 0", V.NO_CLAIM),
        ("ClaimNb > 0 AND SeverityRowCount = 0", V.NO_SEVERITY),
        ("ClaimNb > 0 AND ClaimNb = SeverityRowCount", V.MATCHED),
        ("SeverityRowCount < ClaimNb", V.FEWER),
        ("SeverityRowCount > ClaimNb", V.MORE),
    ]
    status = F.when(unmatched, V.ORPHAN) if unmatched is not None else F
    for rule, name in rules:
        status = status.when(F.expr(rule), name)
    return status.otherwise(V.UNCLASSIFIED)


def outer_counts(policies: DataFrame, counts: DataFrame) -> DataFrame:
    """Ids of either table with both counts and the side they came from.

    Claims come counted per id, so no id is hot in the join.
    """
    left = policies.select("IDpol", "ClaimNb", F.lit(True).alias("_left"))
    right = counts.select("IDpol", "SeverityRowCount", F.lit(True).alias("_right"))
    return left.join(right, "IDpol", "full_outer").select(
        "IDpol",
        F.coalesce("ClaimNb", F.lit(0)).cast("bigint").alias("ClaimNb"),
        F.coalesce("SeverityRowCount", F.lit(0)).cast("bigint").alias("SeverityRowCount"),
        F.when(F.col("_right").isNull(), "left_only")
        .when(F.col("_left").isNull(), "right_only")
        .otherwise("both")
        .alias("_merge"),
    )


def claim_count_audit(policies: DataFrame, counts: DataFrame) -> DataFrame:
    """Every id of either table with its counts, difference and audit status.

    `counts` holds claim rows per id, as severity_by_policy or claim_counts gives them.
    """
    return outer_counts(policies, counts).withColumns(
        {
            "ClaimCountDifference": F.expr("ClaimNb - SeverityRowCount"),
            "ClaimCountMatch": F.expr("ClaimNb = SeverityRowCount"),
            "AuditStatus": _status(F.col("_merge") == "right_only"),
        }
    )


def policy_analytics(policies: DataFrame, by_policy: DataFrame) -> DataFrame:
    """The policy-level fact: counts, amounts, completeness and eligibility.

    An unknown loss is NULL and a known absence of loss is 0; only policies whose
    counts agree carry complete amounts.
    """
    joined = policies.join(by_policy, "IDpol", "left").withColumns(
        {
            "SeverityRowCount": F.coalesce("SeverityRowCount", F.lit(0)).cast("bigint"),
            "SeverityTotalClaimAmount": F.coalesce("SeverityTotalClaimAmount", F.lit(0.0)),
        }
    )
    total, rows = F.col("SeverityTotalClaimAmount"), F.col("SeverityRowCount")
    match = F.col("ClaimCountMatch")
    derived = joined.withColumns(
        {
            "HasClaim": (F.col("ClaimNb") > 0).cast("int"),
            "HasSeverityRecord": (rows > 0).cast("int"),
            "ClaimCountDifference": F.col("ClaimNb") - rows,
            "ClaimCountMatch": F.col("ClaimNb") == rows,
            "SeverityCompletenessStatus": _status(None),
            "AnnualizedClaimFrequency": ratio(F.col("ClaimNb"), F.col("Exposure")),
            "ObservedAverageClaimAmount": ratio(total, rows),
        }
    )
    eligible = F.expr(
        "ClaimNb > 0 AND ClaimCountMatch AND ObservedAverageClaimAmount IS NOT NULL"
    )
    return derived.withColumns(
        {
            "CompleteTotalClaimAmount": F.when(match, total),
            "CompleteAverageClaimAmount": F.when(eligible, ratio(total, F.col("ClaimNb"))),
            "CompletePurePremium": F.when(match, ratio(total, F.col("Exposure"))),
            "FrequencyModelEligible": F.lit(True),
            "SeverityModelEligible": eligible,
            "PurePremiumModelEligible": match,
        }
    )


# --- relational layer -----------------------------------------------------


def policies_table(policy: DataFrame) -> DataFrame:
    """The 31 typed policy columns, flags as 0/1. A bad count or flag raises."""
    columns = []
    for name in V.POLICY_COLUMNS:
        if name in V.POLICY_FLAGS:
            column = strict_truth(policy, name).cast("int")
        elif name in V.POLICY_COUNTS:
            column = strict_long(name)
        else:
            column = F.col(name)
        columns.append(column.alias(name))
    return policy.select(*columns)


def known_claims(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Each claim with `Known`: whether its policy is known. The claims are read twice.

    Claims are counted per id and the counts written once. An id with more than an even
    share of all claims is hot; there are fewer such ids than partitions, so these are looked
    up first and broadcast. A claim of a hot id takes its answer from there and, for the
    join that answers for the others, is dealt by the partition it came from. The policies'
    ids grow with the input and are never broadcast, however small the plan takes them to be.
    """
    spark = claims.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = policies.select("IDpol").distinct().withColumn("_known", F.lit(True)).hint("merge")
    counts = stage(claim_counts(claims), "claim-counts")
    total = counts.agg(F.sum("SeverityRowCount")).first()[0] or 0
    hot = counts.filter(F.col("SeverityRowCount") * shares > F.lit(total)).join(
        known, "IDpol", "left").select("IDpol", F.coalesce("_known", F.lit(False)).alias("_hot"))
    dealt = claims.select("IDpol", "ClaimAmount").join(F.broadcast(hot), "IDpol", "left").withColumn(
        "_lane", F.when(F.col("_hot").isNull(), -1).otherwise(F.spark_partition_id()))
    return dealt.join(known.withColumn("_lane", F.lit(-1)), ["IDpol", "_lane"], "left").select(
        "IDpol", "ClaimAmount",
        F.coalesce("_hot", "_known", F.lit(False)).alias("Known"))


def matched_claims(known: DataFrame) -> DataFrame:
    """Claims of a known policy, from known_claims."""
    return known.filter("Known").drop("Known")


def orphan_claims(known: DataFrame) -> DataFrame:
    """Claims without a known policy, from known_claims."""
    return known.filter("NOT Known").drop("Known")


def claim_count_issues(audit: DataFrame) -> DataFrame:
    """Ids whose two counts disagree, typed for the relational layer."""
    return (
        audit.withColumn("ClaimCountMatch", strict_truth(audit, "ClaimCountMatch").cast("int"))
        .filter("ClaimCountMatch = 0")
        .withColumnRenamed("_merge", "SourceStatus")
        .select(
            *[
                strict_long(c).alias(c) if c in V.POLICY_COUNTS else F.col(c)
                for c in V.ISSUE_COLUMNS
            ]
        )
    )


def unknown_claim_ids(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Distinct claim ids that no policy has (a missing id is one of them); the policies' ids
    are not broadcast, as in known_claims."""
    return claims.select("IDpol").distinct().join(
        policies.select("IDpol").distinct().hint("merge"), "IDpol", "left_anti"
    )
