"""Portfolio and segment indicators: totals first, ratios of totals after."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright import vocabulary as V
from claimwright.functions.bands import case_band, claim_count_group
from claimwright.functions.measures import count_if, percent, ratio, sum_if
from claimwright.operators.shaping import long_report

KPIS = [
    "total_policies", "total_exposure_years", "total_reported_claims", "policies_with_claims",
    "claim_occurrence_rate", "claim_frequency", "claims_per_100_exposure_years",
    "complete_loss_policies", "complete_claim_cost", "average_claim_severity", "pure_premium",
]
KPI_TEXTS = {
    "total_policies": ("Total policies", "Number of policies"),
    "total_exposure_years": ("Total exposure years", "Combined observed coverage period"),
    "total_reported_claims": ("Total reported claims", "Sum of ClaimNb"),
    "policies_with_claims": (
        "Policies with at least one claim", "Policies where ClaimNb is greater than zero"),
    "claim_occurrence_rate": (
        "Claim occurrence rate", "Policies with claims divided by all policies"),
    "claim_frequency": ("Claim frequency", "Claims divided by exposure"),
    "claims_per_100_exposure_years": (
        "Claims per 100 exposure-years", "Claim frequency multiplied by 100"),
    "complete_loss_policies": (
        "Complete loss policies", "Policies with complete frequency and severity outcomes"),
    "complete_claim_cost": ("Complete claim cost", "Claim cost among complete policies"),
    "average_claim_severity": (
        "Average claim severity", "Complete positive claim cost divided by complete claims"),
    "pure_premium": ("Pure premium", "Complete claim cost divided by complete exposure"),
}


def _flag(name: str) -> Column:
    return F.col(name).cast("boolean")


def totals() -> list[Column]:
    """The ten conditional totals every indicator is made of."""
    complete, positive = _flag("PurePremiumModelEligible"), _flag("SeverityModelEligible")
    cost = F.col("CompleteTotalClaimAmount")
    return [
        F.count("*").alias("Policies"),
        F.sum("Exposure").alias("Exposure"),
        F.sum("ClaimNb").alias("Claims"),
        F.sum(F.col("HasClaim").cast("bigint")).alias("PoliciesWithClaim"),
        count_if(complete).alias("CompleteLossPolicies"),
        sum_if(complete, F.col("Exposure")).alias("CompleteLossExposure"),
        sum_if(complete, cost).alias("CompleteClaimCost"),
        count_if(positive).alias("CompletePositivePolicies"),
        F.coalesce(F.sum(F.when(positive, F.col("ClaimNb"))), F.lit(0)).cast("bigint").alias(
            "CompletePositiveClaims"),
        sum_if(positive, cost).alias("CompletePositiveClaimCost"),
    ]


def _ratios() -> dict[str, Column]:
    c = F.col
    return {
        "ClaimOccurrenceRate": ratio(c("PoliciesWithClaim"), c("Policies")),
        "ClaimFrequency": ratio(c("Claims"), c("Exposure")),
        "ClaimsPer100ExposureYears": percent(c("Claims"), c("Exposure")),
        "AverageClaimSeverity": ratio(
            c("CompletePositiveClaimCost"), c("CompletePositiveClaims")),
        "PurePremium": ratio(c("CompleteClaimCost"), c("CompleteLossExposure")),
        "CompleteLossPercentage": percent(c("CompleteLossPolicies"), c("Policies")),
    }


def segment_summary(policy: DataFrame, *by: str) -> DataFrame:
    """Ten totals and six ratios per group; a missing group value is a group."""
    return policy.groupBy(*by).agg(*totals()).withColumns(_ratios())


def portfolio_kpis(policy: DataFrame) -> DataFrame:
    """The eleven portfolio indicators in one row, from one aggregation."""
    return segment_summary(policy).select(
        F.col("Policies").alias("total_policies"),
        F.col("Exposure").alias("total_exposure_years"),
        F.col("Claims").alias("total_reported_claims"),
        F.col("PoliciesWithClaim").alias("policies_with_claims"),
        F.col("ClaimOccurrenceRate").alias("claim_occurrence_rate"),
        F.col("ClaimFrequency").alias("claim_frequency"),
        F.col("ClaimsPer100ExposureYears").alias("claims_per_100_exposure_years"),
        F.col("CompleteLossPolicies").alias("complete_loss_policies"),
        F.col("CompleteClaimCost").alias("complete_claim_cost"),
        F.col("AverageClaimSeverity").alias("average_claim_severity"),
        F.col("PurePremium").alias("pure_premium"),
    )


def portfolio_summary(policy: DataFrame) -> DataFrame:
    """The same indicators in long form with their definitions."""
    row = portfolio_kpis(policy)
    rows = [
        F.struct(
            F.lit(KPI_TEXTS[k][0]).alias("Metric"), F.col(k).cast("double").alias("Value"),
            F.lit(KPI_TEXTS[k][1]).alias("Definition"),
        )
        for k in KPIS
    ]
    return row.select(F.explode(F.array(*rows)).alias("k")).select("k.*")


def kpi_reconciliation(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two KPI rows compared by metric, within 1e-6 + 1e-9 of the second value."""
    def long(row: DataFrame, name: str) -> DataFrame:
        return long_report(
            row, ("Metric", name), [(k, F.col(k).cast("double")) for k in KPIS])

    difference = F.abs(F.col("DataFrameValue") - F.col("SQLValue"))
    return (
        long(left, "DataFrameValue").join(long(right, "SQLValue"), "Metric")
        .withColumn("AbsoluteDifference", difference)
        .withColumn("Passed", difference <= 1e-6 + 1e-9 * F.abs(F.col("SQLValue")))
    )


def area_metrics(policy: DataFrame) -> DataFrame:
    return segment_summary(policy, "Area").select(
        "Area",
        F.col("Policies").alias("policies"),
        F.col("Exposure").alias("exposure"),
        F.col("Claims").alias("claims"),
        F.col("PoliciesWithClaim").alias("policies_with_claim"),
        F.col("ClaimOccurrenceRate").alias("claim_occurrence_rate"),
        F.col("ClaimFrequency").alias("claim_frequency"),
        F.col("ClaimsPer100ExposureYears").alias("claims_per_100_exposure_years"),
        F.col("AverageClaimSeverity").alias("average_claim_severity"),
        F.col("PurePremium").alias("pure_premium"),
        F.col("CompleteLossPercentage").alias("complete_loss_percentage"),
    )


def area_ranking(policy: DataFrame) -> DataFrame:
    """Areas by claim frequency, highest first."""
    return (
        area_metrics(policy)
        .select("Area", "policies", "exposure", "claims", "claims_per_100_exposure_years")
        .orderBy(F.desc("claims_per_100_exposure_years"), "Area")
    )


def _band_metrics(policy: DataFrame, source: str, edges, labels, name: str) -> DataFrame:
    order = case_band(F.col(source), edges, list(range(1, len(labels) + 1)))
    return (
        segment_summary(
            policy.withColumns({
                name: case_band(F.col(source), edges, labels), "sort_order": order}),
            name, "sort_order",
        )
        .orderBy("sort_order")
        .select(
            name,
            F.col("Policies").alias("policies"),
            F.col("Exposure").alias("exposure"),
            F.col("Claims").alias("claims"),
            F.col("ClaimsPer100ExposureYears").alias("claims_per_100_exposure_years"),
            F.col("AverageClaimSeverity").alias("average_claim_severity"),
            F.col("PurePremium").alias("pure_premium"),
        )
    )


def driver_age_metrics(policy: DataFrame) -> DataFrame:
    return _band_metrics(
        policy, "DrivAge", V.DRIVER_AGE_EDGES, V.DRIVER_AGE_LABELS, "driver_age_band")


def bonus_malus_metrics(policy: DataFrame) -> DataFrame:
    return _band_metrics(
        policy, "BonusMalus", V.BONUS_MALUS_EDGES, V.BONUS_MALUS_LABELS, "bonus_malus_band",
    ).drop("average_claim_severity")


def top_regions(policy: DataFrame, least_exposure: float = V.REGION_EXPOSURE, rows: int = 10):
    """Regions by pure premium among those with enough complete exposure."""
    return (
        segment_summary(policy, "Region")
        .filter(F.col("CompleteLossExposure") >= least_exposure)
        .select(
            "Region",
            F.col("Policies").alias("policies"),
            F.col("CompleteLossExposure").alias("complete_loss_exposure"),
            F.col("PurePremium").alias("pure_premium"),
        )
        .orderBy(F.desc("pure_premium"), "Region")
        .limit(rows)
    )


def largest_losses(policy: DataFrame, rows: int = 20) -> DataFrame:
    """Policies with the largest complete losses, ties by id."""
    return (
        policy.filter(_flag("PurePremiumModelEligible") & (F.col("CompleteTotalClaimAmount") > 0))
        .select(*V.LOSS_COLUMNS)
        .orderBy(F.desc("CompleteTotalClaimAmount"), "IDpol")
        .limit(rows)
    )


def model_eligibility(policy: DataFrame) -> DataFrame:
    """Eligible policies per model sample, from one scan."""
    samples = {
        "Frequency model": "FrequencyModelEligible",
        "Severity model": "SeverityModelEligible",
        "Pure premium model": "PurePremiumModelEligible",
    }
    row = policy.agg(
        F.count("*").alias("n"), *[count_if(_flag(c)).alias(c) for c in samples.values()])
    return long_report(
        row.select("*"), ("model_sample", "pair"),
        [(n, F.struct(F.col(c).alias("a"), percent(F.col(c), F.col("n")).alias("b")))
         for n, c in samples.items()],
    ).select(
        "model_sample",
        F.col("pair.a").alias("eligible_policies"),
        F.col("pair.b").alias("eligible_percentage"),
    )


def status_shares(df: DataFrame, column: str, name: str, count: str, share: str) -> DataFrame:
    """Rows and percentage per value, most frequent first.

    The total is a sum over the few groups, so the rows are read once.
    """
    groups = df.groupBy(F.col(column).alias(name)).agg(F.count("*").alias(count))
    return with_share(groups, count, share).orderBy(F.desc(count), name)


def with_share(groups: DataFrame, count: str, share: str, within: tuple = ()) -> DataFrame:
    """Groups with their percentage of all counted rows.

    The total is a window over the groups, of which there are few; rows do not move.
    """
    total = F.sum(count).over(Window.partitionBy(*within))
    return groups.withColumn(share, percent(F.col(count), total))


def with_share_of_many(groups: DataFrame, count: str, share: str, within: str) -> DataFrame:
    """As with_share, for groups that may be many: no task sees all groups of a part.

    The parts are few (`within` is a column the plan itself made), so their totals are a
    table of as many rows.
    """
    totals = groups.groupBy(within).agg(F.sum(count).alias("_all"))
    return groups.join(F.broadcast(totals), within).withColumn(
        share, percent(F.col(count), F.col("_all"))).drop("_all")


def claim_completeness(policy: DataFrame) -> DataFrame:
    return status_shares(
        policy, "SeverityCompletenessStatus", "completeness_status", "policy_count", "percentage")


def audit_summary(audit: DataFrame) -> DataFrame:
    return status_shares(audit, "AuditStatus", "AuditStatus", "PolicyCount", "Percentage")


def claim_count_distribution(policy: DataFrame) -> DataFrame:
    """Policies by claim count, four and more together, in order of the count."""
    groups = policy.groupBy(
        claim_count_group(F.col("ClaimNb")).alias("claim_count_group")
    ).agg(F.count("*").alias("policy_count"))
    order = F.when(F.col("claim_count_group").isin("0", "1", "2", "3"),
                   F.col("claim_count_group").try_cast("int")).otherwise(4)
    return with_share(groups, "policy_count", "percentage").orderBy(order)


def claim_count_bars(policy: DataFrame) -> DataFrame:
    """The five capped groups with zero for an absent one."""
    row = policy.agg(*[
        count_if(F.col("ClaimNb") == k).alias(f"c{k}") for k in range(4)
    ], count_if(F.col("ClaimNb") >= 4).alias("c4"))
    labels = ["0", "1", "2", "3", "4+"]
    return long_report(
        row, ("ClaimCountGroup", "PolicyCount"),
        [(n, F.col(f"c{k}")) for k, n in enumerate(labels)])


def claim_occurrence_counts(policy: DataFrame) -> DataFrame:
    """Policies without and with a claim, and the share with one."""
    row = policy.agg(
        count_if(F.col("HasClaim") == 0).alias("without"),
        count_if(F.col("HasClaim") == 1).alias("with"),
    )
    every = F.col("without") + F.col("with")
    return long_report(
        row, ("ClaimStatus", "pair"),
        [(n, F.struct(F.col(c).alias("a"), ratio(F.col(c), every).alias("b")))
         for n, c in [("No claim", "without"), ("At least one claim", "with")]],
    ).select("ClaimStatus", F.col("pair.a").alias("PolicyCount"), F.col("pair.b").alias("Share"))


def issue_types(issues: DataFrame) -> DataFrame:
    return (
        issues.groupBy("AuditStatus")
        .agg(
            F.count("*").alias("policy_count"),
            F.sum("ClaimCountDifference").alias("total_count_difference"),
        )
        .orderBy(F.desc("policy_count"), "AuditStatus")
    )


def orphans_by_policy(orphans: DataFrame) -> DataFrame:
    return (
        orphans.groupBy("IDpol")
        .agg(F.count("*").alias("claim_rows"), F.sum("ClaimAmount").alias("total_claim_amount"))
        .orderBy(F.desc("total_claim_amount"), "IDpol")
    )


def orphan_summary(orphans: DataFrame) -> DataFrame:
    """Rows, ids and amount of the orphan claims.

    Ids are grouped first, so the distinct count needs no second pass.
    """
    return orphans_by_policy(orphans).agg(
        F.coalesce(F.sum("claim_rows"), F.lit(0)).alias("orphan_claim_rows"),
        F.count("IDpol").alias("orphan_policy_ids"),
        F.sum("total_claim_amount").alias("orphan_claim_amount"),
    )


def incomplete_policies(policy: DataFrame) -> DataFrame:
    return policy.filter(~_flag("ClaimCountMatch")).select(
        "IDpol", "ClaimNb", "SeverityRowCount", "ClaimCountDifference",
        "SeverityTotalClaimAmount", "CompleteTotalClaimAmount", "SeverityCompletenessStatus",
    )


def complete_zero_claim_policies(policy: DataFrame) -> DataFrame:
    return policy.filter((F.col("ClaimNb") == 0) & _flag("ClaimCountMatch")).select(
        "IDpol", "ClaimNb", "SeverityRowCount", "CompleteTotalClaimAmount", "CompletePurePremium",
    )


