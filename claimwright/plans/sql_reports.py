"""The named SQL reports: texts over the registered tables and views, with their columns.

A text may have parameters (`:name`), which have defaults here. Reports with `exported`
set are the ones a run writes.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from claimwright import vocabulary as V


@dataclass
class Report:
    """A SQL text, the columns it gives, and the values of its parameters."""

    text: str
    columns: str
    parameters: dict = field(default_factory=dict)
    exported: bool = False


_COMPLETE = "FILTER (WHERE PurePremiumModelEligible = 1)"
_POSITIVE = "FILTER (WHERE SeverityModelEligible = 1)"
_PREMIUM = f"sum(CompleteTotalClaimAmount) {_COMPLETE} / nullif(sum(Exposure) {_COMPLETE}, 0)"
_INDICATORS = ("claim_occurrence_rate double, claim_frequency double,"
               " claims_per_100_exposure_years double, average_claim_severity double, pure_premium double")
_BANDED = """count(*) AS policies, sum(Exposure) AS exposure, sum(ClaimNb) AS claims,
    100D * sum(ClaimNb) / nullif(sum(Exposure), 0) AS claims_per_100_exposure_years"""


def _band(column: str, edges: list, labels: list, results: list | None = None) -> str:
    """A CASE over left-closed bands; missing values come out at the end."""
    results = results or [f"'{x}'" for x in labels]
    arms = " ".join(f"WHEN {column} < {e} THEN {r}" for e, r in zip(edges[1:], results))
    return f"CASE {arms} ELSE {results[-1]} END"


def _by_band(column: str, edges: list, labels: list, name: str, more: str = "") -> str:
    place = _band(column, edges, labels, [str(i) for i in range(len(labels))])
    return f"""SELECT {name}, {_BANDED}{more}, {_PREMIUM} AS pure_premium
    FROM (SELECT *, {_band(column, edges, labels)} AS {name}, {place} AS place FROM policies)
    GROUP BY {name}, place ORDER BY place"""


REPORTS: dict[str, Report] = {
    "portfolio_kpis": Report(
        "FROM v_portfolio_kpis", "total_policies bigint, total_exposure_years double,"
        " total_reported_claims bigint, policies_with_claims bigint, complete_loss_policies bigint,"
        f" complete_claim_cost double, {_INDICATORS}", exported=True),
    "table_counts": Report(
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in (
            "policies", "claims", "orphan_claims", "claim_count_issues")),
        "table_name string, row_count bigint"),
    "claim_count_distribution": Report(
        """SELECT if(capped = 4, '4+', CAST(capped AS STRING)) AS claim_count_group, policy_count,
        100D * policy_count / (SELECT count(*) FROM policies) AS percentage
        FROM (SELECT least(ClaimNb, 4) AS capped, count(*) AS policy_count FROM policies GROUP BY 1)
        ORDER BY capped""",
        "claim_count_group string, policy_count bigint, percentage double"),
    "area_metrics": Report(
        "FROM v_area_metrics ORDER BY Area", "Area string, policies bigint, exposure double,"
        " claims bigint, policies_with_claim bigint, complete_loss_percentage double,"
        f" {_INDICATORS}", exported=True),
    "area_ranking": Report(
        """SELECT Area, policies, exposure, claims, claims_per_100_exposure_years
        FROM v_area_metrics ORDER BY claims_per_100_exposure_years DESC, Area""",
        "Area string, policies bigint, exposure double, claims bigint,"
        " claims_per_100_exposure_years double"),
    "model_eligibility": Report(
        "FROM v_model_eligibility",
        "model_sample string, eligible_policies bigint, eligible_percentage double", exported=True),
    "claim_completeness": Report(
        "FROM v_claim_completeness ORDER BY policy_count DESC, completeness_status",
        "completeness_status string, policy_count bigint, percentage double", exported=True),
    "claim_count_issues": Report(
        """SELECT AuditStatus, count(*) AS policy_count, sum(ClaimCountDifference) AS total_count_difference
        FROM claim_count_issues GROUP BY AuditStatus ORDER BY policy_count DESC, AuditStatus""",
        "AuditStatus string, policy_count bigint, total_count_difference bigint", exported=True),
    "orphan_claims": Report(
        """SELECT IDpol, count(*) AS claim_rows, sum(ClaimAmount) AS total_claim_amount
        FROM orphan_claims GROUP BY IDpol ORDER BY total_claim_amount DESC, IDpol""",
        "IDpol bigint, claim_rows bigint, total_claim_amount double"),
    "driver_age_metrics": Report(
        _by_band("DrivAge", V.DRIVER_AGE_EDGES, V.DRIVER_AGE_LABELS, "driver_age_band",
                 f""", sum(CompleteTotalClaimAmount) {_POSITIVE}
    / nullif(sum(ClaimNb) {_POSITIVE}, 0) AS average_claim_severity"""),
        "driver_age_band string, policies bigint, exposure double, claims bigint,"
        " claims_per_100_exposure_years double, average_claim_severity double, pure_premium double"),
    "bonus_malus_metrics": Report(
        _by_band("BonusMalus", V.BONUS_MALUS_EDGES, V.BONUS_MALUS_LABELS, "bonus_malus_band"),
        "bonus_malus_band string, policies bigint, exposure double, claims bigint,"
        " claims_per_100_exposure_years double, pure_premium double"),
    "top_regions_by_pure_premium": Report(
        f"""SELECT Region, count(*) AS policies, sum(Exposure) {_COMPLETE} AS complete_loss_exposure,
        {_PREMIUM} AS pure_premium FROM policies GROUP BY Region
        HAVING complete_loss_exposure >= :least_exposure
        ORDER BY pure_premium DESC, Region LIMIT 10""",
        "Region string, policies bigint, complete_loss_exposure double, pure_premium double",
        {"least_exposure": V.REGION_EXPOSURE}, exported=True),
    "largest_losses": Report(
        f"""SELECT {', '.join(V.LOSS_COLUMNS)} FROM policies
        WHERE PurePremiumModelEligible = 1 AND CompleteTotalClaimAmount > 0
        ORDER BY CompleteTotalClaimAmount DESC, IDpol LIMIT 20""",
        "IDpol bigint, ClaimNb bigint, Exposure double, Area string, VehPower double, VehAge double,"
        " DrivAge double, BonusMalus double, VehBrand string, VehGas string, Region string,"
        " CompleteTotalClaimAmount double, CompletePurePremium double"),
}


def report(spark: SparkSession, name: str, **parameters) -> DataFrame:
    """One report over the registered tables and views, its columns checked.

    An unknown name or parameter, or columns other than the catalogue's, raise an error.
    """
    if name not in REPORTS:
        raise KeyError(f"No report {name}; there are {sorted(REPORTS)}")
    wanted = REPORTS[name]
    unknown = set(parameters) - set(wanted.parameters)
    if unknown:
        raise KeyError(f"{name} has no parameters {sorted(unknown)}")
    found = spark.sql(wanted.text, args={**wanted.parameters, **parameters})
    declared = [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(wanted.columns)]
    if found.dtypes != declared:
        raise ValueError(f"{name} gives {found.dtypes}, the catalogue says {declared}")
    return found


def exported(spark: SparkSession) -> dict[str, DataFrame]:
    """The reports that a run writes."""
    return {name: report(spark, name) for name, r in REPORTS.items() if r.exported}
