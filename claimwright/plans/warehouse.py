"""The relational layer: five tables, four views, and named reports."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.operators import contracts, ranking, reconcile
from claimwright.operators.clean import valid_severity
from claimwright.operators.contracts import require_columns
from claimwright.plans import sql_reports
from claimwright.session import stage
from claimwright.sources import store
from claimwright import vocabulary as V


def relational_tables(
    policy: DataFrame, severity_clean: DataFrame, audit: DataFrame
) -> dict[str, DataFrame]:
    """Typed policies, matched and orphan claims with surrogate ids, and issues.

    The claims are matched once and kept on shared storage, as both claim tables and
    their numbering read them.
    """
    require_columns(policy, V.POLICY_COLUMNS, "The policy data")
    require_columns(severity_clean, [*V.SEVERITY_COLUMNS, "SeverityRecordValid"], "The severity data")
    require_columns(
        audit, [*[c for c in V.ISSUE_COLUMNS if c != "SourceStatus"], "_merge"], "The audit data")
    policies = reconcile.policies_table(policy)
    known = stage(
        reconcile.known_claims(valid_severity(severity_clean), policies), "known-claims", "IDpol")
    return {
        "policies": policies,
        "claims": ranking.numbered(
            reconcile.matched_claims(known), "IDpol", "ClaimAmount", "ClaimID"),
        "orphan_claims": ranking.numbered(
            reconcile.orphan_claims(known), "IDpol", "ClaimAmount", "OrphanClaimID"),
        "claim_count_issues": reconcile.claim_count_issues(audit),
    }


def metadata(tables: dict[str, DataFrame], source: str, built: str | None = None) -> DataFrame:
    """Build facts as key and value text, ordered by key."""
    built = built or datetime.now(timezone.utc).isoformat()
    keys = {
        "policies": "policy_rows", "claims": "matched_claim_rows",
        "orphan_claims": "orphan_claim_rows", "claim_count_issues": "claim_count_issue_rows",
    }
    spark = next(iter(tables.values())).sparkSession
    counts = contracts.table_counts({n: tables[n] for n in keys})
    named = F.create_map(*[F.lit(x) for pair in keys.items() for x in pair])
    facts = counts.select(
        F.element_at(named, F.col("table_name")).alias("MetadataKey"),
        F.col("row_count").cast("string").alias("MetadataValue"))
    fixed = spark.createDataFrame(
        [("database_build_timestamp_utc", built), ("source_dataset", source)],
        "MetadataKey string, MetadataValue string")
    return facts.unionByName(fixed).orderBy("MetadataKey")


# The views are SQL text over the policies table.
_COMPLETE = "CAST(PurePremiumModelEligible AS BOOLEAN)"
_POSITIVE = "CAST(SeverityModelEligible AS BOOLEAN)"
_INDICATORS = f"""
    sum(CAST(HasClaim AS BIGINT)) / CAST(count(*) AS DOUBLE) AS claim_occurrence_rate,
    CAST(sum(ClaimNb) AS DOUBLE) / nullif(sum(Exposure), 0) AS claim_frequency,
    100 * CAST(sum(ClaimNb) AS DOUBLE) / nullif(sum(Exposure), 0) AS claims_per_100_exposure_years,
    coalesce(sum(CompleteTotalClaimAmount) FILTER (WHERE {_POSITIVE}), 0D)
      / nullif(CAST(sum(ClaimNb) FILTER (WHERE {_POSITIVE}) AS DOUBLE), 0) AS average_claim_severity,
    coalesce(sum(CompleteTotalClaimAmount) FILTER (WHERE {_COMPLETE}), 0D)
      / nullif(sum(Exposure) FILTER (WHERE {_COMPLETE}), 0) AS pure_premium"""
_SAMPLES = " UNION ALL ".join(
    f"""SELECT '{name}' AS model_sample,
    count(*) FILTER (WHERE CAST({flag} AS BOOLEAN)) AS eligible_policies,
    100D * count(*) FILTER (WHERE CAST({flag} AS BOOLEAN)) / nullif(count(*), 0) AS eligible_percentage
    FROM policies"""
    for name, flag in [
        ("Frequency model", "FrequencyModelEligible"), ("Severity model", "SeverityModelEligible"),
        ("Pure premium model", "PurePremiumModelEligible")])
VIEWS = {
    "v_portfolio_kpis": f"""SELECT count(*) AS total_policies, sum(Exposure) AS total_exposure_years,
    sum(ClaimNb) AS total_reported_claims, sum(CAST(HasClaim AS BIGINT)) AS policies_with_claims,
    count(*) FILTER (WHERE {_COMPLETE}) AS complete_loss_policies,
    coalesce(sum(CompleteTotalClaimAmount) FILTER (WHERE {_COMPLETE}), 0D) AS complete_claim_cost,
    {_INDICATORS} FROM policies""",
    "v_area_metrics": f"""SELECT Area, count(*) AS policies, sum(Exposure) AS exposure,
    sum(ClaimNb) AS claims, sum(CAST(HasClaim AS BIGINT)) AS policies_with_claim,
    100D * count(*) FILTER (WHERE {_COMPLETE}) / count(*) AS complete_loss_percentage,
    {_INDICATORS} FROM policies GROUP BY Area""",
    "v_model_eligibility": _SAMPLES,
    "v_claim_completeness": """SELECT SeverityCompletenessStatus AS completeness_status,
    count(*) AS policy_count, 100D * count(*) / sum(count(*)) OVER () AS percentage
    FROM policies GROUP BY SeverityCompletenessStatus""",
}


def register(tables: dict[str, DataFrame]) -> None:
    """Names the tables and the four views for SQL in their session."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name, text in VIEWS.items():
        spark.sql(text).createOrReplaceTempView(name)


def query(spark: SparkSession, text: str) -> DataFrame:
    """Any SQL over the registered tables and views."""
    return spark.sql(text)


def reports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The named SQL reports that are exported, over the given tables."""
    register(tables)
    return sql_reports.exported(next(iter(tables.values())).sparkSession)


def export_reports(tables: dict[str, DataFrame], folder: str, kind: str = "csv") -> list[str]:
    return store.write_tables(reports(tables), folder, kind)


def build(
    spark: SparkSession, prepared_folder: str, folder: str, source: str = "claims"
) -> dict[str, DataFrame]:
    """Reads the prepared tables, works out and checks the relational ones, then writes them.

    When a check does not pass, nothing is written to the folder.
    """
    prepared = store.read_tables(
        spark, prepared_folder, ["policy_analytics", "severity_clean", "claim_count_audit"])
    planned = relational_tables(
        prepared["policy_analytics"], prepared["severity_clean"], prepared["claim_count_audit"])
    written = {name: stage(df, f"table-{name}") for name, df in planned.items()}
    contracts.require_counts(written, {
        "policies": prepared["policy_analytics"].count(),
        "claim_count_issues": prepared["claim_count_audit"].filter("NOT ClaimCountMatch").count(),
    })
    valid = valid_severity(prepared["severity_clean"]).count()
    split = written["claims"].count() + written["orphan_claims"].count()
    if split != valid:
        raise ValueError(f"{split} claims written, {valid} expected")
    if not contracts.foreign_key_violations(written["claims"], written["policies"]).isEmpty():
        raise ValueError("Claims without a policy are in the claims table")
    written["database_metadata"] = stage(metadata(written, source), "table-database_metadata")
    broken = contracts.constraint_violations(written).filter("Violations > 0").collect()
    if broken:
        raise ValueError(f"Constraint violations: {[r.asDict() for r in broken]}")
    store.write_tables(written, folder)
    return store.read_tables(spark, folder, list(written))
