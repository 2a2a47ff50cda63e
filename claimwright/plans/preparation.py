"""From the two raw tables to the policy-level fact and its reports."""

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from claimwright import vocabulary as V
from claimwright.operators import clean, contracts, portfolio, quality, reconcile
from claimwright.session import stage
from claimwright.sources import store

POLICIES = "The valid frequency data"


@dataclass
class Prepared:
    """Lazy prepared tables; nothing runs until one of them is used."""

    frequency: DataFrame
    severity: DataFrame
    by_policy: DataFrame
    audit: DataFrame
    policy: DataFrame

    @property
    def policies(self) -> DataFrame:
        return clean.valid_frequency(self.frequency)

    @property
    def claims(self) -> DataFrame:
        return clean.valid_severity(self.severity)

    def summary(self) -> DataFrame:
        return quality.preparation_summary(self.frequency, self.severity, self.audit)

    def audit_summary(self) -> DataFrame:
        return portfolio.audit_summary(self.audit)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "frequency_clean": self.frequency,
            "severity_clean": self.severity,
            "severity_by_policy": self.by_policy,
            "claim_count_audit": self.audit,
            "policy_analytics": self.policy,
            "data_preparation_summary": self.summary(),
            "claim_count_audit_summary": self.audit_summary(),
        }


def prepare(
    raw_frequency: DataFrame, raw_severity: DataFrame, keep=lambda df, label: df
) -> Prepared:
    """The preparation plan over two raw tables.

    A policy id on several valid rows makes every plan that joins policies fail.
    `keep` may write a step's rows and read them back (see session.stage); by default
    every table is one lazy plan from the raw rows.
    """
    contracts.require_columns(raw_frequency, V.FREQUENCY_COLUMNS, "The frequency table")
    contracts.require_columns(raw_severity, V.SEVERITY_COLUMNS, "The severity table")
    frequency = keep(clean.clean_frequency(raw_frequency), "frequency-clean")
    severity = keep(clean.clean_severity(raw_severity), "severity-clean")
    policies = contracts.one_per_key(clean.valid_frequency(frequency), POLICIES)
    claims = clean.valid_severity(severity)
    by_policy = keep(reconcile.severity_by_policy(claims), "severity-by-policy")
    return Prepared(
        frequency, severity, by_policy,
        keep(reconcile.claim_count_audit(policies, by_policy), "claim-count-audit"),
        keep(reconcile.policy_analytics(policies, by_policy), "policy-analytics"),
    )


def stored(raw_frequency: DataFrame, raw_severity: DataFrame, folder: str) -> Prepared:
    """The plan with every step written once as its table of the folder; what follows a step,
    the summaries as well, reads that table."""
    def written(df: DataFrame, label: str) -> DataFrame:
        return df.sparkSession.read.parquet(
            store.write_table(df, folder, label.replace("-", "_")))

    prepared = prepare(raw_frequency, raw_severity, written)
    store.write_tables({
        "data_preparation_summary": prepared.summary(),
        "claim_count_audit_summary": prepared.audit_summary(),
    }, folder)
    return prepared


def run(raw_frequency: DataFrame, raw_severity: DataFrame, folder: str,
        kind: str = "parquet") -> Prepared:
    """Prepares, checks, then writes all seven tables to the folder.

    Each step is worked out once, on shared storage. When a check does not pass,
    nothing is written to the folder.
    """
    contracts.require_rows(raw_frequency, "The frequency table")
    contracts.require_rows(raw_severity, "The severity table")
    try:
        prepared = prepare(raw_frequency, raw_severity, stage)
    except PySparkException as error:
        if POLICIES not in str(error):
            raise
        raise ValueError(f"{POLICIES} has repeated values of IDpol") from error
    contracts.enforce(contracts.output_checks(prepared.policy, prepared.audit))
    store.write_tables(prepared.tables(), folder, kind)
    return prepared
