"""The steps of a full run, each its own job.

    python -m claimwright.run prepare --frequency F --severity S --to prepared
    python -m claimwright.run tables --prepared prepared --to tables
    python -m claimwright.run reports --tables tables --to reports/sql
    python -m claimwright.run quality --frequency F --severity S --to reports
    python -m claimwright.run explore --prepared prepared --to reports
    python -m claimwright.run logistic --prepared prepared --to reports/modeling/logistic
    python -m claimwright.run occurrence --prepared prepared \\
        --logistic reports/modeling/logistic --to reports/modeling/occurrence

and frequency and severity like logistic. What logistic, frequency and severity have
published is read back and reviewed by

    python -m claimwright.run review --family frequency \\
        --reports reports/modeling/frequency --to reports/modeling/frequency

The file can be given to
spark-submit as well.
"""

import argparse

from claimwright import vocabulary as V
from claimwright.operators import contracts, explore, portfolio, quality
from claimwright.operators.clean import valid_severity
from claimwright.plans import frequency, occurrence, preparation, review, severity, warehouse
from claimwright.session import session
from claimwright.sources import raw, store


def _policy(spark, folder):
    return store.read_tables(spark, folder, ["policy_analytics"])["policy_analytics"]


def _raw(spark, args):
    return raw.read_frequency(spark, args.frequency), raw.read_severity(spark, args.severity)


def prepare(spark, args):
    preparation.run(*_raw(spark, args), args.to)


def tables(spark, args):
    warehouse.build(spark, args.prepared, args.to)


def reports(spark, args):
    warehouse.export_reports(store.read_tables(spark, args.tables, store.RELATIONAL), args.to)


def quality_reports(spark, args):
    policies, claims = (quality.typed(t) for t in _raw(spark, args))
    store.write_tables({
        "data_quality_summary": quality.quality_summary(policies, claims),
        "consistency_summary": quality.consistency_summary(policies, claims),
        "validity_checks": quality.validity_checks(policies, claims),
        "missing_values": quality.missing_values(policies),
        "percentiles": quality.review_percentiles(policies, claims),
        "category_values": quality.category_values(policies),
    }, args.to, "csv")
    store.write_if_any(
        quality.mismatches(quality.raw_consistency(policies, claims)), args.to,
        "claim_count_mismatches", "csv")


def exploration(spark, args):
    policy = _policy(spark, args.prepared)
    claims = valid_severity(
        store.read_tables(spark, args.prepared, ["severity_clean"])["severity_clean"])
    contracts.enforce(contracts.analysis_checks(policy))
    store.write_tables({
        "portfolio_summary": portfolio.portfolio_summary(policy),
        "group_risk_summary": explore.group_risk_summary(policy),
        "segment_extremes": explore.segment_extremes(policy),
        "claim_occurrence": portfolio.claim_occurrence_counts(policy),
        "claim_counts": portfolio.claim_count_bars(policy),
        "largest_losses": portfolio.largest_losses(policy),
        "driver_age_histogram": explore.driver_age_histogram(policy),
        "claim_amount_histogram": explore.log_histogram(claims, "ClaimAmount"),
        "claim_amount_percentiles": explore.amount_percentiles(claims),
    }, args.to, "csv")


def logistic(spark, args):
    occurrence.train_logistic(occurrence.split(_policy(spark, args.prepared))).publish(args.to)


def occurrence_models(spark, args):
    logistic_model = occurrence.saved_logistic(spark, args.logistic)
    rows = occurrence.split(_policy(spark, args.prepared))
    occurrence.compare(rows, fitted={V.LOGISTIC: logistic_model}).publish(args.to, rows)


def frequency_models(spark, args):
    frequency.train(frequency.split(_policy(spark, args.prepared))).publish(args.to)


def severity_models(spark, args):
    severity.train(severity.split(_policy(spark, args.prepared))).publish(args.to)


def review_reports(spark, args):
    store.write_table(
        review.of_folder(spark, args.family, args.reports), args.to, "published_report_checks", "csv")


STEPS = {
    "prepare": prepare, "tables": tables, "reports": reports, "quality": quality_reports,
    "explore": exploration, "logistic": logistic, "occurrence": occurrence_models,
    "frequency": frequency_models, "severity": severity_models, "review": review_reports,
}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("step", choices=STEPS)
    for name in ("frequency", "severity", "prepared", "tables", "logistic", "reports"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--family", choices=review.TABLES)
    parser.add_argument("--to", required=True)
    args = parser.parse_args()
    STEPS[args.step](session(f"claimwright-{args.step}"), args)


if __name__ == "__main__":
    main()
