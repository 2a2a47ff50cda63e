"""The registered queries: name -> function of (session, table folder)."""

from functools import lru_cache
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright import vocabulary as V
from claimwright.functions.bands import with_bands
from claimwright.functions.casting import lenient_truth, truth
from claimwright.functions.measures import clipped
from claimwright.operators import (
    audit, boosting, contracts, curves, explore, features, models, portfolio, quality, ranking,
    reconcile, sampling,
)
from claimwright.operators.features import Design
from claimwright.operators.importance import permutation_importance
from claimwright.operators.shaping import previewed
from claimwright.plans import (
    frequency, occurrence, preparation, review, severity, sql_reports, warehouse)
from claimwright.session import shared_folder
from claimwright.sources import raw, store
from verification import base


QUERIES = {}
# The same queries without the rounding, which only the comparison needs.
PLAIN = {}


def query(function):
    """Registers a query under its name, with doubles rounded for comparison."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return base.shown(function(spark, folder))

    QUERIES[function.__name__] = run
    PLAIN[function.__name__] = function
    return function


# --- cleaning and preparation ---------------------------------------------


@query
def clean_frequency(spark, folder):
    return base.prepared(spark, folder).frequency


@query
def clean_severity(spark, folder):
    return base.prepared(spark, folder).severity


@query
def column_contract(spark, folder):
    return contracts.column_report(base.raw(spark, folder)[0], V.FREQUENCY_COLUMNS)


@query
def boolean_words(spark, folder):
    """Status words as booleans, strictly known and leniently."""
    words = spark.read.parquet(f"{folder}/orders.parquet").selectExpr(
        "CASE o_orderkey % 6 WHEN 0 THEN ' True ' WHEN 1 THEN 'FALSE' WHEN 2 THEN '1'"
        " WHEN 3 THEN '0' WHEN 4 THEN o_orderstatus END AS Word")
    return words.groupBy(
        truth(words, "Word").alias("Known"), lenient_truth(words, "Word").alias("Lenient")
    ).agg(F.count("*").alias("Words"))


@query
def severity_by_policy(spark, folder):
    return base.prepared(spark, folder).by_policy


@query
def claim_count_audit(spark, folder):
    return base.prepared(spark, folder).audit


@query
def audit_summary(spark, folder):
    return base.prepared(spark, folder).audit_summary()


@query
def policy_analytics(spark, folder):
    return base.prepared(spark, folder).policy.select(*V.POLICY_COLUMNS)


@query
def preparation_summary(spark, folder):
    return base.prepared(spark, folder).summary()


@query
def preparation_checks(spark, folder):
    found = base.prepared(spark, folder)
    return contracts.preparation_checks(found.policy, found.audit)


@query
def output_checks(spark, folder):
    found = base.prepared(spark, folder)
    return contracts.output_checks(found.policy, found.audit)


@query
def analysis_checks(spark, folder):
    return contracts.analysis_checks(base.prepared(spark, folder).policy)


@query
def raw_files(spark, folder):
    """The two raw tables as CSV files, read by their readers."""
    target = f"{shared_folder(spark)}/raw-files-{uuid4().hex}"
    frequency_rows, severity_rows = base.raw(spark, folder)
    frequency_rows.write.option("header", True).csv(f"{target}/frequency")
    severity_rows.write.option("header", True).csv(f"{target}/severity")
    read = {"frequency": raw.read_frequency(spark, f"{target}/frequency"),
            "severity": raw.read_severity(spark, f"{target}/severity")}
    parts = [df.agg(F.lit(name).alias("TableName"), F.count("*").alias("RowCount"),
                    F.count_distinct("IDpol").alias("Ids")) for name, df in read.items()]
    return parts[0].unionByName(parts[1])


# --- relational layer ------------------------------------------------------


@query
def policies_table(spark, folder):
    return reconcile.policies_table(base.policy(spark, folder))


@query
def claims_table(spark, folder):
    return ranking.numbered(
        reconcile.matched_claims(base.known_claims(spark, folder)), "IDpol", "ClaimAmount",
        "ClaimID")


@query
def orphan_claims_table(spark, folder):
    return ranking.numbered(
        base.orphans(spark, folder), "IDpol", "ClaimAmount", "OrphanClaimID")


@query
def claim_count_issues(spark, folder):
    return reconcile.claim_count_issues(base.prepared(spark, folder).audit)


@query
def foreign_key_violations(spark, folder):
    found = base.prepared(spark, folder)
    return contracts.foreign_key_violations(found.claims, found.policies)


@query
def unknown_claim_ids(spark, folder):
    found = base.prepared(spark, folder)
    return reconcile.unknown_claim_ids(found.claims, found.policies)


@query
def constraint_violations(spark, folder):
    tables = base.relational(spark, folder)
    return contracts.constraint_violations(
        {**tables, "database_metadata": warehouse.metadata(tables, "fixture", "fixed")})


@query
def repeated_key_violations(spark, folder):
    """The key rules where keys do repeat: claims stand for policies and issues."""
    tables = base.relational(spark, folder)
    facts = warehouse.metadata(tables, "fixture", "fixed")
    return contracts.key_violations({
        **tables, "policies": tables["claims"], "claim_count_issues": tables["orphan_claims"],
        "database_metadata": facts.unionByName(facts.filter("MetadataKey LIKE '%rows'"))})


@query
def raw_constraint_violations(spark, folder):
    """The claim rules on all cleaned claims, where some are broken."""
    return contracts.violations(
        base.prepared(spark, folder).severity, "claims", contracts.CLAIM_RULES)


@query
def duplicate_claim_ids(spark, folder):
    return contracts.duplicate_ids(base.prepared(spark, folder).claims)


@query
def table_counts(spark, folder):
    return contracts.table_counts(base.relational(spark, folder))


@query
def build_metadata(spark, folder):
    return warehouse.metadata(base.relational(spark, folder), "fixture", "fixed")


@lru_cache(maxsize=8)
def _stored(spark, folder):
    """The seven prepared tables, written to a folder."""
    target = f"{shared_folder(spark)}/prepared-{uuid4().hex}"
    preparation.stored(*base.raw(spark, folder), target)
    return target


@query
def stored_policies(spark, folder):
    """The policy fact as written to a folder and read back."""
    return store.read_tables(spark, _stored(spark, folder), ["policy_analytics"])[
        "policy_analytics"].select(*V.POLICY_COLUMNS)


@query
def stored_tables(spark, folder):
    """All seven prepared tables as written to a folder and read back, with their rows."""
    return contracts.table_counts(store.read_tables(spark, _stored(spark, folder), store.PREPARED))


@query
def sql_on_views(spark, folder):
    """A SQL text over the registered views."""
    warehouse.register(base.relational(spark, folder))
    return warehouse.query(
        spark,
        """SELECT Area, claims, pure_premium,
                  (SELECT pure_premium FROM v_portfolio_kpis) AS portfolio_pure_premium
           FROM v_area_metrics WHERE claims > 0""")


def _sql_report(name: str, **parameters):
    """Registers a named SQL report as a query of its own."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        warehouse.register(base.relational(spark, folder))
        return sql_reports.report(spark, name, **parameters)

    run.__name__ = f"sql_{name}"
    query(run)


for _name, _report in sql_reports.REPORTS.items():
    _sql_report(_name, **({"least_exposure": base.REGION_EXPOSURE} if _report.parameters else {}))


# --- portfolio reports -----------------------------------------------------


@query
def portfolio_kpis(spark, folder):
    """From the raw tables to the indicators in one plan."""
    return portfolio.portfolio_kpis(base.prepared(spark, folder).policy)


@query
def portfolio_summary(spark, folder):
    return portfolio.portfolio_summary(base.policy(spark, folder))


@query
def kpi_reconciliation(spark, folder):
    """DataFrame indicators against the same indicators of the typed SQL table."""
    policies = base.policy(spark, folder)
    warehouse.register({"policies": reconcile.policies_table(policies)})
    by_sql = warehouse.query(spark, "SELECT * FROM v_portfolio_kpis")
    return portfolio.kpi_reconciliation(portfolio.portfolio_kpis(policies), by_sql)


@query
def area_metrics(spark, folder):
    return portfolio.area_metrics(base.policy(spark, folder))


@query
def area_ranking(spark, folder):
    return portfolio.area_ranking(base.policy(spark, folder))


@query
def driver_age_metrics(spark, folder):
    return portfolio.driver_age_metrics(base.policy(spark, folder))


@query
def bonus_malus_metrics(spark, folder):
    return portfolio.bonus_malus_metrics(base.policy(spark, folder))


@query
def top_regions(spark, folder):
    return portfolio.top_regions(base.policy(spark, folder), base.REGION_EXPOSURE)


@query
def largest_losses(spark, folder):
    return portfolio.largest_losses(base.policy(spark, folder))


@query
def model_eligibility(spark, folder):
    return portfolio.model_eligibility(base.policy(spark, folder))


@query
def claim_completeness(spark, folder):
    return portfolio.claim_completeness(base.policy(spark, folder))


@query
def claim_count_distribution(spark, folder):
    return portfolio.claim_count_distribution(base.policy(spark, folder))


@query
def claim_count_bars(spark, folder):
    return portfolio.claim_count_bars(base.policy(spark, folder))


@query
def claim_occurrence_counts(spark, folder):
    return portfolio.claim_occurrence_counts(base.policy(spark, folder))


@query
def issue_types(spark, folder):
    return portfolio.issue_types(
        reconcile.claim_count_issues(base.prepared(spark, folder).audit))


@query
def orphans_by_policy(spark, folder):
    return portfolio.orphans_by_policy(base.orphans(spark, folder))


@query
def orphan_summary(spark, folder):
    return portfolio.orphan_summary(base.orphans(spark, folder))


@query
def incomplete_policies(spark, folder):
    return portfolio.incomplete_policies(base.policy(spark, folder))


@query
def complete_zero_claim_policies(spark, folder):
    return portfolio.complete_zero_claim_policies(base.policy(spark, folder))


@query
def policy_preview(spark, folder):
    return previewed(base.policy(spark, folder).select(*V.POLICY_COLUMNS), ["IDpol"])


# --- quality reports -------------------------------------------------------


def _typed(spark, folder):
    return tuple(quality.typed(t) for t in base.raw(spark, folder))


@query
def missing_values(spark, folder):
    return quality.missing_values(_typed(spark, folder)[0])


@query
def numeric_describe(spark, folder):
    return quality.describe(_typed(spark, folder)[0], V.FREQUENCY_NUMBERS)


@query
def review_percentiles(spark, folder):
    return quality.review_percentiles(*_typed(spark, folder))


@query
def claim_count_values(spark, folder):
    return quality.claim_count_values(_typed(spark, folder)[0])


@query
def category_values(spark, folder):
    return quality.category_values(_typed(spark, folder)[0])


@query
def validity_checks(spark, folder):
    return quality.validity_checks(*_typed(spark, folder))


@query
def raw_mismatches(spark, folder):
    return quality.mismatches(quality.raw_consistency(*_typed(spark, folder)))


@query
def consistency_summary(spark, folder):
    return quality.consistency_summary(*_typed(spark, folder))


@query
def duplicate_report(spark, folder):
    return quality.duplicate_report(*_typed(spark, folder))


@query
def quality_summary(spark, folder):
    return quality.quality_summary(*_typed(spark, folder))


# --- exploration -----------------------------------------------------------


@query
def policy_bands(spark, folder):
    return with_bands(base.policy(spark, folder)).select("IDpol", *V.BANDS)


@query
def group_risk_summary(spark, folder):
    return explore.group_risk_summary(base.policy(spark, folder))


@query
def segment_extremes(spark, folder):
    return explore.segment_extremes(
        base.policy(spark, folder), base.REGION_EXPOSURE)


@query
def amount_percentiles(spark, folder):
    return explore.amount_percentiles(base.claims(spark, folder))


@query
def driver_age_histogram(spark, folder):
    return explore.driver_age_histogram(base.policy(spark, folder))


@query
def claim_amount_histogram(spark, folder):
    return explore.log_histogram(base.claims(spark, folder), "ClaimAmount")


# --- ranks, splits, samples ------------------------------------------------


@query
def risk_deciles(spark, folder):
    rows = base.policy(spark, folder).select(
        "IDpol", F.expr(base.FIRST_SCORE).alias("Score"))
    return ranking.with_decile(rows, "Score", "IDpol")


@query
def constant_score_deciles(spark, folder):
    """All predictions equal: the deciles are pure tie-break."""
    rows = base.policy(spark, folder).select("IDpol", F.lit(0.1).alias("Score"))
    return ranking.with_decile(rows, "Score", "IDpol")


@query
def severity_strata(spark, folder):
    return features.severity_sample(base.severity_rows(spark, folder)).select(
        "IDpol", "AverageClaimSeverity", "SeverityStratum")


@query
def occurrence_split(spark, folder):
    return base.occurrence_split(spark, folder).select("IDpol", "HasClaim", "Sample")


@query
def frequency_split(spark, folder):
    return base.frequency_split(spark, folder).select("IDpol", "ClaimCountStratum", "Sample")


@query
def severity_split(spark, folder):
    return base.severity_split(spark, folder).select("IDpol", "SeverityStratum", "Sample")


@query
def occurrence_split_summary(spark, folder):
    return sampling.occurrence_split_summary(base.occurrence_split(spark, folder))


@query
def frequency_split_summary(spark, folder):
    return sampling.frequency_split_summary(base.frequency_split(spark, folder))


@query
def severity_split_summary(spark, folder):
    return sampling.severity_split_summary(base.severity_split(spark, folder))


@query
def stratified_sample(spark, folder):
    return sampling.stratified_sample(
        base.occurrence_split(spark, folder), "HasClaim", 1_000).select("IDpol", "HasClaim")


@query
def prediction_sample(spark, folder):
    rows = base.occurrence_scores(spark, folder).filter(F.col("Model") == V.LOGISTIC)
    return sampling.prediction_sample(
        rows.select("IDpol", "Score"), "Score", 500)


@query
def occurrence_problems(spark, folder):
    return contracts.problem_counts(
        features.occurrence_sample(base.policy(spark, folder)), features.OCCURRENCE_PROBLEMS)


@query
def frequency_problems(spark, folder):
    return contracts.problem_counts(
        features.frequency_sample(base.policy(spark, folder)), features.FREQUENCY_PROBLEMS)


@query
def severity_problems(spark, folder):
    return contracts.problem_counts(
        features.severity_policies(base.policy(spark, folder)), features.SEVERITY_PROBLEMS)


@query
def raw_problems(spark, folder):
    """The frequency guards on all cleaned policies, where some are broken."""
    return contracts.problem_counts(
        base.prepared(spark, folder).frequency, features.FREQUENCY_PROBLEMS)


# --- audit of the occurrence score ----------------------------------------


def _case(spark, folder, sample):
    return base.occurrence_scores(spark, folder).filter(F.col("Sample") == sample)


@query
def occurrence_metrics(spark, folder):
    return curves.occurrence_metrics(_case(spark, folder, "Test"), F.lit(0.2))


@query
def confusion_cells(spark, folder):
    return curves.confusion_cells(curves.confusion(_case(spark, folder, "Test"), F.lit(0.2)))


@query
def precision_recall_curve(spark, folder):
    return curves.threshold_curve(curves.score_steps(_case(spark, folder, "Validation")))


@query
def roc_points(spark, folder):
    return curves.roc_points(curves.score_steps(_case(spark, folder, "Validation")))


@query
def ranking_areas(spark, folder):
    return curves.ranking_areas(curves.score_steps(base.occurrence_scores(spark, folder)))


@query
def f2_threshold(spark, folder):
    steps = curves.score_steps(_case(spark, folder, "Validation"))
    return curves.best_threshold_table(curves.threshold_curve(steps))


@query
def threshold_grid(spark, folder):
    rows = _case(spark, folder, "Test").filter(F.col("Model") == V.LOGISTIC)
    return curves.threshold_report(rows, 0.1234)


@query
def thresholds_in_range(spark, folder):
    rows = _case(spark, folder, "Test").filter(F.col("Model") == V.LOGISTIC)
    return curves.thresholds_between(curves.threshold_report(rows, 0.1234))


@query
def quantile_calibration(spark, folder):
    return curves.quantile_calibration(base.occurrence_scores(spark, folder))


@query
def capacity_analysis(spark, folder):
    return curves.capacity_comparison(
        _case(spark, folder, "Test"), [V.LOGISTIC, V.BOOSTING])


@query
def capture_curve(spark, folder):
    return curves.capture_curve(curves.capacity_comparison(
        base.occurrence_scores(spark, folder), [V.LOGISTIC, V.BOOSTING]))


@query
def subgroup_metrics(spark, folder):
    return curves.subgroup_metrics(
        with_bands(base.occurrence_scores(spark, folder)), F.lit(0.15),
        least_rows=base.SUBGROUP_ROWS)


@query
def recall_range(spark, folder):
    return curves.recall_range(curves.subgroup_metrics(
        with_bands(base.occurrence_scores(spark, folder)), F.lit(0.15),
        least_rows=base.SUBGROUP_ROWS))


@query
def occurrence_selection(spark, folder):
    steps = curves.score_steps(_case(spark, folder, "Validation"))
    return audit.select_occurrence(curves.ranking_areas(steps))


@query
def two_threshold_predictions(spark, folder):
    rows = _case(spark, folder, "Test").filter(F.col("Model") == V.LOGISTIC)
    return occurrence.decided(rows.withColumnRenamed("Score", occurrence.PROBABILITIES[V.LOGISTIC]), 0.15)


# --- audit of the frequency and severity scores ---------------------------


@query
def frequency_metrics(spark, folder):
    return audit.frequency_metrics(base.frequency_scores(spark, folder))


@query
def severity_metrics(spark, folder):
    return audit.severity_metrics(base.severity_scores(spark, folder))


@query
def frequency_selection(spark, folder):
    return audit.select_frequency(audit.frequency_metrics(
        base.frequency_scores(spark, folder)).filter("Sample = 'Validation'")).select("Model")


@query
def severity_selection(spark, folder):
    return audit.select_severity(audit.severity_metrics(
        base.severity_scores(spark, folder)).filter("Sample = 'Validation'")).select("Model")


def _one(scores: DataFrame, model: str) -> DataFrame:
    return scores.filter(F.col("Model") == model)


@query
def frequency_deciles(spark, folder):
    return audit.frequency_deciles(
        _one(base.frequency_scores(spark, folder), V.POISSON), V.POISSON)


@query
def severity_deciles(spark, folder):
    return audit.severity_deciles(_one(base.severity_scores(spark, folder), V.GAMMA), V.GAMMA)


@query
def frequency_segments(spark, folder):
    return audit.frequency_segments(
        _one(base.frequency_scores(spark, folder), V.POISSON), V.POISSON,
        least_exposure=base.SEGMENT_EXPOSURE)


@query
def severity_segments(spark, folder):
    return audit.severity_segments(_one(base.severity_scores(spark, folder), V.GAMMA), V.GAMMA)


@query
def bonus_malus_bars(spark, folder):
    segments = audit.frequency_segments(
        _one(base.frequency_scores(spark, folder), V.POISSON), V.POISSON,
        least_exposure=base.SEGMENT_EXPOSURE)
    return audit.band_bars(segments, "ObservedFrequency", "PredictedFrequency")


@query
def decile_extremes(spark, folder):
    deciles = audit.frequency_deciles(
        _one(base.frequency_scores(spark, folder), V.POISSON), V.POISSON)
    return audit.decile_extremes(deciles, "ObservedFrequency")


@query
def tail_summary(spark, folder):
    return audit.tail_summary(base.severity_rows(spark, folder))


@query
def largest_errors(spark, folder):
    return audit.largest_errors(_one(base.severity_scores(spark, folder), V.GAMMA))


@query
def severity_histogram(spark, folder):
    return explore.log_histogram(base.severity_rows(spark, folder), "AverageClaimSeverity")


# --- features and models ---------------------------------------------------


@query
def design_matrix(spark, folder):
    rows = base.frequency_split(spark, folder)
    design = Design.fit(rows.filter("Sample = 'Training'"), V.RATE_NUMBERS, V.MODEL_TEXTS)
    return design.frame(rows, "IDpol")


@query
def first_split_gains(spark, folder):
    """What every split of the first tree's root would gain."""
    return boosting.first_split_gains(
        base.frequency_split(spark, folder).filter("Sample = 'Training'"), "ClaimFrequency",
        "Exposure", ["VehPower", "VehAge", "DrivAge", "BonusMalus"], V.MODEL_TEXTS,
        boosting.FREQUENCY_SETTINGS)


@query
def model_baselines(spark, folder):
    """The three constants: claim rate, claim frequency, mean severity."""
    def training(split):
        return split(spark, folder).filter("Sample = 'Training'")

    return spark.createDataFrame([
        ("Claim rate", models.claim_rate(training(base.occurrence_split))),
        ("Claim frequency", models.portfolio_frequency(training(base.frequency_split))),
        ("Mean severity", models.mean_severity(training(base.severity_split))),
    ], "Baseline string, Value double")


@query
def coefficient_effects(spark, folder):
    return models.coefficient_table(base.coefficients(spark, folder), "RateRatio")


@query
def strongest_effects(spark, folder):
    """The fifteen largest positive and the fifteen most negative coefficients."""
    table = models.coefficient_table(base.coefficients(spark, folder), "RateRatio")
    return models.strongest(table, True).unionByName(models.strongest(table, False))


@query
def formula_importance(spark, folder):
    """Permutation importance of a formula, on all test rows."""
    rows = features.with_missing_label(base.occurrence_split(spark, folder)).filter("Sample = 'Test'")
    return permutation_importance(base.Formula(base.PERMUTED_SCORE), rows, base.PERMUTED)


@query
def occurrence_sample(spark, folder):
    return features.occurrence_sample(base.policy(spark, folder)).select(
        "IDpol", "HasClaim", "LogExposure", "LogDensity")


@query
def frequency_sample(spark, folder):
    return features.frequency_sample(base.policy(spark, folder)).select(
        "IDpol", "ClaimFrequency", "LogDensity", "ClaimCountStratum")


def _with_gaps(spark, folder):
    """The split with categories missing in places."""
    return base.frequency_split(spark, folder).withColumns({
        "Area": F.expr("IF(IDpol % 7 = 0, NULL, Area)"),
        "VehGas": F.expr("IF(IDpol % 5 = 0 OR VehGas = 'Diesel' AND IDpol % 3 = 0, NULL, VehGas)")})


@query
def missing_labels(spark, folder):
    return features.with_missing_label(
        _with_gaps(spark, folder).select("IDpol", *V.MODEL_TEXTS))


@query
def design_with_gaps(spark, folder):
    """Missing categories take the most frequent one of the training rows."""
    rows = _with_gaps(spark, folder)
    design = Design.fit(rows.filter("Sample = 'Training'"), ["VehPower"], ["Area", "VehGas"])
    return design.frame(rows, "IDpol")


@query
def clipped_predictions(spark, folder):
    """Predictions at and below zero are kept just above it."""
    return base.policy(spark, folder).select(
        "IDpol", (clipped(F.expr("(BonusMalus - 100) / 50D")) * 1e12).alias("Scaled"))


def _wide(scores: DataFrame, columns: dict, value: str, baseline: str | None = None) -> DataFrame:
    """Test rows with a prediction column for each model, as a run scores them."""
    test = scores.filter("Sample = 'Test'")
    first, second = [m for m in columns if m != baseline]
    keys = [c for c in test.columns if c not in ("Model", value)]
    wide = test.filter(F.col("Model") == first).withColumnRenamed(value, columns[first]).drop("Model").join(
        test.filter(F.col("Model") == second).select("IDpol", F.col(value).alias(columns[second])), "IDpol")
    return wide.select(*keys, columns[first], columns[second], *(
        [F.lit(0.25).alias(columns[baseline])] if baseline else []))


@query
def occurrence_predictions(spark, folder):
    wide = _wide(base.occurrence_scores(spark, folder), occurrence.PROBABILITIES, "Score")
    return occurrence.predictions(wide, [V.LOGISTIC, V.BOOSTING], V.BOOSTING, 0.15)


@query
def frequency_predictions(spark, folder):
    wide = _wide(base.frequency_scores(spark, folder), frequency.COLUMNS, "PredictedFrequency",
                 V.BASELINE_FREQUENCY)
    rates = wide.withColumn("ClaimFrequency", F.col("ClaimNb") / F.col("Exposure"))
    return frequency.predictions(rates, V.POISSON)


@query
def severity_predictions(spark, folder):
    wide = _wide(base.severity_scores(spark, folder), severity.COLUMNS, "PredictedSeverity",
                 V.BASELINE_SEVERITY)
    return severity.predictions(wide, V.GAMMA)


def _published(spark, label: str, tables: dict[str, DataFrame]) -> str:
    target = f"{shared_folder(spark)}/{label}-{uuid4().hex}"
    store.write_tables(tables, target, "csv")
    return target


@query
def occurrence_published_review(spark, folder):
    """Reports on formula scores, published as CSV, read back and reviewed."""
    test = _case(spark, folder, "Test")
    cases = test.unionByName(test.filter(F.col("Model") == V.LOGISTIC).withColumn(
        "Model", F.lit(occurrence.SELECTED)))
    target = _published(spark, "occurrence-reports", {
        "claim_occurrence_metrics": curves.occurrence_metrics(cases, F.lit(0.2)),
        "prediction_sample": sampling.prediction_sample(
            test.filter(F.col("Model") == V.LOGISTIC).select("IDpol", "Score"), "Score", 500),
        "logistic_coefficients": models.coefficient_table(base.coefficients(spark, folder), "OddsRatio")})
    return review.of_folder(spark, "occurrence", target)


@query
def frequency_published_review(spark, folder):
    scores = base.frequency_scores(spark, folder)
    metrics = audit.frequency_metrics(scores)
    validation, test = (metrics.filter(F.col("Sample") == s) for s in ("Validation", "Test"))
    best = audit.select_frequency(validation).first()["Model"]
    chosen = _one(scores, best).filter("Sample = 'Test'")
    target = _published(spark, "frequency-reports", {
        "validation_frequency_model_comparison": validation,
        "test_frequency_model_comparison": test,
        "selected_frequency_model_summary": _one(test, best),
        "frequency_calibration_deciles": audit.frequency_deciles(chosen, best),
        "segment_frequency_calibration": audit.frequency_segments(chosen, best),
        "poisson_coefficients": models.coefficient_table(base.coefficients(spark, folder), "RateRatio")})
    return review.of_folder(spark, "frequency", target)


@query
def severity_published_review(spark, folder):
    scores = base.severity_scores(spark, folder)
    metrics = audit.severity_metrics(scores)
    validation, test = (metrics.filter(F.col("Sample") == s) for s in ("Validation", "Test"))
    best = audit.select_severity(validation).first()["Model"]
    chosen = _one(scores, best).filter("Sample = 'Test'")
    target = _published(spark, "severity-reports", {
        "validation_severity_model_comparison": validation,
        "test_severity_model_comparison": test,
        "selected_severity_model_summary": _one(test, best),
        "severity_calibration_deciles": audit.severity_deciles(chosen, best),
        "segment_severity_calibration": audit.severity_segments(chosen, best),
        "gamma_coefficients": models.coefficient_table(base.coefficients(spark, folder), "SeverityRatio"),
        "severity_tail_summary": audit.tail_summary(chosen),
        "largest_severity_errors": audit.largest_errors(chosen)})
    return review.of_folder(spark, "severity", target)


@query
def contained_models(spark, folder):
    """Metric rows whose model name contains a text, in any case."""
    metrics = curves.occurrence_metrics(_case(spark, folder, "Test"), F.lit(0.2))
    return review.selected_case(metrics, "GRADIENT").select("Model", "Recall")


@query
def selected_frequency_summary(spark, folder):
    """The test metrics of the model that validation selects."""
    metrics = audit.frequency_metrics(base.frequency_scores(spark, folder))
    best = audit.select_frequency(metrics.filter("Sample = 'Validation'")).select("Model")
    return metrics.filter("Sample = 'Test'").join(F.broadcast(best), "Model").select(
        "Model", "ObservedClaims", "PredictedClaims", "ExposureWeightedPoissonDeviance")


@query
def repeated_issue_ids(spark, folder):
    """Ids on several rows of an issue table; some issues are in it twice."""
    issues = reconcile.claim_count_issues(base.prepared(spark, folder).audit)
    return contracts.duplicate_ids(issues.unionByName(issues.filter("IDpol % 5 = 0")))


@query
def mismatch_tables(spark, folder):
    """Mismatches are written if there are any; a table written again replaces the first."""
    target = f"{shared_folder(spark)}/mismatches-{uuid4().hex}"
    found = quality.mismatches(quality.raw_consistency(*_typed(spark, folder)))
    for _ in range(2):
        store.write_if_any(found, target, "some")
    store.write_if_any(found.filter("false"), target, "none")
    try:
        absent = store.read_tables(spark, target, ["some", "none"]) is None
    except FileNotFoundError as error:
        absent = str(error).count(target) == 1 and "none" in str(error)
    return store.read_tables(spark, target, ["some"])["some"].agg(
        F.count("*").alias("Mismatches"), F.lit(absent).alias("NoEmptyTable"))


@query
def guard_outcomes(spark, folder):
    """Whether each guard stops the tables it should stop, and lets the others pass."""
    policy, claims = base.policy(spark, folder), base.claims(spark, folder)
    guards = {
        "columns": (lambda df: contracts.require_columns(df, V.POLICY_COLUMNS, "policies"),
                    policy, policy.drop("Area")),
        "rows": (lambda df: contracts.require_rows(df, "policies"), policy, policy.filter("IDpol IS NULL")),
        "unique": (lambda df: contracts.require_unique(df, "policies"), policy, claims),
        # The plan runs in full on the executors; no row comes to the driver.
        "one per key": (lambda df: contracts.one_per_key(df.select("IDpol"), "policies").write.format(
            "noop").mode("overwrite").save(), policy, claims),
        "fit for a model": (lambda df: contracts.require_none(df, {"many": "ClaimNb > 3"}, "sample"),
                            policy.filter("ClaimNb <= 3"), policy),
    }

    def stops(guard, df):
        try:
            guard(df)
            return False
        except (ValueError, PySparkException):
            return True

    return spark.createDataFrame(
        [(name, stops(guard, good), stops(guard, bad)) for name, (guard, good, bad) in guards.items()],
        "Guard string, StopsGood boolean, StopsBad boolean")


@query
def saved_model_scores(spark, folder):
    """A model saved, loaded and scored again, next to its first scores."""
    run = _logistic_run(spark, folder)
    target = f"{shared_folder(spark)}/saved-{uuid4().hex}"
    run.model.save(target)
    rows = base.occurrence_split(spark, folder).filter("Sample = 'Test'")
    again = models.FittedModel.load(spark, target).score(run.model.score(rows, "First"), "Second")
    return again.agg(
        F.count("*").alias("Policies"),
        F.sum(F.when(F.col("First") == F.col("Second"), 1).otherwise(0)).cast("bigint").alias("Equal"))


@lru_cache(maxsize=8)
def _logistic_run(spark, folder):
    return occurrence.train_logistic(base.occurrence_split(spark, folder))


@lru_cache(maxsize=8)
def _comparison(spark, folder):
    return occurrence.compare(base.occurrence_split(spark, folder))


@lru_cache(maxsize=8)
def _frequency_run(spark, folder):
    return frequency.train(base.frequency_split(spark, folder))


@lru_cache(maxsize=8)
def _severity_run(spark, folder):
    return severity.train(base.severity_split(spark, folder))


@query
def logistic_metrics(spark, folder):
    return _logistic_run(spark, folder).reports["claim_occurrence_metrics"]


@query
def fit_gradients(spark, folder):
    """Whether the penalised loss of each fitted regression is flat where it ended."""
    def training(split):
        return split(spark, folder).filter("Sample = 'Training'")

    logistic_rows, rates, losses = (
        training(x) for x in (base.occurrence_split, base.frequency_split, base.severity_split))
    tables = {
        V.LOGISTIC: _logistic_run(spark, folder).model.gradient(
            logistic_rows, "HasClaim", None, 1.0 / logistic_rows.count()),
        V.POISSON: _frequency_run(spark, folder).models[V.POISSON].gradient(
            rates, "ClaimFrequency", "Exposure", 1e-4),
        V.GAMMA: _severity_run(spark, folder).models[V.GAMMA].gradient(
            losses, "AverageClaimSeverity", "ClaimNb", 1e-4),
    }
    parts = [t.agg((F.max(F.abs("Gradient")) < 1e-4).alias("Flat"), F.count("*").alias("Features")).select(
        F.lit(name).alias("Model"), "Flat", "Features") for name, t in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def logistic_coefficients(spark, folder):
    return _logistic_run(spark, folder).reports["logistic_coefficients"]


@query
def logistic_predictions(spark, folder):
    return _logistic_run(spark, folder).predictions


@query
def logistic_review(spark, folder):
    reports = _logistic_run(spark, folder).reports
    return review.occurrence_review(
        reports["claim_occurrence_metrics"], reports["prediction_sample"],
        reports["logistic_coefficients"])


@query
def occurrence_model_comparison(spark, folder):
    run = _comparison(spark, folder)
    return run.validation.unionByName(run.test)


@query
def occurrence_model_predictions(spark, folder):
    return _comparison(spark, folder).predictions()


@query
def permutation_importances(spark, folder):
    return _comparison(spark, folder).importance(
        features.with_missing_label(base.occurrence_split(spark, folder)))


@query
def frequency_model_comparison(spark, folder):
    run = _frequency_run(spark, folder)
    return run.validation.unionByName(run.test)


@query
def frequency_model_predictions(spark, folder):
    return _frequency_run(spark, folder).predictions()


@query
def poisson_coefficients(spark, folder):
    return _frequency_run(spark, folder).reports()["poisson_coefficients"]


@query
def strongest_coefficients(spark, folder):
    table = _frequency_run(spark, folder).reports()["poisson_coefficients"]
    return models.strongest(table, True).unionByName(models.strongest(table, False))


@query
def frequency_review(spark, folder):
    run = _frequency_run(spark, folder)
    reports = run.reports()
    return review.frequency_review(
        run.selected, reports["validation_frequency_model_comparison"],
        reports["test_frequency_model_comparison"], reports["frequency_calibration_deciles"],
        reports["segment_frequency_calibration"], reports["poisson_coefficients"])


@query
def severity_model_comparison(spark, folder):
    run = _severity_run(spark, folder)
    return run.validation.unionByName(run.test)


@query
def severity_model_predictions(spark, folder):
    return _severity_run(spark, folder).predictions()


@query
def gamma_coefficients(spark, folder):
    return _severity_run(spark, folder).reports()["gamma_coefficients"]


@query
def severity_review(spark, folder):
    run = _severity_run(spark, folder)
    reports = run.reports()
    return review.severity_review(
        run.selected, reports["validation_severity_model_comparison"],
        reports["test_severity_model_comparison"], reports["severity_calibration_deciles"],
        reports["segment_severity_calibration"], reports["gamma_coefficients"],
        reports["severity_tail_summary"], reports["largest_severity_errors"])
