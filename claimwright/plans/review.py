"""Pass/fail reviews of the published model reports.

Each takes the report tables, as built or as read back from a report folder; `of_folder`
reads what a run has published and reviews that.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.functions.measures import count_if
from claimwright.operators import audit
from claimwright.operators.shaping import long_report, stacked
from claimwright.sources import store

NAMES = ("Validation", "Passed")


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def _non_empty(df: DataFrame, text: str) -> DataFrame:
    return long_report(_rows(df), NAMES, [(text, F.col("n") > 0)])


def _known(df: DataFrame, name: str, text: str) -> DataFrame:
    row = df.agg(count_if(F.col(name).isNull() | F.isnan(name)).alias("n"))
    return long_report(row, NAMES, [(text, F.col("n") == 0)])


def _positive(df: DataFrame, name: str, text: str) -> DataFrame:
    row = df.agg(count_if(~F.coalesce(F.col(name) > 0, F.lit(False))).alias("n"))
    return long_report(row, NAMES, [(text, F.col("n") == 0)])


def _three(df: DataFrame, text: str) -> DataFrame:
    return long_report(_rows(df), NAMES, [(text, F.col("n") == 3)])


def _ten_deciles(df: DataFrame) -> DataFrame:
    row = df.agg(F.count_distinct("RiskDecile").alias("n"))
    return long_report(row, NAMES, [("Calibration contains ten deciles", F.col("n") == 10)])


def _from_validation(selected: str, validation: DataFrame, best: DataFrame) -> DataFrame:
    """The model a run selected was trained, and is the best by validation."""
    named = validation.select("Model", F.lit("trained").alias("as_")).unionByName(
        best.select("Model", F.lit("best").alias("as_"))).filter(F.col("Model") == selected)
    row = named.agg(count_if(F.col("as_") == "trained").alias("trained"),
                    count_if(F.col("as_") == "best").alias("best"))
    return long_report(row, NAMES, [
        ("Selected model came from validation", (F.col("trained") == 1) & (F.col("best") == 1))])


def selected_case(metrics: DataFrame, text: str = "selected threshold") -> DataFrame:
    """The metric row whose model name contains the text, in any case."""
    return metrics.filter(F.lower("Model").contains(text.lower()))


def occurrence_review(metrics: DataFrame, sample: DataFrame, coefficients: DataFrame) -> DataFrame:
    case = selected_case(metrics).agg(
        F.max(F.col("Threshold")).alias("t"), F.max("ROCAUC").alias("a"),
        F.max("PRAUC").alias("p"))
    return stacked([
        _three(metrics, "Three evaluation rows exist"),
        long_report(case, NAMES, [
            ("Selected threshold is between zero and one",
             F.coalesce((F.col("t") > 0) & (F.col("t") < 1), F.lit(False))),
            ("ROC-AUC is at least 0.50", F.coalesce(F.col("a") >= 0.5, F.lit(False))),
            ("PR-AUC exceeds zero", F.coalesce(F.col("p") > 0, F.lit(False))),
        ]),
        _non_empty(sample, "Test sample contains predictions"),
        _non_empty(coefficients, "Coefficient table is non-empty"),
    ])


def frequency_review(selected: str, validation: DataFrame, test: DataFrame, deciles: DataFrame,
                     segments: DataFrame, coefficients: DataFrame) -> DataFrame:
    ends = audit.decile_extremes(deciles, "ObservedFrequency")
    return stacked([
        _three(test, "Three models were evaluated"),
        _from_validation(selected, validation, audit.select_frequency(validation)),
        _positive(test, "PredictedClaims", "All predicted claim totals are positive"),
        _known(test, "ExposureWeightedPoissonDeviance", "All Poisson deviances are finite"),
        _ten_deciles(deciles),
        long_report(ends, NAMES, [
            ("Risk decile ten has higher observed frequency than decile one",
             F.coalesce(F.col("Increasing"), F.lit(False)))]),
        _non_empty(segments, "Segment calibration is non-empty"),
        _non_empty(coefficients, "Poisson coefficient table is non-empty"),
    ])


def severity_review(selected: str, validation: DataFrame, test: DataFrame, deciles: DataFrame,
                    segments: DataFrame, coefficients: DataFrame, tail: DataFrame,
                    errors: DataFrame) -> DataFrame:
    return stacked([
        _three(test, "Three models were evaluated"),
        _from_validation(selected, validation, audit.select_severity(validation)),
        _known(test, "WeightedGammaDeviance", "All Gamma deviances are finite"),
        _positive(test, "PredictedClaimAmount", "All predicted claim amounts are positive"),
        _ten_deciles(deciles),
        _positive(deciles, "PredictedSeverity", "Predicted severity is positive in every decile"),
        _non_empty(segments, "Segment calibration is non-empty"),
        _non_empty(coefficients, "Gamma coefficient table is non-empty"),
        _non_empty(tail, "Tail summary is non-empty"),
        _non_empty(errors, "Largest-error report contains records"),
    ])




# The tables a review reads, in the order it takes them; the one named first holds the
# selected model, where there is one.
TABLES = {
    "occurrence": (None, ["claim_occurrence_metrics", "prediction_sample", "logistic_coefficients"]),
    "frequency": ("selected_frequency_model_summary", [
        "validation_frequency_model_comparison", "test_frequency_model_comparison",
        "frequency_calibration_deciles", "segment_frequency_calibration", "poisson_coefficients"]),
    "severity": ("selected_severity_model_summary", [
        "validation_severity_model_comparison", "test_severity_model_comparison",
        "severity_calibration_deciles", "segment_severity_calibration", "gamma_coefficients",
        "severity_tail_summary", "largest_severity_errors"]),
}


def of_folder(spark: SparkSession, family: str, folder: str, kind: str = "csv") -> DataFrame:
    """The review of published report tables; all missing ones are named in the error."""
    summary, names = TABLES[family]
    found = store.read_tables(spark, folder, [*([summary] if summary else []), *names], kind)
    tables = [found[n] for n in names]
    if summary is None:
        return occurrence_review(*tables)
    selected = [r["Model"] for r in found[summary].select("Model").distinct().limit(2).collect()]
    if len(selected) != 1:
        raise ValueError(f"{summary} names {len(selected)} models, not one")
    review = frequency_review if family == "frequency" else severity_review
    return review(selected[0], *tables)
