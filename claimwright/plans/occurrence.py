"""Claim occurrence: train, compare and audit the logistic and boosted models."""

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright import vocabulary as V
from claimwright.functions.bands import with_bands
from claimwright.operators import audit, boosting, curves, features, models, sampling
from claimwright.operators.importance import permutation_importance
from claimwright.plans import review
from claimwright.session import stage
from claimwright.sources import store


def split(policy: DataFrame) -> DataFrame:
    """The checked sample with its 60/20/20 label, written once for the passes to come."""
    sample = features.check_occurrence(features.occurrence_sample(policy))
    return stage(sampling.stratified_split(sample, "HasClaim"), "occurrence-split", "IDpol")


PROBABILITIES = {V.LOGISTIC: "LogisticProbability", V.BOOSTING: "GradientBoostingProbability"}


def score(rows: DataFrame, fitted: dict) -> DataFrame:
    """Rows with one probability column per model, in one pass and keyed by id."""
    out = rows.select(
        "Sample", "IDpol", "HasClaim", "Exposure", *V.OCCURRENCE_NUMBERS, *V.MODEL_TEXTS)
    for name, model in fitted.items():
        out = model.score(out, PROBABILITIES[name])
    return out


def long_scores(scored: DataFrame, names: list[str]) -> DataFrame:
    """One row per policy and model."""
    pairs = F.array(*[
        F.struct(F.lit(n).alias("Model"), F.col(PROBABILITIES[n]).alias("Score")) for n in names])
    return scored.select(
        "Sample", "IDpol", "HasClaim", "Area", "VehGas", "DrivAge", F.inline(pairs))


@dataclass
class Comparison:
    """Fitted models, scores, thresholds, and the audit tables built from them."""

    models: dict
    scored: DataFrame
    thresholds: dict[str, float]
    validation: DataFrame
    test: DataFrame
    selected: str

    def test_scores(self) -> DataFrame:
        return long_scores(self.scored.filter("Sample = 'Test'"), list(self.models))

    def selected_scores(self) -> DataFrame:
        return self.test_scores().filter(F.col("Model") == self.selected)

    def reports(self) -> dict[str, DataFrame]:
        names = list(self.models)
        return {
            "validation_model_comparison": self.validation,
            "test_model_comparison": self.test,
            "selected_model_summary": self.test.filter(F.col("Model") == self.selected),
            "capacity_analysis": curves.capacity_comparison(self.test_scores(), names),
            "subgroup_metrics": curves.subgroup_metrics(
                with_age_band(self.selected_scores()), curves.per_model(self.thresholds)),
        }

    def importance(self, rows: DataFrame, model: str = V.BOOSTING) -> DataFrame:
        """Permutation importance of one model on the test rows of the split."""
        return permutation_importance(
            self.models[model], rows.filter("Sample = 'Test'"),
            [*V.OCCURRENCE_NUMBERS, *V.MODEL_TEXTS])

    def predictions(self) -> DataFrame:
        return predictions(self.scored.filter("Sample = 'Test'"), list(self.models), self.selected,
                           self.thresholds[self.selected])

    def publish(self, folder: str, rows: DataFrame, kind: str = "csv") -> None:
        """Writes all report tables, the test predictions and the models."""
        store.write_tables(
            {**self.reports(), "permutation_importance": self.importance(
                features.with_missing_label(rows))}, folder, kind)
        store.write_table(self.predictions(), folder, "predictions", kind)
        for name, model in self.models.items():
            model.save(f"{folder}/models/{name.replace(' ', '_').lower()}")


def predictions(scored: DataFrame, names: list[str], selected: str, threshold: float) -> DataFrame:
    """Policies with every model's probability and the selected model's decision."""
    chosen = F.col(PROBABILITIES[selected])
    return scored.select(
        "IDpol", "Exposure", "HasClaim", *[PROBABILITIES[m] for m in names],
        F.lit(selected).alias("SelectedModel"), chosen.alias("SelectedModelProbability"),
        (chosen >= threshold).cast("int").alias("SelectedModelPrediction"))


def with_age_band(scored: DataFrame) -> DataFrame:
    return with_bands(scored, ("DrivAgeBand",))


def saved_logistic(spark: SparkSession, folder: str) -> models.FittedModel:
    """The model a logistic run has published in the folder; it must be there."""
    try:
        return models.FittedModel.load(spark, f"{folder.rstrip('/')}/models/logistic")
    except AnalysisException as error:
        raise FileNotFoundError(
            f"No logistic model in {folder}: run the logistic step first.") from error


def compare(rows: DataFrame, rounds: int = 250, fitted: dict | None = None) -> Comparison:
    """Fits the models not yet `fitted` on Training, picks thresholds and model on
    Validation, and measures on Test. `rows` is the labelled split."""
    labelled = features.with_missing_label(rows)
    train = labelled.filter("Sample = 'Training'")
    fits = {
        V.LOGISTIC: lambda: models.fit_logistic(rows.filter("Sample = 'Training'")),
        V.BOOSTING: lambda: boosting.fit_boosting(
            train, "HasClaim", None, V.OCCURRENCE_NUMBERS, V.MODEL_TEXTS,
            replace(boosting.OCCURRENCE_SETTINGS, rounds=rounds)),
    }
    given = fitted or {}
    fitted = {name: given[name] if name in given else fit() for name, fit in fits.items()}
    scored = stage(
        score(labelled.filter("Sample <> 'Training'"), fitted), "occurrence-scores")
    long = long_scores(scored, list(fitted))
    validation = long.filter("Sample = 'Validation'")
    curve = curves.threshold_curve(curves.score_steps(validation))
    thresholds = {m: t for m, (t, _) in curves.best_thresholds(curve).items()}
    at = curves.per_model(thresholds)
    measured = {
        s: curves.occurrence_metrics(long.filter(F.col("Sample") == s), at).withColumn(
            "Sample", F.lit(s)).drop("NegativePredictiveValue")
        for s in ("Validation", "Test")
    }
    best = audit.select_occurrence(measured["Validation"]).first()["Model"]
    return Comparison(
        fitted, scored, thresholds, measured["Validation"], measured["Test"], best)


@dataclass
class LogisticRun:
    """The single-model run: curve, metrics and predictions of the logistic model."""

    model: models.FittedModel
    threshold: float
    reports: dict[str, DataFrame]
    predictions: DataFrame

    def publish(self, folder: str, kind: str = "csv") -> None:
        """Writes all report tables, the test predictions and the model."""
        checks = review.occurrence_review(
            self.reports["claim_occurrence_metrics"], self.reports["prediction_sample"],
            self.reports["logistic_coefficients"])
        store.write_tables({**self.reports, "report_checks": checks}, folder, kind)
        store.write_table(self.predictions, folder, "predictions", kind)
        self.model.save(f"{folder}/models/logistic")


SELECTED = f"{V.LOGISTIC} — selected threshold"
DEFAULT = f"{V.LOGISTIC} — threshold 0.50"


def decided(scored: DataFrame, threshold: float) -> DataFrame:
    """Policies with the logistic probability and the decisions at one half and at the
    selected threshold."""
    probability = F.col(PROBABILITIES[V.LOGISTIC])
    return scored.select(
        "IDpol", "Exposure", "HasClaim", probability.alias("PredictedClaimProbability"),
        (probability >= 0.5).cast("int").alias("PredictedClaimDefaultThreshold"),
        (probability >= threshold).cast("int").alias("PredictedClaimSelectedThreshold"))


def train_logistic(rows: DataFrame) -> LogisticRun:
    """Fits on Training, picks the F2 threshold on Validation, measures on Test."""
    train = rows.filter("Sample = 'Training'")
    model = models.fit_logistic(train)
    scored = stage(
        score(rows.filter("Sample <> 'Training'"), {V.LOGISTIC: model}), "logistic-scores")
    long = long_scores(scored, [V.LOGISTIC])
    curve = curves.threshold_curve(curves.score_steps(long.filter("Sample = 'Validation'")))
    threshold = curves.best_thresholds(curve)[V.LOGISTIC][0]
    test = long.filter("Sample = 'Test'")
    base = models.claim_rate(train)
    variants = {V.BASELINE_OCCURRENCE: 0.5, DEFAULT: 0.5, SELECTED: threshold}
    cases = test.select("IDpol", "HasClaim", F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("Model"),
            (F.lit(base) if name == V.BASELINE_OCCURRENCE else F.col("Score")).alias("Score"))
        for name in variants
    ])))
    predictions = decided(scored.filter("Sample = 'Test'"), threshold)
    return LogisticRun(model, threshold, {
        "split_summary": sampling.occurrence_split_summary(rows),
        "validation_threshold_results": curve,
        "claim_occurrence_metrics": curves.occurrence_metrics(cases, curves.per_model(variants)),
        "test_threshold_comparison": curves.threshold_report(test, threshold),
        "logistic_coefficients": model.coefficients("OddsRatio"),
        "prediction_sample": sampling.prediction_sample(
            predictions, "PredictedClaimProbability"),
    }, predictions)
