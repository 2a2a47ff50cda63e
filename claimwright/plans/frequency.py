"""Claim frequency: constant, Poisson and boosted models, compared and audited."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from claimwright import vocabulary as V
from claimwright.functions.measures import clipped
from claimwright.operators import audit, boosting, features, models, sampling
from claimwright.plans import review
from claimwright.session import stage
from claimwright.sources import store

COLUMNS = {
    V.BASELINE_FREQUENCY: "BaselinePredictedFrequency",
    V.POISSON: "PoissonPredictedFrequency",
    V.BOOSTING: "BoostingPredictedFrequency",
}


def split(policy: DataFrame) -> DataFrame:
    sample = features.check_frequency(features.frequency_sample(policy))
    return stage(sampling.stratified_split(sample, "ClaimCountStratum"), "frequency-split", "IDpol")


@dataclass
class FrequencyRun:
    models: dict
    baseline: float
    scored: DataFrame
    validation: DataFrame
    test: DataFrame
    selected: str
    rows: DataFrame

    def selected_scores(self) -> DataFrame:
        test = self.scored.filter("Sample = 'Test'")
        return long_scores(test).filter(F.col("Model") == self.selected)

    def reports(self) -> dict[str, DataFrame]:
        chosen = self.selected_scores()
        return {
            "split_summary": sampling.frequency_split_summary(self.rows),
            "validation_frequency_model_comparison": self.validation,
            "test_frequency_model_comparison": self.test,
            "selected_frequency_model_summary": self.test.filter(
                F.col("Model") == self.selected),
            "frequency_calibration_deciles": audit.frequency_deciles(chosen, self.selected),
            "segment_frequency_calibration": audit.frequency_segments(chosen, self.selected),
            "poisson_coefficients": self.models[V.POISSON].coefficients("RateRatio"),
        }

    def predictions(self) -> DataFrame:
        return predictions(self.scored.filter("Sample = 'Test'"), self.selected)

    def publish(self, folder: str, kind: str = "csv") -> None:
        """Writes all report tables, the test predictions and the models."""
        reports = self.reports()
        checks = review.frequency_review(
            self.selected, self.validation, self.test, reports["frequency_calibration_deciles"],
            reports["segment_frequency_calibration"], reports["poisson_coefficients"])
        store.write_tables({**reports, "report_checks": checks}, folder, kind)
        store.write_table(self.predictions(), folder, "predictions", kind)
        for name, model in self.models.items():
            model.save(f"{folder}/models/{name.replace(' ', '_').lower()}")


def score(rows: DataFrame, fitted: dict, baseline: float) -> DataFrame:
    """Rows with one prediction column per model, in one pass and keyed by id."""
    out = rows.withColumn(COLUMNS[V.BASELINE_FREQUENCY], F.lit(baseline))
    for name, model in fitted.items():
        out = model.score(out, COLUMNS[name])
    return out.withColumns({c: clipped(F.col(c)) for c in COLUMNS.values()})


def long_scores(scored: DataFrame) -> DataFrame:
    """One row per policy and model."""
    pairs = F.array(*[
        F.struct(F.lit(n).alias("Model"), F.col(c).alias("PredictedFrequency"))
        for n, c in COLUMNS.items()])
    return scored.select(
        *[c for c in scored.columns if c not in COLUMNS.values()], F.inline(pairs))


def predictions(scored: DataFrame, selected: str) -> DataFrame:
    """Policies with every model's frequency and the expected claims of the selected one."""
    chosen = F.col(COLUMNS[selected])
    return scored.select(
        "IDpol", "Exposure", "ClaimNb",
        F.col("ClaimFrequency").alias("ObservedFrequency"), *COLUMNS.values(),
        F.lit(selected).alias("SelectedModel"),
        chosen.alias("SelectedPredictedFrequency"),
        (chosen * F.col("Exposure")).alias("SelectedExpectedClaims"))


def train(rows: DataFrame, rounds: int = 300) -> FrequencyRun:
    """Fits on Training, selects on Validation (the baseline is no candidate), and
    measures on Test. `rows` is the labelled split."""
    training = rows.filter("Sample = 'Training'")
    baseline = models.portfolio_frequency(training)
    fitted = {
        V.POISSON: models.fit_poisson(training),
        V.BOOSTING: boosting.fit_boosting(
            training, "ClaimFrequency", "Exposure", V.RATE_NUMBERS, V.MODEL_TEXTS,
            replace(boosting.FREQUENCY_SETTINGS, rounds=rounds)),
    }
    scored = stage(
        score(rows.filter("Sample <> 'Training'"), fitted, baseline), "frequency-scores")
    metrics = audit.frequency_metrics(long_scores(scored))
    validation = metrics.filter("Sample = 'Validation'")
    best = audit.select_frequency(validation).first()["Model"]
    return FrequencyRun(
        fitted, baseline, scored, validation, metrics.filter("Sample = 'Test'"), best, rows)
