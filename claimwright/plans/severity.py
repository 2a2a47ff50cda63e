"""Claim severity: constant, Gamma and boosted models, compared and audited."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from claimwright import vocabulary as V
from claimwright.functions.measures import clipped
from claimwright.operators import audit, boosting, features, models, sampling
from claimwright.plans import review
from claimwright.session import stage
from claimwright.sources import store

COLUMNS = {
    V.BASELINE_SEVERITY: "BaselinePredictedSeverity",
    V.GAMMA: "GammaPredictedSeverity",
    V.BOOSTING: "BoostingPredictedSeverity",
}


def split(policy: DataFrame) -> DataFrame:
    sample = features.severity_sample(stage(features.severity_policies(policy), "severity-rows"))
    return stage(sampling.stratified_split(
        features.check_severity(sample), "SeverityStratum"), "severity-split", "IDpol")


@dataclass
class SeverityRun:
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
            "split_summary": sampling.severity_split_summary(self.rows),
            "validation_severity_model_comparison": self.validation,
            "test_severity_model_comparison": self.test,
            "selected_severity_model_summary": self.test.filter(
                F.col("Model") == self.selected),
            "severity_calibration_deciles": audit.severity_deciles(chosen, self.selected),
            "segment_severity_calibration": audit.severity_segments(chosen, self.selected),
            "gamma_coefficients": self.models[V.GAMMA].coefficients("SeverityRatio"),
            "severity_tail_summary": audit.tail_summary(
                self.rows.filter("Sample = 'Test'")),
            "largest_severity_errors": audit.largest_errors(chosen),
        }

    def predictions(self) -> DataFrame:
        return predictions(self.scored.filter("Sample = 'Test'"), self.selected)

    def publish(self, folder: str, kind: str = "csv") -> None:
        """Writes all report tables, the test predictions and the models."""
        reports = self.reports()
        checks = review.severity_review(
            self.selected, self.validation, self.test, reports["severity_calibration_deciles"],
            reports["segment_severity_calibration"], reports["gamma_coefficients"],
            reports["severity_tail_summary"], reports["largest_severity_errors"])
        store.write_tables({**reports, "report_checks": checks}, folder, kind)
        store.write_table(self.predictions(), folder, "predictions", kind)
        for name, model in self.models.items():
            model.save(f"{folder}/models/{name.replace(' ', '_').lower()}")


def score(rows: DataFrame, fitted: dict, baseline: float) -> DataFrame:
    """Rows with one prediction column per model, in one pass and keyed by id."""
    out = rows.withColumn(COLUMNS[V.BASELINE_SEVERITY], F.lit(baseline))
    for name, model in fitted.items():
        out = model.score(out, COLUMNS[name])
    return out.withColumns({c: clipped(F.col(c)) for c in COLUMNS.values()})


def long_scores(scored: DataFrame) -> DataFrame:
    """One row per policy and model."""
    pairs = F.array(*[
        F.struct(F.lit(n).alias("Model"), F.col(c).alias("PredictedSeverity"))
        for n, c in COLUMNS.items()])
    return scored.select(
        *[c for c in scored.columns if c not in COLUMNS.values()], F.inline(pairs))


def predictions(scored: DataFrame, selected: str) -> DataFrame:
    """Policies with every model's severity and the expected amount of the selected one."""
    chosen = F.col(COLUMNS[selected])
    return scored.select(
        "IDpol", "ClaimNb", "CompleteTotalClaimAmount", "AverageClaimSeverity",
        *COLUMNS.values(), F.lit(selected).alias("SelectedModel"),
        chosen.alias("SelectedPredictedSeverity"),
        (chosen * F.col("ClaimNb")).alias("SelectedPredictedClaimAmount"))


def train(rows: DataFrame, rounds: int = 300) -> SeverityRun:
    """Fits on Training, selects on Validation (the baseline is a candidate), and
    measures on Test. `rows` is the labelled split."""
    training = rows.filter("Sample = 'Training'")
    baseline = models.mean_severity(training)
    fitted = {
        V.GAMMA: models.fit_gamma(training),
        V.BOOSTING: boosting.fit_boosting(
            training, "AverageClaimSeverity", "ClaimNb", V.RATE_NUMBERS, V.MODEL_TEXTS,
            replace(boosting.SEVERITY_SETTINGS, rounds=rounds)),
    }
    scored = stage(
        score(rows.filter("Sample <> 'Training'"), fitted, baseline), "severity-scores")
    metrics = audit.severity_metrics(long_scores(scored))
    validation = metrics.filter("Sample = 'Validation'")
    best = audit.select_severity(validation).first()["Model"]
    return SeverityRun(
        fitted, baseline, scored, validation, metrics.filter("Sample = 'Test'"), best, rows)
