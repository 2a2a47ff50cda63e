"""Audit tables of the rate and amount models.

Scored rows have the columns Model, Sample and IDpol, the observed values, and
PredictedFrequency or PredictedSeverity.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from claimwright import vocabulary as V
from claimwright.functions.bands import with_bands
from claimwright.functions.casting import label
from claimwright.functions.measures import clipped, gamma_loss, poisson_loss, ratio
from claimwright.operators.ranking import not_after, quantile_table, rows_at, with_decile
from claimwright.operators.shaping import long_report, unpivoted


def frequency_metrics(scored: DataFrame, within: list[str] = ("Model", "Sample")) -> DataFrame:
    """Rate, count, deviance and calibration metrics in one weighted aggregation.

    The deviance of the constant weighted mean, which D2 compares with, follows from
    three of the same sums, so the rows are read once.
    """
    w, n = F.col("Exposure"), F.col("ClaimNb").cast("double")
    rate, expected = n / w, clipped(F.col("PredictedFrequency"))
    count = expected * w
    log_rate = F.when(n > 0, n * F.log(rate)).otherwise(0.0)
    sums = scored.groupBy(*within).agg(
        F.count("*").alias("_n"),
        F.sum(w).alias("_w"),
        F.sum(n).alias("ObservedClaims"),
        F.sum(count).alias("PredictedClaims"),
        F.sum(w * poisson_loss(rate, expected)).alias("_rate_loss"),
        F.avg(poisson_loss(n, count)).alias("CountMeanPoissonDeviance"),
        F.sum(log_rate).alias("_log"),
        F.sum(w * F.abs(rate - expected)).alias("_mae"),
        F.avg(F.abs(n - count)).alias("CountMAE"),
        F.sqrt(F.avg(F.pow(n - count, 2))).alias("CountRMSE"),
        F.avg(F.pow(n - count, 2) / clipped(count)).alias("PearsonDispersionDiagnostic"),
    )
    c = F.col
    observed, predicted = ratio(c("ObservedClaims"), c("_w")), ratio(c("PredictedClaims"), c("_w"))
    constant = 2.0 * (c("_log") - c("ObservedClaims") * F.log(observed))
    return sums.select(
        *within,
        ratio(c("_rate_loss"), c("_w")).alias("ExposureWeightedPoissonDeviance"),
        "CountMeanPoissonDeviance",
        (1.0 - ratio(c("_rate_loss"), constant)).alias("D2Poisson"),
        ratio(c("_mae"), c("_w")).alias("WeightedFrequencyMAE"),
        "CountMAE", "CountRMSE", "ObservedClaims", "PredictedClaims",
        ratio(c("PredictedClaims"), c("ObservedClaims")).alias("PredictedToObservedClaimsRatio"),
        observed.alias("ObservedFrequency"),
        predicted.alias("PredictedFrequency"),
        (predicted - observed).alias("FrequencyDifference"),
        "PearsonDispersionDiagnostic",
    )


def severity_metrics(scored: DataFrame, within: list[str] = ("Model", "Sample")) -> DataFrame:
    """Claim-weighted deviance, errors and totals in one aggregation."""
    w, y = F.col("ClaimNb").cast("double"), F.col("AverageClaimSeverity")
    expected = clipped(F.col("PredictedSeverity"))
    sums = scored.groupBy(*within).agg(
        F.count("*").alias("Policies"),
        F.sum("ClaimNb").alias("Claims"),
        F.sum("CompleteTotalClaimAmount").alias("ObservedClaimAmount"),
        F.sum(expected * w).alias("PredictedClaimAmount"),
        F.sum(y * w).alias("_y"),
        F.sum(w * F.log(y)).alias("_log"),
        F.sum(w * gamma_loss(y, expected)).alias("_loss"),
        F.sum(w * F.abs(y - expected)).alias("_mae"),
        F.sum(w * F.pow(y - expected, 2)).alias("_mse"),
        F.sum(w * (expected - y)).alias("_bias"),
    )
    c, claims = F.col, F.col("Claims").cast("double")
    observed, predicted = ratio(c("_y"), claims), ratio(c("PredictedClaimAmount"), claims)
    constant = 2.0 * (claims * F.log(observed) - c("_log"))
    return sums.select(
        *within,
        ratio(c("_loss"), claims).alias("WeightedGammaDeviance"),
        (1.0 - ratio(c("_loss"), constant)).alias("D2Gamma"),
        ratio(c("_mae"), claims).alias("WeightedMAE"),
        F.sqrt(ratio(c("_mse"), claims)).alias("WeightedRMSE"),
        ratio(c("_bias"), claims).alias("WeightedBias"),
        "Policies", "Claims", "ObservedClaimAmount", "PredictedClaimAmount",
        ratio(c("PredictedClaimAmount"), c("ObservedClaimAmount")).alias(
            "PredictedToObservedAmountRatio"),
        observed.alias("ObservedMeanSeverity"),
        predicted.alias("PredictedMeanSeverity"),
        (predicted - observed).alias("MeanSeverityDifference"),
    )


def frequency_deciles(scored: DataFrame, model: str) -> DataFrame:
    """Observed and predicted frequency per risk decile."""
    rows = scored.select(
        "IDpol", "Exposure", "ClaimNb", clipped(F.col("PredictedFrequency")).alias("_p"))
    summary = with_decile(rows, "_p", "IDpol").groupBy("RiskDecile").agg(
        F.count("*").alias("Policies"),
        F.sum("Exposure").alias("Exposure"),
        F.sum("ClaimNb").alias("ObservedClaims"),
        F.sum(F.col("_p") * F.col("Exposure")).alias("PredictedClaims"),
        F.min("_p").alias("MinimumPredictedFrequency"),
        F.max("_p").alias("MaximumPredictedFrequency"),
        F.avg("_p").alias("MeanPredictedFrequency"),
    )
    return _named(_frequency_ratios(summary), model).orderBy("RiskDecile")


def severity_deciles(scored: DataFrame, model: str) -> DataFrame:
    """Observed and predicted severity per risk decile."""
    rows = scored.select(
        "IDpol", "ClaimNb", "CompleteTotalClaimAmount",
        clipped(F.col("PredictedSeverity")).alias("_p"))
    summary = with_decile(rows, "_p", "IDpol").groupBy("RiskDecile").agg(
        F.count("*").alias("Policies"),
        F.sum("ClaimNb").alias("Claims"),
        F.sum("CompleteTotalClaimAmount").alias("ObservedClaimAmount"),
        F.sum(F.col("_p") * F.col("ClaimNb")).alias("PredictedClaimAmount"),
        F.min("_p").alias("MinimumPredictedSeverity"),
        F.max("_p").alias("MaximumPredictedSeverity"),
    )
    return _named(_severity_ratios(summary), model).orderBy("RiskDecile")


def _named(df: DataFrame, model: str) -> DataFrame:
    return df.select(F.lit(model).alias("Model"), *df.columns)


def _frequency_ratios(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns({
        "ObservedFrequency": ratio(c("ObservedClaims"), c("Exposure")),
        "PredictedFrequency": ratio(c("PredictedClaims"), c("Exposure")),
        "ObservedToExpectedRatio": ratio(c("ObservedClaims"), c("PredictedClaims")),
    })


def _severity_ratios(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns({
        "ObservedSeverity": ratio(c("ObservedClaimAmount"), c("Claims")),
        "PredictedSeverity": ratio(c("PredictedClaimAmount"), c("Claims")),
        "ObservedToExpectedRatio": ratio(c("ObservedClaimAmount"), c("PredictedClaimAmount")),
    })


def frequency_segments(
    scored: DataFrame, model: str, segments: list[str] = V.FREQUENCY_SEGMENTS,
    least_exposure: float = V.SEGMENT_EXPOSURE,
) -> DataFrame:
    """Observed and predicted frequency by segment, all segmentations in one pass."""
    banded = with_bands(scored, ("DrivAgeBand", "BonusMalusBand")).select(
        "Exposure", "ClaimNb",
        (clipped(F.col("PredictedFrequency")) * F.col("Exposure")).alias("_p"), *segments)
    summary = unpivoted(banded, segments, "SegmentType", "Segment", label).groupBy(
        "SegmentType", "Segment").agg(
        F.count("*").alias("Policies"),
        F.sum("Exposure").alias("Exposure"),
        F.sum("ClaimNb").alias("ObservedClaims"),
        F.sum("_p").alias("PredictedClaims"),
    )
    return _named(_frequency_ratios(summary), model).withColumn(
        "EligibleForComparison", F.col("Exposure") >= least_exposure)


def severity_segments(
    scored: DataFrame, model: str, segments: list[str] = V.SEVERITY_SEGMENTS,
    least_policies: int = V.SEGMENT_POLICIES, least_claims: int = V.SEGMENT_CLAIMS,
) -> DataFrame:
    """Observed and predicted severity by segment, all segmentations in one pass."""
    banded = with_bands(scored).select(
        "ClaimNb", "CompleteTotalClaimAmount",
        (clipped(F.col("PredictedSeverity")) * F.col("ClaimNb")).alias("_p"), *segments)
    summary = unpivoted(banded, segments, "SegmentType", "Segment", label).groupBy(
        "SegmentType", "Segment").agg(
        F.count("*").alias("Policies"),
        F.sum("ClaimNb").alias("Claims"),
        F.sum("CompleteTotalClaimAmount").alias("ObservedClaimAmount"),
        F.sum("_p").alias("PredictedClaimAmount"),
    )
    return _named(_severity_ratios(summary), model).withColumn(
        "EligibleForComparison",
        (F.col("Policies") >= least_policies) & (F.col("Claims") >= least_claims))


def tail_summary(sample: DataFrame) -> DataFrame:
    """Percentiles of the average claim and the loss share of the costliest policies."""
    points = quantile_table(sample, ["AverageClaimSeverity"], V.AMOUNT_POINTS).select(
        F.concat(F.lit("Policy average severity: "), F.col("Point")).alias("Metric"), "Value")
    losses = sample.select("IDpol", (-F.col("CompleteTotalClaimAmount")).alias("_place"))
    _, places = rows_at(
        losses, "_place", "IDpol",
        lambda n: [max(1, math.ceil(n * s)) for s in V.TAIL_SHARES] if n else [])
    row = losses.agg(F.sum("_place").alias("total"), *[
        F.sum(F.when(not_after(F.col("_place"), F.col("IDpol"), p), F.col("_place"))).alias(f"s{i}")
        for i, p in enumerate(places)
    ])
    if not places:
        return points
    shares = long_report(row, ("Metric", "Value"), [
        (f"Top {share:.0%} policy share of claim amount", ratio(F.col(f"s{i}"), F.col("total")))
        for i, share in enumerate(V.TAIL_SHARES)
    ])
    return points.unionByName(shares)


def largest_errors(scored: DataFrame, rows: int = 25) -> DataFrame:
    """Policies with the largest financial error, ties by id."""
    expected = clipped(F.col("PredictedSeverity"))
    return (
        scored.select(
            "IDpol", "ClaimNb", "Area", "VehPower", "VehAge", "DrivAge", "BonusMalus",
            "VehBrand", "VehGas", "Region", "CompleteTotalClaimAmount", "AverageClaimSeverity",
            expected.alias("PredictedSeverity"),
            (expected * F.col("ClaimNb")).alias("PredictedClaimAmount"),
        )
        .withColumn("SeverityError", F.expr("PredictedSeverity - AverageClaimSeverity"))
        .withColumn("AbsoluteSeverityError", F.abs("SeverityError"))
        .withColumn("FinancialError", F.expr("PredictedClaimAmount - CompleteTotalClaimAmount"))
        .withColumn("AbsoluteFinancialError", F.abs("FinancialError"))
        .orderBy(F.desc("AbsoluteFinancialError"), "IDpol")
        .limit(rows)
    )


def decile_extremes(deciles: DataFrame, metric: str) -> DataFrame:
    """The metric in the first and the last decile, their ratio, and the order."""
    first, last = F.min_by(metric, "RiskDecile"), F.max_by(metric, "RiskDecile")
    return deciles.agg(first.alias("Lowest"), last.alias("Highest")).withColumns({
        "Ratio": ratio(F.col("Highest"), F.col("Lowest")),
        "Increasing": F.col("Highest") > F.col("Lowest"),
    })


def selected(metrics: DataFrame, order: list[Column], excluded: list[str] = ()) -> DataFrame:
    """The best model by the given order among those not excluded."""
    allowed = metrics.filter(~F.col("Model").isin(list(excluded))) if excluded else metrics
    return allowed.orderBy(*order, "Model").limit(1)


def select_occurrence(validation: DataFrame) -> DataFrame:
    return selected(validation, [F.desc("PRAUC"), F.desc("ROCAUC")])


def select_frequency(validation: DataFrame) -> DataFrame:
    """The baseline is no candidate for the frequency model."""
    return selected(
        validation, [F.asc("ExposureWeightedPoissonDeviance"), F.desc("D2Poisson")],
        [V.BASELINE_FREQUENCY])


def select_severity(validation: DataFrame) -> DataFrame:
    """The baseline is a candidate for the severity model."""
    return selected(validation, [F.asc("WeightedGammaDeviance"), F.desc("D2Gamma")])


def band_bars(segments: DataFrame, observed: str, predicted: str) -> DataFrame:
    """Observed and predicted values by bonus-malus band, eligible bands only."""
    return segments.filter(
        (F.col("SegmentType") == "BonusMalusBand") & F.col("EligibleForComparison")
    ).select("Model", "Segment", observed, predicted)
