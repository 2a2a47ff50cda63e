"""Exact threshold curves, ranking areas and capacity tables of a score.

Scores are first collapsed to distinct values, then running totals are built in
pieces (see ranking), so nothing is down-sampled and no task sees all rows.

Scored rows have the columns Model, IDpol, HasClaim (0/1) and Score.
"""

import math

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from claimwright import vocabulary as V
from claimwright.functions.measures import ratio, ratio_or_zero
from claimwright.operators.ranking import (
    Pieces, accumulate, not_after, offsets, quantiles_of, rows_at_in_groups)
from claimwright.operators.shaping import unpivoted


def score_steps(scored: DataFrame, within: list[str] = ("Model",)) -> DataFrame:
    """One row per distinct score: rows and claims at it, below it, and in all."""
    within = list(within)
    rows = scored.select(
        *within, F.col("Score").alias("Threshold"),
        F.col("HasClaim").cast("bigint").alias("_y"))
    pieced = Pieces.fit(rows, "Threshold").assign(rows, "Threshold")
    before = offsets(pieced, {"n": F.lit(1), "pos": F.col("_y")}, within)
    steps = pieced.groupBy(*within, "_piece", "Threshold").agg(
        F.count("*").alias("n"), F.sum("_y").alias("pos"))
    return accumulate(
        steps, before, ["Threshold"], {"n": F.col("n"), "pos": F.col("pos")}, within)


def _selected() -> tuple[Column, Column]:
    """Rows and claims at or above the threshold of a step."""
    return F.col("n_all") - F.col("n_before"), F.col("pos_all") - F.col("pos_before")


def f_score(precision: Column, recall: Column, beta: float) -> Column:
    b = beta * beta
    return ratio_or_zero((1 + b) * precision * recall, b * precision + recall)


def threshold_curve(steps: DataFrame, within: list[str] = ("Model",)) -> DataFrame:
    """Precision, recall and F2 when everything from a threshold up is selected."""
    rows, hits = _selected()
    precision, recall = ratio_or_zero(hits, rows), ratio_or_zero(hits, F.col("pos_all"))
    return steps.select(
        *within, "Threshold", precision.alias("Precision"), recall.alias("Recall"),
        f_score(precision, recall, 2.0).alias("F2Score"))


def roc_points(steps: DataFrame, within: list[str] = ("Model",)) -> DataFrame:
    """False and true positive rate at every distinct threshold."""
    rows, hits = _selected()
    return steps.select(
        *within, "Threshold",
        ratio(rows - hits, F.col("n_all") - F.col("pos_all")).alias("FalsePositiveRate"),
        ratio(hits, F.col("pos_all")).alias("TruePositiveRate"))


def ranking_areas(steps: DataFrame, within: list[str] = ("Model",)) -> DataFrame:
    """ROC area with ties counted half, and average precision as a step sum."""
    rows, hits = _selected()
    neg = F.col("n") - F.col("pos")
    neg_before = F.col("n_before") - F.col("pos_before")
    pairs = F.sum(F.col("pos") * (neg_before + 0.5 * neg))
    positives, negatives = F.max("pos_all"), F.max(F.col("n_all") - F.col("pos_all"))
    return steps.groupBy(*within).agg(
        ratio(pairs, positives.cast("double") * negatives).alias("ROCAUC"),
        ratio(F.sum(F.col("pos") * ratio(hits, rows)), positives).alias("PRAUC"))


def best_thresholds(curve: DataFrame) -> dict[str, tuple[float, float]]:
    """Per model the threshold of the largest F2, the lowest one on a tie."""
    best = curve.groupBy("Model").agg(
        F.min(F.struct((-F.col("F2Score")).alias("f"), "Threshold")).alias("b"))
    return {r["Model"]: (r["b"]["Threshold"], -r["b"]["f"]) for r in best.collect()}


def best_threshold_table(curve: DataFrame) -> DataFrame:
    best = curve.groupBy("Model").agg(
        F.min(F.struct((-F.col("F2Score")).alias("f"), "Threshold")).alias("b"))
    return best.select("Model", F.col("b.Threshold").alias("Threshold"),
                       (-F.col("b.f")).alias("F2Score"))


def per_model(values: dict[str, float], column: str = "Model") -> Column:
    """A constant per model as a column."""
    chain = F
    for name, value in values.items():
        chain = chain.when(F.col(column) == name, F.lit(float(value)))
    return chain.otherwise(F.lit(None).cast("double"))


def confusion(scored: DataFrame, threshold: Column, within: list[str] = ("Model",)) -> DataFrame:
    """Counts, error rates and probability loss at a threshold, in one aggregation."""
    y, p = F.col("HasClaim"), F.col("Score")
    flagged = scored.withColumns({"Threshold": threshold, "_hit": (p >= threshold).cast("int")})
    hit = F.col("_hit")
    counted = flagged.groupBy(*within).agg(
        F.first("Threshold").alias("Threshold"),
        F.sum((1 - y) * (1 - hit)).cast("bigint").alias("TrueNegatives"),
        F.sum((1 - y) * hit).cast("bigint").alias("FalsePositives"),
        F.sum(y * (1 - hit)).cast("bigint").alias("FalseNegatives"),
        F.sum(y * hit).cast("bigint").alias("TruePositives"),
        F.avg(F.pow(p - y, 2)).alias("BrierScore"),
        F.avg(p).alias("MeanPredictedProbability"),
    )
    tn, fp, fn, tp = (
        F.col(c) for c in ["TrueNegatives", "FalsePositives", "FalseNegatives", "TruePositives"])
    every = tn + fp + fn + tp
    precision, recall = ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn)
    return counted.withColumns({
        "Accuracy": ratio(tp + tn, every),
        "Precision": precision,
        "Recall": recall,
        "Specificity": ratio(tn, tn + fp),
        "NegativePredictiveValue": ratio(tn, tn + fn),
        "F1Score": f_score(precision, recall, 1.0),
        "F2Score": f_score(precision, recall, 2.0),
        "PredictedPositiveRate": ratio(tp + fp, every),
        "ObservedClaimRate": ratio(tp + fn, every),
    })


def occurrence_metrics(scored: DataFrame, threshold: Column, within: list[str] = ("Model",)):
    """Confusion table joined with the ranking areas: one row per model."""
    within = list(within)
    areas = ranking_areas(score_steps(scored, within), within)
    return confusion(scored, threshold, within).join(areas, within)


def threshold_grid(selected: float) -> list[float]:
    """49 even steps from 0.01 to 0.25, the selected threshold, and 0.5."""
    return sorted({*np.linspace(0.01, 0.25, 49).tolist(), float(selected), 0.5})


def threshold_report(scored: DataFrame, selected: float) -> DataFrame:
    """Metrics at every threshold of the grid, from one scan.

    Each row is counted once, under the highest threshold it reaches; the counts are
    then summed from the top. Rows are not repeated per threshold.
    """
    grid = threshold_grid(selected)
    edges = Bucketizer(
        splits=[-math.inf, *grid, math.inf], inputCol="Score", outputCol="_at",
        handleInvalid="error")
    counted = edges.transform(scored.select("Score", "HasClaim")).groupBy(
        F.col("_at").cast("int").alias("k")).agg(
        F.count("*").alias("n"), F.sum(F.col("HasClaim").cast("bigint")).alias("pos"))
    # At most 52 rows from here on.
    points = ", ".join(
        f"named_struct('Threshold', {t!r}D, 'rows', sum(if(k > {i}, n, 0)),"
        f" 'hits', sum(if(k > {i}, pos, 0)))"
        for i, t in enumerate(grid))
    report = counted.agg(
        F.expr(f"array({points})").alias("points"), F.sum("n").alias("n_all"),
        F.sum("pos").alias("pos_all"),
    ).select("n_all", "pos_all", F.explode("points").alias("p")).select("n_all", "pos_all", "p.*")
    precision = ratio_or_zero(F.col("hits"), F.col("rows"))
    recall = ratio_or_zero(F.col("hits"), F.col("pos_all"))
    return report.select(
        "Threshold", precision.alias("Precision"), recall.alias("Recall"),
        f_score(precision, recall, 1.0).alias("F1Score"),
        f_score(precision, recall, 2.0).alias("F2Score"),
        ratio(F.col("rows"), F.col("n_all")).alias("PredictedPositiveRate"))


def thresholds_between(report: DataFrame, low: float = 0.01, high: float = 0.20) -> DataFrame:
    return report.filter(F.col("Threshold").between(low, high)).orderBy("Threshold")


def quantile_calibration(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and claim rate per model and score bin; inner edges are exact percentiles.

    A row's bin is the number of its model's inner edges below its score; empty bins are
    absent. All models share the passes.
    """
    points = [(i / bins, str(i)) for i in range(1, bins)]
    long = scored.select(F.col("Model").alias("Variable"), F.col("Score").alias("value"))
    edges: dict[int, dict[str, float]] = {}
    for r in quantiles_of(long, points).collect():
        edges.setdefault(r["Position"], {})[r["Variable"]] = r["Value"]
    number = F.lit(0)
    for found in edges.values():
        number = number + (F.col("Score") > per_model(found)).cast("int")
    return scored.groupBy("Model", number.alias("Bin")).agg(
        F.count("*").alias("Policies"),
        F.avg("Score").alias("MeanPredictedProbability"),
        F.avg(F.col("HasClaim").cast("double")).alias("ObservedClaimRate"))


def capacity_comparison(scored: DataFrame, models: list[str],
                        capacities=tuple(V.CAPACITIES)) -> DataFrame:
    """What the top share of policies by score holds, per model and review capacity.

    Only the rows at the cuts are looked up, for all models in the same passes; the claims
    above them are one conditional aggregation. A model without scores has no rows.
    """
    mine = scored.filter(F.col("Model").isin(models)).select(
        "Model", "IDpol", "HasClaim", (-F.col("Score")).alias("_place"))
    found = {m: places for m, (_, places) in rows_at_in_groups(
        mine, "Model", "_place", "IDpol",
        lambda n: [max(1, math.ceil(n * c)) for c in capacities]).items()}

    def cut(i: int, part: int) -> Column:
        chain = F
        for model, places in found.items():
            chain = chain.when(F.col("Model") == model, F.lit(places[i][part]))
        return F.lit(None) if chain is F else chain.otherwise(F.lit(None))

    claims = F.col("HasClaim").cast("bigint")
    rows = mine.groupBy("Model").agg(
        F.sum(claims).alias("claims"), F.count("*").alias("n"),
        *[
            F.coalesce(F.sum(F.when(
                not_after(F.col("_place"), F.col("IDpol"), (cut(i, 0), cut(i, 1))), claims)),
                F.lit(0)).alias(f"c{i}")
            for i in range(len(capacities))
        ],
    )
    levels = F.array(*[
        F.struct(
            F.lit(float(c)).alias("Capacity"),
            F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(float(c)))).cast("bigint").alias(
                "SelectedPolicies"),
            F.col(f"c{i}").alias("SelectedClaims"),
            (-cut(i, 0).cast("double")).alias("ThresholdAtCapacity"))
        for i, c in enumerate(capacities)])
    precision = ratio(F.col("SelectedClaims"), F.col("SelectedPolicies"))
    return rows.select("Model", "claims", "n", F.inline(levels)).select(
        "Model", "Capacity", "SelectedPolicies", "SelectedClaims",
        precision.alias("PrecisionAtCapacity"),
        ratio(F.col("SelectedClaims"), F.col("claims")).alias("ClaimCaptureRate"),
        ratio(precision, ratio(F.col("claims"), F.col("n"))).alias("Lift"),
        "ThresholdAtCapacity")


def capture_curve(capacity: DataFrame) -> DataFrame:
    """Claim capture by reviewed share, both in percent, with the random line."""
    return capacity.select(
        "Model", (F.col("Capacity") * 100).alias("ReviewedPercent"),
        (F.col("ClaimCaptureRate") * 100).alias("CapturedPercent"),
        (F.col("Capacity") * 100).alias("RandomPercent"),
    ).orderBy("Model", "ReviewedPercent")


def subgroup_metrics(
    scored: DataFrame, threshold: Column, groups: list[str] = V.SUBGROUPS,
    least_rows: int = V.SUBGROUP_ROWS, least_claims: int = V.SUBGROUP_CLAIMS,
) -> DataFrame:
    """Metrics of every subgroup that is large enough; a missing value is a group."""
    rows = unpivoted(
        scored.select("Model", "HasClaim", "Score", *groups), groups, "GroupType", "GroupValue",
        lambda c: F.coalesce(c.cast("string"), F.lit("Missing")),
    ).select("Model", "GroupType", "GroupValue", "HasClaim", "Score")
    within = ["Model", "GroupType", "GroupValue"]
    claims = F.col("TruePositives") + F.col("FalseNegatives")
    every = claims + F.col("TrueNegatives") + F.col("FalsePositives")
    large = (
        confusion(rows, threshold, within)
        .withColumns({"Policies": every, "Claims": claims})
        .filter((F.col("Policies") >= least_rows) & (F.col("Claims") >= least_claims))
    )
    # The curves are built for the groups that stay; their names are a short list.
    kept = rows.join(large.select(*within), within, "left_semi")
    areas = ranking_areas(score_steps(kept, within), within)
    return large.join(areas, within).select(
        *within, "Policies", "Claims", "ObservedClaimRate", "MeanPredictedProbability",
        (F.col("MeanPredictedProbability") - F.col("ObservedClaimRate")).alias(
            "CalibrationDifference"),
        F.col("PredictedPositiveRate").alias("SelectionRate"),
        "Precision", "Recall", "Specificity", "ROCAUC", "PRAUC")


def recall_range(subgroups: DataFrame) -> DataFrame:
    """Smallest and largest recall of each model over the subgroups."""
    return subgroups.groupBy("Model").agg(
        F.min("Recall").alias("MinimumRecall"), F.max("Recall").alias("MaximumRecall"))


def confusion_cells(metrics: DataFrame) -> DataFrame:
    """The four confusion counts in long form."""
    cells = ["TrueNegatives", "FalsePositives", "FalseNegatives", "TruePositives"]
    return metrics.select("Model", F.explode(F.array(*[
        F.struct(F.lit(c).alias("Cell"), F.col(c).alias("Policies")) for c in cells
    ])).alias("c")).select("Model", "c.*")


