"""Exploratory reports: stacked segmentations, histograms, extreme segments."""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from claimwright import vocabulary as V
from claimwright.functions.bands import with_bands
from claimwright.functions.casting import label
from claimwright.operators.portfolio import segment_summary
from claimwright.operators.ranking import quantile_table, quantiles
from claimwright.operators.shaping import unpivoted


def group_risk_summary(policy: DataFrame, segments: list[str] = V.RISK_SEGMENTS) -> DataFrame:
    """All segmentations stacked, from one scan and one aggregation."""
    needed = [
        "Exposure", "ClaimNb", "HasClaim", "PurePremiumModelEligible", "SeverityModelEligible",
        "CompleteTotalClaimAmount",
    ]
    banded = with_bands(policy).select(*needed, *segments)
    rows = unpivoted(banded, segments, "SegmentType", "Segment", label)
    return segment_summary(rows, "SegmentType", "Segment")


# Which metric the extremes of a segmentation are taken of (fixed values).
EXTREMES = {
    "Area": "ClaimsPer100ExposureYears",
    "DrivAgeBand": "PurePremium",
    "BonusMalusBand": "ClaimsPer100ExposureYears",
    "Region": "PurePremium",
}


def highest_and_lowest(summary: DataFrame, metrics: dict[str, str] = EXTREMES) -> DataFrame:
    """Per kind of segment the segments with the largest and smallest known metric."""
    value, name = F, F
    for kind, metric in metrics.items():
        value = value.when(F.col("SegmentType") == kind, F.col(metric))
        name = name.when(F.col("SegmentType") == kind, F.lit(metric))
    known = summary.select(
        "SegmentType", "Segment", name.alias("Metric"), value.alias("v")).filter("v IS NOT NULL")
    # On a tie the first segment by name is taken, at either end.
    ends = known.groupBy("SegmentType", "Metric").agg(
        F.min(F.struct((-F.col("v")).alias("m"), "Segment")).alias("top"),
        F.min(F.struct(F.col("v").alias("m"), "Segment")).alias("bottom"),
    )
    return ends.select("SegmentType", "Metric", F.inline(F.array(
        F.struct(F.lit("Highest").alias("Extreme"), F.col("top.Segment").alias("Segment"),
                 (-F.col("top.m")).alias("Value")),
        F.struct(F.lit("Lowest").alias("Extreme"), F.col("bottom.Segment").alias("Segment"),
                 F.col("bottom.m").alias("Value")),
    )))


def segment_extremes(policy: DataFrame, least_exposure: float = V.REGION_EXPOSURE) -> DataFrame:
    """The extreme segments the exploration reports on, from one summary."""
    enough = group_risk_summary(policy, list(EXTREMES)).filter(
        (F.col("SegmentType") != "Region") | (F.col("CompleteLossExposure") >= least_exposure))
    return highest_and_lowest(enough)


def amount_percentiles(claims: DataFrame) -> DataFrame:
    return quantile_table(claims, ["ClaimAmount"], V.AMOUNT_POINTS)


def _histogram(values: DataFrame, column: str, edges: list[float] | None) -> DataFrame:
    """Counts between neighbouring edges; a value on an edge counts above it, and the last bin
    is closed.

    Without values (no edges) there are no bins; if all values are equal, so are the
    edges, and the first bin has all.
    """
    spark = values.sparkSession
    rows = list(enumerate(zip(edges or [], (edges or [])[1:])))
    bins = spark.createDataFrame(
        [(i, float(a), float(b)) for i, (a, b) in rows], "Bin bigint, LowerEdge double, UpperEdge double")
    number = F.lit(0.0)
    if edges and edges[-1] > edges[0]:
        values = Bucketizer(splits=edges, inputCol=column, outputCol="_bin").transform(values)
        number = F.col("_bin")
    counts = values.groupBy(number.cast("bigint").alias("Bin")).agg(F.count("*").alias("n"))
    return bins.join(counts, "Bin", "left").select(
        "Bin", "LowerEdge", "UpperEdge", F.coalesce("n", F.lit(0)).cast("bigint").alias("Count"))


def _edges(low: float | None, high: float | None, bins: int, log: bool = False) -> list[float] | None:
    """Equally or logarithmically spaced edges, with both ends exact."""
    if low is None:
        return None
    a, b = (math.log10(low), math.log10(high)) if log else (low, high)
    inner = [a + i * ((b - a) / bins) for i in range(1, bins)]
    return [float(low), *(10.0 ** x if log else float(x) for x in inner), float(high)]


def driver_age_histogram(policy: DataFrame, bins: int = 40, share: float = 0.995) -> DataFrame:
    """Driver ages up to the exact 99.5th percentile in equal bins."""
    upper = (quantiles(policy, "DrivAge", [share]) or [None])[0]
    kept = policy.filter(F.col("DrivAge") <= F.lit(upper)).select(F.col("DrivAge").cast("double"))
    ends = kept.agg(F.min("DrivAge"), F.max("DrivAge")).first()
    return _histogram(kept, "DrivAge", _edges(ends[0], ends[1], bins))


def log_histogram(df: DataFrame, column: str, edges: int = 60) -> DataFrame:
    """Positive amounts between logarithmically spaced edges."""
    kept = df.filter(F.col(column) > 0).select(F.col(column).cast("double"))
    ends = kept.agg(F.min(column), F.max(column)).first()
    return _histogram(kept, column, _edges(ends[0], ends[1], edges - 1, log=True))
