"""Exact stratified splits and samples by a hashed order, without a sort.

Rows are ordered inside their stratum by the MD5 digest of id and seed. The first
hex digits of the digest spread every stratum evenly over 4,096 pieces, a very large
stratum as well. Piece counts tell which pieces the wanted sizes end in; only those
are ordered, to find the digest at the cut. Labelling is then a comparison with a few
constants: no row is shuffled for it.
"""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright import vocabulary as V

PIECE_DIGITS = 3


def digest(key: str, salt: str) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{salt}")))


def largest_remainder(counts: dict, draws: int) -> dict:
    """Shares the draws over the strata in proportion; leftovers by largest fraction."""
    total = sum(counts.values())
    exact = {s: n / total * draws for s, n in counts.items()}
    given = {s: math.floor(x) for s, x in exact.items()}
    order = sorted(counts, key=lambda s: (-(exact[s] - given[s]), str(s)))
    for s in order[: draws - sum(given.values())]:
        given[s] += 1
    return given


def split_sizes(counts: dict) -> dict:
    """(test, validation) rows per stratum of a 60/20/20 split."""
    total = sum(counts.values())
    tests = math.ceil(0.2 * total)
    development = largest_remainder(counts, total - tests)
    validations = math.ceil(0.25 * (total - tests))
    training = largest_remainder(development, total - tests - validations)
    return {
        s: (counts[s] - development[s], development[s] - training[s]) for s in counts
    }


def _cuts(df: DataFrame, stratum: str, key: str, salt: str, ranks) -> dict:
    """Per stratum the (digest, id) at each wanted rank, None for rank 0.

    `ranks` maps the stratum counts to the ranks wanted per stratum.
    """
    hashed = df.select(F.col(stratum).alias("_s"), F.col(key).alias("_k")).withColumn(
        "_d", digest("_k", salt)
    ).withColumn("_piece", F.substring("_d", 1, PIECE_DIGITS))
    # At most strata x 4,096 rows come to the driver.
    pieces = hashed.groupBy("_s", "_piece").agg(F.count("*").alias("n")).collect()
    counts: dict = {}
    for r in pieces:
        counts[r["_s"]] = counts.get(r["_s"], 0) + r["n"]
    if not counts:
        return {}
    wanted = ranks(counts)
    places = {}
    for s, targets in wanted.items():
        ordered = sorted((r["_piece"], r["n"]) for r in pieces if r["_s"] == s)
        for rank in targets:
            before = 0
            for piece, n in ordered:
                if before < rank <= before + n:
                    places[(s, rank)] = (piece, rank - before)
                    break
                before += n
    if not places:
        return {s: [None] * len(t) for s, t in wanted.items()}
    needed = sorted({(str(s), p) for (s, _), (p, _) in places.items()})
    inside = Window.partitionBy("_s", "_piece").orderBy("_d", "_k")
    rows = (
        hashed.filter(
            F.struct(F.col("_s").cast("string"), "_piece").isin(
                [F.struct(F.lit(s), F.lit(p)) for s, p in needed])
        )
        .withColumn("_place", F.row_number().over(inside))
        .filter(
            F.struct(F.col("_s").cast("string"), "_piece", "_place").isin([
                F.struct(F.lit(str(s)), F.lit(p), F.lit(i))
                for (s, _), (p, i) in places.items()
            ])
        )
        .collect()
    )
    at = {(r["_s"], r["_piece"], r["_place"]): (r["_d"], r["_k"]) for r in rows}
    return {
        s: [at[(s, *places[(s, rank)])] if rank else None for rank in targets]
        for s, targets in wanted.items()
    }


def _upto(place: tuple | None, d: Column, k: Column) -> Column:
    if place is None:
        return F.lit(False)
    return (d < place[0]) | ((d == place[0]) & (k <= F.lit(place[1])))


def stratified_split(
    df: DataFrame, stratum: str, key: str = "IDpol", seed: int = V.SEED
) -> DataFrame:
    """Rows labelled Training, Validation or Test (60/20/20 in every stratum)."""
    def ranks(counts):
        return {s: [t, t + v] for s, (t, v) in split_sizes(counts).items()}

    found = _cuts(df, stratum, key, str(seed), ranks)
    d, k = F.col("_digest"), F.col(key)
    test, validation = F.lit(False), F.lit(False)
    for s, (first, second) in found.items():
        mine = F.col(stratum).eqNullSafe(F.lit(s))
        test = test | (mine & _upto(first, d, k))
        validation = validation | (mine & _upto(second, d, k))
    # The digest is a column of its own, so that it is worked out once per row.
    return df.withColumn("_digest", digest(key, str(seed))).withColumn(
        "Sample", F.when(test, "Test").when(validation, "Validation").otherwise("Training")
    ).drop("_digest")


def stratified_sample(
    df: DataFrame, stratum: str, size: int, key: str = "IDpol", salt: str = "sample"
) -> DataFrame:
    """Exactly `size` rows, each stratum in proportion; all rows if there are fewer."""
    def ranks(counts):
        draws = min(size, sum(counts.values()))
        return {s: [n] for s, n in largest_remainder(counts, draws).items()}

    found = _cuts(df, stratum, key, salt, ranks)
    kept = F.lit(False)
    for s, (place,) in found.items():
        mine = F.col(stratum).eqNullSafe(F.lit(s))
        kept = kept | (mine & _upto(place, F.col("_digest"), F.col(key)))
    return df.withColumn("_digest", digest(key, salt)).filter(kept).drop("_digest")


def prediction_sample(
    predictions: DataFrame, score: str, size: int = V.PREVIEW_ROWS, key: str = "IDpol"
) -> DataFrame:
    """A hashed sample of at most `size` predictions, highest score first."""
    return (
        predictions.orderBy(digest(key, f"preview-{V.SEED}"), key).limit(size)
        .orderBy(F.desc(score), key)
    )


def occurrence_split_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("Sample").agg(
        F.count("*").alias("Rows"),
        F.sum(F.col("HasClaim").cast("bigint")).alias("Claims"),
        F.sum((1 - F.col("HasClaim")).cast("bigint")).alias("NoClaims"),
        F.avg(F.col("HasClaim").cast("double")).alias("ClaimRate"),
    )


def frequency_split_summary(split: DataFrame) -> DataFrame:
    claims, exposure = F.sum("ClaimNb"), F.sum("Exposure")
    return split.groupBy("Sample").agg(
        F.count("*").alias("Policies"),
        exposure.alias("Exposure"),
        claims.alias("Claims"),
        F.count(F.when(F.col("ClaimNb") == 0, 1)).alias("ZeroClaimPolicies"),
        F.count(F.when(F.col("ClaimNb") == 1, 1)).alias("OneClaimPolicies"),
        F.count(F.when(F.col("ClaimNb") >= 2, 1)).alias("MultipleClaimPolicies"),
        F.try_divide(claims.cast("double"), exposure).alias("ObservedFrequency"),
        F.try_divide(100.0 * claims, exposure).alias("ClaimsPer100ExposureYears"),
    )


def severity_split_summary(split: DataFrame) -> DataFrame:
    """Sizes and outcomes per sample; the median is exact and built in pieces."""
    from claimwright.operators.ranking import Pieces, accumulate, offsets

    value = "AverageClaimSeverity"
    rows = split.select("Sample", value)
    pieced = Pieces.fit(rows, value).assign(rows, value)
    placed = accumulate(
        pieced.groupBy("Sample", "_piece", value).agg(F.count("*").alias("n")),
        offsets(pieced, {"n": F.lit(1)}, ["Sample"]), [value], {"n": F.col("n")}, ["Sample"],
    )
    upto = F.col("n_before") + F.col("n")
    middle = (F.col("n_all") - 1) / 2
    median = placed.groupBy("Sample").agg(
        ((F.min(F.when(upto > F.floor(middle), F.col(value)))
          + F.min(F.when(upto > F.ceil(middle), F.col(value)))) / 2
         ).alias("MedianPolicyAverageSeverity"))
    totals = split.groupBy("Sample").agg(
        F.count("*").alias("Policies"),
        F.sum("ClaimNb").alias("Claims"),
        F.sum("CompleteTotalClaimAmount").alias("TotalClaimAmount"),
        F.try_divide(F.sum("CompleteTotalClaimAmount"), F.sum("ClaimNb").cast("double")).alias(
            "WeightedMeanSeverity"),
        F.max(value).alias("MaximumPolicyAverageSeverity"),
    )
    return totals.join(median, "Sample")
