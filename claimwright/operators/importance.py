"""Permutation importance as one scored plan.

Every (feature, repeat) is a variant of the same sample in which one column is taken
from another row; only that column moves. All variants are scored by one transform and compared by average
precision. All test rows take part unless a sample size is given.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright import vocabulary as V
from claimwright.operators.curves import ranking_areas, score_steps
from claimwright.operators.ranking import accumulate, offsets
from claimwright.operators.sampling import stratified_sample
from claimwright.session import stage


PIECE_ROWS = 100_000


def _placed(rows: DataFrame, digest: Column, pieces: int, within: tuple = ()) -> DataFrame:
    """Rows with `_at`, their place by digest and id, in each group if `within` is given.

    Digests are even, so equal ranges of their first digits are pieces of like size.
    """
    prefix = F.conv(F.substring("_digest", 1, 8), 16, 10).cast("double")
    pieced = rows.withColumn("_digest", digest).withColumn(
        "_piece", F.floor(prefix * pieces / float(1 << 32)))
    count = {"_at": F.lit(1)}
    return accumulate(
        pieced, offsets(pieced, count, within), ["_digest", "IDpol"], count, within
    ).withColumnRenamed("_at_before", "_at").drop("_at_all", "_digest")


def permuted(sample: DataFrame, features: list[str], target: str, repeats: int, seed: int,
             pieces: int) -> DataFrame:
    """Feature, Repeat, IDpol, HasClaim and the features of every variant of the sample.

    Rows take values from each other by unrelated hashed orders: one of the takers, which all
    variants share, and one of the givers of each variant. A giver moves with the one value
    it gives; the values for a row of the sample meet it as one map, and the variants of the row
    are written out after that.
    """
    texts = [f for f, kind in sample.select(*features).dtypes if kind == "string"]
    variants = [(f, r) for f in features for r in range(1, repeats + 1)]
    own = F.md5(F.concat_ws("-", F.col("IDpol").cast("string"), F.lit(str(seed))))
    takers = _placed(sample, own, pieces)
    given = F.inline(F.array(*[
        F.struct(
            F.lit(v).alias("_v"), F.lit(f"{f}-{r}-{seed}").alias("_salt"),
            (F.lit(None) if f in texts else F.col(f)).cast("double").alias("_number"),
            (F.col(f) if f in texts else F.lit(None)).cast("string").alias("_text"))
        for v, (f, r) in enumerate(variants)]))
    other = F.md5(F.concat_ws("-", F.col("IDpol").cast("string"), "_salt"))
    givers = _placed(sample.select("IDpol", given), other, pieces, ("_v",))
    # One value for each variant, so a group has as many rows as there are variants.
    values = givers.groupBy("_at").agg(F.map_from_entries(F.collect_list(F.struct(
        "_v", F.struct("_number", "_text").alias("x")))).alias("_values"))
    every = takers.join(values, "_at").select(
        "IDpol", target, *features, F.explode("_values").alias("_v", "_given"))
    names = F.array(*[F.lit(f) for f, _ in variants])
    kinds = dict(sample.dtypes)

    def taken(i: int, f: str) -> Column:
        value = F.col("_given._text" if f in texts else "_given._number").cast(kinds[f])
        mine = (F.col("_v") >= i * repeats) & (F.col("_v") < (i + 1) * repeats)
        return F.when(mine, value).otherwise(F.col(f)).alias(f)

    return every.select(
        F.element_at(names, F.col("_v") + 1).alias("Feature"),
        (F.col("_v") % repeats + 1).cast("int").alias("Repeat"), "IDpol",
        F.col(target).alias("HasClaim"), *[taken(i, f) for i, f in enumerate(features)])


def permutation_importance(
    model, test: DataFrame, features: list[str], target: str = "HasClaim",
    size: int | None = None, repeats: int = V.IMPORTANCE_REPEATS, seed: int = V.SEED,
) -> DataFrame:
    """How much average precision a feature's values are worth: mean and deviation over the
    repeats, largest first."""
    chosen = test if size is None else stratified_sample(
        test, target, size, salt=f"importance-{seed}")
    sample = stage(chosen.select("IDpol", target, *features), "importance-sample", "IDpol")
    mixed = permuted(
        sample, features, target, repeats, seed, sample.count() // PIECE_ROWS + 1)
    within = ["Feature", "Repeat"]
    plain = sample.withColumn("HasClaim", F.col(target)).withColumns(
        {"Feature": F.lit(""), "Repeat": F.lit(0)}).select(mixed.columns)
    scored = stage(
        model.score(mixed.unionByName(plain), "Score").select(*within, "HasClaim", "Score"),
        "importance-scores",
    )
    areas = ranking_areas(score_steps(scored, within), within)
    # The areas are one row per variant, so this window is over a handful of rows.
    every = Window.partitionBy(F.lit(1))
    whole = F.max(F.when(F.col("Feature") == "", F.col("PRAUC"))).over(every)
    drops = areas.withColumn("_drop", whole - F.col("PRAUC")).filter("Feature <> ''")
    return drops.groupBy("Feature").agg(
        F.avg("_drop").alias("ImportanceMean"),
        F.stddev_pop("_drop").alias("ImportanceStandardDeviation"),
    ).orderBy(F.desc("ImportanceMean"), "Feature")
