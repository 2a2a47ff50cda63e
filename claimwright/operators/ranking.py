"""Exact order statistics and running totals without a single-task sort.

A window without a partition key sends all rows to one task. Here the order is cut
into pieces first, in one of two ways. `in_ranges` lets Spark deal the rows by ranges of
their own sort columns, of any type, and the ranges are the pieces. `Pieces` gives every
row the number of its piece without moving it: the cut points are quantiles of the sort
key (a small array on the driver), and a value that is itself frequent, as with a constant
score, gets pieces of its own that are cut by the tie-breaking column. Piece totals are a
small table; their running sum gives the offset of each piece, and rows are ordered
inside their piece only.
"""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright.session import stage

HEAVY_REPEATS = 4
FEW_COPIES = 1_000


class Pieces:
    """An order-preserving cut of (key, tie) into pieces of bounded size."""

    def __init__(self, key_cuts: list, tie_cuts: list, heavy: list):
        edges = {cut + 0.0 for cut in key_cuts}
        for value in heavy:
            edges.add(math.nextafter(value, math.inf))
        self.key_cuts = sorted(edges)
        self.tie_cuts = sorted({cut + 0.0 for cut in tie_cuts})
        self.heavy = sorted(heavy)

    @classmethod
    def fit(cls, df: DataFrame, key: str, tie: str | None = None, pieces: int | None = None):
        """Reads the cut points off the rows: one scan of two columns."""
        if pieces is None:
            shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            pieces = max(8, 2 * shuffles)
        shares = [i / pieces for i in range(1, pieces)]
        columns = [key] if tie is None else [key, tie]
        found = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).approxQuantile(
            columns, shares, 1.0 / (4 * pieces)
        )
        key_cuts = found[0] if found else []
        tie_cuts = found[1] if tie is not None and len(found) > 1 else []
        # Beyond 2^53 different longs share a double, so a value there is not one key.
        heavy = [
            v for v in set(key_cuts)
            if tie is not None and abs(v) < 2**53 and key_cuts.count(v) >= HEAVY_REPEATS
        ]
        return cls(key_cuts, tie_cuts, heavy)

    @staticmethod
    def _locate(df: DataFrame, source: str, target: str, cuts: list) -> DataFrame:
        if not cuts:
            return df.withColumn(target, F.lit(0.0))
        splits = [-math.inf, *[c for c in cuts if math.isfinite(c)], math.inf]
        if len(splits) == 2:
            return df.withColumn(target, F.lit(0.0))
        return Bucketizer(
            splits=splits, inputCol=source, outputCol=target, handleInvalid="keep"
        ).transform(df)

    def assign(self, df: DataFrame, key: str, tie: str | None = None) -> DataFrame:
        """The rows with the number of their piece in `_piece`."""
        width = len(self.tie_cuts) + 1
        # Adding zero turns -0.0, which sorts as 0.0, into 0.0.
        out = df.withColumn("_key", F.col(key).cast("double") + 0.0)
        out = self._locate(out, "_key", "_coarse", self.key_cuts)
        piece = F.col("_coarse").cast("bigint") * width
        if self.heavy and tie is not None:
            out = out.withColumn("_tie", F.col(tie).cast("double") + 0.0)
            out = self._locate(out, "_tie", "_fine", self.tie_cuts)
            fine = F.when(F.col("_key").isin(self.heavy), F.col("_fine")).otherwise(0.0)
            piece = piece + fine.cast("bigint")
        return out.withColumn("_piece", piece).drop("_key", "_coarse", "_tie", "_fine")


def in_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """The rows, written once, with `_piece`: ascending ranges of the keys, nulls first.

    The cut points are values of the keys themselves, so numbers of any size, decimals and
    texts are cut alike. Rows that agree in all keys share a piece; count them first.
    """
    ranged = df.repartitionByRange(*keys).withColumn("_piece", F.spark_partition_id())
    return stage(ranged, "in-ranges")


def offsets(pieced: DataFrame, totals: dict[str, Column], within: list[str] = ()) -> DataFrame:
    """Per piece: what stands before it (`<name>_before`) and in all (`<name>_all`).

    The table holds at most groups x pieces rows, whatever the size of the input.
    """
    within = list(within)
    per_piece = pieced.groupBy(*within, "_piece").agg(
        *[F.sum(e).alias(n) for n, e in totals.items()]
    )
    everything = Window.partitionBy(*within)
    earlier = everything.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    return per_piece.select(
        *within,
        "_piece",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in totals],
        *[F.sum(n).over(everything).alias(f"{n}_all") for n in totals],
    )


def accumulate(
    rows: DataFrame, before: DataFrame, order: list, totals: dict[str, Column], within: list[str] = ()
) -> DataFrame:
    """Rows (with `_piece`) with exact totals of all rows ordered before them."""
    within = list(within)
    inside = (
        Window.partitionBy(*within, "_piece").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = {f"_{n}": F.coalesce(F.sum(e).over(inside), F.lit(0)) for n, e in totals.items()}
    # The window has dealt the rows by these keys already. Groups come from the data, so
    # whether `before` is small enough to broadcast is left to adaptive execution.
    out = rows.withColumns(local).join(before, [*within, "_piece"])
    return out.withColumns(
        {f"{n}_before": F.col(f"{n}_before") + F.col(f"_{n}") for n in totals}
    ).drop("_piece", *local)


def numbered(df: DataFrame, order: str, then: str, name: str) -> DataFrame:
    """Rows numbered 1, 2, ... by two columns; equal rows get adjacent numbers.

    Equal rows are counted before the shuffle and written out again afterwards, in
    blocks, so that many copies of one row never meet in one task; a frequent value of
    the first column is cut by the second.
    """
    block = 100_000
    kinds = in_ranges(df.groupBy(order, then).agg(F.count("*").alias("n")), order, then)
    count = {"n": F.col("n")}
    placed = accumulate(kinds, offsets(kinds, count), [order, then], count)
    if (kinds.agg(F.max("n")).first()[0] or 0) <= FEW_COPIES:
        # Rows stand in even ranges already; only many copies need to be dealt anew.
        return placed.select(
            F.explode(F.expr("sequence(n_before + 1, n_before + n)")).alias(name), order, then)
    blocks = placed.select(
        order, then, "n", "n_before",
        F.explode(F.expr(f"sequence(0L, (n - 1) div {block})")).alias("_block"),
    )
    spread = blocks.repartition(order, then, "_block")
    return spread.select(
        F.explode(
            F.expr(
                f"sequence(n_before + _block * {block} + 1, "
                f"n_before + least(n, (_block + 1) * {block}))"
            )
        ).alias(name),
        order,
        then,
    )


def rows_at(df: DataFrame, key: str, tie: str, ranks, pieces: int | None = None) -> tuple[int, list]:
    """The number of rows, and the (key, tie) found at the given 1-based ranks.

    `ranks` maps the row count to the ranks wanted. Rows are ordered by key, then by
    the unique tie column, both ascending.
    """
    total, found = rows_at_in_groups(
        df.select(F.lit("").alias("_group"), key, tie), "_group", key, tie, ranks, pieces
    ).get("", (0, []))
    return total, found


def rows_at_in_groups(df: DataFrame, group: str, key: str, tie: str, ranks,
                      pieces: int | None = None) -> dict:
    """rows_at for every value of a column at once: {value: (rows, places)}.

    Only the pieces a rank falls in are sorted; nothing else is shuffled. The driver gets
    piece counts and one row per rank, however many groups share the passes.
    """
    narrow = df.select(F.col(group).alias("_g"), key, tie)
    cut = Pieces.fit(narrow, key, tie, pieces)
    pieced = cut.assign(narrow, key, tie)
    counts: dict = {}
    for r in pieced.groupBy("_g", "_piece").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r["_g"], []).append((r["_piece"], r["n"]))
    totals = {g: sum(n for _, n in found) for g, found in counts.items()}
    places: dict = {}
    for g, found in counts.items():
        for rank in ranks(totals[g]):
            before = 0
            for piece, n in sorted(found):
                if before < rank <= before + n:
                    places[g, rank] = (piece, rank - before)
                    break
                before += n
    if not places:
        return {g: (n, []) for g, n in totals.items()}
    wanted = {(g, *place) for (g, _), place in places.items()}
    inside = Window.partitionBy("_g", "_piece").orderBy(key, tie)
    chosen = (
        pieced.filter(F.struct("_g", "_piece").isin(
            [F.struct(F.lit(g), F.lit(p).cast("bigint")) for g, p in {w[:2] for w in wanted}]))
        .withColumn("_nth", F.row_number().over(inside))
        .filter(
            F.struct("_g", "_piece", "_nth").isin(
                [F.struct(F.lit(g), F.lit(p).cast("bigint"), F.lit(i).cast("int"))
                 for g, p, i in wanted]
            )
        )
        .collect()
    )
    at = {(r["_g"], r["_piece"], r["_nth"]): (r[key], r[tie]) for r in chosen}
    return {g: (n, [at[g, *places[g, rank]] for rank in ranks(n)]) for g, n in totals.items()}


def not_after(key: Column, tie: Column, place: tuple) -> Column:
    """Whether (key, tie) stands at or before the given place (values or columns) in
    ascending order."""
    at_key, at_tie = F.lit(place[0]), F.lit(place[1])
    return (key < at_key) | ((key == at_key) & (tie <= at_tie))


def decile_ranks(total: int) -> list[int]:
    """Last rank of each of the first nine deciles.

    Deciles are ten equal-width bins of the rank 1..n, right edge included, so the
    larger groups are not simply the first ones.
    """
    return [d * (total - 1) // 10 + 1 for d in range(1, 10)] if total else []


def with_decile(df: DataFrame, key: str, tie: str, name: str = "RiskDecile") -> DataFrame:
    """Rows with their decile (1-10) by key; a narrow plan, nothing is shuffled."""
    _, places = rows_at(df, key, tie, decile_ranks)
    decile = F.lit(1)
    for place in places:
        decile = decile + F.when(not_after(F.col(key), F.col(tie), place), 0).otherwise(1)
    return df.withColumn(name, decile.cast("int"))


def quantile_table(df: DataFrame, columns: list[str], points: list[tuple[float, str]]) -> DataFrame:
    """Exact, linearly interpolated percentiles: one row per variable and point."""
    pairs = ", ".join(
        f"named_struct('Variable', '{c}', 'value', CAST({c} AS DOUBLE))" for c in columns)
    return quantiles_of(df.selectExpr(f"inline(array({pairs}))"), points)


def quantiles_of(long: DataFrame, points: list[tuple[float, str]]) -> DataFrame:
    """Exact, linearly interpolated percentiles of (Variable, value) rows.

    The rows are read once: values are counted before the shuffle, so a frequent value is
    one row, and the counted values are dealt by ranges, so no task holds all values of a
    variable.
    """
    known = long.filter("value IS NOT NULL AND NOT isnan(value)")
    # Adding zero turns -0.0 into 0.0, with which it is counted.
    values = in_ranges(
        known.groupBy("Variable", (F.col("value") + 0.0).alias("value")).agg(
            F.count("*").alias("n")), "Variable", "value")
    count = {"n": F.col("n")}
    placed = accumulate(values, offsets(values, count, ["Variable"]), ["value"], count, ["Variable"])
    # Per point: the values standing at the two ranks around it, then the line between.
    found, rows = [], []
    for i, (share, label) in enumerate(points):
        at = f"({float(share)!r}D * (n_all - 1))"
        for name, way in (("low", "floor"), ("high", "ceil")):
            found.append(
                f"min(CASE WHEN n_before + n > {way}({at}) THEN value END) AS {name}{i}")
        rows.append(
            f"named_struct('Position', {i}, 'Point', '{label}', "
            f"'Value', low{i} + (high{i} - low{i}) * ({at} - floor({at})))")
    ends = placed.groupBy("Variable").agg(
        F.max("n_all").alias("n_all"), *[F.expr(e) for e in found])
    return ends.selectExpr("Variable", f"inline(array({', '.join(rows)}))")


def quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float]:
    """Exact percentiles of one column as driver values."""
    rows = quantile_table(df, [column], [(s, str(s)) for s in shares]).collect()
    by_position = {r["Position"]: r["Value"] for r in rows}
    return [by_position.get(i) for i in range(len(shares))]


def medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians of several columns as driver values."""
    rows = quantile_table(df, columns, [(0.5, "Median")]).collect()
    return {r["Variable"]: r["Value"] for r in rows}
