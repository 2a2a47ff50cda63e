"""SimHash near-duplicates: exact links within a bit radius by tiled comparison.

Fingerprints are cut into cells by the population counts of their four 16-bit parts.
Two fingerprints within the radius have cells whose counts differ by no more than the
radius in sum, so only tiles of such cells are compared: numpy takes the exclusive-or
of a whole tile against another and counts the bits. Equal fingerprints are one row
before any comparison, and a pair of tiles yields a spanning forest of its links, so
a group of any size yields links in proportion to its rows, never all its pairs.
Components are joined by rounds of large-star and small-star steps on the links.
"""

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from claimwright.llm.common import map_batches, shielded, utf8
from claimwright.session import stage

SEED = 42
PARTS = 4
TILE = 2048
POINTS = np.arange(64, dtype=np.uint64)


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of every run of `shingle` words, repeats included."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - shingle + 1].tolist()
    hashed, seed = xxhash.xxh64_intdigest, SEED
    return np.fromiter(
        (hashed(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1:].tolist())),
        np.uint64, len(starts))


def majority(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """The bits set in more than half of the hashes."""
    if not len(hashes):
        return 0
    totals = np.zeros(64, np.int64)
    for at in range(0, len(hashes), block):
        part = hashes[at:at + block].astype("<u8").view(np.uint8).reshape(-1, 8)
        totals += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << POINTS[2 * totals > len(hashes)]).sum()) if totals.any() else 0


def fingerprints(docs: DataFrame, id_column: str = "doc_id", shingle: int = 4,
                 keep: list[str] = ()) -> DataFrame:
    """(id, `_fp` as a signed long): no words give zero."""
    types = dict(docs.dtypes)
    keep = [c for c in keep if c != id_column]
    schema = ", ".join([f"`{id_column}` {types[id_column]}", "_fp bigint",
                        *[f"`{c}` {types[c]}" for c in keep]])

    def work(blocks):
        for block in blocks:
            found = [majority(shingle_hashes(raw.lower().split(), shingle)) for raw in block["_raw"]]
            yield {**{c: block[c] for c in (id_column, *keep)},
                   "_fp": np.array(found, np.uint64).view(np.int64).tolist()}

    return map_batches(docs.select(id_column, *keep, utf8().alias("_raw")), schema, work)


def _part_counts(fp: str) -> list[Column]:
    return [F.expr(f"bit_count(shiftrightunsigned({fp}, {16 * i}) & 65535L)") for i in range(PARTS)]


def _offsets(radius: int) -> list[tuple]:
    """The differences of cells within the radius, one of each opposite pair."""
    around = range(-radius, radius + 1)
    grid = np.array(np.meshgrid(*[around] * PARTS)).reshape(PARTS, -1).T
    near = sorted(map(tuple, grid[np.abs(grid).sum(axis=1) <= radius].tolist()))
    return [d for d in near if d >= (0,) * PARTS]


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that join exactly what the links between two tiles (or within one) join."""
    if not len(left) or not len(right):
        return []
    everything = np.unique(np.concatenate([left, right]))
    a, b = np.searchsorted(everything, left), np.searchsorted(everything, right)
    parent = list(range(len(everything)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    step = max(1, (1 << 19) // len(right))
    for at in range(0, len(left), step):
        near = np.bitwise_count(left[at:at + step, None] ^ right[None, :]) <= radius
        if not near.any():
            continue
        near &= a[at:at + step, None] != b[None, :]
        rows, cols = np.nonzero(near)
        for i, j in zip(a[at + rows].tolist(), b[cols].tolist()):
            ri, rj = root(i), root(j)
            if ri != rj:
                parent[max(ri, rj)] = min(ri, rj)
                edges.append((i, j))
    return [(int(everything[i]), int(everything[j])) for i, j in edges]


def links(prints: DataFrame, radius: int) -> DataFrame:
    """A forest of links (`u`, `v`) between different values of `_fp` within the radius."""
    cell = [f"_c{i}" for i in range(PARTS)]
    cells = prints.select("_fp", *[c.alias(n) for c, n in zip(_part_counts("_fp"), cell)])
    # Tiles of a cell hold TILE rows on average: rows are dealt by hash into as many
    # tiles as the cell's count asks for.
    sizes = cells.groupBy(*cell).agg(F.count("*").alias("_n"))
    tiles = (
        cells.join(sizes, cell)
        .withColumn("_tile", F.expr(f"pmod(xxhash64(_fp, 7), cast(ceil(_n / {TILE}) as bigint))"))
        .groupBy(*cell, "_tile").agg(F.collect_list("_fp").alias("_rows"))
    )
    tiles = stage(tiles, "simhash-tiles")
    moves = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(d)])
                      for d in _offsets(radius)])
    sent = tiles.select("*", F.explode(moves).alias("_d")).select(
        *[(F.col(c) + F.col(f"_d.d{i}")).alias(c) for i, c in enumerate(cell)],
        F.col("_tile").alias("_other"), F.col("_rows").alias("_left"),
        (F.expr(" + ".join(f"abs(_d.d{i})" for i in range(PARTS))) == 0).alias("_own"))
    # The planner does not see how much an explode multiplies, so it must not broadcast this.
    pairs = sent.hint("merge").join(tiles, cell).filter("NOT _own OR _other <= _tile")

    def work(blocks):
        for block in blocks:
            found = {(u, v) for x, y in zip(block["_left"], block["_rows"])
                     for u, v in forest(np.array(x, np.int64).view(np.uint64),
                                        np.array(y, np.int64).view(np.uint64), radius)}
            signed = np.array(sorted(found), np.uint64).reshape(-1, 2).view(np.int64)
            yield {"u": signed[:, 0].tolist(), "v": signed[:, 1].tolist()}

    return map_batches(pairs.select("_left", "_rows"), "u bigint, v bigint", work)


def components(edges: DataFrame) -> DataFrame:
    """(`node`, `root`) of every node on an edge; the root is the component's smallest node.

    Each round replaces the links of a node by links to its smallest neighbour, first
    for its larger neighbours, then for the smaller ones, until nothing changes. The
    smallest neighbour is a minimum with map-side partials and is joined back, so a
    node with very many links is split like any skewed join key.
    """
    now = stage(edges.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u"))
                .filter("u <> v").distinct(), "simhash-edges")
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = stage(large, "simhash-large")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"))
        after = stage(small.filter("u <> v").distinct(), "simhash-small")
        # Done when every node hangs on one root that is no node's child.
        parents = after.groupBy("u").agg(F.count("*").alias("n"))
        if not parents.filter("n > 1").limit(1).count() and not (
                after.join(after.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
                .limit(1).count()):
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        now = after


def grouped(prints: DataFrame, id_column: str, radius: int) -> DataFrame:
    """(`_fp`, `component_id`) of every fingerprint of a staged table."""
    kinds = stage(prints.groupBy("_fp").agg(F.min(id_column).alias("_least")), "simhash-kinds")
    roots = components(links(kinds.select("_fp"), radius))
    joined = kinds.join(roots.withColumnRenamed("node", "_fp"), "_fp", "left").withColumn(
        "root", F.coalesce("root", "_fp"))
    smallest = joined.groupBy("root").agg(F.min("_least").alias("component_id"))
    return joined.join(smallest, "root").select("_fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", shingle: int = 4, radius: int = 4,
                    keep: list[str] = ()) -> DataFrame:
    """One row per document: id, `_fp`, `component_id` (the smallest id reachable by links).

    Equal fingerprints are linked, zero included (texts without words; no text is the
    empty text). Repeated rows share their component. A null id is a component's
    smallest only where it has no other. `keep` names columns carried over.
    """
    prints = stage(fingerprints(docs, id_column, shingle, keep), "simhash-prints")
    return prints.join(grouped(prints, id_column, radius).drop("root"), "_fp")


def contract(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of each component: the one of smallest id, of repeated rows the first."""
    return shielded(docs, lambda d: _first_rows(d, shingle, radius))


def _first_rows(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    prints = stage(
        fingerprints(docs.withColumn("_row", F.monotonically_increasing_id()),
                     "doc_id", shingle, ["_row", *[c for c in docs.columns if c != "doc_id"]]),
        "simhash-prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("_first")
    kept = (
        prints.groupBy("_fp").agg(first)
        .join(grouped(prints, "doc_id", radius), "_fp")
        .groupBy("root").agg(F.min("_first").alias("_first"))
        .select(F.col("_first._row").alias("_row")))
    return prints.join(kept, "_row", "left_semi")
