"""Approximate nearest neighbours by balanced posting lists.

Centroids come from balanced halving of a bounded sample, so lists are of like size. A
vector goes to its nearest list and, near a boundary, to every other list whose centroid
is not much farther; a query reads every list whose centroid is not much farther than
the nearest. Nearest centroids are found by beam search in a neighbour graph that each
task holds in memory (at most MAX_LISTS centroids). Lists that are long all the same,
and lists many queries read, are dealt into chunks, so no task holds a whole list.
Distances are exact, in double precision, on the original vectors.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from claimwright.llm.common import map_batches
from claimwright.session import stage

LIST_SIZE = 200
MAX_LISTS = 8192
SAMPLE = 65_536
DEGREE = 24
BEAM = 48
STORE_RATIO = 1.10
STORE_LISTS = 4
READ_RATIO = 1.35
CHUNK = 2048
QUERY_CHUNK = 1024


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part; of rows with one id, the least vector.

    Vectors that are null, zero or hold null or non-finite components take no part, nor
    do those without an id or of another length than most.
    """
    v = F.col("embedding")
    fine = (vectors.select("vec_id", F.transform(v, lambda x: x.cast("double")).alias("v"))
            .filter("vec_id IS NOT NULL AND size(v) > 0")
            .filter("forall(v, x -> coalesce(abs(x) < double('Infinity'), false))"
                    " AND exists(v, x -> x <> 0)")
            .groupBy("vec_id").agg(F.min("v").alias("v")))
    fine = stage(fine, "neighbours-vectors")
    most = fine.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return fine.filter(F.size("v") == (most["d"] if most else 0))


def balanced_centroids(points: np.ndarray, lists: int) -> np.ndarray:
    """The means of `lists` parts of like size, by halving along the two means."""
    parts, out = [(np.arange(len(points)), lists)], []
    while parts:
        own, wanted = parts.pop()
        rows = points[own]
        if wanted <= 1 or len(own) < 2:
            out.append(rows.mean(axis=0))
            continue
        spread = rows - rows.mean(axis=0)
        axis = spread[np.argmax((spread * spread).sum(axis=1))]
        for _ in range(6):
            side = spread @ axis
            far = side > np.median(side)
            if not far.any() or far.all():
                break
            axis = spread[far].mean(axis=0) - spread[~far].mean(axis=0)
        order = np.argsort(spread @ axis, kind="stable")
        left = wanted // 2
        cut = max(1, min(len(own) - 1, round(len(own) * left / wanted)))
        parts += [(own[order[:cut]], left), (own[order[cut:]], wanted - left)]
    return np.array(out)


class Graph:
    """Centroids with links to their nearest ones; `nearest` is a beam search."""

    def __init__(self, centroids: np.ndarray, links: np.ndarray | None = None,
                 degree: int = DEGREE):
        self.centroids = centroids
        n = len(centroids)
        # Ways in from all sides, should links alone not reach every centroid.
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 64)).astype(np.int64))
        if links is not None:
            self.links = links
            return
        self.links = np.zeros((n, min(degree, max(1, n - 1))), np.int64)
        norms = (centroids * centroids).sum(axis=1)
        for at in range(0, n, 512):
            gap = norms[None, :] - 2.0 * centroids[at:at + 512] @ centroids.T
            gap[np.arange(len(gap)), np.arange(at, at + len(gap))] = np.inf
            self.links[at:at + 512] = np.argsort(gap, axis=1, kind="stable")[:, :self.links.shape[1]]

    def _gaps(self, points: np.ndarray, ids: np.ndarray) -> np.ndarray:
        step = self.centroids[ids] - points[:, None, :]
        return np.sqrt(np.einsum("abc,abc->ab", step, step))

    def nearest(self, points: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of each point's beam, nearest first; -1 fills it up."""
        rows = np.arange(len(points))
        ids = np.broadcast_to(self.entries, (len(points), len(self.entries)))
        gaps = self._gaps(points, ids)
        width = min(beam, len(self.centroids))
        order = np.argsort(gaps, axis=1, kind="stable")[:, :width]
        ids, gaps = np.take_along_axis(ids, order, 1), np.take_along_axis(gaps, order, 1)
        opened = np.zeros(ids.shape, bool)
        while True:
            waiting = np.where(opened | (ids < 0), np.inf, gaps)
            best = waiting.argmin(axis=1)
            active = np.isfinite(waiting[rows, best])
            if not active.any():
                return ids, gaps
            opened[rows, best] = True
            new = np.where(active[:, None], self.links[np.maximum(ids[rows, best], 0)], -1)
            known = (new[:, :, None] == ids[:, None, :]).any(axis=2) | (new < 0)
            far = np.where(known, np.inf, self._gaps(points, np.maximum(new, 0)))
            ids = np.concatenate([ids, np.where(known, -1, new)], axis=1)
            gaps = np.concatenate([gaps, far], axis=1)
            opened = np.concatenate([opened, known], axis=1)
            order = np.argsort(gaps, axis=1, kind="stable")[:, :width]
            ids, gaps, opened = (np.take_along_axis(x, order, 1) for x in (ids, gaps, opened))


def fit_graph(vectors: DataFrame, list_size: int = LIST_SIZE) -> Graph | None:
    """The centroid graph from at most SAMPLE vectors, chosen by hash of their id."""
    total = vectors.count()
    if not total:
        return None
    share = min(1.0, 0.95 * SAMPLE / total)
    drawn = vectors.filter(F.pmod(F.xxhash64("vec_id", F.lit("lists")), F.lit(1 << 20)) <
                           int(share * (1 << 20)) + 1).limit(SAMPLE).select("vec_id", "v").toArrow()
    order = np.argsort(drawn["vec_id"].to_numpy(), kind="stable")
    points = matrix(drawn["v"])[order]
    lists = max(1, min(MAX_LISTS, -(-total // list_size), len(points)))
    return Graph(balanced_centroids(points, lists))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of vectors as a matrix."""
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def listed(vectors: DataFrame, graph: Graph, ratio: float, most: int) -> DataFrame:
    """(list, vec_id, v): a row for each list within `ratio` of the nearest, at most `most`."""
    # Plain arrays: a broadcast object would need its class's module on the executors.
    sent = vectors.sparkSession.sparkContext.broadcast((graph.centroids, graph.links))

    def work(blocks):
        graph = Graph(*sent.value)
        for block in blocks:
            for at in range(0, len(block["v"]), 512):
                points = np.array(block["v"][at:at + 512], np.float64)
                ids, gaps = graph.nearest(points)
                taken = (ids >= 0) & (gaps <= ratio * gaps[:, :1] + 1e-12)
                taken[:, most:] = False
                rows, places = np.nonzero(taken)
                yield {"list": ids[rows, places].tolist(),
                       "vec_id": [block["vec_id"][at + i] for i in rows.tolist()],
                       "v": [block["v"][at + i] for i in rows.tolist()]}

    kind = dict(vectors.dtypes)["vec_id"]
    return map_batches(vectors, f"list bigint, vec_id {kind}, v array<double>", work)


def compare(postings: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): each query's `k` nearest in every chunk it reads."""
    kind = dict(queries.dtypes)["vec_id"]
    # A list has so many chunks of vectors and so many of queries; each meets each once.
    sizes = (postings.groupBy("list").agg(F.count("*").alias("n"))
             .join(queries.groupBy("list").agg(F.count("*").alias("q")), "list")
             .select("list", F.expr(f"cast(ceil(n / {CHUNK}) as int)").alias("chunks"),
                     F.expr(f"cast(ceil(q / {QUERY_CHUNK}) as int)").alias("parts")))

    def dealt(rows, own, other, own_name, other_name):
        return rows.join(sizes, "list").select(
            "list", "vec_id", "v",
            F.expr(f"cast(pmod(xxhash64(vec_id), {own}) as int)").alias(own_name),
            F.explode(F.expr(f"sequence(0, {other} - 1)")).alias(other_name))

    left = dealt(postings, "chunks", "parts", "chunk", "part")
    right = dealt(queries, "parts", "chunks", "part", "chunk")
    schema = f"query_id {kind}, vec_id {kind}, score double"

    def nearest(key, vectors: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if vectors.num_rows and asked.num_rows:
            ids, points = vectors["vec_id"].to_numpy(), matrix(vectors["v"])
            for name, query in zip(asked["vec_id"].to_pylist(), matrix(asked["v"])):
                step = points - query
                gaps = np.sqrt((step * step).sum(axis=1))
                gaps[ids == name] = np.inf
                if len(gaps) > k:
                    edge = np.partition(gaps, k - 1)[k - 1]
                    some = np.flatnonzero((gaps <= edge) & np.isfinite(gaps))
                else:
                    some = np.flatnonzero(np.isfinite(gaps))
                some = some[np.lexsort((ids[some], gaps[some]))][:k]
                out["query_id"] += [name] * len(some)
                out["vec_id"] += ids[some].tolist()
                out["score"] += gaps[some].tolist()
        types = [asked.schema.field("vec_id").type] * 2 + [pa.float64()]
        return pa.table({n: pa.array(x, t) for (n, x), t in zip(out.items(), types)})

    return (left.groupBy("list", "chunk", "part")
            .cogroup(right.groupBy("list", "chunk", "part")).applyInArrow(nearest, schema))


def top(found: DataFrame, k: int) -> DataFrame:
    """Each query's `k` nearest of what was found, ties to the smaller vec_id."""
    each = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, every: int = 100, k: int = 10, read_ratio: float = READ_RATIO,
           store_ratio: float = STORE_RATIO, list_size: int = LIST_SIZE) -> DataFrame:
    """(query_id, rank, vec_id, score) for every vector whose id is divisible by `every`.

    A query whose lists held fewer than `k` others reads all lists, so it finds `k`
    wherever there are as many. No usable vectors give no rows.
    """
    fine = usable(vectors)
    graph = fit_graph(fine, list_size)
    if graph is None:
        kind = dict(vectors.dtypes)["vec_id"]
        return vectors.sparkSession.createDataFrame(
            [], f"query_id {kind}, rank int, vec_id {kind}, score double")
    postings = stage(listed(fine, graph, store_ratio, STORE_LISTS), "neighbours-lists")
    asked = fine.filter(F.col("vec_id") % every == 0)
    reading = stage(listed(asked, graph, read_ratio, BEAM), "neighbours-queries")
    found = stage(top(compare(postings, reading, k), k), "neighbours-found")
    enough = found.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = asked.join(enough, "vec_id", "left_anti")
    if short.limit(1).count():
        every_list = F.expr(f"sequence(0L, {len(graph.centroids) - 1}L)")
        wide = short.select(F.explode(every_list).alias("list"), "vec_id", "v")
        again = top(compare(postings, wide, k), k)
        found = found.join(enough.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi") \
            .unionByName(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
