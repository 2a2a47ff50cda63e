"""Centroid clustering of integer vectors, with most centroids ruled out by a bound.

All vectors are rotated onto the principal axes of the table once, and the leading
coordinates and the norm of the rest are stored beside the integers. With a centroid
rotated alike, the squared distance of the leading coordinates plus the squared difference
of the two rest norms is never more than the squared distance. In each block the centroid
of least bound is measured first, in integers; a centroid whose bound, less a margin for
rounding, is beyond that distance is out, and the others are measured in integers too. So
results are exact, whatever the axes.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from claimwright.llm.common import map_batches
from claimwright.llm.vector_codes import finite, integers
from claimwright.session import stage

LENGTH, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
LEADING = 16
MARGIN = 1e-9
BLOCK = 8192


def principal_axes(rows: DataFrame, length: int, scale: int, leading: int) -> "Axes":
    """The mean and the leading principal axes of all integer vectors.

    Tasks add up first and second moments; the shuffle holds a row for each of these
    from each task, so nothing grows with the rows.
    """
    upper = np.triu_indices(length)

    def run(batches):
        count, first, second = 0, np.zeros(length), np.zeros((length, length))
        for batch in batches:
            values = integers(batch.column(0), scale).astype(np.float64)
            count += len(values)
            first += values.sum(axis=0)
            second += values.T @ values
        every = np.concatenate([[count], first, second[upper]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(every)), pa.int64()), pa.array(every)], ["place", "total"])

    sums = rows.select("v").mapInArrow(run, "place bigint, total double").groupBy("place").agg(
        F.sum("total").alias("total"))
    every = np.zeros(1 + length + len(upper[0]))
    for r in sums.collect():
        every[r["place"]] = r["total"]
    count = max(every[0], 1.0)
    mean = every[1:1 + length] / count
    second = np.zeros((length, length))
    second[upper] = every[1 + length:] / count
    second = second + np.triu(second, 1).T - np.outer(mean, mean)
    _, vectors = np.linalg.eigh(second)
    return Axes(mean, vectors[:, ::-1][:, :leading].copy())


@dataclass
class Axes:
    """A rotation: what to subtract, and the leading axes as columns."""

    mean: np.ndarray
    leading: np.ndarray

    def rotated(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and the norm of the rest."""
        moved = values - self.mean
        lead = moved @ self.leading
        rest = (moved * moved).sum(axis=1) - (lead * lead).sum(axis=1)
        return lead, np.sqrt(np.maximum(rest, 0.0))


def rotated_blocks(rows: DataFrame, axes: Axes, scale: int, block: int = BLOCK) -> DataFrame:
    """(vec_id, v) as blocks of ids, integers, leading coordinates and rest norms."""
    schema = f"vec_id array<{dict(rows.dtypes)['vec_id']}>, ints binary, lead binary, rest binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    mean, leading = axes.mean, axes.leading

    def run(batches):
        own = Axes(mean, leading)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                values = integers(part.column(1), scale)
                lead, rest = own.rotated(values)
                record = [part.column(0).to_pylist(), values.astype("<i8").tobytes(),
                          lead.astype("<f8").tobytes(), rest.astype("<f8").tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t.type) for x, t in zip(record, arrow)], schema=arrow)

    return rows.select("vec_id", "v").mapInArrow(run, schema)


def nearest(values: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray,
            centre_lead: np.ndarray, centre_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, distances measured): the nearest centroid of every row,
    ties to the smaller number."""
    size, centre_size = (lead * lead).sum(axis=1), (centre_lead * centre_lead).sum(axis=1)
    bound = (size[:, None] + centre_size[None, :] - 2.0 * (lead @ centre_lead.T)
             + (rest[:, None] - centre_rest[None, :]) ** 2)
    # Rounding moves a bound by far less than this share of the two squared norms.
    bound -= MARGIN * (1.0 + (size + rest * rest)[:, None] + (centre_size + centre_rest ** 2)[None, :])
    far = np.full(bound.shape, np.iinfo(np.int64).max, np.int64)
    every = np.arange(len(values))
    first = bound.argmin(axis=1)
    step = values - centroids[first]
    far[every, first] = (step * step).sum(axis=1)
    near = bound <= far[every, first][:, None]
    near[every, first] = False
    for c in range(len(centroids)):
        some = np.flatnonzero(near[:, c])
        step = values[some] - centroids[c]
        far[some, c] = (step * step).sum(axis=1)
    cluster = far.argmin(axis=1)
    return cluster, far[every, cluster], len(values) + int(near.sum())


def _blocks(found, columns, length, leading):
    """Blocks as (ids or None, integers, leading coordinates, rest norms)."""
    for some in found:
        for record in zip(*(some[c] for c in columns)):
            ids = record[0] if len(columns) == 4 else None
            ints, lead, rest = record[-3:]
            yield (ids, np.frombuffer(ints, "<i8").reshape(-1, length),
                   np.frombuffer(lead, "<f8").reshape(-1, leading), np.frombuffer(rest, "<f8"))


def cluster_sums(blocks: DataFrame, centroids: np.ndarray, axes: Axes) -> DataFrame:
    """(cluster, place, total, n): component sums and sizes of every cluster with members."""
    clusters, length = centroids.shape
    columns, leading = ["ints", "lead", "rest"], axes.leading.shape[1]
    centre = axes.rotated(centroids)

    def work(found):
        totals, sizes = np.zeros((clusters, length), np.int64), np.zeros(clusters, np.int64)
        for _, values, lead, rest in _blocks(found, columns, length, leading):
            cluster, _, _ = nearest(values, lead, rest, centroids, *centre)
            sizes += np.bincount(cluster, minlength=clusters)
            for c in range(clusters):
                totals[c] += values[cluster == c].sum(axis=0)
        cluster, place = (x.ravel().tolist() for x in np.indices(totals.shape))
        yield {"cluster": cluster, "place": place, "total": totals.ravel().tolist(),
               "n": np.repeat(sizes, length).tolist()}

    each = map_batches(
        blocks.select(*columns), "cluster int, place int, total bigint, n bigint", work)
    return each.filter("n > 0").groupBy("cluster", "place").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"))


def assign(blocks: DataFrame, centroids: np.ndarray, axes: Axes) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    kind = dict(blocks.dtypes)["vec_id"][len("array<"):-1]
    columns, leading = ["vec_id", "ints", "lead", "rest"], axes.leading.shape[1]
    centre, length = axes.rotated(centroids), centroids.shape[1]

    def work(found):
        for ids, values, lead, rest in _blocks(found, columns, length, leading):
            cluster, distance, _ = nearest(values, lead, rest, centroids, *centre)
            yield {"vec_id": ids, "cluster": cluster.tolist(), "distance": distance.tolist()}

    return map_batches(
        blocks.select(*columns), f"vec_id {kind}, cluster int, distance bigint", work)


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS,
            length: int = LENGTH, scale: int = SCALE, leading: int = LEADING,
            seed: str = "1") -> tuple[np.ndarray, DataFrame]:
    """The final centroids, and (vec_id, cluster, distance) of every vector.

    Vectors of another length, null vectors and those with null or non-finite components
    take no part. Rows of one vec_id are vectors of their own. The first centroids are the vectors
    whose `seed:vec_id` has the smallest SHA-256 (equal ids by their vectors, null ids
    last); fewer vectors give fewer centroids, none give no rows. Further columns are not read.
    """
    rows = finite(vectors.select("vec_id", "embedding")).select("vec_id", "v").filter(
        F.size("v") == length)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(drawn.asc_nulls_last(), "v").limit(clusters).select("v").toArrow()
    if not first.num_rows:
        kind = dict(rows.dtypes)["vec_id"]
        return np.zeros((0, length), np.int64), vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance bigint")
    centroids = integers(first["v"].combine_chunks(), scale)
    axes = principal_axes(rows, length, scale, leading)
    blocks = stage(rotated_blocks(rows, axes, scale), "centroids-blocks")
    for _ in range(rounds):
        new = centroids.copy()
        for r in cluster_sums(blocks, centroids, axes).collect():
            new[r["cluster"], r["place"]] = r["total"] // r["n"]
        centroids = new
    return centroids, assign(blocks, centroids, axes)


def contract(vectors: DataFrame) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), a row for each
    vector of 64 components."""
    centroids, rows = cluster(vectors)
    found = stage(rows, "centroids")
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # At most CLUSTERS rows, whatever the table.
    sums = {r["cluster"]: r["total"] for r in
            found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    facts = vectors.sparkSession.createDataFrame(
        [(c, total, names[c]) for c, total in sorted(sums.items())],
        "cluster int, cluster_inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia",
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"), "centroid_sha256")
