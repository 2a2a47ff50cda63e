"""Histogram-boosted trees for the logistic, Poisson and Gamma losses.

Rows are binned once, a byte for each feature, and kept with target, weight and linear
score in blocks of arrays. A pass over them adds up the first and second derivatives of the
loss by node, feature and bin in every task, and a few tasks add these up by node; the
driver gets at most 256 sums a node and feature. A pass has a task a core at most, so
what these report does not grow with the rows. Trees grow by best gain to a limit of leaves, and all
nodes that may be split next share one pass. The loss on the hold-out comes with a
round's first pass.
"""

import math
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimwright.operators.sampling import digest
from claimwright.operators.trees import (
    BINS, Binner, Forest, Growth, Tree, bin_matrix, grow, split_gains)
from claimwright.session import checkpointing, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])


TASK_ROWS = 50_000
BLOCK_ROWS = 65_536
REDUCERS = 8
REDUCED_NODES = 4
KEPT = StorageLevel.MEMORY_AND_DISK


@dataclass
class Settings:
    """Parameters of a boosting run."""

    loss: str
    rate: float
    rounds: int = 300
    leaves: int = 31
    least_rows: int = 100
    penalty: float = 1.0
    patience: int = 20
    tolerance: float = 1e-7
    checkpoint_every: int = 10

    def growth(self) -> Growth:
        return Growth(self.leaves, self.least_rows, self.penalty, self.rate)


OCCURRENCE_SETTINGS = Settings("logistic", rate=0.08, rounds=250)
FREQUENCY_SETTINGS = Settings("poisson", rate=0.08)
SEVERITY_SETTINGS = Settings("gamma", rate=0.06, leaves=15, penalty=5.0)


def _mean(loss: str, eta: Column) -> Column:
    """The prediction on the scale of the target."""
    return 1.0 / (1.0 + F.exp(-eta)) if loss == "logistic" else F.exp(eta)


def _start(loss: str, mean: float) -> float:
    return math.log(mean / (1.0 - mean)) if loss == "logistic" else math.log(mean)


def derivatives(loss: str, y: np.ndarray, w: np.ndarray, eta: np.ndarray):
    """First and second derivative of the loss in the linear score."""
    if loss == "logistic":
        m = 1.0 / (1.0 + np.exp(-eta))
        return w * (m - y), w * m * (1.0 - m)
    m = np.exp(eta)
    if loss == "poisson":
        return w * (m - y), w * m
    if loss == "gamma":
        return w * (1.0 - y / m), w * y / m
    raise ValueError(f"Unknown loss {loss}")


def losses(loss: str, y: np.ndarray, w: np.ndarray, eta: np.ndarray) -> np.ndarray:
    """The loss up to what does not depend on the score."""
    if loss == "logistic":
        return w * (np.log1p(np.exp(-np.abs(eta))) + np.maximum(eta, 0.0) - y * eta)
    if loss == "poisson":
        return w * (np.exp(eta) - y * eta)
    return w * (y * np.exp(-eta) + eta)


def binned(df: DataFrame, binner: Binner, keep: list[Column]) -> DataFrame:
    """The kept columns with `_bins`: the bins of all features, a byte each."""
    @F.arrow_udf("binary")
    def packed(*columns: pa.Array) -> pa.Array:
        return pa.array([row.tobytes() for row in binner.bins(list(columns))], pa.binary())

    return df.select(*keep, packed(*binner.columns()).alias("_bins"))


def added(trees: list[Tree], binner: Binner) -> Column:
    """What the trees add to the score of a row with the binner's columns: one expression,
    however many trees there are."""
    forest: list[Forest] = []  # built once in a task, for all its blocks

    @F.arrow_udf("double")
    def total(*columns: pa.Array) -> pa.Array:
        if not forest:
            forest.append(Forest(trees, len(binner.names)))
        return pa.array(forest[0].added(binner.bins(list(columns))))

    return total(*binner.columns())


def blocks(rows: DataFrame, width: int) -> RDD:
    """Binned rows as blocks of arrays: (bins by feature, target, weight, score, rows to fit on).

    The rows to fit on come first in a block, those of the hold-out after them. A pass reads a
    few large arrays in place of rows, and a block is the most a task holds at once.
    """
    def run(batches):
        waiting, count = [], 0
        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            if count >= BLOCK_ROWS:
                yield packed(waiting)
                waiting, count = [], 0
        if count:
            yield packed(waiting)

    def packed(batches):
        table = pa.Table.from_batches(batches).combine_chunks()
        bins = bin_matrix(table.column(0), width)
        held = table.column(4).to_numpy()
        order = np.argsort(held, kind="stable")
        arrays = [np.ascontiguousarray(bins[order].T),
                  *[table.column(i).to_numpy()[order] for i in (1, 2, 3)]]
        return pa.RecordBatch.from_arrays(
            [pa.array([int((~held).sum())]), *[pa.array([x.tobytes()], pa.binary()) for x in arrays]],
            ["fit", "bins", "y", "w", "eta"])

    def arrays(row):
        y, w, eta = (np.frombuffer(row[c]) for c in ("y", "w", "eta"))
        return np.frombuffer(row["bins"], np.uint8).reshape(width, len(y)), y, w, eta, row["fit"]

    return rows.select("_bins", "_y", "_w", "_eta", "_held").mapInArrow(
        run, "fit bigint, bins binary, y binary, w binary, eta binary").rdd.map(arrays)


def advanced(block: tuple, tree: Tree) -> tuple:
    """A block whose score has the tree's values added."""
    bins, y, w, eta, fit = block
    eta = eta.copy()
    for leaf, rows in tree.members(bins, np.flatnonzero(tree.feature < 0).tolist()):
        eta[rows] += tree.value[leaf]
    return bins, y, w, eta, fit


def measured(state: RDD, loss: str, tree: Tree, wanted: list[int], sizes: list[int]):
    """(sums, held) of one pass over blocks: derivatives and rows by (wanted node, feature, bin),
    and with the root the loss and weight of the hold-out. `sizes` are the bins of each feature.

    Every task adds its blocks up, and tasks are added up by node: few tasks, whatever the rows.
    """
    edges = np.cumsum([0, *sizes]).tolist()
    slots = {node: slot for slot, node in enumerate(wanted)}

    def run(parts):
        sums, held_sums = np.zeros((len(slots), 3, edges[-1])), np.zeros(2)
        for bins, y, w, eta, fit in parts:
            if 0 in slots:
                held_sums += losses(loss, y[fit:], w[fit:], eta[fit:]).sum(), w[fit:].sum()
            for node, rows in tree.members(bins[:, :fit], wanted):
                out = sums[slots[node]]
                gradient, curvature = derivatives(loss, y[:fit][rows], w[:fit][rows], eta[:fit][rows])
                for f, (low, high) in enumerate(zip(edges, edges[1:])):
                    own = bins[f, :fit][rows].astype(np.intp)
                    out[0, low:high] += np.bincount(own, gradient, high - low)
                    out[1, low:high] += np.bincount(own, curvature, high - low)
                    out[2, low:high] += np.bincount(own, minlength=high - low)
        yield -1, held_sums
        yield from enumerate(sums)

    found = dict(state.mapPartitions(run).reduceByKey(
        np.add, min(1 + len(wanted) // REDUCED_NODES, REDUCERS)).mapValues(_narrow).collect())
    sums = np.zeros((len(wanted), len(sizes), BINS, 3))
    for slot in range(len(wanted)):
        own = _wide(found[slot], edges[-1])
        for f, (low, high) in enumerate(zip(edges, edges[1:])):
            sums[slot, f, :high - low] = own[:, low:high].T
    return sums, found[-1]


def _narrow(sums: np.ndarray):
    """What goes to the driver of a node's sums: those of bins with rows, counts in few bytes."""
    if sums.ndim == 1:
        return sums
    used = sums[2] > 0
    counts = sums[2, used]
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    return np.packbits(used), sums[:2, used], counts.astype(kind)


def _wide(narrow: tuple, width: int) -> np.ndarray:
    """The sums of all bins again."""
    used = np.unpackbits(narrow[0], count=width).astype(bool)
    out = np.zeros((3, width))
    out[:2, used], out[2, used] = narrow[1:]
    return out


def histograms(state: DataFrame, loss: str, tree: Tree, wanted: list[int], width: int):
    """One pass over binned rows, as `measured`."""
    return measured(blocks(state, width), loss, tree, wanted, [BINS] * width)


@dataclass
class BoostedTrees:
    """A fitted run: the bins, the start value and the trees."""

    binner: Binner
    loss: str
    start: float
    trees: list[Tree] = field(default_factory=list)
    history: list[float] = field(default_factory=list)

    def score(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Rows with the predicted mean."""
        eta = F.lit(self.start) + added(self.trees, self.binner)
        return df.withColumn(output, _mean(self.loss, eta))

    def save(self, path: str) -> None:
        """Three small tables: the start, the bins, and a row for each node."""
        spark = SparkSession.getActiveSession()

        def write(rows, schema, name):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(
                f"{path}/{name}")

        write([(self.loss, self.start)], "loss string, start double", "start")
        write([(i, c, cuts, None) for i, (c, cuts) in enumerate(self.binner.numbers.items())]
              + [(i, c, None, kept) for i, (c, kept) in enumerate(
                  self.binner.texts.items(), len(self.binner.numbers))],
              "place int, name string, cuts array<double>, categories array<string>", "bins")
        write([(t, i, int(tree.feature[i]), np.packbits(tree.lefts[i]).tobytes(),
                *tree.children[i].tolist(), float(tree.value[i]))
               for t, tree in enumerate(self.trees) for i in range(len(tree.feature))],
              "tree int, node int, feature int, lefts binary, left int, right int, value double",
              "nodes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedTrees":
        start = spark.read.parquet(f"{path}/start").first()
        bins = spark.read.parquet(f"{path}/bins").orderBy("place").collect()
        binner = Binner({r["name"]: r["cuts"] for r in bins if r["cuts"] is not None},
                        {r["name"]: r["categories"] for r in bins if r["cuts"] is None})
        nodes: dict[int, list] = {}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            nodes.setdefault(r["tree"], []).append(r)
        trees = [Tree(
            np.array([r["feature"] for r in rows], np.int16),
            np.array([np.unpackbits(np.frombuffer(r["lefts"], np.uint8)).astype(bool) for r in rows]),
            np.array([(r["left"], r["right"]) for r in rows], np.int32),
            np.array([r["value"] for r in rows])) for _, rows in sorted(nodes.items())]
        return cls(binner, start["loss"], start["start"], trees)


def held_out(key: str = "IDpol") -> Column:
    """A tenth of the rows by hashed id, for early stopping."""
    return F.conv(F.substring(digest(key, "holdout"), 1, 7), 16, 10).cast("bigint") % 10 == 0


def start_rows(train: DataFrame, label: str, weight: str | None, numbers: list[str],
               texts: list[str], loss: str, key: str) -> tuple[Binner, float, DataFrame]:
    """The bins, the start value, and the binned rows with their first score."""
    binner = Binner.fit(train.filter(~held_out(key)), numbers, texts)
    # Every pass reads these rows, so they are written once, narrow.
    rows = stage(binned(train, binner, [
        F.col(label).cast("double").alias("_y"),
        (F.col(weight) if weight else F.lit(1)).cast("double").alias("_w"),
        held_out(key).alias("_held"), F.col(key)]), "boosting-rows", key).drop(key)
    sums = rows.filter("NOT _held").agg(
        F.sum(F.col("_y") * F.col("_w")), F.sum("_w"), F.count("*")).first()
    start = _start(loss, sums[0] / sums[1])
    # A pass is as slow as starting its tasks where these have few rows. Every task of every
    # pass reports to the driver, so there are no more than run at once, whatever the rows.
    cores = train.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(rows.rdd.getNumPartitions(), sums[2] // TASK_ROWS, cores))
    return binner, start, rows.coalesce(tasks).withColumn("_eta", F.lit(start))


ROOT = Tree(np.array([-1], np.int16), np.zeros((1, BINS), bool), np.zeros((1, 2), np.int32), np.zeros(1))


def fit_boosting(
    train: DataFrame, label: str, weight: str | None, numbers: list[str], texts: list[str],
    settings: Settings, key: str = "IDpol",
) -> BoostedTrees:
    checkpointing(train.sparkSession)
    binner, start, rows = start_rows(train, label, weight, numbers, texts, settings.loss, key)
    model = BoostedTrees(binner, settings.loss, start)
    _add_trees(model, rows, settings)
    return model


def _add_trees(model: BoostedTrees, rows: DataFrame, settings: Settings) -> None:
    """Adds trees until the rounds are over or the hold-out does not get better."""
    sizes = model.binner.sizes()
    state, previous, best, since_best = blocks(rows, len(sizes)).persist(KEPT), None, math.inf, 0
    for number in range(settings.rounds):
        def measure(tree, wanted, state=state):
            return measured(state, settings.loss, tree, wanted, sizes)[0]

        # This pass also works the last tree's scores out and keeps them.
        root, held = measured(state, settings.loss, ROOT, [0], sizes)
        if previous is not None:
            previous.unpersist()
        # The loss of the rounds so far; this round's tree is judged in the next one.
        if held[1] > 0:
            reached = held[0] / held[1]
            model.history.append(reached)
            if reached < best - settings.tolerance:
                best, since_best = reached, 0
            else:
                since_best += 1
            if since_best >= settings.patience:
                break
        tree = grow(root[0], measure, model.binner.categorical, settings.growth())
        model.trees.append(tree)
        if tree.leaves < 2 or number + 1 == settings.rounds:
            break
        previous, state = state, state.map(
            lambda block, tree=tree: advanced(block, tree)).persist(KEPT)
        if (number + 1) % settings.checkpoint_every == 0:
            state.checkpoint()
    state.unpersist()


def first_split_gains(
    train: DataFrame, label: str, weight: str | None, numbers: list[str], texts: list[str],
    settings: Settings, key: str = "IDpol",
) -> DataFrame:
    """The gain of every split of the first root: a row for each number, cut and side of the
    missing values, and for each text and number of categories on the left.

    `Cut` is NULL where all known values go left; `Category` is the last one that does
    (NULL for missing or rare ones).
    """
    binner, _, rows = start_rows(train, label, weight, numbers, texts, settings.loss, key)
    sums = histograms(rows, settings.loss, ROOT, [0], len(binner.names))[0][0]
    gains, orders, lefts = split_gains(sums, binner.categorical, settings.growth())
    known = list(binner.numbers.values()) + list(binner.texts.values())
    out = []
    for f, d, k in zip(*(x.tolist() for x in np.nonzero(np.isfinite(gains)))):
        if binner.categorical[f]:
            b = int(orders[f, k])
            cut, category = None, known[f][b - 1] if b else None
        else:
            cut, category = known[f][k - 1] if k <= len(known[f]) else None, None
        out.append((binner.names[f], cut, category, d == 1, int(lefts[f, d, k, 2]),
                    float(gains[f, d, k])))
    return train.sparkSession.createDataFrame(
        out, "Feature string, Cut double, Category string, MissingLeft boolean,"
             " LeftRows bigint, Gain double")
