"""Binned features, gradient histograms and regression trees grown leaf by leaf.

Features are cut once into at most 256 bins, a byte each: bin 0 holds missing numbers and
missing, rare or unknown categories. A tree is a few small arrays; each inner node names
a feature and the bins that go left, so numbers, categories and missing values are walked
alike, a block of rows at a time.
"""

import heapq
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

# What tasks run travels with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 256
CUTS = BINS - 2
FEW = 400
AHEAD = 2
MOST_NODES = 32
LEAST_CURVATURE = 1e-3


@dataclass
class Binner:
    """Cut points of the numbers and the categories of the texts."""

    numbers: dict[str, list[float]]
    texts: dict[str, list[str]]

    @classmethod
    def fit(cls, df: DataFrame, numbers: list[str], texts: list[str]) -> "Binner":
        """Numbers with few values are cut between these, others at 254 quantiles; texts
        keep their 255 most frequent values. The driver gets bounded lists only."""
        values = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in numbers}
        cuts: dict[str, list[float]] = {c: [] for c in numbers}
        row = df.agg(F.lit(0).alias("_"), *[
            F.approx_count_distinct(v, 0.02).alias(c) for c, v in values.items()]).first()
        few = [c for c in numbers if row[c] <= FEW]
        if few:
            pairs = F.array(*[F.struct(F.lit(c).alias("c"), values[c].alias("v")) for c in few])
            found: dict[str, list[float]] = {c: [] for c in few}
            for r in df.select(F.explode(pairs).alias("p")).select("p.*").filter(
                    "v IS NOT NULL").distinct().collect():
                found[r["c"]].append(r["v"])
            cuts |= {c: _between(sorted(x)) for c, x in found.items() if len(x) <= BINS - 1}
            few = [c for c, x in found.items() if len(x) <= BINS - 1]
        many = [c for c in numbers if c not in few]
        if many:
            shares = [i / (CUTS + 1) for i in range(1, CUTS + 1)]
            found_cuts = df.select(*[values[c].alias(c) for c in many]).approxQuantile(
                many, shares, 1.0 / (4 * BINS))
            cuts |= {c: sorted(set(x)) for c, x in zip(many, found_cuts)}
        kept = {}
        for c in texts:
            top = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(
                F.count("*").alias("n")).orderBy(F.desc("n"), "v").limit(BINS - 1)
            kept[c] = sorted(r["v"] for r in top.collect())
        return cls(cuts, kept)

    @property
    def names(self) -> list[str]:
        return [*self.numbers, *self.texts]

    @property
    def categorical(self) -> np.ndarray:
        return np.array([False] * len(self.numbers) + [True] * len(self.texts))

    def sizes(self) -> list[int]:
        """The number of bins of each feature, that of missing values included."""
        return [*[len(x) + 2 for x in self.numbers.values()], *[len(x) + 1 for x in self.texts.values()]]

    def columns(self) -> list:
        """The features as Spark columns of the two kinds a block holds."""
        return [*[F.col(c).cast("double") for c in self.numbers],
                *[F.col(c).cast("string") for c in self.texts]]

    def bins(self, columns: list) -> np.ndarray:
        """The bins of a block's rows, a column for each feature."""
        out = np.zeros((len(columns[0]) if columns else 0, len(columns)), np.uint8)
        for i, cuts in enumerate(self.numbers.values()):
            x = columns[i].to_numpy(zero_copy_only=False).astype(np.float64)
            known = ~np.isnan(x)
            out[known, i] = 1 + np.searchsorted(np.array(cuts), x[known], side="left")
        for i, kept in enumerate(self.texts.values(), len(self.numbers)):
            place = pc.index_in(columns[i].cast(pa.string()), pa.array(kept, pa.string()))
            out[:, i] = pc.fill_null(pc.add(place, 1), 0).to_numpy(zero_copy_only=False)
        return out


def _between(values: list[float]) -> list[float]:
    """The midpoints of neighbouring values."""
    return [a + (b - a) / 2 for a, b in zip(values, values[1:])]


def bin_matrix(column, width: int) -> np.ndarray:
    """A binary column of `width` bytes a row as a matrix."""
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(chunk):
        return np.zeros((0, width), np.uint8)
    chunk = chunk.cast(pa.binary())
    at = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset]
    data = np.frombuffer(chunk.buffers()[2], np.uint8, len(chunk) * width, at)
    return data.reshape(len(chunk), width)


@dataclass
class Tree:
    """Nodes as arrays: the feature (-1 in a leaf), the bins that go left, both children,
    and what a leaf adds."""

    feature: np.ndarray
    lefts: np.ndarray
    children: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, nodes: list["Node"]) -> "Tree":
        return cls(
            np.array([n.feature for n in nodes], np.int16),
            np.array([n.lefts if n.lefts is not None else np.zeros(BINS, bool) for n in nodes]),
            np.array([n.children or (i, i) for i, n in enumerate(nodes)], np.int32),
            np.array([n.value for n in nodes], np.float64))

    @property
    def leaves(self) -> int:
        return int((self.feature < 0).sum())

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        """The leaf each row ends in."""
        node = np.zeros(len(bins), np.int32)
        rows = np.arange(len(bins))
        while len(rows):
            rows = rows[self.feature[node[rows]] >= 0]
            at = node[rows]
            left = self.lefts[at, bins[rows, self.feature[at]]]
            node[rows] = np.where(left, self.children[at, 0], self.children[at, 1])
        return node

    def members(self, bins: np.ndarray, wanted: list[int]):
        """(node, rows) of every wanted node, for bins by feature; only branches that lead to one
        are walked."""
        needed, own = set(wanted), set(wanted)
        # Children come after their parents.
        for node in range(len(self.feature) - 1, -1, -1):
            if self.feature[node] >= 0 and needed.intersection(self.children[node].tolist()):
                needed.add(node)
        waiting = [(0, slice(None))] if 0 in needed else []
        while waiting:
            node, rows = waiting.pop()
            if node in own:
                yield node, rows
                if self.feature[node] < 0 or not needed.intersection(self.children[node].tolist()):
                    continue
            left = self.lefts[node][bins[self.feature[node]][rows]]
            for child, mask in zip(self.children[node].tolist(), (left, None)):
                if child in needed:
                    mask = ~left if mask is None else mask
                    inside = np.flatnonzero(mask) if node == 0 else rows[mask]
                    waiting.append((child, inside))

    def added(self, bins: np.ndarray) -> np.ndarray:
        """What the tree adds to each row's score."""
        return self.value[self.leaf(bins)]


MASK_BITS = 64


class Forest:
    """Trees scored together: a row's leaf is the one that all its bins leave open.

    For each feature, bin and tree a bit set tells which leaves the tests of that feature
    leave open; the sets of a row's bins are intersected for all trees at once. Trees with
    more leaves than a set has bits are walked.
    """

    def __init__(self, trees: list[Tree], features: int):
        self.trees = trees
        self.narrow = all(t.leaves <= MASK_BITS for t in trees)
        if not self.narrow:
            return
        # Of the sizes of unsigned numbers the smallest that holds the leaves of every tree.
        most = max((t.leaves for t in trees), default=1)
        self.kind = np.uint32 if most <= 32 else np.uint64
        self.open = np.full((features, BINS, len(trees)), np.iinfo(self.kind).max, self.kind)
        self.values = np.zeros((len(trees), MASK_BITS))
        for t, tree in enumerate(trees):
            below: list[int] = [0] * len(tree.feature)
            leaves = np.flatnonzero(tree.feature < 0).tolist()
            for i, leaf in enumerate(leaves):
                below[leaf] = 1 << i
                self.values[t, i] = tree.value[leaf]
            every = (1 << len(leaves)) - 1
            self.open[:, :, t] = every
            # Children come after their parents.
            for node in range(len(tree.feature) - 1, -1, -1):
                f = tree.feature[node]
                if f >= 0:
                    left, right = (below[c] for c in tree.children[node].tolist())
                    below[node] = left | right
                    self.open[f, :, t] &= np.where(
                        tree.lefts[node], self.kind(every & ~right), self.kind(every & ~left))
        self.used = [f for f in range(features) if any((t.feature == f).any() for t in trees)]

    def added(self, bins: np.ndarray, step: int = 512) -> np.ndarray:
        """What all trees add to each row's score, summed in the order of the trees."""
        out = np.zeros(len(bins))
        if not self.narrow:
            for tree in self.trees:
                out += tree.added(bins)
            return out
        if not self.used:
            return out + sum(self.values[:, 0].tolist())
        place = np.arange(len(self.trees))
        for at in range(0, len(bins), step):
            rows = bins[at:at + step]
            left = self.open[self.used[0]][rows[:, self.used[0]]]
            for f in self.used[1:]:
                left &= self.open[f][rows[:, f]]
            # One bit stays, a power of two: its exponent is the leaf.
            leaf = np.frexp(left.astype(np.float64))[1] - 1
            found = self.values[place, leaf]
            for t in range(len(self.trees)):
                out[at:at + step] += found[:, t]
        return out


@dataclass
class Measured:
    """What a pass measured for a split: the sums of one side (0 is left), and what it measured
    ahead for the splits expected of both children."""

    feature: int
    lefts: np.ndarray
    side: int
    sums: np.ndarray
    ahead: tuple["Measured | None", "Measured | None"] = (None, None)

    def fits(self, sums: np.ndarray, split: tuple | None) -> bool:
        """Whether this is the split of a node with the histogram `sums`, to the row, and the
        side measured is the one that is measured."""
        if split is None or split[1] != self.feature or _smaller(sums, split) != self.side:
            return False
        used = sums[self.feature, :, 2] > 0
        return bool((split[2][used] == self.lefts[used]).all())


@dataclass
class Node:
    """A node while its tree grows."""

    sums: np.ndarray
    feature: int = -1
    lefts: np.ndarray | None = None
    children: tuple[int, int] | None = None
    value: float = 0.0
    measured: Measured | None = None


@dataclass
class Growth:
    """Limits of a tree and the penalty on its leaves."""

    leaves: int = 31
    least_rows: int = 100
    penalty: float = 1.0
    rate: float = 0.1


def split_gains(sums: np.ndarray, categorical: np.ndarray, growth: Growth):
    """(gains, orders, lefts) of all splits of a node with the histogram `sums`.

    `sums` has gradient, curvature and rows for (feature, bin). The split (f, d, k) of a
    number sends bins 1 to k left, and missing values too if d is 1. That of a text sends
    the first k + 1 categories left, ordered by gradient over penalised curvature.
    A split that leaves too few rows on a side gains minus infinity.
    """
    features = len(sums)
    orders = np.tile(np.arange(BINS), (features, 1))
    lefts = np.zeros((features, 2, BINS, 3))
    valid = np.zeros((features, 2, BINS), bool)
    for f in range(features):
        if categorical[f]:
            used = np.flatnonzero(sums[f, :, 2])
            slope = sums[f, used, 0] / (sums[f, used, 1] + growth.penalty)
            used = used[np.argsort(slope, kind="stable")]
            orders[f, :len(used)] = used
            lefts[f, 0, :len(used)] = np.cumsum(sums[f, used], axis=0)
            valid[f, 0, :len(used)] = True
        else:
            known = sums[f].copy()
            known[0] = 0.0
            lefts[f, 0] = np.cumsum(known, axis=0)
            lefts[f, 1] = lefts[f, 0] + sums[f, 0]
            # An empty bin would only repeat the split before it.
            valid[f, 0] = known[:, 2] > 0
            valid[f, 1] = valid[f, 0] & (sums[f, 0, 2] > 0)
    total = sums[0].sum(axis=0)
    rights = total - lefts
    valid &= (lefts[..., 2] >= growth.least_rows) & (rights[..., 2] >= growth.least_rows)
    valid &= (lefts[..., 1] >= LEAST_CURVATURE) & (rights[..., 1] >= LEAST_CURVATURE)

    def part(x):
        return x[..., 0] ** 2 / np.maximum(x[..., 1] + growth.penalty, 1e-300)

    gains = np.where(valid, part(lefts) + part(rights) - part(total), -np.inf)
    return gains, orders, lefts


def best_split(sums: np.ndarray, categorical: np.ndarray, growth: Growth):
    """(gain, feature, bins that go left, rows on the left) of the best split, if any gains.

    Bins the node has no rows of go with the larger side.
    """
    if sums[0, :, 2].sum() < 2 * growth.least_rows:
        return None
    gains, orders, lefts = split_gains(sums, categorical, growth)
    f, d, k = np.unravel_index(np.argmax(gains), gains.shape)
    if not gains[f, d, k] > 0:
        return None
    rows = lefts[f, d, k, 2]
    larger_left = rows > sums[f, :, 2].sum() - rows
    if categorical[f]:
        go = np.full(BINS, larger_left)
        used = orders[f, :int((sums[f, :, 2] > 0).sum())]
        go[used] = False
        go[used[:k + 1]] = True
    else:
        go = np.arange(BINS) <= k
        go[0] = d == 1 if sums[f, 0, 2] > 0 else larger_left
    return gains[f, d, k], int(f), go, rows


def _by_gain(nodes: list[Node], splits: list, limit: int) -> set[int]:
    """The nodes that splitting the leaf of greatest gain, `limit` times, takes."""
    taken, waiting = set(), [(-splits[0][0], 0)] if splits[0] else []
    while waiting and len(taken) < limit:
        _, i = heapq.heappop(waiting)
        taken.add(i)
        for child in nodes[i].children or ():
            if splits[child]:
                heapq.heappush(waiting, (-splits[child][0], child))
    return taken


def _smaller(sums: np.ndarray, split: tuple) -> int:
    """The side of a split with fewer rows, which is measured: 0 is left."""
    return 0 if split[3] <= sums[0, :, 2].sum() - split[3] else 1


def expected_left(sums: np.ndarray, feature: int, go: np.ndarray) -> np.ndarray:
    """What the left side's histogram will be like: exact for the feature that is split, for
    the others the node's own, in proportion, with slopes moved to the side's sum."""
    whole, part = sums[feature].sum(axis=0), sums[feature, go].sum(axis=0)
    share = part / np.where(whole == 0, 1.0, whole)
    out = np.empty_like(sums)
    out[..., 1:] = sums[..., 1:] * share[1:]
    shift = (part[0] - whole[0] * share[1]) / part[1] if part[1] else 0.0
    out[..., 0] = sums[..., 0] * share[1] + out[..., 1] * shift
    out[feature] = np.where(go[:, None], sums[feature], 0.0)
    return out


def _planned(nodes: list[Node], splits: list, batch: list[int], categorical: np.ndarray,
             growth: Growth):
    """(tree, opened): the growing tree with the splits of the batch and, some levels ahead,
    those its children are expected to take; the splits as (node, the side to measure)."""
    nodes = [Node(n.sums, n.feature, n.lefts, n.children, measured=n.measured) for n in nodes]
    splits, opened, level = list(splits), [], 0
    while batch:
        for i in batch:
            _, feature, go, _ = splits[i]
            opened.append((i, _smaller(nodes[i].sums, splits[i])))
            nodes[i].feature, nodes[i].lefts = feature, go
            nodes[i].children = (len(nodes), len(nodes) + 1)
            left = expected_left(nodes[i].sums, feature, go)
            nodes += [Node(left), Node(nodes[i].sums - left)]
            splits += [best_split(n.sums, categorical, growth) for n in nodes[-2:]]
        level += 1
        taken = _by_gain(nodes, splits, growth.leaves - 1) if level <= AHEAD else ()
        batch = sorted(i for i in taken if nodes[i].children is None and nodes[i].measured is None)
        batch = batch[:max(0, MOST_NODES - len(opened))]
    return Tree.of(nodes), opened


def grow(root: np.ndarray, measure, categorical: np.ndarray, growth: Growth) -> Tree:
    """A tree grown by best gain to the limit of leaves.

    `measure(tree, wanted)` gives the histograms of some nodes of a growing tree in one pass
    over the rows. Growth is played through on the nodes known so far; all nodes it takes
    whose children are not known yet are split in one pass, until it takes none of these.
    Of two children the one with fewer rows is measured, and the other is what the parent has
    more. A pass also measures, some levels ahead, the splits that the new children are
    expected to take. A node's split is found from its own histogram only, so trees do not
    depend on what was expected: what was measured for another split is dropped.
    """
    nodes = [Node(root)]
    splits = [best_split(root, categorical, growth)]
    while True:
        taken = _by_gain(nodes, splits, growth.leaves - 1)
        batch = sorted(i for i in taken if nodes[i].children is None)
        if not batch:
            break
        if not any(nodes[i].measured for i in batch):
            tree, opened = _planned(nodes, splits, batch, categorical, growth)
            found: dict[int, Measured] = {}
            sums = measure(tree, [int(tree.children[i][side]) for i, side in opened])
            # Children come after their parents.
            for (i, side), own in reversed(list(zip(opened, sums))):
                left, right = (found.get(c) for c in tree.children[i].tolist())
                found[i] = Measured(int(tree.feature[i]), tree.lefts[i], side, own, (left, right))
            for i in found.keys() & set(range(len(nodes))):
                nodes[i].measured = found[i]
        for i in batch:
            known = nodes[i].measured
            if known is None:
                continue
            nodes[i].feature, nodes[i].lefts = splits[i][1:3]
            nodes[i].children = (len(nodes), len(nodes) + 1)
            pair = [known.sums, nodes[i].sums - known.sums]
            for own, ahead in zip(pair[::-1] if known.side else pair, known.ahead):
                split = best_split(own, categorical, growth)
                nodes.append(Node(own, measured=ahead if ahead and ahead.fits(own, split) else None))
                splits.append(split)
            nodes[i].measured = None
    order = [0]
    for i in order:
        if i in taken:
            order.extend(nodes[i].children)
    place = {i: k for k, i in enumerate(order)}
    final = []
    for i in order:
        g, h, _ = nodes[i].sums[0].sum(axis=0)
        if i in taken:
            final.append(Node(nodes[i].sums, nodes[i].feature, nodes[i].lefts,
                              tuple(place[c] for c in nodes[i].children)))
        else:
            final.append(Node(nodes[i].sums, value=-growth.rate * g / (h + growth.penalty)))
    return Tree.of(final)
