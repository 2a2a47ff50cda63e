"""Grown trees, gains and boosting against plain versions of the same rules."""

import time
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimwright.operators import boosting, trees
from claimwright.operators.trees import BINS, Binner, Growth, Tree

N = 900


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, N).astype(float)
    z = rng.normal(size=N)
    t = rng.choice(list("abcde"), N, p=[0.5, 0.2, 0.15, 0.1, 0.05])
    w = rng.uniform(0.3, 1.0, N)
    eta = 0.2 * x + np.where(t == "c", 1.0, 0.0) + 0.5 * z - 1.5
    n = rng.poisson(np.exp(eta) * w)
    rows = [(i, None if i % 9 == 0 else x[i].item(), float("nan") if i % 11 == 0 else z[i].item(),
             None if i % 13 == 0 else str(t[i]), w[i].item(), (n[i] / w[i]).item()) for i in range(N)]
    return spark.createDataFrame(
        rows, "IDpol long, x double, z double, t string, w double, y double").repartition(
            3, "IDpol").cache()


SETTINGS = replace(boosting.FREQUENCY_SETTINGS, leaves=6, least_rows=25, rounds=3, rate=0.5)


def local(binner, df):
    frame = df.orderBy("IDpol").toPandas()
    columns = [pa.array(frame[c], from_pandas=True) for c in binner.names]
    return frame, binner.bins(columns)


def test_bins(spark, data):
    binner = Binner.fit(data, ["x", "z"], ["t"])
    assert binner.numbers["x"] == [i + 0.5 for i in range(11)]
    assert len(binner.numbers["z"]) == trees.CUTS and binner.texts["t"] == list("abcde")
    frame, bins = local(binner, data)
    known = frame["x"].notna()
    assert (bins[known, 0] == frame["x"][known] + 1).all() and (bins[~known, 0] == 0).all()
    assert (bins[frame["z"].isna(), 1] == 0).all() and bins[:, 1].max() == 255
    counts = np.bincount(bins[:, 1], minlength=256)[1:]
    assert counts.max() <= 3 * (frame["z"].notna().sum() / 255)
    assert (bins[frame["t"].isna(), 2] == 0).all()
    odd = binner.bins([pa.array([99.0, -99.0]), pa.array([None, 0.0]), pa.array(["?", "a"])])
    assert odd[:, 0].tolist() == [12, 1] and odd[:, 2].tolist() == [0, 1]


def test_only_frequent_categories_have_bins(spark):
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, 'z', concat('c', id % 700)) AS t")
    binner = Binner.fit(df, [], ["t"])
    assert len(binner.texts["t"]) == 255 and "z" in binner.texts["t"]


def best_plain(bins, g, h, rows, categorical, s):
    """Best (gain, mask) over every split of the rows, by trying all."""
    best = (0.0, None, None)
    G, H = g[rows].sum(), h[rows].sum()

    def score(a, b):
        return a * a / (b + s.penalty)

    for f in range(bins.shape[1]):
        own = bins[rows, f]
        used = sorted(set(own.tolist()))
        masks = []
        if categorical[f]:
            used.sort(key=lambda b: g[rows][own == b].sum() / (h[rows][own == b].sum() + s.penalty))
            masks = [np.isin(own, used[:k + 1]) for k in range(len(used))]
        else:
            values = [b for b in used if b]
            masks = [(own <= b) & (own > 0) for b in values]
            if 0 in used:
                masks += [own <= b for b in values]
        for left in masks:
            if left.sum() < s.least_rows or (~left).sum() < s.least_rows:
                continue
            a, b = g[rows][left].sum(), h[rows][left].sum()
            gain = score(a, b) + score(G - a, H - b) - score(G, H)
            if gain > best[0] + 1e-9:
                best = (gain, left, f)
    return best


def grown_plain(bins, g, h, categorical, s):
    """Leaves as row sets, by splitting the leaf of the largest gain again and again."""
    leaves = [np.arange(len(bins))]
    while len(leaves) < s.leaves:
        found = [best_plain(bins, g, h, rows, categorical, s) for rows in leaves]
        at = max(range(len(leaves)), key=lambda i: found[i][0])
        if found[at][1] is None:
            break
        rows = leaves.pop(at)
        leaves += [rows[found[at][1]], rows[~found[at][1]]]
    return leaves


def test_boosting_equals_plain_boosting(spark, data, tmp_path):
    model = boosting.fit_boosting(data, "y", "w", ["x", "z"], ["t"], SETTINGS)
    frame, bins = local(model.binner, data)
    held = np.array([r[0] for r in data.orderBy("IDpol").select(boosting.held_out()).collect()])
    y, w = frame["y"].to_numpy(), frame["w"].to_numpy()
    fit = ~held
    assert 40 < held.sum() < 150
    eta = np.full(N, np.log((y * w)[fit].sum() / w[fit].sum()))
    for tree in model.trees:
        g, h = boosting.derivatives("poisson", y, w, eta)
        leaves = grown_plain(bins[fit], g[fit], h[fit], [False, False, True], SETTINGS)
        own = tree.leaf(bins[fit])
        assert sorted(sorted(np.flatnonzero(own == n).tolist()) for n in set(own.tolist())) == \
            sorted(rows.tolist() for rows in leaves)
        for rows in leaves:
            value = -0.5 * g[fit][rows].sum() / (h[fit][rows].sum() + 1.0)
            assert tree.value[own[rows[0]]] == pytest.approx(value)
        eta = eta + tree.added(bins)
    assert len(model.trees) == 3 and model.trees[0].leaves == 6
    assert model.history[2] < model.history[0]
    scored = {r.IDpol: r.p for r in model.score(data, "p").collect()}
    assert [scored[i] for i in range(N)] == pytest.approx(np.exp(eta).tolist())
    model.save(str(tmp_path / "m"))
    again = boosting.BoostedTrees.load(spark, str(tmp_path / "m"))
    assert {r.IDpol: r.p for r in again.score(data, "p").collect()} == scored


def test_subtracted_histograms_equal_measured_ones(data):
    binner, _, rows = boosting.start_rows(data, "y", "w", ["x", "z"], ["t"], "poisson", "IDpol")
    mask = np.arange(BINS) <= 6
    tree = Tree(np.array([0, -1, -1]), np.array([mask, mask, mask]),
                np.array([(1, 2), (1, 1), (2, 2)]), np.zeros(3))
    both, _ = boosting.histograms(rows, "poisson", tree, [1, 2], 3)
    root, held = boosting.histograms(rows, "poisson", boosting.ROOT, [0], 3)
    assert np.allclose(root[0] - both[0], both[1]) and held[1] > 0
    assert both[..., 2].sum() == 3 * rows.filter("NOT _held").count()


def test_unseen_bins_go_with_the_larger_side():
    sums = np.zeros((2, BINS, 3))
    sums[0, 1:5] = [(-5, 2, 30), (-4, 2, 30), (6, 2, 20), (3, 2, 20)]
    sums[1, [3, 9]] = [(-9, 4, 60), (9, 4, 40)]
    _, f, go, rows = trees.best_split(sums, np.array([False, True]), Growth(least_rows=10))
    assert (f, rows) == (0, 60) and go[[0, 1, 2]].all() and not go[[3, 4, 200]].any()
    sums[0] = 0
    sums[0, 1] = (0, 8, 100)
    _, f, go, _ = trees.best_split(sums, np.array([False, True]), Growth(least_rows=10))
    assert f == 1 and go[[0, 3, 77]].all() and not go[9]
    assert trees.best_split(sums, np.array([False, True]), Growth(least_rows=51)) is None


def test_many_trees_plan_as_fast_as_few(spark, data):
    model = boosting.fit_boosting(data, "y", "w", ["x", "z"], ["t"], replace(SETTINGS, rounds=2))

    def planning(count):
        many = replace(model, trees=model.trees[:1] * count)
        times = []
        for _ in range(5):
            started = time.perf_counter()
            many.score(data)._jdf.queryExecution().executedPlan()
            times.append(time.perf_counter() - started)
        return min(times)

    planning(1)
    assert planning(240) < 1.5 * planning(20) + 0.05
    plan = replace(model, trees=model.trees * 120).score(data)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_a_table_nothing_splits(spark):
    df = spark.range(200).selectExpr(
        "id AS IDpol", "1D AS x", "CAST(NULL AS STRING) AS t", "CAST(id % 2 AS DOUBLE) AS y")
    model = boosting.fit_boosting(df, "y", None, ["x"], ["t"], boosting.OCCURRENCE_SETTINGS)
    assert [t.leaves for t in model.trees] == [1]
    assert {round(r.prediction, 1) for r in model.score(df).collect()} == {0.5}
    gains = boosting.first_split_gains(df, "y", None, ["x"], ["t"], boosting.OCCURRENCE_SETTINGS)
    assert gains.count() == 0 and gains.columns[0] == "Feature"


def test_gains_table(data):
    table = boosting.first_split_gains(data, "y", "w", ["x"], ["t"], SETTINGS)
    assert table.filter("Feature = 'x' AND Cut IS NULL AND NOT MissingLeft").count() == 1
    assert table.filter("Feature = 'x' AND MissingLeft").count() > 5
    assert table.filter("Feature = 't'").count() >= 3
    best = table.orderBy(F.desc("Gain")).first()
    model = boosting.fit_boosting(data, "y", "w", ["x"], ["t"], replace(SETTINGS, rounds=1))
    assert model.binner.names[model.trees[0].feature[0]] == best.Feature


def test_a_pass_takes_few_tasks_whatever_the_shuffle_setting(spark, data):
    """A boosting run has thousands of passes; each may start few tasks only."""
    binner, _, rows = boosting.start_rows(data, "y", "w", ["x", "z"], ["t"], "poisson", "IDpol")
    context, key = spark.sparkContext, "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    context.setJobGroup("one-pass", "one pass")
    try:
        boosting.histograms(rows, "poisson", boosting.ROOT, [0], 3)
    finally:
        spark.conf.set(key, before)
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("one-pass")
              for s in tracker.getJobInfo(job).stageIds]
    assert sum(s.numTasks for s in stages if s) <= 2 * boosting.REDUCERS


def test_a_pass_has_no_more_tasks_than_cores(spark, data, monkeypatch):
    """What the tasks of a pass report to the driver may not grow with the rows."""
    monkeypatch.setattr(boosting, "TASK_ROWS", 10)
    wanted = {"spark.sql.shuffle.partitions": "24", "spark.sql.files.maxPartitionBytes": "2000",
              "spark.sql.files.openCostInBytes": "2000"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        _, _, rows = boosting.start_rows(data, "y", "w", ["x", "z"], ["t"], "poisson", "IDpol")
        kept = boosting.blocks(rows, 3)
        assert kept.getNumPartitions() <= spark.sparkContext.defaultParallelism
        assert kept.map(lambda block: len(block[1])).sum() == N
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def grown(bins, g, h, growth):
    """(tree, passes) grown over rows in one block."""
    passes = []

    def histogram(rows):
        out = np.zeros((len(bins), BINS, 3))
        for f, own in enumerate(bins):
            for c, x in enumerate((g, h, np.ones(len(g)))):
                out[f, :, c] = np.bincount(own[rows], x[rows], BINS)
        return out

    def measure(tree, wanted):
        found = dict(tree.members(bins, wanted))
        passes.append(len(wanted))
        return np.array([histogram(found[node]) for node in wanted])

    categorical = np.array([False] * (len(bins) - 1) + [True])
    return trees.grow(histogram(slice(None)), measure, categorical, growth), passes


@pytest.mark.parametrize("seed", range(6))
def test_splits_measured_ahead_leave_the_tree_as_it_is(monkeypatch, seed):
    """Few passes where children split as expected, and the same tree in any case."""
    rng = np.random.default_rng(seed)
    bins = np.stack([rng.integers(1, 100, 6000), rng.integers(0, 30, 6000),
                     rng.integers(0, 9, 6000)]).astype(np.uint8)
    y = np.exp(bins[0] / 20) + (seed % 2) * rng.normal(size=6000) * bins[1]
    growth = Growth(leaves=12, least_rows=20 + seed)
    curvature = rng.uniform(0.5, 1.0, 6000)
    tree, passes = grown(bins, 1.0 - y, curvature, growth)
    depth = [0] * len(tree.feature)
    for node in np.flatnonzero(tree.feature >= 0).tolist():
        for child in tree.children[node].tolist():
            depth[child] = depth[node] + 1
    if seed % 2 == 0:
        assert len(passes) < max(depth)
    assert tree.leaves == 12 and max(passes) <= trees.MOST_NODES
    monkeypatch.setattr(trees, "AHEAD", 0)
    plain, more = grown(bins, 1.0 - y, curvature, growth)
    assert len(passes) <= len(more)
    for name in ("feature", "lefts", "children", "value"):
        assert (getattr(tree, name) == getattr(plain, name)).all()


def test_sums_go_to_the_driver_without_empty_bins():
    sums = np.zeros((3, 500))
    sums[:, 7], sums[:, 499] = (-1.5, 0.25, 3), (2.0, 0.5, 70_000)
    narrow = boosting._narrow(sums)
    assert (boosting._wide(narrow, 500) == sums).all() and sum(x.nbytes for x in narrow) < 120
    assert (boosting._wide(boosting._narrow(np.zeros((3, 9))), 9) == 0).all()
    assert boosting._narrow(np.array([1.0, 2.0])).tolist() == [1.0, 2.0]


def test_members_of_a_node_and_of_a_child_of_it():
    bins = np.arange(40, dtype=np.uint8)[None]
    low, half = np.arange(BINS) < 20, np.arange(BINS) < 10
    tree = Tree(np.array([0, 0, -1, -1, -1]), np.array([low, half, low, low, low]),
                np.array([(1, 2), (3, 4), (2, 2), (3, 3), (4, 4)]), np.zeros(5))
    found = {node: rows.tolist() for node, rows in tree.members(bins, [1, 4])}
    assert found == {1: list(range(20)), 4: list(range(10, 20))}


def test_members_are_the_rows_of_the_leaves():
    """Walking the branches of some leaves finds the rows that end in them."""
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 20, (500, 2)).astype(np.uint8)
    low, odd = np.arange(BINS) <= 9, np.arange(BINS) % 2 == 1
    tree = Tree(np.array([0, 1, -1, -1, -1]), np.array([low, odd, low, low, low]),
                np.array([(1, 2), (3, 4), (2, 2), (3, 3), (4, 4)]), np.array([0, 0, 1.0, 2.0, 3.0]))
    leaf, by_feature = tree.leaf(bins), np.ascontiguousarray(bins.T)
    for wanted in ([2, 3, 4], [4], [2]):
        found = dict(tree.members(by_feature, wanted))
        assert {n: r.tolist() for n, r in found.items()} == {
            n: np.flatnonzero(leaf == n).tolist() for n in wanted}
    block = (by_feature, None, None, np.ones(500), 400)
    assert boosting.advanced(block, tree)[3].tolist() == (1 + tree.added(bins)).tolist()


@pytest.mark.parametrize("leaves", [1, 5, 31, 32, 33, 64, 70])
def test_trees_scored_together_add_the_same(leaves):
    rng = np.random.default_rng(leaves)

    def tree():
        nodes, open_ = [trees.Node(np.empty(0), value=rng.normal())], [0]
        while len(open_) < leaves:
            node = nodes[open_.pop(rng.integers(len(open_)))]
            node.feature, node.lefts = int(rng.integers(4)), rng.random(BINS) < 0.5
            node.children = (len(nodes), len(nodes) + 1)
            open_ += node.children
            nodes.extend(trees.Node(np.empty(0), value=rng.normal()) for _ in range(2))
        return Tree.of(nodes)

    several = [tree() for _ in range(9)] + [Tree.of([trees.Node(np.empty(0), value=0.25)])]
    bins = rng.integers(0, BINS, (1_300, 4)).astype(np.uint8)
    walked = np.zeros(len(bins))
    for one in several:
        walked += one.added(bins)
    # Equal to the last bit, as the values are added in the same order.
    assert (trees.Forest(several, 4).added(bins) == walked).all()
    assert trees.Forest(several, 4).added(bins[:0]).shape == (0,)
