"""Vector codes, centroid clusters and text digests against plain versions."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimwright.llm import centroids, text_digest, vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, part string"


def made(n, length, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    points = (rng.normal(size=(n, length)) * spread).astype(np.float32)
    points[n // 2:] = points[n // 2]  # half the rows are equal
    return [(int(i), points[i].tolist(), None if i % 7 == 0 else int(i % 3), "x", None)
            for i in rng.permutation(n)]


def broken(length):
    nan, inf = float("nan"), float("inf")
    return [(900, None, 1, "", ""), (901, [], 1, "", ""), (902, [None] * length, 1, "", ""),
            (903, [nan] + [0.5] * (length - 1), 1, "", ""), (904, [-inf] * length, 1, "", ""),
            (905, [0.5] * (length + 1), 1, "", "")]


def plain_codes(rows, parts, entries, rounds, scale):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[math.floor(scale * x) for x in r[1]] for r in rows]
    width = len(ints[0]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in ints]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def best(part, book):
        far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return min(range(len(book)), key=lambda i: (far[i], i)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(best(v[p], books[p])[0], []).append(v[p])
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for r, v in zip(rows, cut):
        picks = [best(v[p], books[p]) for p in range(parts)]
        out.append((r[0], r[2], bytes(i for i, _ in picks).hex(), sum(d for _, d in picks)))
    totals = {}
    for _, label, _, error in out:
        totals[label] = totals.get(label, 0) + error
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted((-1 if i is None else i, code, error, totals[label], hashlib.sha256(text.encode()).hexdigest())
                  for i, label, code, error in out)


@pytest.mark.parametrize("partitions", [1, 5])
def test_codes_equal_brute_force(spark, partitions):
    rows = made(300, 16)
    rows += [rows[3], rows[3], (rows[5][0], rows[6][1], None, "", ""), (None, rows[7][1], 2, "", "")]
    table = spark.createDataFrame(rows + broken(16), SCHEMA).repartition(partitions)
    found = vector_codes.contract(table)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in found.collect()) == plain_codes(rows, 8, 16, 6, 4096)


def test_codes_of_small_and_empty_tables(spark):
    rows = made(5, 8)
    found = vector_codes.contract(spark.createDataFrame(rows + broken(8), SCHEMA)).collect()
    assert sorted(map(tuple, found)) == plain_codes(rows, 8, 16, 6, 4096)
    assert {r["error"] for r in found} == {0}  # every vector is an entry
    for empty in ([], broken(8)[:5]):
        none = vector_codes.contract(spark.createDataFrame(empty, SCHEMA))
        assert none.count() == 0 and none.columns[-1] == "codebooks_sha256"


def test_codes_are_read_back(spark):
    rows = made(60, 8, seed=3)
    books, coded = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), entries=4, rounds=2)
    ints = {r[0]: [math.floor(4096 * x) for x in r[1]] for r in rows}
    for r in coded.collect():
        near = books.decoded(r["code"])
        assert sum((a - b) ** 2 for a, b in zip(ints[r["vec_id"]], near)) == r["error"]


def test_blocks_keep_every_value(spark):
    rows = spark.createDataFrame(made(50, 8), SCHEMA).select(
        "vec_id", "label", F.expr("transform(embedding, x -> double(x))").alias("v"))
    for block in (7, 8192):
        seen = {}
        for r in vector_codes.coded_blocks(rows, 4096, block).collect():
            columns = [words[codes] for words, codes in
                       vector_codes.opened(r["sizes"], bytes(r["words"]), bytes(r["codes"]))]
            assert len(r["vec_id"]) <= block
            seen.update(zip(r["vec_id"], map(tuple, np.array(columns).T.tolist())))
        assert seen == {r["vec_id"]: tuple(math.floor(4096 * x) for x in r["v"]) for r in rows.collect()}
    with pytest.raises(Exception, match="squared distances leave a long"):
        vector_codes.coded_blocks(rows.withColumn("v", F.expr("transform(v, x -> x + 1e12D)")), 4096).collect()


def plain_clusters(rows, clusters, rounds, scale):
    rows = sorted(rows, key=lambda r: (
        r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    ints = [[math.floor(scale * x) for x in r[1]] for r in rows]
    centres = [list(v) for v in ints[:clusters]]

    def best(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
        return min(range(len(far)), key=lambda i: (far[i], i)), min(far)

    for _ in range(rounds):
        groups = {}
        for v in ints:
            groups.setdefault(best(v)[0], []).append(v)
        for c, members in groups.items():
            centres[c] = [sum(x) // len(members) for x in zip(*members)]
    found = [(r[0], *best(v)) for r, v in zip(rows, ints)]
    total = {}
    for _, c, d in found:
        total[c] = total.get(c, 0) + d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((-1 if i is None else i, c, d, total[c], sum(total.values()), names[c]) for i, c, d in found)


@pytest.mark.parametrize("partitions", [1, 5])
def test_clusters_equal_brute_force(spark, partitions):
    rows = made(300, 64)
    rows += [rows[3], rows[3], (rows[5][0], rows[6][1], None, "", ""), (None, rows[7][1], 2, "", "")]
    table = spark.createDataFrame(rows + broken(64), SCHEMA).repartition(partitions)
    found = centroids.contract(table)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in found.collect()) == plain_clusters(rows, 16, 3, 64)


def test_clusters_of_small_and_empty_tables(spark):
    rows = made(5, 64)
    found = centroids.contract(spark.createDataFrame(rows + broken(64), SCHEMA)).collect()
    assert sorted(map(tuple, found)) == plain_clusters(rows, 16, 3, 64)
    same = [(i, [0.25] * 64, 1, "", "") for i in range(20)]
    found = centroids.contract(spark.createDataFrame(same, SCHEMA)).collect()
    assert {(r["cluster"], r["inertia"]) for r in found} == {(0, 0)}
    for empty in ([], broken(64)):
        assert centroids.contract(spark.createDataFrame(empty, SCHEMA)).count() == 0


def test_bound_rules_out_most_centroids(spark):
    rng = np.random.default_rng(4)
    basis = rng.normal(size=(6, 64))
    centres = np.floor(40 * rng.normal(size=(16, 6)) @ basis).astype(np.int64)
    values = centres[rng.integers(0, 16, 4000)] + rng.integers(-9, 10, (4000, 64))
    rows = spark.createDataFrame([(v.tolist(),) for v in values / 64.0], "v array<double>")
    axes = centroids.principal_axes(rows, 64, 64, 16)
    lead, rest = axes.rotated(values)
    centre = axes.rotated(centres)
    far = ((values[:, None, :] - centres[None]) ** 2).sum(axis=2)
    bound = ((lead[:, None] - centre[0][None]) ** 2).sum(axis=2) + (rest[:, None] - centre[1][None]) ** 2
    assert (bound <= far * (1 + 1e-9) + 1e-6).all()
    cluster, distance, measured = centroids.nearest(values, lead, rest, centres, *centre)
    assert (cluster == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
    assert measured < 1.2 * len(values)  # 16 a vector without the bound


def plain_digests(rows):
    """Digests by plain counting, in the order of the contract."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in ordered]

    def counted(raw):
        counts = [0] * 512
        for a, b, c in zip(raw, raw[1:], raw[2:]):
            h = (a * 2654435761 + b * 2246822519 + c * 3266489917) % (1 << 32)
            h = (h ^ h >> 15) * 2246822519 % (1 << 32)
            counts[h >> 23] += 1
        s = sorted(counts)
        return "".join(str(sum(n > s[i] for i in (127, 255, 383))) for n in counts), raw

    def code(n):
        return 0 if n == 0 else math.floor(4 * n.bit_length() + (n / 2 ** n.bit_length() * 8 - 4))

    def like(a, b):
        apart = sum(x != y for x, y in zip(a[0], b[0]))
        return 1 - (apart + 8 * min(16, abs(code(len(a[1])) - code(len(b[1]))))) / 640

    out = []
    for i, (doc, _) in enumerate(ordered):
        t, after = texts[i], texts[(i + 1) % len(texts)]
        edited = t[:len(t) - len(t) // 3] + after[:len(t) // 3]
        own, changed, following = (counted(x.encode()) for x in (t, edited, after))
        hexed = [f"{code(len(x[1])):02x}" + "".join(
            f"{int(x[0][k:k + 4], 4):02x}" for k in range(0, 512, 4)) for x in (own, changed)]
        out.append((doc, len(t), hashlib.sha256(edited.encode()).hexdigest(), *hexed,
                    round(like(own, changed), 9), round(like(own, following), 9)))
    return sorted(out, key=str)


def digests(table):
    found = text_digest.contract(table)
    return sorted(((*r[:-2], round(r[-2], 9), round(r[-1], 9)) for r in found.collect()), key=str)


@pytest.mark.parametrize("partitions", [1, 7, 211])
def test_digests_equal_brute_force(spark, partitions):
    rows = [(i, f"text {i} héllo wörld 日本 " * (i % 9)) for i in range(40)]
    rows += [(100, ""), (101, None), (102, "a"), (103, "ab"), (104, "日本語"), (105, "x" * 300_000),
             (None, "no id"), (106, "long words " * 20_000), (-5, "\x00 \U0001f600 \n")]
    table = spark.createDataFrame(
        [(t, i, "edge", 3) for i, t in rows], "text string, doc_id bigint, edge string, part int")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = digests(table.repartition(3))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == plain_digests(rows)


def test_digests_of_repeated_single_and_no_rows(spark):
    same = [(1, "one text of some words")] * 3 + [(0, "another text here")]
    found = digests(spark.createDataFrame(same, "doc_id bigint, text string"))
    assert found == plain_digests(same) and len(found) == 4
    one = [(1, "alone in the table")]
    found = digests(spark.createDataFrame(one, "doc_id bigint, text string"))
    assert found == plain_digests(one) and found[0][-1] == 1.0
    assert text_digest.contract(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    ties = [(7, "a b c"), (7, "d e f g"), (7, None)]
    found = digests(spark.createDataFrame(ties, "doc_id bigint, text string"))
    assert found == digests(spark.createDataFrame(ties[::-1], "doc_id bigint, text string"))


def test_digests_tell_edited_texts_from_others(spark, folder):
    found = text_digest.contract(spark.read.parquet(f"{folder}/documents.parquet")).filter("n_chars > 60")
    nearer = found.agg(F.avg((F.col("near_edited") > F.col("near_next")).cast("int"))).first()[0]
    assert nearer > 0.98


def test_digest_text_is_read_back():
    for text in ("", "ab", "some longer text " * 40, "日本"):
        found = text_digest.digest(text)
        again = text_digest.read(text_digest.written(found))
        assert (found[0] == again[0]).all() and found[1] == again[1]
        assert text_digest.likeness(found, again) == 1.0
    far = text_digest.likeness(text_digest.digest("a" * 9), text_digest.digest("zyx w" * 99_999))
    assert 0.0 <= far < 1.0
