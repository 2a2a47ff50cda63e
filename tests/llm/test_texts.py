"""Toxicity, decontamination, SimHash, secret scan and language model against brute force."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
import xxhash

from claimwright.llm import (
    decontamination, lm_scoring, secret_scan, simhash, toxicity)
from claimwright.llm.common import words_of
from claimwright.llm.fm_index import FMIndex, suffix_array

DOC = "doc_id bigint, text string, score double, spans string, _row int"
AWKWARD = [
    (1, None, 0.5, "a", 1), (2, "", None, None, None), (None, "no id here at all", 1.0, "x", 2),
    (3, "word " * 60_000, 0.1, "b", 3), (4, "same text twice", 0.1, "c", 4),
    (4, "same text twice", 0.1, "c", 4), (5, "   \n\t ", 0.2, "d", 5),
]


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOC)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOC)


def test_toxicity_learns_and_keeps_columns(spark, awkward, nothing):
    rows = [(i, f"a b{i % 7} {'vile' if i % 3 == 0 else 'kind'} c", 0.0, "", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, DOC)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    found = {r.doc_id: r for r in toxicity.contract(docs, labels).collect()}
    assert all(found[i].predicted == (i % 3 == 0) for i in range(300))
    assert {i for i in found if found[i].held_out} == {
        i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert toxicity.without_toxic(docs, labels).count() == 200
    kept = toxicity.without_toxic(awkward, labels)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD)
    assert toxicity.contract(nothing, labels).count() == 0
    assert toxicity.contract(awkward, labels.limit(0)).filter("predicted = 1").count() == 0


def brute_leaks(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words_of((text or "").encode())
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i:i + n])].add(str(item))
    out = []
    for doc, text in docs:
        w = words_of((text or "").encode())
        hit, names = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    names |= windows[tuple(w[i:i + n])]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(names), digest, bool(hit)))
    return out


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_decontamination_equals_brute_force(spark, awkward, nothing, block_words, monkeypatch):
    rng = np.random.default_rng(3)
    item = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 6, n))
    items = [(i, item(int(rng.integers(0, 30)))) for i in range(12)] + [(50, None), (51, "Only, three words")]
    docs = [(i, item(200) + " " + items[i % 12][1] + " ONLY three. words " + item(5)) for i in range(30)]
    docs += [(90, None), (91, "")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    real = decontamination.find_leaks
    monkeypatch.setattr(decontamination, "find_leaks", lambda *a, **k: real(*a, **{
        **k, "block_words": block_words}))
    found = sorted(map(tuple, decontamination.contract(spark, d, b).collect()))
    assert found == brute_leaks(docs, items)
    clean = decontamination.remove_leaks(d, b)
    left = real(clean, b.filter("item_id = 51"))
    assert left.filter("size(spans) > 0").count() == 0
    assert {r.doc_id for r in clean.collect()} >= {90, 91}
    assert decontamination.remove_leaks(awkward, b).columns == awkward.columns
    assert decontamination.contract(spark, nothing, b).count() == 0
    assert decontamination.contract(spark, d, b.limit(0)).filter("contaminated").count() == 0


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 4, 600)
    text[-1] = 0
    separators = np.flatnonzero(text == 0)
    told = text + len(separators)
    told[separators] = np.arange(len(separators))
    order = suffix_array(told).tolist()
    assert order == sorted(range(600), key=lambda i: told[i:].tolist())
    index = FMIndex(text, 3)
    for length in (1, 2, 4):
        phrases = rng.integers(1, 4, (20, length))
        low, high = index.search(phrases)
        for phrase, a, b in zip(phrases, low, high):
            want = [i for i in range(600 - length + 1) if (text[i:i + length] == phrase).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def brute_fingerprint(text, k=4):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_equals_brute_force(spark, awkward, nothing):
    rng = np.random.default_rng(5)
    base = [[f"w{x}" for x in rng.integers(0, 500, 60)] for _ in range(12)]
    texts = []
    for i in range(160):
        w = list(base[i % 12])
        for _ in range(int(rng.integers(0, 4))):
            w[int(rng.integers(0, 60))] = f"n{i}"
        texts.append(" ".join(w))
    rows = [(i, t) for i, t in enumerate(texts)] + [(200, None), (201, ""), (202, "a b"), (202, "a b")]
    found = simhash.contract(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = sorted((d, f"{p:016x}", rows[root(i)][0]) for i, ((d, _), p) in enumerate(zip(rows, prints)))
    assert sorted(map(tuple, found)) == want
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({w[2] for w in want})
    once = simhash.one_of_each(awkward)
    assert once.columns == awkward.columns
    # The empty texts are one group, the repeated row another.
    assert sorted(r.doc_id or -1 for r in once.collect()) == [-1, 1, 3, 4]
    assert simhash.contract(nothing).count() == 0


def test_secret_scan_base_and_lexed_spans(spark, awkward, nothing):
    rows = [
        (1, 'é password = "abcdef" API-KEY x'), (2, "AKIA" + "Q" * 16 + " " + "0a" * 12 + " token=abc"),
        (3, 'a = "hunter22X9"\nclient_pwd = a\n'), (4, None), (5, "apikey:password=abcdefg"),
        (6, "a clean text: it says token of love"), (7, "<privateKey>ab12CD34ef</privateKey>"),
    ]
    found = {r.doc_id: r for r in secret_scan.contract(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[1].spans == "assign:2:20"
    assert found[1].base_sha256 == hashlib.sha256(b"assign:2:20").hexdigest()
    assert found[2].spans == "access:0:20,hex:21:45" and found[2].n_assign == 0
    assert found[3].spans == "literal:5:15" and found[3].n_assign == 0
    assert found[4].spans == found[6].spans == ""
    assert found[5].n_assign == 1
    assert found[7].spans == "literal:12:22"
    masked = {r.doc_id: r.text for r in secret_scan.without_secrets(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert masked[3] == 'a = "[literal]"\nclient_pwd = a\n' and masked[6] == rows[5][1]
    assert secret_scan.without_secrets(awkward).columns == awkward.columns
    assert secret_scan.without_secrets(awkward).count() == len(AWKWARD)
    assert secret_scan.contract(nothing).count() == 0


def test_secret_with_punctuation_is_masked_whole(spark):
    rows = [(1, 'password = "hunter22!Secret$99" then'), (2, "token: 'abcdef12' x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in secret_scan.contract(docs).collect()}
    assert found == {1: "assign:0:20,literal:12:30", 2: "assign:0:16"}
    masked = {r.doc_id: r.text for r in secret_scan.without_secrets(docs).collect()}
    assert masked == {1: '[assign][literal]" then', 2: "[assign]' x"}


def test_quotes_and_apostrophes_hide_nothing():
    for text, secret in [
            ("it's here: client_pwd = hunter22X9 and it's not", "hunter22X9"),
            ("don't worry, passphrase: ab12CD34ef isn't set", "ab12CD34ef"),
            ('say "hi: client_pwd = hunter22X9 "', "hunter22X9"),
            ('db_pwd = """hunter22X9"""', "hunter22X9"),
            ("db_pwd = '''hunter\n22X9''' # two lines", "hunter\n22X9"),
            ('{"client_pwd": "hunter22X9", "b": 1}', "hunter22X9"),
            ('["client_pwd = hunter22X9"]', "hunter22X9"),
            ("cmd = --db-pwd=hunter22X9", "hunter22X9"),
            ("run --db-pwd hunter22X9 now", "hunter22X9"),
            ('client_pwd = "hunter22X9', "hunter22X9"),
            ("client_pwd = ab=12XY==", "ab=12XY=="),
            ('b_name = "a \\" hunter"; x_pwd = "hunter22X9"', "hunter22X9"),
            ("a = b = hunter22X9; client_pwd = b", "hunter22X9")]:
        found = [text[s:e] for s, _, e in secret_scan.lexed_spans(text)]
        assert found == [secret], (text, found)
    for clean in ("it's what they said: the pass over the hills isn't open", "the key: don't",
                  'he said "password" and "token"', "auth: see the notes; key = value"):
        assert secret_scan.lexed_spans(clean) == []


@pytest.mark.parametrize("unit", [
    '\\"', '"', "'", '="', 'pwd="', "a=b=", "pwd=", '"""', "pwd='''", "['", '{"a', "--pwd ", "<pwd>",
    "x!", "pwd:`"])
def test_long_lines_take_linear_time(unit):
    import time

    for lead in ("", 'token="', "pwd = "):
        text = lead + unit * (400_000 // len(unit))
        started = time.process_time()
        secret_scan.scan(text, text.encode())
        assert time.process_time() - started < 12
    text = "a = " + "Xy1" * 70_000 + "\n" + "pwd = a\n" * 20_000
    started = time.process_time()
    assert len(secret_scan.lexed_spans(text)) == 1
    assert time.process_time() - started < 12


def test_base_spans_are_the_plain_patterns(spark):
    """Over all documents: every kind found by its pattern alone, in a loop of its own."""
    import re

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in secret_scan.scan_secrets(docs).collect()}
    masked = {r.doc_id: r.text for r in secret_scan.without_secrets(docs).collect()}
    assign = re.compile(
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    seen = 0
    for r in docs.collect():
        text = r.text or ""
        plain = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        plain += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        plain += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        plain.sort()
        names = ("assign", "access", "hex")
        assert found[r.doc_id].base == ",".join(f"{names[k]}:{s}:{e}" for s, k, e in plain)
        for s, k, e in plain:
            seen += 1
            assert text[s:e] not in masked[r.doc_id]
    assert seen > 10


def test_lexer_reads_on_after_comment_marks(spark):
    rows = [
        (1, 'see http://host/x client_pwd = "hunter22X9"'), (2, "color: #fff; private_key: ab12CD34ef"),
        (3, "# client_pwd = hunter22X9\nx = 1"), (4, "// passphrase: 'ab12CD34ef'"),
        (5, "client_pwd = # hunter22X9"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in secret_scan.contract(docs).collect()}
    assert found == {1: "literal:32:42", 2: "literal:26:36", 3: "literal:15:25", 4: "literal:16:26", 5: ""}
    masked = {r.doc_id: r.text for r in secret_scan.without_secrets(docs).collect()}
    assert masked[1] == 'see http://host/x client_pwd = "[literal]"'
    assert masked[3] == "# client_pwd = [literal]\nx = 1"


def test_language_model_counts_and_probabilities(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(lm_scoring.Vocabulary.__init__, "__defaults__", (20,))
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{x}" for x in rng.zipf(1.6, 40) % 90)) for i in range(120)]
    rows += [(500, None), (501, "Never SEEN words"), (501, "Never SEEN words")]
    out = lm_scoring.score_texts(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    texts = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in rows]
    train = [w for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1 for w in t]
    c, n = collections.Counter(train), len(train)
    want = sorted((i, zlib.crc32(str(i).encode()) % 5 == 1, len(t), sum(c[w] > 0 for w in t), n)
                  for i, t in texts)
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in out) == want
    base = {i: sum(math.log10((c[w] + 0.5) / (n + 0.5 * (len(c) + 1))) for w in t) for i, t in texts}
    assert all(abs(r.base_score - base[r.doc_id]) < 1e-6 for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 500]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm_scoring.score_texts(awkward).count() == len(AWKWARD)
    assert lm_scoring.score_texts(nothing).count() == 0


def test_language_model_is_normalised():
    noise = np.full(lm_scoring.CLASSES, 1.0 / lm_scoring.CLASSES)
    table = lm_scoring.Model(noise).log_table()
    assert np.allclose((10.0 ** table.astype(float)).sum(axis=1), 1.0, atol=1e-4)
