"""Tool calls, pages and neighbours; the SQL checks; the pipeline."""

import json
import pickle

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from claimwright.llm import chat_tools, html_text, lm_scoring, neighbours
from claimwright.llm.queries import ORACLE, QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, folder, name):
    found = QUERIES[name](spark, folder)
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = connection.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    rows = [tuple(r[names.index(c)] for c in found.columns) for r in result.fetchall()]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(rows, key=key)


def test_tool_calls_wait_for_what_they_need(spark):
    rows = [
        (1, 1, "assistant", '{"tool_calls":[{"id":"a","name":"t","arguments":{"q":"z","n":1}},'
                            '{"id":"b","name":"t","arguments":"{\\"q\\":1}","after":"a"}]}'),
        (1, 2, "tool", '{"tool_call_id":"b","content":{"y":2,"x":1.5}}'),
        (1, 3, "tool", '{"tool_call_id":"a","content":"ok"}'),
        (1, 4, "tool", '{"tool_call_id":"zz"}'),
        (1, 5, "assistant", '{"tool_calls":[{"id":"a","name":"u","arguments":{}},'
                            '{"id":"l1","name":"t","after":"l2"},{"id":"l2","name":"t","after":"l1"}]}'),
        (None, None, None, None), (2, 0, "assistant", "{broken"), (2, 0, "assistant", "{broken"),
    ]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    schemas = spark.createDataFrame(
        [("t", "q", "string", True), ("t", "n", "number", False)],
        "name string, param string, type string, required boolean")
    out = chat_tools.link_tool_calls(messages, schemas).orderBy("conv_id", "position").collect()
    one = [(r.kind, r.call_id, r.status, r.errors) for r in out if r.conv_id == 1]
    assert one == [
        ("call", "a", "linked", ""), ("result", "a", "linked", ""),
        ("call", "b", "linked", "wrong type q"), ("result", "b", "linked", ""),
        ("result", "zz", "orphan", ""), ("call", "a", "duplicate", "no schema"),
        ("call", "l1", "loop", "no object"), ("call", "l2", "loop", "no object")]
    assert [r.line for r in out if r.call_id == "b"] == [
        '{"arguments":{"q":1},"id":"b","name":"t","role":"assistant"}',
        '{"content":{"x":1.5,"y":2},"id":"b","role":"tool"}']
    assert [r.position for r in out if r.conv_id == 2] == [0, 1]
    assert chat_tools.link_tool_calls(messages.limit(0), schemas).count() == 0


def test_long_chain_of_calls_is_in_order(spark):
    text = '{{"tool_calls":[{{"id":"{0}","name":"t","arguments":{{}},"after":"{1}"}}]}}'
    rows = [(7, 300 - i, "assistant", text.format(i, i - 1)) for i in range(300)]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    schemas = spark.createDataFrame([], "name string, param string, type string, required boolean")
    out = chat_tools.link_tool_calls(messages, schemas).orderBy("position").collect()
    assert [r.call_id for r in out] == [str(i) for i in range(300)]


def linked(spark, rows):
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    schemas = spark.createDataFrame([], "name string, param string, type string, required boolean")
    return chat_tools.link_tool_calls(messages, schemas).orderBy("conv_id", "position").collect()


def test_content_beside_calls_and_empty_calls_are_kept(spark):
    out = linked(spark, [
        (1, 0, "assistant", '{"content":"let me see","tool_calls":[{"id":"a","name":"t","arguments":{}}]}'),
        (1, 1, "tool", '{"tool_call_id":"a","content":"ok"}'),
        (1, 2, "assistant", '{"tool_calls":[],"content":[{"b":1,"a":2}]}'),
        (1, 3, "assistant", '{"tool_calls":[]}'), (1, 4, "assistant", '{"tool_calls":null,"content":"x"}'),
        (1, 5, "assistant", '{"tool_calls":[{"id":"b","name":"t","arguments":{}}],"content":null}')])
    assert [(r.kind, r.turn, r.line) for r in out] == [
        ("message", 0, '{"content":"let me see","role":"assistant"}'),
        ("call", 0, '{"arguments":{},"id":"a","name":"t","role":"assistant"}'),
        ("result", 1, '{"content":"ok","id":"a","role":"tool"}'),
        ("message", 2, '{"content":[{"a":2,"b":1}],"role":"assistant"}'),
        ("message", 3, '{"content":"{\\"tool_calls\\":[]}","role":"assistant"}'),
        ("message", 4, '{"content":"{\\"tool_calls\\":null,\\"content\\":\\"x\\"}","role":"assistant"}'),
        ("call", 5, '{"arguments":{},"id":"b","name":"t","role":"assistant"}')]


def test_calls_wait_for_every_call_they_name(spark):
    def said(turn, id, after=None):
        return (1, turn, "assistant", json.dumps({"tool_calls": [
            {"id": id, "name": "t", "arguments": {}, **({} if after is None else {"after": after})}]}))

    # Two levels of joins, chains between and behind them, and a loop through a join.
    rows = [said(0, "z", ["y"]), said(1, "y", ["x", "c"]), said(2, "x", "w"), said(3, "w", ["b", "a", "b"]),
            said(4, "c", "a"), said(5, "b"), said(6, "a", []),
            said(7, "p", ["q", "a"]), said(8, "q", "p"), said(9, "r", ["a", "gone"]), said(10, "s", ["p", "b"]),
            (1, 11, "tool", '{"tool_call_id":"a","content":1}')]
    out = linked(spark, rows)
    at = {r.call_id: r.position for r in out if r.kind == "call"}
    done = next(r.position for r in out if r.kind == "result")
    assert {r.call_id for r in out if r.status == "loop"} == {"p", "q", "s"}
    assert at["a"] < done < at["c"] and at["b"] < at["w"] and done < at["w"] < at["x"]
    assert max(at["x"], at["c"]) < at["y"] < at["z"] and done < at["r"]
    assert [r.position for r in out] == list(range(len(rows)))


def test_pages_keep_the_article_alone(spark):
    menu = "<nav><a>one</a><a>two</a></nav><div>we use these pages to tell you all about it daily</div>"
    rows = [
        (1, "http://h/1", f"<title>t</title>{menu}<article><header><h1>A &amp; b</h1></header><p>x\n  y"
                          "<p class='ad'>buy<p>z<div id=comments><p>hm</div></article><footer>f"),
        (2, "http://h/2", f"{menu}<p>only here we have some news</p>"),
        (3, "http://h/3", f"{menu}<p>other words stand on this page</p>"),
        (3, "http://h/3", f"{menu}<p>other words stand on this page</p>"),
        (4, None, None), (5, "http://h/5", ""), (6, "x", "plain &lt;b&gt; text"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn(
        "text", pages_extra())
    out = sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert out == [
        (1, "A & b\nx y\nz", 11), (2, "only here we have some news", 27),
        (3, "other words stand on this page", 30), (3, "other words stand on this page", 30),
        (4, "", 0), (5, "", 0), (6, "plain <b> text", 14)]
    assert html_text.extract(pages.limit(0)).count() == 0


def texts_of(spark, bodies):
    rows = [(i, f"http://h/{i}", body) for i, body in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    return [r.text for r in html_text.extract(pages).orderBy("page_id").collect()]


NOTICE = "please write to us if you find a mistake in this text"


def own_text(i, n=30):
    return " ".join(f"w{i}x{j}" for j in range(n))


def test_the_host_decides_on_ordinary_pages(spark):
    def page(i, notice):
        return (f"<body class='no-sidebar search'><article class=search><p>{own_text(i)}<div class=x>{notice}</div>"
                f"</article><div class='ad-free'>{own_text(i, 3)}</div><p>{NOTICE}</p>")

    found = texts_of(spark, [page(i, NOTICE) for i in range(6)])
    assert found == [f"{own_text(i)}\n{own_text(i, 3)}" for i in range(6)]
    # Inside articles a run goes if half of the pages have it, and five at least.
    found = texts_of(spark, [page(i, NOTICE) for i in range(4)])
    assert found == [f"{own_text(i)}\n{NOTICE}\n{own_text(i, 3)}" for i in range(4)]
    found = texts_of(spark, [page(i, NOTICE if i % 4 == 0 else own_text(i, 2)) for i in range(24)])
    assert found == [f"{own_text(i)}\n{NOTICE if i % 4 == 0 else own_text(i, 2)}\n{own_text(i, 3)}"
                     for i in range(24)]
    copies = [f"<div>{own_text(i, 4)}</div><article><header>{own_text(1, 9)}</header><p>{own_text(2)}</article>"
              for i in (5, 6)]
    assert texts_of(spark, copies) == [
        f"{own_text(i, 4)}\n{own_text(1, 9)}\n{own_text(2)}" for i in (5, 6)]
    # A teaser on another page takes nothing from the article.
    found = texts_of(spark, [f"<article><p>{own_text(0)}</p></article>", f"<p>{own_text(0, 10)}</p><p>more"])
    assert found == [own_text(0), "more"]


def test_covered_runs_go_and_unique_ones_and_copies_stay(spark):
    found = texts_of(spark, [f"<p>{NOTICE} {own_text(i, 7)}</p><p>{own_text(i + 9, 20)} {NOTICE}</p>"
                             for i in range(2)])
    assert found == [f"{own_text(i, 7)}\n{own_text(i + 9, 20)}" for i in range(2)]
    # Copies are one page, with or without an article; only what other pages have goes.
    plain, head = f"<p>{own_text(0)}</p>", f"<header>{own_text(1, 9)}</header><p>{own_text(2)}</p>"
    assert texts_of(spark, [plain, plain, f"<p>{NOTICE}</p>"]) == [own_text(0), own_text(0), NOTICE]
    copies = [f"<nav>{own_text(i, 4)}</nav><article>{head}</article>" for i in (5, 6)]
    assert texts_of(spark, copies) == [f"{own_text(1, 9)}\n{own_text(2)}"] * 2
    # Changed copies of an article stay as well, however many there are.
    assert texts_of(spark, [f"<article>{own_text(0)} {x}</article>" for x in "abcdefg"]) == [
        f"{own_text(0)} {x}" for x in "abcdefg"]


def plain_outside(bodies):
    """Words outside articles in runs that a page of another text has outside articles."""
    pages = [[w for part, t in html_text.blocks_of(b) if part != html_text.CHROME for w in t.split()]
             for b in bodies]
    where: dict = {}
    for words in pages:
        for i in range(len(words) - html_text.RUN + 1):
            where.setdefault(tuple(words[i:i + html_text.RUN]), set()).add(tuple(words))
    out = []
    for words in pages:
        gone = set()
        for i in range(len(words) - html_text.RUN + 1):
            if len(where[tuple(words[i:i + html_text.RUN])]) > 1:
                gone.update(range(i, i + html_text.RUN))
        out.append(" ".join(w for i, w in enumerate(words) if i not in gone))
    return out


@pytest.mark.parametrize("partitions", [1, 7, 211])
def test_repeats_are_exact_over_the_whole_host(spark, partitions):
    """Groups of a few pages: runs that two pages of different groups share go all the same."""
    rng = np.random.default_rng(8)
    shared = [own_text(1000 + k, 9 + k) for k in range(6)]
    bodies = [f"<p>{own_text(i, 12)} {shared[rng.integers(6)] if i % 3 else ''} {own_text(i + 500, 5)}</p>"
              for i in range(40)]
    bodies += [bodies[0], bodies[0], "", f"<p>{shared[0]}</p>"]
    rows = [(i, f"http://h/{i}", body) for i, body in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = {r.page_id: r.text for r in html_text.extract(pages, group_pages=5).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [found[i] for i in range(len(bodies))] == plain_outside(bodies)


def test_articles_keep_their_headlines(spark, folder):
    """No article of the pages loses its first heading or a third of its words."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        own = [t for part, t in html_text.blocks_of(r.html) if part in html_text.ARTICLE]
        if own:
            assert own[0] in found[r.page_id].split("\n")
            assert 3 * len(found[r.page_id].split()) > 2 * len(" ".join(own).split())


@pytest.mark.parametrize("unit", ["<div ", '<div a="', "<div a='x' ", "<", "<a<", "<!", "<!--", "<p", "</p",
                                  "<div><b>", '<div a=">', "<script", "<b class=x>", "</div>", "&lt;<"])
@pytest.mark.parametrize("end", ["", ">", "-->"])
def test_broken_pages_take_linear_time(unit, end):
    import time

    page = unit * (1_000_000 // len(unit)) + end
    started = time.process_time()
    html_text.blocks_of(page)
    assert time.process_time() - started < 10


def test_tags_with_quotes_and_without_ends():
    def texts(page):
        return [t for _, t in html_text.blocks_of(page)]

    assert texts('<p title="a > b">x</p>y') == ["x", "y"]
    assert texts('<p title="a>x</p>y') == ["x", "y"]  # never closed: ends at the next >
    assert texts("a < b <p>c") == ["a < b", "c"]
    assert texts("x<!-- <p> --> y <!-- z") == ["x y"]
    assert texts("<p>a<script>if (a < b) { '</p>' }</script>b") == ["ab"]


def pages_extra():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_neighbours_reach_the_nearest(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(30, 16)) * 2
    points = (centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 16))).astype(np.float32)
    points[500:900] = points[500]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(5000, None), (5100, [0.0] * 16), (5200, [float("nan")] + [1.0] * 15),
             (5300, [None] + [1.0] * 15), (None, [1.0] * 16), (5400, [1.0]), (100, rows[100][1])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    out = neighbours.search(vectors).collect()
    exact = points.astype(np.float64)
    hits = 0
    for q in range(0, 3000, 100):
        gaps = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        gaps[q] = np.inf
        best = np.lexsort((np.arange(3000), gaps))[:10]
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert all(abs(r.score - gaps[r.vec_id]) < 1e-9 for r in mine)
        assert mine == sorted(mine, key=lambda r: (r.score, r.vec_id))
        hits += len({r.vec_id for r in mine} & set(best.tolist()))
    assert len(out) == 300 and hits >= 0.9 * 300
    few = neighbours.search(vectors.filter("vec_id < 4"))
    assert [r.vec_id for r in few.orderBy("rank").collect()] and few.count() == 3
    # Tight ratios leave queries short; those read every list.
    assert neighbours.search(vectors, read_ratio=0.0, list_size=3).count() == 300
    assert neighbours.search(vectors.limit(0)).count() == 0


def test_broadcasts_are_plain_values(spark, folder, monkeypatch):
    """Executors may have no copy of this package, so no broadcast may hold its objects."""
    sent, real = [], type(spark.sparkContext).broadcast

    def seen(self, value):
        sent.append(pickle.dumps(value))
        return real(self, value)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", seen)
    docs = spark.createDataFrame([(i, "some words here") for i in range(9)], "doc_id int, text string")
    lm_scoring.score_texts(docs).count()
    neighbours.search(spark.read.parquet(f"{folder}/embeddings.parquet").limit(300)).count()
    assert len(sent) >= 5 and not any(b"claimwright" in value for value in sent)


def test_pipeline_equals_its_stages(spark, folder):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        assert 0 < after.count() <= docs.count()
        docs = after
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).select(*columns)
    whole = corpus_pipeline.run(spark, folder).select(*columns)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, whole.collect()))
