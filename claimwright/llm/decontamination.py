"""Benchmark decontamination: an FM-index per shard of documents, searched for test phrases.

Each task turns its documents, shard by shard, into word ids, indexes them, and runs
all windows of the benchmark through the index by backward search. Occurrences are
located by sampled suffix positions and merged into spans of words to remove. A word
no window has is a separator, and a run of words shorter than the shortest window is
not indexed: no occurrence can lie in it, so nothing is lost.

The benchmark is read in blocks of at most BLOCK_WORDS words (a longer item is a block
of its own), of which one at a time is sent to the tasks.
"""

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.llm.common import map_batches, shielded, utf8, words_of
from claimwright.llm.fm_index import FMIndex

WINDOW = 10
BLOCK_WORDS = 1_000_000
SHARD_WORDS = 1 << 20

WORD = re.compile(rb"[\x30-\x39A-Za-z\x80-\xff]+")


class Windows:
    """The different windows of a block of items, by length, and whose they are."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple, set] = {}
        for item, raw in items:
            numbers = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(raw)]
            width = min(window, len(numbers))
            for at in range(len(numbers) - width + 1) if width else ():
                owners.setdefault(tuple(numbers[at:at + width]), set()).add(item)
        self.by_length = {}
        for phrase in owners:
            self.by_length.setdefault(len(phrase), []).append(phrase)
        self.owners = {n: [sorted(owners[p]) for p in ps] for n, ps in self.by_length.items()}
        self.by_length = {n: np.array(ps, np.int64) for n, ps in self.by_length.items()}
        self.shortest = min(self.by_length, default=0)


def runs_of(ids: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    """(start, end) of the runs of known words that a window can lie in."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= shortest
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def search_shard(arrays: list[np.ndarray], windows: Windows) -> list[tuple[list, list]]:
    """(merged spans, items) of each document of a shard."""
    pieces, owner, offset = [], [], []
    for number, ids in enumerate(arrays):
        for start, end in runs_of(ids, windows.shortest) if windows.shortest else ():
            pieces += [ids[start:end], np.zeros(1, np.int64)]
            owner.append(number)
            offset.append(start)
    out = [([], []) for _ in arrays]
    if not pieces:
        return out
    text = np.concatenate(pieces)
    run_starts = np.concatenate([[0], np.flatnonzero(text == 0)[:-1] + 1])
    index = FMIndex(text, len(windows.ids))
    change = np.zeros(len(text) + 1, np.int64)
    items: dict[int, set] = {}
    for length, phrases in windows.by_length.items():
        low, high = index.search(phrases)
        counts = high - low
        which = np.repeat(np.arange(len(phrases)), counts)
        if not len(which):
            continue
        rows = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
        at = index.locate(rows)
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
        docs = np.array(owner)[np.searchsorted(run_starts, at, side="right") - 1]
        for pair in np.unique(docs * len(phrases) + which).tolist():
            items.setdefault(pair // len(phrases), set()).update(
                windows.owners[length][pair % len(phrases)])
    hit = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    runs = np.searchsorted(run_starts, starts, side="right") - 1
    for start, end, run in zip(starts.tolist(), ends.tolist(), runs.tolist()):
        shift = offset[run] - int(run_starts[run])
        out[owner[run]][0].append((start + shift, end + shift))
    for number, found in items.items():
        out[number][1].extend(sorted(found))
    return out


def blocks_of(benchmark: DataFrame, block_words: int) -> int:
    """How many blocks the benchmark makes; counted by its bytes, two to a word at least."""
    size = benchmark.agg(F.sum(F.octet_length(utf8()))).first()[0] or 0
    return max(1, -(-size // (2 * block_words)))


def _search(docs: DataFrame, items: list[tuple], window: int, keep: list[str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)
    types = dict(docs.dtypes)
    schema = ", ".join([
        "n_words bigint", "spans array<struct<s:bigint,e:bigint>>", "items array<string>",
        *[f"`{c}` {types[c]}" for c in keep]])

    def work(blocks):
        windows = Windows(sent.value, window)
        get = windows.ids.get

        def flush(held, arrays):
            found = search_shard(arrays, windows)
            return {
                **held, "n_words": [len(a) for a in arrays],
                "spans": [[{"s": s, "e": e} for s, e in spans] for spans, _ in found],
                "items": [names for _, names in found]}

        held, arrays, size = {c: [] for c in keep}, [], 0
        for block in blocks:
            for number, raw in enumerate(block["_raw"]):
                words = words_of(raw)
                arrays.append(np.array([get(w, 0) for w in words], np.int64))
                for c in keep:
                    held[c].append(block[c][number])
                size += len(words) + 1
                if size >= SHARD_WORDS:
                    yield flush(held, arrays)
                    held, arrays, size = {c: [] for c in keep}, [], 0
        if arrays:
            yield flush(held, arrays)

    return map_batches(docs.select(*keep, utf8().alias("_raw")), schema, work)


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
               block_words: int = BLOCK_WORDS, keep: list[str] = ("doc_id",)) -> DataFrame:
    """One row per document: `n_words`, merged word `spans` of hit words, `items` found.

    A window is `window` consecutive words of an item, or the whole of a shorter one;
    an item without words has none. Null texts have no words; repeated rows give
    repeated rows; a null item id is found but not named.
    """
    keep = list(keep)
    many = blocks_of(benchmark, block_words)
    named = benchmark.select(F.col("item_id").cast("string").alias("item"), utf8().alias("raw"))
    if many == 1:
        return _search(docs, [(r.item or "", bytes(r.raw)) for r in named.collect()], window, keep)
    # 128 bits: rows of one key are equal rows.
    used = list(dict.fromkeys([*keep, "text"]))
    key = F.concat_ws(":", *[F.xxhash64(F.lit(salt), *used) for salt in "ab"]).alias("_key")
    keyed = docs.select(*used, key)
    parts = []
    for block in range(many):
        items = named.filter(F.pmod(F.xxhash64("item", "raw"), F.lit(many)) == block).collect()
        parts.append(_search(keyed, [(r.item or "", bytes(r.raw)) for r in items], window,
                             [*keep, "_key"]))
    rows = parts[0].select(*keep, "_key", "n_words")
    found = parts[0].filter("size(spans) > 0").select("_key", "spans", "items")
    for part in parts[1:]:
        found = found.union(part.filter("size(spans) > 0").select("_key", "spans", "items"))
    # Rows of one key are equal rows, so what they found is the same.
    merged = found.groupBy("_key").agg(
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("_all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    joined_spans = F.expr("""aggregate(_all, CAST(array() AS array<struct<s:bigint,e:bigint>>),
        (m, x) -> CASE WHEN size(m) > 0 AND element_at(m, -1).e >= x.s
            THEN concat(slice(m, 1, size(m) - 1), array(named_struct(
                's', element_at(m, -1).s, 'e', greatest(element_at(m, -1).e, x.e))))
            ELSE concat(m, array(x)) END)""")
    merged = merged.select("_key", joined_spans.alias("spans"), "items")
    return rows.join(merged, "_key", "left").select(
        "n_words", F.coalesce("spans", F.expr("CAST(array() AS array<struct<s:bigint,e:bigint>>)"))
        .alias("spans"),
        F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"), *keep)


def contract(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    found = find_leaks(docs, benchmark)
    named = F.expr("filter(items, x -> x <> '')")
    n_hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.e - x.s)")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size(named).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(named), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def cut_words(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [(m.start(), m.end()) for m in WORD.finditer(raw)]
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at:places[s][0]])
        at = places[e - 1][1]
    return b"\n".join(x for x in (p.strip() for p in [*out, raw[at:]]) if x)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents with hit words cut out; a document with no other words goes."""
    return shielded(docs, lambda d: _cut(d, benchmark, window))


def _cut(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    columns = docs.columns
    found = find_leaks(docs, benchmark, window, keep=columns).filter(
        "size(spans) = 0 OR aggregate(spans, 0L, (n, x) -> n + x.e - x.s) < n_words")
    types = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns)

    def work(blocks):
        for block in blocks:
            texts = []
            for text, spans in zip(block["text"], block["spans"]):
                if spans:
                    text = cut_words(text.encode(), [(x["s"], x["e"]) for x in spans]).decode()
                texts.append(text)
            yield {**{c: block[c] for c in columns}, "text": texts}

    return map_batches(found.select(*columns, "spans"), schema, work)
