"""Locality-keeping digests of texts: quartiles of byte-triplet buckets, and the length.

Every triplet of neighbouring UTF-8 bytes is hashed to one of BUCKETS counters. A digest
keeps, for each counter, how many of the three quartiles of all counters it exceeds (two
bits), and the length in quarters of an octave. Two digests differ by the number of
counters in different quartiles plus a bounded share for the lengths; likeness is one
less the difference over its greatest value.
"""

import hashlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import map_batches
from claimwright.session import stage

BUCKETS = 512
LENGTH_WEIGHT, LENGTH_STEPS = 8, 16
GREATEST = BUCKETS + LENGTH_WEIGHT * LENGTH_STEPS
# Odd 32-bit multipliers of the three bytes and of the final mix.
FACTORS = (2654435761, 2246822519, 3266489917)
MIX = 2246822519
ROWS = 2048


def bucket_counts(raw: bytes) -> np.ndarray:
    """How often each bucket is hit by the byte triplets of a text."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(BUCKETS, np.int64)
    one, two, three = map(np.uint32, FACTORS)
    h = b[:-2] * one + b[1:-1] * two + b[2:] * three
    h ^= h >> np.uint32(15)
    h *= np.uint32(MIX)
    return np.bincount(h >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)


def length_code(n: int) -> int:
    """The length in quarters of an octave; 0 for the empty text."""
    bits = n.bit_length()
    return 4 * bits + (((n << 3) >> bits) & 3)


def digest(text: str) -> tuple[np.ndarray, int]:
    """The quartile of every bucket (0 to 3) and the length code."""
    raw = text.encode()
    counts = bucket_counts(raw)
    quarter = BUCKETS // 4
    low, middle, high = np.partition(counts, [quarter - 1, 2 * quarter - 1, 3 * quarter - 1])[
        [quarter - 1, 2 * quarter - 1, 3 * quarter - 1]]
    return ((counts > low).astype(np.uint8) + (counts > middle) + (counts > high)), length_code(len(raw))


def written(found: tuple[np.ndarray, int]) -> str:
    """A digest as text: the length code in two hex digits, then four buckets a byte."""
    four = found[0].reshape(-1, 4)
    packed = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return f"{found[1]:02x}" + packed.astype(np.uint8).tobytes().hex()


def read(text: str) -> tuple[np.ndarray, int]:
    """A digest from its text."""
    packed = np.frombuffer(bytes.fromhex(text[2:]), np.uint8)
    return (packed[:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3).ravel(), int(text[:2], 16)


def likeness(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int]) -> float:
    """1 for equal digests, 0 for the greatest difference."""
    apart = int(np.count_nonzero(a[0] != b[0]))
    return 1.0 - (apart + LENGTH_WEIGHT * min(abs(a[1] - b[1]), LENGTH_STEPS)) / GREATEST


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every text, row by row; no text is the empty text."""
    def work(blocks):
        for block in blocks:
            yield {"doc_id": block["doc_id"],
                   "fingerprint": [written(digest(t or "")) for t in block["text"]]}

    return map_batches(docs.select("doc_id", "text"),
                       f"doc_id {dict(docs.dtypes)['doc_id']}, fingerprint string", work)


def compared(doc_id, text: str, own, after: str, after_own) -> dict:
    """The result row of a text and the text that follows it."""
    cut = len(text) // 3
    edited = text[:len(text) - cut] + after[:cut]
    changed = digest(edited)
    return {
        "doc_id": doc_id, "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
        "fingerprint": written(own), "edited_fingerprint": written(changed),
        "near_edited": likeness(own, changed), "near_next": likeness(own, after_own)}


RESULT = ("doc_id {id}, n_chars bigint, edited_sha256 string, fingerprint string,"
          " edited_fingerprint string, near_edited double, near_next double")


def contract(docs: DataFrame) -> DataFrame:
    """Digests of all texts and of their edited texts, whose last third comes from the next.

    Rows are ordered by descending doc_id in ranges (rows of one id by a hash of their
    texts, null ids last), so a text meets the next one in its task; texts are shuffled once. The
    first and the last text of each range are kept aside and joined to each other: two
    rows a range. Null texts are empty; repeated rows follow each other; further columns
    are not read; an empty table gives no rows, and a single row follows itself.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    result = RESULT.format(id=kind)
    names = [c.split()[0] for c in result.split(", ")]
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text")]
    ranged = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
              .repartitionByRange(*order).sortWithinPartitions(*order))

    def work(blocks):
        part, held = TaskContext.get().partitionId(), None
        columns = ["part", "edge", "text", *names]

        def row(edge=None, text=None, **values):
            return [part, edge, text, *(values.get(n) for n in names)]

        for block in blocks:
            texts = list(zip(block["doc_id"], block["text"]))
            for at in range(0, len(texts), ROWS):
                rows = []
                for doc_id, text in texts[at:at + ROWS]:
                    own = digest(text)
                    if held is None:
                        rows.append(row("first", text))
                    else:
                        rows.append(row(**compared(*held, text, own)))
                    held = (doc_id, text, own)
                yield dict(zip(columns, map(list, zip(*rows))))
        if held is not None:
            yield dict(zip(columns, ([x] for x in row("last", held[1], doc_id=held[0]))))

    mapped = stage(map_batches(ranged, f"part int, edge string, text string, {result}", work),
                   "digests")
    # A few bytes for each range: which one holds the next text.
    parts = sorted(r["part"] for r in mapped.filter("edge = 'first'").select("part").collect())
    follows = spark.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    firsts = mapped.filter("edge = 'first'").select(
        F.col("part").alias("next_part"), F.col("text").alias("after"))
    edges = mapped.filter("edge = 'last'").select("part", "doc_id", "text").join(
        follows, "part").join(firsts, "next_part").select("doc_id", "text", "after")

    def joined(blocks):
        for block in blocks:
            rows = [compared(d, t, digest(t), a, digest(a))
                    for d, t, a in zip(block["doc_id"], block["text"], block["after"])]
            yield {n: [r[n] for r in rows] for n in names}

    return mapped.filter("edge IS NULL").select(*names).unionByName(map_batches(edges, result, joined))
