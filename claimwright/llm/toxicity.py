"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of words, their stems (the first bytes, STEMS of
them), word pairs and pairs with one word between, hashed to a fixed number of slots. Training follows the per-coordinate rule with L1, so most
weights are exactly zero and what is sent to the scoring tasks is small; its size is
bounded by the number of slots whatever the data. The fit takes a bounded sample of
labelled rows (SAMPLE_PER_LABEL of either label, by hash of the id); scoring takes
every word of every text.
"""

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import fold, map_batches, shielded, utf8, words_of

SLOTS = 1 << 18
STEMS = (6, 7, 8)
SAMPLE_PER_LABEL = 2048
EPOCHS = 6
STEP_BYTES = 2 << 20
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 1.0
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def block_features(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, slot) of every feature occurrence in a block of texts."""
    words = [words_of(raw) for raw in raws]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    hashes = np.fromiter((zlib.crc32(w) for ws in words for w in ws), np.uint64, int(counts.sum()))
    owner = np.repeat(np.arange(len(words)), counts)
    shift = np.uint64(64 - int(math.log2(SLOTS)))
    texts, slots = [owner], [(hashes * MIX[0]) >> shift]
    for stem in STEMS:
        stems = np.fromiter(
            (zlib.crc32(w[:stem], stem) for ws in words for w in ws), np.uint64, len(owner))
        texts.append(owner)
        slots.append((stems * MIX[0]) >> shift)
    for gap in (1, 2):
        same = owner[gap:] == owner[:-gap]
        pair = (hashes[:-gap] * MIX[1] + hashes[gap:] * MIX[2] + np.uint64(gap)) * MIX[0]
        texts.append(owner[gap:][same])
        slots.append((pair >> shift)[same])
    return np.concatenate(texts), np.concatenate(slots).astype(np.int64)


def features_of(raw: bytes) -> np.ndarray:
    return np.unique(block_features([raw])[1])


class Ftrl:
    """Per-coordinate FTRL-proximal with L1 and L2; slot SLOTS is the bias, unpenalised."""

    def __init__(self):
        self.z, self.n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
        self.l1 = np.full(SLOTS + 1, L1)
        self.l1[SLOTS] = 0.0

    def weights(self, slots=slice(None)) -> np.ndarray:
        z, l1 = self.z[slots], self.l1[slots]
        step = (BETA + np.sqrt(self.n[slots])) / ALPHA + L2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / step)

    def learn(self, slots: np.ndarray, label: int) -> None:
        slots = np.append(slots, SLOTS)
        w = self.weights(slots)
        g = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, w.sum())))) - label
        sigma = (np.sqrt(self.n[slots] + g * g) - np.sqrt(self.n[slots])) / ALPHA
        self.z[slots] += g - sigma * w
        self.n[slots] += g * g


def fit_weights(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
                target: str = "toxic", held_out_fold: int = 0) -> dict[int, float]:
    """Slot -> weight of the non-zero weights; slot SLOTS is the bias.

    The shares of the labels in the sample differ from those in the data; the bias is
    corrected for that. Without labelled rows there is only a bias, below one half.
    """
    known = (labels.filter(fold(id_column) != held_out_fold).filter(F.col(target).isin(0, 1))
             .select(id_column, F.col(target).cast("int").alias("_label"))
             .filter(F.col(id_column).isNotNull()).distinct())
    numbers = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    order = F.xxhash64(F.col(id_column), F.lit("toxicity")).alias("_order")
    chosen = [known.filter(F.col("_label") == v).select("*", order).orderBy("_order", id_column)
              .limit(SAMPLE_PER_LABEL) for v in (0, 1)]
    # At most 2 x SAMPLE_PER_LABEL rows, so the join may be a broadcast. Of rows with one
    # id one text is learnt from, so an id of very many rows adds no more than any other.
    sample = (
        docs.select(id_column, utf8().alias("_raw"))
        .join(F.broadcast(chosen[0].union(chosen[1])), id_column)
        .groupBy(id_column, "_order", "_label").agg(F.min("_raw").alias("_raw")))

    def featured(blocks):
        for block in blocks:
            yield {"_order": block["_order"], "_label": block["_label"],
                   "_slots": [features_of(raw).tolist() for raw in block["_raw"]]}

    def train(blocks):
        rows = [row for b in blocks for row in zip(b["_order"], b["_label"], b["_slots"])]
        rows = [(y, np.array(x, np.int64)) for _, y, x in sorted(rows)]
        model = Ftrl()
        mixed = np.random.default_rng(7)
        for _ in range(EPOCHS):
            for i in mixed.permutation(len(rows)).tolist():
                model.learn(rows[i][1], rows[i][0])
        w = model.weights()
        some = np.flatnonzero(w)
        yield {"slot": some.tolist(), "weight": w[some].tolist(),
               "ones": [sum(y for y, _ in rows)] * len(some), "rows": [len(rows)] * len(some)}

    arrays = map_batches(
        sample, "_order bigint, _label int, _slots array<int>", featured).coalesce(1)
    fitted = map_batches(arrays, "slot int, weight double, ones int, rows int", train).collect()
    weights = {r["slot"]: r["weight"] for r in fitted}
    prior = math.log((numbers.get(1, 0) + 1) / (numbers.get(0, 0) + 2))
    if not fitted:
        return {SLOTS: prior}
    ones, rows = fitted[0]["ones"], fitted[0]["rows"]
    weights[SLOTS] = weights.get(SLOTS, 0.0) + prior - math.log((ones + 1) / (rows - ones + 2))
    return weights


def score_texts(docs: DataFrame, weights: dict[int, float], keep: list[str]) -> DataFrame:
    """The kept columns and `score`; the empty text scores by the bias alone."""
    types = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keep], "score double"])
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def work(blocks):
        dense = np.zeros(SLOTS + 1)
        for slot, weight in sent.value.items():
            dense[slot] = weight
        for block in blocks:
            texts, slots = block_features(block["_raw"])
            some = dense[slots] != 0.0
            pairs = np.unique(texts[some] * SLOTS + slots[some])
            total = np.bincount(
                pairs // SLOTS, weights=dense[pairs % SLOTS], minlength=len(block["_raw"]))
            logit = np.clip(total + dense[SLOTS], -35.0, 35.0)
            yield {**{c: block[c] for c in keep}, "score": (1.0 / (1.0 + np.exp(-logit))).tolist()}

    return map_batches(docs.select(*keep, utf8().alias("_raw")), schema, work, STEP_BYTES)


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_texts(docs, fit_weights(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id", (fold() == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold."""
    return shielded(docs, lambda d: score_texts(d, fit_weights(d, labels), d.columns).filter(
        F.col("score") < threshold))
