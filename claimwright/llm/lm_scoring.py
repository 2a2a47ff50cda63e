"""Language-model scores: a log-bilinear neural model trained by noise-contrastive estimation.

Words fall into CLASSES classes: the most frequent ones alone, all others by a hash of
their ending. The model predicts the class of a word from the classes of the two words
before it: the context is the sum of one learned vector per position, and its product
with every class vector, through a softmax, gives probabilities that sum to one. Inside
a class a word has its smoothed share of the class's training tokens, so the score of a
text is a probability over all words, unseen ones included.

Everything is counted over the whole corpus: word counts; the class sequences every task
trains on (all training tokens, in rounds, after which the tasks' parameters are
averaged); and the rare words, which are joined to their counts. What is broadcast is
bounded by parameters: HEAD frequent words and the model itself.
"""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from claimwright.llm.common import fold, map_batches
from claimwright.llm.tokens import text_blocks
from claimwright.session import stage

CLASSES = 256
SINGLES = 160
BUCKETS = CLASSES - SINGLES
CONTEXTS = CLASSES + 1
HEAD = 1 << 17
DIMENSIONS = 32
NOISE = 20
ROUNDS = 2
EPOCHS = 4
RATE = 0.15
BATCH = 2048
CHUNK_TOKENS = 2_000_000
BLOCK_BYTES = 8 << 20
SCORE_BYTES = 1 << 20
END = "\n"


def bucket_of(word: str) -> int:
    """The class of a word that has none of its own, by its last two bytes."""
    return zlib.crc32(word.encode()[-2:]) % BUCKETS


def split_words(texts: pa.StringArray) -> tuple[pa.Array, np.ndarray]:
    """(the different words of a block numbered, the text of each word), ends included.

    A word is what stands between \\x20 and \\x09-\\x0D, A-Z lowered; after its words
    every text has END.
    """
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    edges = cut.offsets.to_numpy().astype(np.int64)
    words = cut.flatten()
    owner = np.repeat(np.arange(len(texts)), np.diff(edges))
    real = pc.not_equal(words, "")
    owner = owner[real.to_numpy(zero_copy_only=False)]
    order = np.argsort(np.concatenate([owner, np.arange(len(texts))]), kind="stable")
    together = pa.concat_arrays([words.filter(real), pa.array([END] * len(texts), pa.string())])
    coded = together.dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)[order]
    return coded.dictionary, index, np.concatenate([owner, np.arange(len(texts))])[order]


def count_words(docs: DataFrame) -> DataFrame:
    """(word, bucket, n) over all texts; every text counts one END."""
    schema = "word string, bucket int, n bigint"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for _, texts in text_blocks(batches, "text", BLOCK_BYTES):
            words, index, _ = split_words(texts)
            yield pa.RecordBatch.from_arrays([
                words, pa.array([bucket_of(w) for w in words.to_pylist()], pa.int32()),
                pa.array(np.bincount(index, minlength=len(words)), pa.int64())], schema=arrow)

    return docs.select("text").mapInArrow(run, schema).groupBy("word", "bucket").agg(
        F.sum("n").alias("n"))


class Vocabulary:
    """The counts that scoring needs: totals, the frequent words, and the bucket totals."""

    def __init__(self, counts: DataFrame, head: int = HEAD):
        per_size = (counts.groupBy(F.floor(F.log2("n") * 16).alias("size"))
                    .agg(F.count("*").alias("words"), F.min("n").alias("least")).collect())
        per_bucket = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
        # The frequent words are those from a count on that at most `head` words reach.
        self.least, held = 1 << 62, 0
        for r in sorted(per_size, key=lambda r: -r["size"]):
            held += r["words"]
            if held > head:
                break
            self.least = r["least"]
        rows = counts.filter(F.col("n") >= self.least).select("word", "n").toArrow()
        found = sorted(zip(rows["n"].to_pylist(), rows["word"].to_pylist()),
                       key=lambda x: (-x[0], x[1]))
        self.counts = {w: n for n, w in found}
        self.singles = {w: i for i, (_, w) in enumerate(found[:SINGLES])}
        self.bucket_tokens, self.bucket_words = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for r in per_bucket.collect():
            self.bucket_tokens[r["bucket"]] = r["n"]
            self.bucket_words[r["bucket"]] = r["v"]
        self.tokens, self.words = int(self.bucket_tokens.sum()), int(self.bucket_words.sum())
        self.class_tokens = np.zeros(CLASSES)
        for w, i in self.singles.items():
            self.class_tokens[i] = self.counts[w]
            self.bucket_tokens[bucket_of(w)] -= self.counts[w]
            self.bucket_words[bucket_of(w)] -= 1
        self.class_tokens[SINGLES:] = self.bucket_tokens
        self.base_total = self.tokens + 0.5 * (self.words + 1)
        self.bucket_totals = self.bucket_tokens + 0.5 * (self.bucket_words + 1)


ROW_SCHEMA = """n_tokens bigint, head_known bigint, head_base double, head_within double,
    classes binary, tail array<struct<word:string,bucket:int,n:bigint>>"""


def encode_rows(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per document: class sequence, sums over frequent words, and the other words' counts."""
    # Plain values: a broadcast object would need its class's module on the executors.
    sent = docs.sparkSession.sparkContext.broadcast((
        vocabulary.counts, vocabulary.singles, vocabulary.bucket_totals, vocabulary.base_total))
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, {ROW_SCHEMA}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        counts, singles, bucket_totals, base_total = sent.value
        for part, texts in text_blocks(batches, "text", BLOCK_BYTES):
            words, index, owner = split_words(texts)
            words, size = words.to_pylist(), len(texts)
            known = np.fromiter((counts.get(w, 0) for w in words), np.float64, len(words))
            buckets = np.fromiter(map(bucket_of, words), np.int64, len(words))
            single = np.fromiter((singles.get(w, -1) for w in words), np.int64, len(words))
            classes = np.where(single >= 0, single, buckets + SINGLES).astype(np.uint8)[index]
            head = known > 0
            base = np.where(head, np.log10((known + 0.5) / base_total), 0.0)
            within = np.where(
                head & (single < 0), np.log10((known + 0.5) / bucket_totals[buckets]), 0.0)
            total = lambda x: np.bincount(owner, weights=x[index], minlength=size)
            sizes = np.bincount(owner, minlength=size)
            ends = np.cumsum(sizes).tolist()
            rare = ~head[index]
            pairs, times = np.unique(owner[rare] * len(words) + index[rare], return_counts=True)
            which = pairs % max(1, len(words))
            tail = pa.StructArray.from_arrays(
                [pa.array([words[i] for i in which.tolist()], pa.string()),
                 pa.array(buckets[which], pa.int32()), pa.array(times, pa.int64())],
                fields=list(arrow.field("tail").type.value_type))
            starts = np.searchsorted(pairs // max(1, len(words)), np.arange(size + 1))
            flat = classes.tobytes()
            yield pa.RecordBatch.from_arrays([
                part.column(part.schema.get_field_index("doc_id")),
                part.column(part.schema.get_field_index("held_out")),
                pa.array(sizes, pa.int64()), pa.array(total(head).astype(np.int64)),
                pa.array(total(base)), pa.array(total(within)),
                pa.array([flat[e - n:e] for e, n in zip(ends, sizes.tolist())],
                         arrow.field("classes").type),
                pa.ListArray.from_arrays(
                    pa.array(starts, pa.int32()), tail, type=arrow.field("tail").type),
            ], schema=arrow)

    return docs.select("doc_id", (fold() == 1).alias("held_out"), "text").mapInArrow(run, schema)


class Model:
    """Parameters: a vector per context class and position, a vector and bias per class."""

    shapes = {"first": (CONTEXTS, DIMENSIONS), "second": (CONTEXTS, DIMENSIONS),
              "target": (CLASSES, DIMENSIONS), "bias": (CLASSES,)}

    def __init__(self, noise: np.ndarray):
        self.noise = noise
        random = np.random.default_rng(11)
        for name, shape in self.shapes.items():
            setattr(self, name, random.normal(0.0, 0.1, shape))
        self.bias = np.log(noise)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).reshape(-1) for n in self.shapes])

    def load(self, values: np.ndarray) -> "Model":
        at = 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            setattr(self, name, values[at:at + size].reshape(shape).copy())
            at += size
        return self

    def train(self, contexts: np.ndarray, targets: np.ndarray, times: np.ndarray) -> None:
        """Noise-contrastive estimation on counted (context, target) pairs, by context.

        Each token is told apart from NOISE draws of the noise distribution; the draws
        enter by their expectation, which needs only their share per class. Steps are
        scaled per coordinate by the gradients so far.
        """
        seen, starts = np.unique(contexts, return_index=True)
        ends = np.append(starts[1:], len(contexts))
        squares = {n: np.full(s, 1e-8) for n, s in self.shapes.items()}
        share = NOISE * self.noise
        random = np.random.default_rng(5)
        for _ in range(EPOCHS):
            order = random.permutation(len(seen))
            for at in range(0, len(order), BATCH):
                chosen = np.sort(order[at:at + BATCH])
                spans = ends[chosen] - starts[chosen]
                places = np.repeat(starts[chosen] - np.cumsum(spans) + spans, spans)
                places += np.arange(len(places))
                counts = np.zeros((len(chosen), CLASSES))
                counts[np.repeat(np.arange(len(chosen)), spans), targets[places]] = times[places]
                one, two = seen[chosen] % CONTEXTS, seen[chosen] // CONTEXTS
                hidden = self.first[one] + self.second[two]
                odds = np.exp(np.clip(hidden @ self.target.T + self.bias, -30, 30)) / share
                real = odds / (1.0 + odds)
                tokens = counts.sum(axis=1, keepdims=True)
                slope = (tokens * share * real - counts * (1.0 - real)) / tokens.sum()
                back = slope @ self.target
                grads = {n: np.zeros(s) for n, s in self.shapes.items()}
                np.add.at(grads["first"], one, back)
                np.add.at(grads["second"], two, back)
                grads["target"] = slope.T @ hidden
                grads["bias"] = slope.sum(axis=0)
                for name, g in grads.items():
                    squares[name] += g * g
                    getattr(self, name).__isub__(RATE * g / np.sqrt(squares[name]))

    def log_table(self) -> np.ndarray:
        """log10 of the probability of every class after every pair of classes."""
        out = np.empty((CONTEXTS * CONTEXTS, CLASSES), np.float32)
        for two in range(CONTEXTS):
            scores = (self.first + self.second[two]) @ self.target.T + self.bias
            scores -= scores.max(axis=1, keepdims=True)
            scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
            out[two * CONTEXTS:(two + 1) * CONTEXTS] = scores / np.log(10.0)
        return out


def context_codes(sequences: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, class, text number) of every token; CLASSES stands before a text."""
    sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
    classes = np.frombuffer(b"".join(sequences), np.uint8).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    starts = starts[sizes > 0]
    one = np.concatenate([[CLASSES], classes[:-1]]) if len(classes) else classes
    one[starts] = CLASSES
    two = np.concatenate([[CLASSES], one[:-1]]) if len(one) else one
    two[starts] = CLASSES
    return two * CONTEXTS + one, classes, np.repeat(np.arange(len(sequences)), sizes)


def train_model(rows: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """The parameters after ROUNDS rounds over all training rows.

    In a round every task starts from the same parameters and trains on all its tokens;
    the results are averaged by their number of tokens, one number per parameter.
    """
    noise = (vocabulary.class_tokens + 1.0) / (vocabulary.class_tokens + 1.0).sum()
    values = Model(noise).flat()
    training = rows.filter("NOT held_out").select("classes")
    for _ in range(ROUNDS):
        sent = rows.sparkSession.sparkContext.broadcast((noise, values))

        def work(blocks):
            noise, values = sent.value
            model, tokens, held, size = Model(noise).load(values), 0, [], 0

            def learn():
                contexts, classes, _ = context_codes(held)
                pairs, times = np.unique(contexts * CLASSES + classes, return_counts=True)
                model.train(pairs // CLASSES, pairs % CLASSES, times)

            for block in blocks:
                held += block["classes"]
                size += sum(map(len, block["classes"]))
                if size >= CHUNK_TOKENS:
                    learn()
                    tokens, held, size = tokens + size, [], 0
            if size:
                learn()
                tokens += size
            if tokens:
                yield {"tokens": [tokens], "flat": [model.flat().tolist()]}

        trained = map_batches(training, "tokens bigint, flat array<double>", work, SCORE_BYTES)
        mean = (trained.select("tokens", F.posexplode("flat").alias("i", "x")).groupBy("i")
                .agg((F.sum(F.col("x") * F.col("tokens")) / F.sum("tokens")).alias("x")).toArrow())
        if mean.num_rows:
            values = np.zeros(len(values))
            values[mean["i"].to_numpy()] = mean["x"].to_numpy()
    return values


def score_texts(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the documents whose fold is not 1. No text is the empty text,
    whose one token is its end. Repeated rows are scored each. Without training
    documents every token has probability one in its class, and classes are alike.
    """
    training = docs.filter(fold() != 1)
    counts = stage(count_words(training), "lm-counts")
    vocabulary = Vocabulary(counts)
    rows = stage(
        encode_rows(docs, vocabulary).withColumn("_row", F.monotonically_increasing_id()), "lm-rows")
    noise = (vocabulary.class_tokens + 1.0) / (vocabulary.class_tokens + 1.0).sum()
    sent = docs.sparkSession.sparkContext.broadcast((noise, train_model(rows, vocabulary)))

    def work(blocks):
        noise, values = sent.value
        table = Model(noise).load(values).log_table()
        for block in blocks:
            contexts, classes, owner = context_codes(block["classes"])
            total = np.bincount(
                owner, weights=table[contexts, classes], minlength=len(block["_row"]))
            yield {**{c: block[c] for c in names}, "_classes": total.tolist()}

    names = ["_row", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "head_within"]
    types = dict(rows.dtypes)
    schema = ", ".join([*[f"{c} {types[c]}" for c in names], "_classes double"])
    modelled = map_batches(rows.select(*names, "classes"), schema, work, SCORE_BYTES)

    rare = counts.filter(F.col("n") < vocabulary.least).select("word", F.col("n").alias("c"))
    totals = F.array(*[F.lit(float(x)) for x in vocabulary.bucket_totals])
    seen = F.coalesce("c", F.lit(0)) + 0.5
    tails = (
        rows.select("_row", F.explode("tail").alias("t")).select("_row", "t.*")
        .join(rare, "word", "left").groupBy("_row").agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("n") * F.log10(seen / F.lit(float(vocabulary.base_total)))).alias("tail_base"),
            F.sum(F.col("n") * F.log10(seen / F.element_at(totals, F.col("bucket") + 1)))
            .alias("tail_within")))
    nothing = F.lit(0.0)
    return modelled.join(tails, "_row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", nothing)).alias("base_score"),
        (F.col("_classes") + F.col("head_within") + F.coalesce("tail_within", nothing)).alias("score"))
