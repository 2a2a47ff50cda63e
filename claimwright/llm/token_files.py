"""Token files: ids in canonical length-limited Huffman codes, in independent blocks.

One code is made from the counts of all ids. A file row is a block of whole documents:
the bit stream (most significant bit first), a bit offset for every CHECKPOINT-th id,
and the documents with their lengths. Decoding looks up the next LIMIT bits in a table
that gives an id and the length of its code, for all checkpoints of a block at once.
Blocks carry shard (range of doc_id) and number, so file order is document order.
"""

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from claimwright.llm.common import map_batches
from claimwright.llm.tokens import Encoder, text_blocks
from claimwright.session import shared_folder, stage

LIMIT = 16
CHECKPOINT = 128
BLOCK_IDS = 1 << 18
SHARD_IDS = 8_000_000
END = 2


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The best code length of every symbol within the limit (package-merge); 0 for none."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits.")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        by = np.argsort(merged, kind="stable")
        levels.append(by < len(weights))
        merged = merged[by]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    taken = 2 * len(used) - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:taken].sum())
        lengths[order[:leaves]] += 1
        taken = 2 * (taken - leaves)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes: by length, then by id, counting up."""
    codes = np.zeros(len(lengths), np.int64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        own = lengths[order].astype(np.int64)
        # Every code is the sum of the shares of the code space before it.
        before = np.concatenate([[0], np.cumsum(1 << (32 - own))[:-1]])
        codes[order] = before >> (32 - own)
    return codes


def encode_ids(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """(bit stream, bit offsets of the checkpoints) of a block."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    value = codes[ids].astype(np.uint64) << (64 - size - (at & 31)).astype(np.uint64)
    word = at >> 5
    words = int(ends[-1] + 31 >> 5) + 1 if len(ids) else 1
    # Codes do not overlap, so sums of their bits are exact.
    high = np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64), minlength=words)
    low = np.bincount(word + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64),
                      minlength=words + 1)
    stream = (high + low[:words]).astype(np.uint64).astype(">u4").tobytes()
    return stream, at[::CHECKPOINT].astype("<u8").tobytes()


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, code length) for every pattern of the next LIMIT bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (LIMIT - lengths[order].astype(np.int64))
    ids, sizes = np.zeros(1 << LIMIT, np.uint32), np.zeros(1 << LIMIT, np.int64)
    total = int(spans.sum())
    ids[:total] = np.repeat(order, spans)
    sizes[:total] = np.repeat(lengths[order], spans)
    return ids, sizes


def decode_ids(stream: bytes, checkpoints: bytes, count: int, table) -> np.ndarray:
    """The ids of a block, all its checkpoints side by side."""
    ids, sizes = table
    lanes = np.frombuffer(checkpoints, "<u8").astype(np.int64)
    if not count:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(stream + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.zeros((CHECKPOINT, len(lanes)), np.uint32)
    last, at = len(window) - 1, lanes
    for step in range(min(CHECKPOINT, count)):
        seen = window[np.minimum(at >> 3, last)] >> (32 - LIMIT - (at & 7)).astype(np.uint32)
        seen &= (1 << LIMIT) - 1
        out[step] = ids[seen]
        at = at + sizes[seen]
    return out.T.reshape(-1)[:count]


def id_type(definition: str, end: int = END) -> str:
    """Two bytes an id where the vocabulary allows it, else four."""
    return "<u2" if max(Tokenizer.from_str(definition).get_vocab_size(), end + 1) <= 1 << 16 else "<u4"


def token_table(docs: DataFrame, definition: str, end: int = END) -> DataFrame:
    """(doc_id, ids) of every document, ids as little-endian integers of `id_type`."""
    kind = id_type(definition, end)
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, ids binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        encoder = Encoder(sent.value, spaced=True)
        last = np.array([end], kind).tobytes()
        for part, texts in text_blocks(batches, "text"):
            flat, bounds = encoder.encode(texts)
            flat = flat.astype(kind)
            raws = [flat[a:b].tobytes() + last
                    for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([
                part.column(part.schema.get_field_index("doc_id")),
                pa.array(raws, arrow.field("ids").type)], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def count_ids(table: DataFrame, kind: str) -> np.ndarray:
    """How often each id stands in the table: at most a vocabulary of rows comes back."""

    def work(blocks):
        total = np.zeros(1, np.int64)
        for block in blocks:
            found = np.bincount(np.frombuffer(b"".join(block["ids"]), kind))
            if len(found) > len(total):
                total, found = found, total
            total[:len(found)] += found
        some = np.flatnonzero(total)
        yield {"id": some.tolist(), "n": total[some].tolist()}

    rows = (map_batches(table.select("ids"), "id bigint, n bigint", work)
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


BLOCK_SCHEMA = """shard int, block int, before bigint, n_ids bigint, stream binary, checkpoints binary,
    doc_ids array<{id}>, sizes array<bigint>"""


def write_files(docs: DataFrame, definition: str, path: str, end: int = END) -> None:
    """Writes blocks, code lengths and the start of each shard under `path`.

    Documents are in ascending order of doc_id (null first); rows of one doc_id are in
    the order of their ids, equal ones in the order of the input.
    """
    spark = docs.sparkSession
    table = stage(token_table(docs, definition, end), "token-ids", compression="zstd")
    kind = id_type(definition, end)
    counts = count_ids(table, kind)
    lengths = code_lengths(counts)
    codes = canonical(lengths)
    spark.createDataFrame(
        [(i, int(n)) for i, n in enumerate(lengths.tolist()) if n], "id int, length int"
    ).coalesce(1).write.parquet(f"{path}/code")
    shards = max(1, -(-int(counts.sum()) // SHARD_IDS))
    # The row number lets a doc_id of very many rows go to several shards.
    order = ["doc_id", "_hash", "_row"]
    ranged = table.select(
        "doc_id", "ids", F.xxhash64("ids").alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    ).repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    sent = spark.sparkContext.broadcast((codes, lengths))

    def work(blocks):
        codes, lengths = sent.value
        width = np.dtype(kind).itemsize
        shard, number = TaskContext.get().partitionId(), 0
        names, raws, held, before = [], [], 0, 0

        def made():
            ids = np.frombuffer(b"".join(raws), kind)
            stream, checkpoints = encode_ids(ids, codes, lengths)
            return {"shard": [shard], "block": [number], "before": [before], "n_ids": [len(ids)], "stream": [stream],
                    "checkpoints": [checkpoints], "doc_ids": [names],
                    "sizes": [[len(r) // width for r in raws]]}

        for block in blocks:
            for name, raw in zip(block["doc_id"], block["ids"]):
                names.append(name)
                raws.append(raw)
                held += len(raw) // width
                if held >= BLOCK_IDS:
                    yield made()
                    before += held
                    names, raws, held, number = [], [], 0, number + 1
        if raws:
            yield made()

    schema = BLOCK_SCHEMA.format(id=dict(docs.dtypes)["doc_id"])
    map_batches(ranged, schema, work).write.parquet(f"{path}/blocks")
    # A row for each shard of SHARD_IDS ids: small enough to order in one task.
    totals = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n"))
    totals.select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("start")
    ).coalesce(1).write.parquet(f"{path}/shards")


def read_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files."""
    code = spark.read.parquet(f"{path}/code").collect()
    lengths = np.zeros(max([r["id"] for r in code], default=0) + 1, np.uint8)
    for r in code:
        lengths[r["id"]] = r["length"]
    sent = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = dict(blocks.dtypes)["doc_ids"][len("array<"):-1]
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    schema += ", ids binary" if with_ids else ""

    def work(parts):
        table = decode_table(sent.value)
        for part in parts:
            for i, stream in enumerate(part["stream"]):
                ids = decode_ids(stream, part["checkpoints"][i], part["n_ids"][i], table)
                ids = ids.astype("<u4")
                sizes = np.array(part["sizes"][i], np.int64)
                ends = np.cumsum(sizes).tolist()
                raws = [ids[e - n:e].tobytes() for e, n in zip(ends, sizes.tolist())]
                yield {
                    "doc_id": part["doc_ids"][i],
                    "start": [part["start"][i] + part["before"][i] + e - n for e, n in zip(ends, sizes.tolist())],
                    "n_tokens": sizes.tolist(), "ids_crc32": [zlib.crc32(r) for r in raws],
                    **({"ids": raws} if with_ids else {})}

    # Spark broadcasts the shards if their file is small, and else joins by shuffle.
    starts = spark.read.parquet(f"{path}/shards")
    return map_batches(blocks.join(starts, "shard"), schema, work)


def contract(docs: DataFrame, definition: str) -> DataFrame:
    """Writes the files of all documents into the shared folder and reads them back."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/claimwright/token-files-{uuid.uuid4().hex}"
    write_files(docs, definition, path)
    return read_files(spark, path)
