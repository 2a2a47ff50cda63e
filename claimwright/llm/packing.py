"""Best-fit packing of token pieces into sequences of fixed length.

Every document becomes its ids and an end id; only documents over the capacity are
cut. Pieces are dealt evenly over tasks of about SEQUENCES_PER_TASK sequences. Each
task packs its pieces online, in the order they come, by bounded-space best fit: at most
OPEN_BINS bins are open, found by a bitset over their free space; a piece goes where
the least space is left over, and when a bin too many would be open, the fullest closes.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from claimwright.llm.common import map_batches
from claimwright.llm.tokens import Encoder, text_blocks
from claimwright.session import stage

CAPACITY = 2048
OPEN_BINS = 256
SEQUENCES_PER_TASK = 8192
# A block takes about ten times its size while it is encoded, in every task of an executor.
BLOCK_BYTES = 8 << 20
END = 0


class Bins:
    """Open bins by free space; bit f of `bits` tells that some bin has f places left."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits, self.count, self.made = 0, 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, space: int) -> int:
        stack = self.by_space[space]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << space)
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            if self.count >= self.limit:
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest > left:
                    return number, self.capacity - space
                self._take(fullest)
            self.by_space[left].append(number)
            self.bits |= 1 << left
            self.count += 1
        return number, self.capacity - space


def token_pieces(docs: DataFrame, definition: str, capacity: int = CAPACITY, end: int = END,
                 spaced: bool = False, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; null text is empty."""
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids binary" if with_ids else ""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        encoder = Encoder(sent.value, spaced)
        last = np.array([end], "<u4").tobytes()
        for part, texts in text_blocks(batches, "text", BLOCK_BYTES):
            flat, bounds = encoder.encode(texts)
            out = {n: [] for n in arrow.names}
            ids_of = part.column(part.schema.get_field_index("doc_id")).to_pylist()
            for doc, low, high in zip(ids_of, bounds.tolist(), bounds[1:].tolist()):
                raw = flat[low:high].astype("<u4").tobytes() + last
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[at:at + 4 * capacity]
                    out["doc_id"].append(doc)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(len(own) // 4)
                    out["ids_crc32"].append(zlib.crc32(own))
                    if with_ids:
                        out["ids"].append(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[n], type=arrow.field(n).type) for n in arrow.names], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         per_task: int = SEQUENCES_PER_TASK) -> DataFrame:
    """The pieces with `sequence_id` and `offset`; reads `length` (1 to capacity) alone.

    The pieces must be a stored table: they are counted first, then dealt. A length
    that is null or out of range raises an error. No pieces give no rows.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // (capacity * per_task)))
    # Dealt in turn, not by a key, so no group of equal rows meets in one task.
    dealt = pieces.repartition(tasks)
    types = dict(pieces.dtypes)
    schema = ", ".join([
        *[f"`{c}` {types[c]}" for c in pieces.columns], "sequence_id bigint", "offset bigint"])

    def work(blocks):
        bins = Bins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for block in blocks:
            if any(n is None or not 0 < n <= capacity for n in block["length"]):
                raise ValueError(f"A piece's length is not between 1 and {capacity}.")
            placed = [bins.place(n) for n in block["length"]]
            yield {**block, "sequence_id": [base + b for b, _ in placed],
                   "offset": [o for _, o in placed]}

    return map_batches(dealt, schema, work)


def pack_documents(docs: DataFrame, definition: str, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place; repeated rows are packed each."""
    pieces = stage(
        token_pieces(docs, definition, capacity, with_ids=with_ids), "packing-pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from pieces packed with their ids; at most `capacity` ids a row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, X'', (a, x) -> concat(a, x.ids))").alias("ids"))
