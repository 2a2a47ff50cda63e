"""Small helpers shared by the operators of this package.

Words are cut on bytes: `bytes.split()` cuts at exactly \\x20 and \\x09-\\x0D, and
`bytes.lower()` lowers exactly A-Z.
"""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


# The bytes that belong to words once A-Z is lowered; all others cut.
_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
WORD_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEPT else 32 for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text, A-Z lowered."""
    return raw.translate(WORD_TABLE).split()


def utf8(column: str = "text") -> Column:
    """A text as its UTF-8 bytes; no text is the empty text."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def fold(id_column: str = "doc_id", folds: int = 5) -> Column:
    """The fold of a row: CRC-32 of its id as text; no id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds


def shielded(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Runs a step from documents to documents with its further columns out of the way.

    They get neutral names, so none can clash with a name the step uses, and have their
    own again in the result.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    named = {c: f"extra_{i}" for i, c in enumerate(others)}
    neutral = docs.select(
        "doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in named.items()])
    return step(neutral).select(*[F.col(named.get(c, c)).alias(c) for c in docs.columns])


def map_batches(
    df: DataFrame, schema: str, work: Callable[[Iterator[dict]], Iterator[dict]],
    step_bytes: int = 8 << 20,
) -> DataFrame:
    """Runs `work` over the rows of each partition as plain column lists.

    `work` gets an iterator of {column: list} blocks of about `step_bytes` of data, so
    that its working memory does not depend on the number of rows, and yields blocks
    of the columns in `schema`.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def blocks(batches):
        for batch in batches:
            rows = batch.num_rows
            step = max(1, step_bytes // max(1, batch.nbytes // max(1, rows)))
            for at in range(0, rows, step):
                part = batch.slice(at, step)
                yield {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}

    def run(batches):
        for block in work(blocks(batches)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[n], type=arrow.field(n).type) for n in arrow.names],
                schema=arrow)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
