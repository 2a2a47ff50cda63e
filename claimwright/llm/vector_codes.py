"""Product codes of vectors, with exact integer codebooks.

Vectors become integers and are cut into equal parts; each part position has a codebook
whose entries are refined in rounds of assignment and floored means. Vectors are stored
in blocks: every dimension has a dictionary of the distinct integers a block holds there,
and each vector an index into it. A round tabulates the squared difference of each
distinct integer to every entry once; the distance of a part is then a sum of gathers from
these tables. Dictionaries belong to blocks, so their size is bounded whatever the values,
and sums leave a task added up, one row for each component of the codebooks.
"""

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from claimwright.llm.common import map_batches
from claimwright.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK = 8192
SALTS = 32


def finite(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is not null and holds no null or non-finite component, as
    array<double> `v` beside the columns asked for."""
    rows = vectors.withColumn("v", F.transform(column, lambda x: x.cast("double")))
    return rows.filter("v IS NOT NULL AND forall(v, x -> coalesce(abs(x) < double('Infinity'), false))")


def integers(column: pa.ListArray, scale: int) -> np.ndarray:
    """A column of equally long vectors as floor(scale * x), a row each.

    Raises where a squared distance could leave the range of a long.
    """
    flat = column.flatten().to_numpy(zero_copy_only=False)
    values = np.floor(flat * float(scale)).reshape(len(column), -1)
    bound = math.isqrt((1 << 62) // max(1, values.shape[1])) // 2
    if values.size and np.abs(values).max() > bound:
        raise ValueError(f"A component is beyond {bound / scale}: squared distances leave a long.")
    return values.astype(np.int64)


def common_length(rows: DataFrame, parts: int) -> int:
    """The most frequent length that can be cut into equal parts (the smaller on a tie)."""
    found = (rows.groupBy(F.size("v").alias("d")).count()
             .filter(f"d > 0 AND d % {parts} = 0").orderBy(F.desc("count"), "d").first())
    return found["d"] if found else 0


def coded_blocks(rows: DataFrame, scale: int, block: int = BLOCK) -> DataFrame:
    """(vec_id, label, v) as blocks: ids and labels, the dictionary of every dimension
    (their sizes beside it), and for every dimension the index of each vector's value."""
    types = dict(rows.dtypes)
    schema = (f"vec_id array<{types['vec_id']}>, label array<{types['label']}>,"
              " sizes array<int>, words binary, codes binary")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                values = integers(part.column(2), scale)
                pairs = [np.unique(column, return_inverse=True) for column in values.T]
                record = [
                    part.column(0).to_pylist(), part.column(1).to_pylist(),
                    [len(words) for words, _ in pairs],
                    b"".join(words.astype("<i8").tobytes() for words, _ in pairs),
                    b"".join(codes.astype("<u2").tobytes() for _, codes in pairs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t.type) for x, t in zip(record, arrow)], schema=arrow)

    if not 0 < block <= 1 << 16:
        raise ValueError("A block has 1 to 65,536 vectors.")
    return rows.select("vec_id", "label", "v").mapInArrow(run, schema)


def opened(sizes: list[int], words: bytes, codes: bytes) -> list[tuple[np.ndarray, np.ndarray]]:
    """(dictionary, indexes) of every dimension of a block."""
    ends = np.cumsum(sizes)
    flat = np.frombuffer(words, "<i8")
    table = np.frombuffer(codes, "<u2").reshape(len(sizes), -1)
    return [(flat[end - size:end], row) for size, end, row in zip(sizes, ends, table)]


def assigned(block: list, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part's nearest entry, ties to the lower index, and its distance: (parts, vectors)."""
    parts, entries, width = books.shape
    best = np.empty((parts, len(block[0][1])), np.int64)
    least = np.empty_like(best)
    for p in range(parts):
        far = 0
        for i, (words, codes) in enumerate(block[p * width:(p + 1) * width]):
            table = (words[:, None] - books[p, :, i][None, :]) ** 2
            far = far + table[codes]
        best[p] = far.argmin(axis=1)
        least[p] = np.take_along_axis(far, best[p][:, None], 1)[:, 0]
    return best, least


def entry_sums(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, place, total, n): component sums and sizes of every used entry."""
    parts, entries, width = books.shape

    def work(found):
        totals = np.zeros((parts, entries, width), np.int64)
        sizes = np.zeros((parts, entries), np.int64)
        for some in found:
            for record in zip(some["sizes"], some["words"], some["codes"]):
                block = opened(*record)
                best, _ = assigned(block, books)
                for p in range(parts):
                    sizes[p] += np.bincount(best[p], minlength=entries)
                    for i, (words, codes) in enumerate(block[p * width:(p + 1) * width]):
                        # Whole numbers far below 2^53, so the sums in doubles are exact.
                        totals[p, :, i] += np.bincount(
                            best[p], weights=words[codes], minlength=entries).astype(np.int64)
        part, entry, place = (x.ravel().tolist() for x in np.indices(totals.shape))
        yield {"part": part, "entry": entry, "place": place, "total": totals.ravel().tolist(),
               "n": np.repeat(sizes.ravel(), width).tolist()}

    each = map_batches(blocks.select("sizes", "words", "codes"),
                       "part int, entry int, place int, total bigint, n bigint", work)
    return each.filter("n > 0").groupBy("part", "entry", "place").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"))


@dataclass
class Codebooks:
    """The entries of every part: whole numbers of shape (parts, entries, width)."""

    books: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and place."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def decoded(self, code: str) -> list[int]:
        """The integer vector a code stands for."""
        picks = bytes.fromhex(code)
        return [x for p, e in enumerate(picks) for x in self.books[p, e].tolist()]


def fit(blocks: DataFrame, books: np.ndarray, rounds: int) -> Codebooks:
    """Refines the first entries; an entry no part is nearest to stays as it is."""
    for _ in range(rounds):
        new = books.copy()
        for r in entry_sums(blocks, books).collect():
            new[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
        books = new
    return Codebooks(books)


def encoded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector: indexes in hex, the squared distance."""
    inner = {name: kind[len("array<"):-1] for name, kind in blocks.dtypes if kind.startswith("array")}

    def work(found):
        for some in found:
            for ids, labels, *record in zip(*(some[c] for c in blocks_columns)):
                best, least = assigned(opened(*record), books)
                digits = best.astype(np.uint8).T
                yield {"vec_id": ids, "label": labels, "code": [row.tobytes().hex() for row in digits],
                       "error": least.sum(axis=0).tolist()}

    blocks_columns = ["vec_id", "label", "sizes", "words", "codes"]
    return map_batches(
        blocks.select(*blocks_columns),
        f"vec_id {inner['vec_id']}, label {inner['label']}, code string, error bigint", work)


def with_group_total(rows: DataFrame, key: str, value: str, output: str) -> DataFrame:
    """Rows with the sum of `value` over rows of equal key, nulls together.

    Sums are added up before the shuffle, and rows of a frequent key are spread by a salt.
    """
    sums = rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(output)).withColumn(
        "_salted", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return salted.join(
        sums, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_salted"))
    ).select(*rows.columns, output)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[Codebooks | None, DataFrame]:
    """The codebooks, and (vec_id, label, code, error) of every vector.

    Rows whose vector is null or holds null or non-finite components are left out, and so
    are vectors that cannot be cut into equal parts or are not of the most frequent length;
    `label` may be null. Rows of one vec_id are vectors of their own; a null vec_id comes last when
    the first entries are taken, equal ids are taken by their vectors. Fewer vectors than entries
    give as many entries; no vectors, no codebooks and no rows. Further columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("A codebook has 1 to 256 entries.")
    rows = finite(vectors.select("vec_id", "embedding", "label")).select("vec_id", "label", "v")
    length = common_length(rows, parts)
    rows = rows.filter((F.size("v") == length) & F.lit(length > 0))
    blocks = stage(coded_blocks(rows, scale), "codes-blocks")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").toArrow()
    if not first.num_rows:
        kinds = dict(rows.dtypes)
        return None, vectors.sparkSession.createDataFrame(
            [], f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")
    start = integers(first["v"].combine_chunks(), scale)
    books = fit(blocks, start.reshape(len(start), parts, -1).transpose(1, 0, 2).copy(), rounds)
    return books, encoded(blocks, books.books)


def contract(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), a row for each vector kept."""
    books, rows = compress(vectors)
    coded = stage(rows, "codes")
    return with_group_total(coded, "label", "error", "label_error").select(
        "vec_id", "code", "error", "label_error",
        F.lit(books.digest() if books else "").alias("codebooks_sha256"))
