"""Tokenisation, packing and token files against the tokenizers library; round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from claimwright.llm import packing, token_files
from claimwright.llm.tokens import Encoder, text_blocks

ODD = list(" \n\t  \n a'sBé’ĳΣİ.,  　\x1c|<x1́ªÀµ\x0b\x85")


def definition(name):
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def ids_of(name, texts):
    made = Tokenizer.from_file(public_tokenizers.path(name)).encode_batch(texts, add_special_tokens=False)
    return [m.ids for m in made]


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_pieces_encode_like_whole_texts(name, spaced):
    pick = random.Random(1)
    texts = ["".join(pick.choice(ODD) for _ in range(pick.randint(0, 14))) for _ in range(8000)]
    texts += ["", " ", "  ", "\n \n x", " a", "a ", "a<|endoftext|> b", "one.\nTwo, three!\n\nFour"]
    flat, bounds = Encoder(definition(name), spaced).encode(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == ids_of(name, texts)


def documents(spark):
    pick = random.Random(4)
    rows = [(i, " ".join(pick.choice(["the", "of", "xyzzy", "é", "9"]) for _ in range(pick.randint(0, 3000))))
            for i in range(40)]
    rows += [(100, None), (101, ""), (102, "twice"), (102, "twice"), (None, "no id")]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def test_packing_places_every_piece(spark):
    rows, docs = documents(spark)
    packed = packing.pack_documents(docs, definition("word_bpe_49k.json"), with_ids=True)
    found = packed.toPandas()
    want = []
    for (doc, _), ids in zip(rows, ids_of("word_bpe_49k.json", [t or "" for _, t in rows])):
        ids = ids + [0]
        for at in range(0, len(ids), 2048):
            raw = np.array(ids[at:at + 2048], "<u4").tobytes()
            want.append((-1 if doc is None else doc, at // 2048, at, len(raw) // 4, zlib.crc32(raw)))
    got = found.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert sorted(map(tuple, got.astype(int).values.tolist())) == sorted(want)
    ordered = found.sort_values(["sequence_id", "offset"])
    before = (ordered.offset + ordered.length).groupby(ordered.sequence_id).shift(fill_value=0)
    assert (before == ordered.offset).all() and (ordered.offset + ordered.length).max() <= 2048
    assert found.sequence_id.nunique() <= -(-found.length.sum() // 2048) + 1
    whole = packing.sequences(packed)
    assert whole.count() == found.sequence_id.nunique()
    assert whole.selectExpr("sum(length(ids))").first()[0] == 4 * found.length.sum()
    assert packing.pack_documents(docs.limit(0), definition("word_bpe_49k.json")).count() == 0


def test_bins_stay_within_their_bound():
    """Online, in the order of arrival: never more open than allowed, and near the floor."""
    rng = np.random.default_rng(6)
    lengths = np.minimum(2048, rng.lognormal(5.5, 1.2, 30_000).astype(int) + 1).tolist()
    floor = -(-sum(lengths) // 2048)
    for limit in (1, 64, packing.OPEN_BINS):
        bins, fill, most = packing.Bins(2048, limit), {}, 0
        for n in lengths:
            number, offset = bins.place(n)
            assert offset == fill.get(number, 0) and offset + n <= 2048
            fill[number] = offset + n
            assert bins.count == sum(map(len, bins.by_space)) <= limit
            most = max(most, bins.count)
        assert most == limit and sum(fill.values()) == sum(lengths)
    assert len(fill) <= 1.005 * floor + 1


def test_bins_close_the_fullest():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 7, 4)] == [(0, 0), (1, 0), (0, 6)]
    # Bins with 3 and 5 places are open; a third closes the one with 3.
    assert bins.place(5) == (2, 0) and bins.place(9) == (3, 0)
    assert bins.place(3) == (1, 7) or bins.count <= 2


def test_token_files_give_back_every_id(spark):
    rows, docs = documents(spark)
    found = token_files.contract(docs, definition("byte_bpe_50k.json")).collect()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    want, start = [], 0
    made = ids_of("byte_bpe_50k.json", [t or "" for _, t in rows])
    for i in order:
        ids = made[i] + [2]
        want.append((rows[i][0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    key = lambda r: (r[1], r[2])
    assert sorted(map(tuple, found), key=key) == want
    assert token_files.contract(docs.limit(0), definition("byte_bpe_50k.json")).count() == 0


def test_codes_are_prefix_free_limited_and_best():
    rng = np.random.default_rng(1)
    counts = (rng.zipf(1.3, 3000) % 10_000_000).astype(np.int64)
    counts[rng.integers(0, 3000, 300)] = 0
    lengths = token_files.code_lengths(counts)
    used = lengths[counts > 0].astype(int)
    assert used.min() >= 1 and used.max() <= token_files.LIMIT and not lengths[counts == 0].any()
    assert (2.0 ** -used).sum() == 1.0
    codes = token_files.canonical(lengths)
    words = sorted(f"{codes[i]:0{lengths[i]}b}" for i in np.flatnonzero(counts))
    assert not any(b.startswith(a) for a, b in zip(words, words[1:]))
    ids = rng.choice(np.flatnonzero(counts), 5001)
    stream, marks = token_files.encode_ids(ids, codes, lengths)
    assert (token_files.decode_ids(stream, marks, len(ids), token_files.decode_table(lengths)) == ids).all()
    # Small weights: the limit does not bind and the cost equals Huffman's.
    assert token_files.code_lengths(np.array([5, 9, 12, 13, 16, 45])).tolist() == [4, 4, 3, 3, 3, 1]
    assert token_files.code_lengths(np.array([0, 7])).tolist() == [0, 1]


def test_packing_encodes_small_blocks():
    """An executor encodes several blocks at once, so each has a few megabytes of text."""
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": ["word " * 120_000] * 40})
    blocks = list(text_blocks([batch], "text", packing.BLOCK_BYTES))
    assert sum(part.num_rows for part, _ in blocks) == 40
    assert max(part.num_rows for part, _ in blocks) * 600_000 <= 8 << 20
