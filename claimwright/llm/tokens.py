"""Token ids of whole texts by a public tokenizer, each different piece of text encoded once.

A tokenizer cuts a text before it merges, so a text may be cut at any place where the
tokenizer surely cuts, each piece encoded on its own, and the ids put together. Arrow
cuts a block of texts and numbers its different pieces, the library encodes those, and
numpy gathers the ids. A text in which such places are not certain is encoded whole.
"""

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 32 << 20
CALL = 1024

# The start of special tokens, white space beyond ASCII, and controls that
# libraries class differently; a space that is neither first nor last of its white space;
# a word of Latin letters, which is surely one word to the tokenizer, and marks after it
# (an apostrophe may belong to the word), and the same again after a single line end.
ODD = (r"<\||[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
       r"\x{1c}-\x{1f}]")
LOOSE = r"|[\t\n\v\f\r ] (?:[\t\n\v\f\r ]|\z)"
_LATIN = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+"
_MARKS = r"[!-&(-/:-@\[-`{-~]*"
WORD = (rf"^(?P<word>{_LATIN})(?P<marks>{_MARKS})"
        rf"(?:(?P<line>\n)(?P<next>{_LATIN})(?P<more>{_MARKS}))?$")


def gather(ids: np.ndarray, lengths: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of the pieces named by `index` in a row, where each begins and the end)."""
    # A block is far below 2^31 ids, so four bytes hold their places.
    lengths = lengths.astype(np.int32)
    starts = np.cumsum(lengths, dtype=np.int32) - lengths
    counts = lengths[index]
    ends = np.zeros(len(index) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    places = np.repeat(starts[index] - ends[:-1], counts)
    places += np.arange(ends[-1], dtype=np.int32)
    return ids[places], ends


class Encoder:
    """Encodes columns of texts; `definition` is the tokenizer's JSON.

    `spaced` tokenizers put a single leading space into the piece that follows it;
    others drop white space and lower the text.
    """

    def __init__(self, definition: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.spaced = spaced

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _words(self, pieces: list[str], between: str | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids of each piece); many pieces to a call.

        Latin words may be put together: `between` spaces, where a spaced tokenizer
        takes the space into the word, or line ends, which are dropped again. Other
        pieces are given as a list.
        """
        ids, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(pieces), CALL):
            part = pieces[at:at + CALL]
            if between is None:
                made = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            else:
                text = between.join(part)
                made = self.tokenizer.encode(
                    " " + text if self.spaced and between == " " else text,
                    add_special_tokens=False)
            own, words = np.array(made.ids, np.uint32), np.array(made.word_ids, np.int64)
            if between == "\n":
                own, words = own[words % 2 == 0], words[words % 2 == 0] // 2
            ids.append(own)
            lengths.append(np.bincount(words, minlength=len(part)))
        return np.concatenate(ids), np.concatenate(lengths)

    def _dictionary(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids and lengths of different pieces, each after a space if `spaced`."""
        found = pc.extract_regex(pieces, WORD)
        latin = pc.is_valid(found).to_numpy(zero_copy_only=False)
        fields = pc.drop_null(found)
        words, marks, lines, others, more = (
            pc.struct_field(fields, [i]).dictionary_encode() for i in range(5))
        lead = " " if self.spaced else ""
        rest = pieces.filter(pa.array(~latin)).to_pylist()
        columns = [words, marks, lines, others, more]
        lists = [c.dictionary.to_pylist() for c in columns]
        # An empty field stands for nothing; only the first is never empty.
        tables = [self._words(lists[0], " ")]
        tables += [self._words([x for x in names if x], "\n" if i == 2 else None)
                   for i, names in enumerate(lists[1:])]
        tables.append(self._words([lead + p if p or self.spaced else p for p in rest]))
        ids = np.concatenate([t[0] for t in tables])
        lengths = np.append(np.concatenate([t[1] for t in tables]), 0)
        starts = np.cumsum([0, *(len(t[1]) for t in tables)])
        index = np.full((len(pieces), 5), len(lengths) - 1, np.int64)
        for i, (column, names) in enumerate(zip(columns, lists)):
            real = np.array([bool(x) for x in names], bool)
            place = np.where(real, starts[i] + np.cumsum(real) - 1, len(lengths) - 1)
            if len(names):
                index[latin, i] = place[column.indices.to_numpy()]
        index[~latin, 0] = np.arange(len(rest)) + starts[5]
        flat, ends = gather(ids, lengths, index.reshape(-1))
        return flat, np.diff(ends[::5])

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's ids begin and end)."""
        odd = pc.match_substring_regex(texts, ODD + (LOOSE if self.spaced else ""))
        safe = pc.if_else(odd, "", texts)
        cut = (pc.split_pattern(safe, " ") if self.spaced
               else pc.ascii_split_whitespace(pc.ascii_lower(safe)))
        edges = cut.offsets.to_numpy().astype(np.int64)
        pieces = cut.flatten()
        edges = edges - edges[0]
        coded = pieces.dictionary_encode()
        index = coded.indices.to_numpy().copy()
        ids, lengths = self._dictionary(coded.dictionary)
        if self.spaced and len(texts):
            # The first piece of a text has no space before it.
            opening = pieces.take(pa.array(edges[:-1])).dictionary_encode()
            more_ids, more_lengths = self._words(opening.dictionary.to_pylist())
            index[edges[:-1]] = opening.indices.to_numpy() + len(lengths)
            ids, lengths = np.concatenate([ids, more_ids]), np.concatenate([lengths, more_lengths])
        del safe, cut, pieces, coded
        flat, ends = gather(ids, lengths, index)
        bounds = ends[edges].astype(np.int64)
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(whole):
            parts, sizes, at = [], np.diff(bounds), 0
            for number in whole.tolist():
                made = self.whole(texts[number].as_py())
                parts += [flat[at:bounds[number]], made]
                at, sizes[number] = bounds[number], len(made)
            flat = np.concatenate([*parts, flat[at:]])
            bounds = np.concatenate([[0], np.cumsum(sizes)])
        return flat, bounds


def text_blocks(
    batches, column: str, block_bytes: int = BLOCK_BYTES,
) -> Iterator[tuple[pa.RecordBatch, pa.StringArray]]:
    """Arrow batches cut into blocks of about `block_bytes`, with their texts; null is empty."""
    for batch in batches:
        step = max(1, block_bytes // max(1, batch.nbytes // max(1, batch.num_rows)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            texts = part.column(part.schema.get_field_index(column))
            yield part, pc.fill_null(texts, "")
    pa.default_memory_pool().release_unused()
