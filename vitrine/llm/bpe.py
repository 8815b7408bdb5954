"""BPE encoding and decoding through a table of distinct words.

A text is split at ASCII white space, which no token of a word-level BPE crosses. Each task keeps a table of the distinct
words it has met, without the signs after them, with their ids: a word is encoded by the tokenizer once, and its ids are
joined back to every position where it stands, by Arrow and NumPy. Decoding joins ids to their pieces and pieces by single
spaces. The table is emptied when it holds ``TABLE_WORDS`` words, so memory is bounded and results stay the same.

The words' table is kept per task rather than once for the corpus: see the README for what a corpus-wide join moves.

Null and empty texts have no ids and decode to the empty text. Ids outside the vocabulary have no piece and are left out.
Rows are independent: repeated rows give equal results, an empty table an empty one. The tokenizer must drop white
space and must have no decoder of its own, which :func:`tokenizer` checks.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from vitrine.llm.common import give_back, per_worker, slices

TABLE_WORDS = 400_000


def tokenizer(path: str):
    """The tokenizer of a file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    if made.decoder is not None:
        raise ValueError("a tokenizer without a decoder is expected: pieces are joined by spaces")
    made.no_truncation()
    made.no_padding()
    if made.encode("a b", add_special_tokens=False).ids != [
        i for w in "ab" for i in made.encode(w, add_special_tokens=False).ids
    ]:
        raise ValueError("a tokenizer whose tokens end with the word is expected")
    return made


# Signs that the tokenizer keeps apart from a word of letters before them; an apostrophe may belong to it.
_SIGNS = ".,!?;:%&#$*|\""
MARKED = "\u0130"  # the one letter whose lower case ends in a mark
JOINED = 500  # words of letters that are encoded by one call
EACH = 2_000  # other words whose encodings, a kilobyte each, are held at once


class WordTable:
    """The parts of words met so far and their ids: Arrow texts, and one flat array with a start and a length per part."""

    def __init__(self, path: str) -> None:
        self.encoder = tokenizer(path)
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([""], pa.large_string())
        self.flat, self.used = np.empty(1 << 16, np.int32), 0
        self.starts, self.lengths = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def add(self, words: pa.Array) -> np.ndarray:
        """New rows for distinct words that the table lacks; returns their numbers."""
        given = words.to_pylist()
        letters = np.array([w.isalpha() for w in given], dtype=bool)
        order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        alone = [given[i] for i in order[: letters.sum()]]
        found = [self.encode_letters(alone[at : at + JOINED]) for at in range(0, len(alone), JOINED)]
        found.append(self.encode_each([given[i] for i in order[len(alone) :]]))
        ids, lengths = (np.concatenate(column) for column in zip(*found, strict=True))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        rows = np.empty(len(given), np.int64)
        rows[order] = len(self.known) + np.arange(len(given))
        self.known = pa.concat_arrays([self.known, words.take(pa.array(order))])
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used += len(ids)
        return rows

    @staticmethod
    def split(words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Of each word its letters, lowered, and the signs after them, which have ids of their own; any other word stays whole."""
        core = pc.utf8_rtrim(words, _SIGNS)
        # A capital may leave a mark when lowered, and the tokenizer joins marks with the signs that follow.
        apart = pc.and_(pc.utf8_is_alpha(core), pc.invert(pc.ends_with(core, MARKED)))
        cut = pc.subtract(pc.binary_length(words), pc.binary_length(core))  # signs are of one byte
        cut = pc.if_else(apart, cut, pa.scalar(0, cut.type)).to_numpy(zero_copy_only=False)
        order, signs = np.argsort(cut, kind="stable"), []
        sizes, first = np.unique(cut[order], return_index=True)
        for size, start, end in zip(sizes.tolist(), first, [*first[1:], len(cut)], strict=True):
            some = words.take(pa.array(order[start:end]))
            signs.append(pc.utf8_slice_codeunits(some, -size) if size else pa.array([""] * len(some), words.type))
        back = np.empty(len(cut), np.int64)
        back[order] = np.arange(len(cut))
        after = pa.concat_arrays(signs or [words]).take(pa.array(back))
        return pc.if_else(apart, pc.ascii_lower(core), words), after

    def encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of words of letters: they are one token group each, so many can be encoded as one text."""
        encoded = self.encoder.encode(" ".join(words), add_special_tokens=False)
        counts = np.bincount(np.array(encoded.word_ids), minlength=len(words))
        if len(counts) != len(words) or not counts.all():  # a letter that falls apart when normalised
            return self.encode_each(words)
        return np.array(encoded.ids, np.int32), counts.astype(np.int64)

    def encode_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = (words[at : at + EACH] for at in range(0, len(words), EACH))
        ids = [e.ids for part in parts for e in self.encoder.encode_batch_fast(part, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum())), lengths

    def rows_of(self, words: pa.Array) -> np.ndarray:
        """The table's row of each (distinct) word."""
        if len(self.known) + len(words) > TABLE_WORDS:
            self.clear()
        found = pc.index_in(words, value_set=self.known)
        missing = pc.is_null(found)
        rows = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if pc.any(missing).as_py():
            rows[missing.to_numpy(zero_copy_only=False)] = self.add(words.filter(missing))
        return rows

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (with the end at last)."""
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
        flat = words.flatten().dictionary_encode()
        # The split leaves empty words at the ends; the tokenizer gives them no ids.
        parts = pa.concat_arrays(self.split(flat.dictionary)).dictionary_encode()
        rows = self.rows_of(parts.dictionary)[parts.indices.to_numpy()]
        rows = rows.reshape(2, -1).T.ravel()  # letters and signs of a word side by side
        ids, ends = _listed(self.flat, self.starts[rows], self.lengths[rows])
        ends = ends[::2]  # of whole words
        word = flat.indices.to_numpy()
        ids, ends = _listed(ids, ends[:-1][word], np.diff(ends)[word])
        return ids, ends[bounds]


def _listed(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``flat`` one after the other, and where each begins (with the end at last)."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    places = np.repeat(starts - ends[:-1], lengths)
    places += np.arange(ends[-1])
    return flat[places], ends


@contextmanager
def word_table(path: str) -> Iterator[WordTable]:
    """The worker's table; its words are given up at the end, as an idle worker would keep them through the stages of others."""
    table = per_worker(("bpe", "words", path), lambda: WordTable(path))
    try:
        yield table
    finally:
        table.clear()
        give_back()


Use = Callable[[pa.RecordBatch, np.ndarray, np.ndarray], pa.RecordBatch]


def map_ids(docs: DataFrame, path: str, use: Use, schema, text_column: str = "text") -> DataFrame:
    """``use(rows, ids, bounds)`` for all rows, a few MB of text at a time.

    ``ids`` are those of all the rows' texts; text ``i`` has ``ids[bounds[i] : bounds[i + 1]]``.
    """
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with word_table(path) as table:
            for batch in batches:
                for start, end in slices(batch.column(place)):
                    part = batch.slice(start, end - start)
                    yield use(part, *table.encode(part.column(place)))

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text_column: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text (a column ``out`` of the input is replaced)."""
    source = docs.drop(out)
    schema = T.StructType([*source.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def lists(rows: pa.RecordBatch, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        column = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([*rows.columns, column], [*rows.schema.names, out])

    return map_ids(source, path, lists, schema, text_column)


def piece_table(path: str) -> pa.Array:
    """Pieces by id; null where an id has none. As long as the vocabulary."""
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    pieces: list[str | None] = [None] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        pieces[number] = piece
    return pa.array(pieces, pa.string())


def pieces_of(path: str) -> pa.Array:
    return per_worker(("bpe", "pieces", path), lambda: piece_table(path))


def numbers_of(path: str) -> pa.Array:
    """Decimal texts by id."""
    return per_worker(("bpe", "numbers", path), lambda: pa.array([str(i) for i in range(len(pieces_of(path)))]))


def joined(ids: np.ndarray, bounds: np.ndarray, table: pa.Array) -> pa.Array:
    """For each list of ids its entries of ``table``, joined by spaces; ids without an entry are left out."""
    known = (ids >= 0) & (ids < len(table))
    if not known.all():
        bounds = np.concatenate([[0], np.cumsum(known)])[bounds]
        ids = ids[known]
    parts = table.take(pa.array(ids))
    if parts.null_count:
        kept = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        parts, bounds = parts.drop_null(), np.concatenate([[0], np.cumsum(kept)])[bounds]
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), parts), " ")


def decode(rows: DataFrame, path: str, ids_column: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of each list of ids; a null list decodes to the empty text."""

    @F.arrow_udf("string")
    def join(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pieces_of(path)
        for batch in batches:
            texts = [pa.array([], pa.string())]
            for start in range(0, len(batch), 500):
                lists = batch.slice(start, 500)
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
                texts.append(joined(ids, np.concatenate([[0], np.cumsum(sizes)]), table))
            yield pa.concat_arrays(texts)

    return rows.withColumn(out, join(F.col(ids_column)))
