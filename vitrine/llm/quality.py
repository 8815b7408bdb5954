"""Quality by a regularised quadratic discriminant over document statistics.

A text becomes one vector of statistics: shares of kinds of characters, shapes and repetition of words and lines, and lengths. Shares
are taken against the text's size plus a constant, so that short texts stay near zero, and go through a square root; lengths go
through a logarithm. Each class is a normal distribution with its own covariance, drawn towards the spread of both classes together
(``shrinkage``), so that statistics which hardly vary in one class don't make it brittle. The score is the logistic of the difference
of the two log-densities (Mahalanobis distance and determinant) plus the log-odds of the classes. The Cholesky factors are made once
and travel with the model: two matrices of one row a statistic.

The text is read once: vectors are stored, labelled ones are summed into class moments in the tasks (mergeable, so all labelled rows
count, of rows with equal vectors and labels one), and all are scored.

Null and empty texts have the vector of zeros and are scored by it. Repeated rows are scored alike; a label given twice counts as the
larger. Without labels of both classes the score is the share of good rows among the labels (0.5 without any). Empty tables give an
empty result. Columns other than id and text are left out, whatever their names; labels, language and source are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import stored
from vitrine.llm.importance import slices

# Patterns whose matches are counted; the share is against the text's characters.
CHARACTERS = {
    "upper": r"\p{Lu}",
    "digit": r"\p{N}",
    "symbol": r"[^\p{L}\p{M}\p{N}\s.,;:!?'\"()\-]",
    "stop": r"[.!?]",
    "shout": r"!",
    "comma": r"[,;:]",
    "bar": r"\|",
    "line": r"\n",
    "mark": r"[^\p{L}\p{M}\p{N}\s][^\p{L}\p{M}\p{N}\s]",
}
STATISTICS = (*CHARACTERS, "same_next", "seen_before", "lone", "repeated_line", "word_length", "words", "line_words")
ROOM = 20.0  # characters or words that a text counts more than it has


@dataclass(frozen=True)
class Model:
    """Class means, inverted Cholesky factors and constants of bad (0) and good (1) rows; ``None`` stands for no such class."""

    share: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    constants: np.ndarray | None = None

    def score(self, vectors: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(vectors), self.share)
        logs = [
            c - 0.5 * np.square((vectors - m) @ f.T).sum(axis=1)
            for m, f, c in zip(self.means, self.factors, self.constants, strict=True)
        ]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -500, 500)))


def _repeats(rows: np.ndarray, numbers: np.ndarray, distinct: int, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers of each row, and those that equal the one before them in their row."""
    same = (rows[1:] == rows[:-1]) & (numbers[1:] == numbers[:-1])
    kinds = np.unique(rows * max(1, distinct) + numbers) // max(1, distinct)
    return np.bincount(kinds, minlength=texts), np.bincount(rows[1:][same], minlength=texts)


def _cut(texts: pa.Array, pattern: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    parts = pc.split_pattern_regex(texts, pattern)
    words, rows = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(words, "")
    coded = pc.dictionary_encode(words.filter(real))
    return rows.filter(real).to_numpy().astype(np.int64), coded.indices.to_numpy().astype(np.int64), coded.dictionary


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    texts, n = pc.fill_null(texts, ""), len(texts)
    chars = pc.utf8_length(texts).to_numpy().astype(float)
    found = {}
    for name, pattern in CHARACTERS.items():
        matches = pc.count_substring_regex(texts, pattern).to_numpy().astype(float)
        found[name] = np.sqrt(matches / (chars + ROOM))
    rows, numbers, distinct = _cut(texts, r"\s+")
    words = np.bincount(rows, minlength=n).astype(float)
    kinds, same = _repeats(rows, numbers, len(distinct), n)
    short = (pc.utf8_length(distinct).to_numpy() == 1)[numbers]
    found["same_next"] = np.sqrt(same / (words + ROOM))
    # Long texts repeat words anyway: distinct words are held against what a text of this length may repeat.
    found["seen_before"] = np.sqrt(np.maximum(0, words - kinds) / (words + ROOM))
    found["lone"] = np.sqrt(np.bincount(rows[short], minlength=n) / (words + ROOM))
    line_rows, lines, distinct_lines = _cut(texts, r"\n+")
    n_lines = np.bincount(line_rows, minlength=n).astype(float)
    line_kinds, _ = _repeats(line_rows, lines, len(distinct_lines), n)
    found["repeated_line"] = np.sqrt((n_lines - line_kinds) / (n_lines + 5))
    found["word_length"] = np.log1p((chars + 5 * ROOM) / (words + ROOM))
    found["words"] = np.log1p(words)
    found["line_words"] = np.log1p((words + ROOM) / (n_lines + 1))
    return np.column_stack([found[name] for name in STATISTICS])


def vectors(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, vector)`` of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [statistics(part) for _, part in slices(batch.column(1))]
            flat = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(STATISTICS)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), listed], ["doc_id", "vector"])

    rows = docs.select(F.col(id_column).cast("bigint"), F.col(text_column).cast("string"))
    return rows.mapInArrow(measure, "doc_id bigint, vector array<double>")


def moments(labelled: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products of the vectors of each class; ``labelled`` is ``(vector, quality)``."""
    size = len(STATISTICS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + size + size * size))
        for batch in batches:
            flat = np.asarray(pc.list_flatten(batch.column(0))).reshape(batch.num_rows, size)
            quality = np.asarray(batch.column(1))
            for k in (0, 1):
                x = flat[quality == k]
                sums[k] += np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
        places = np.tile(np.arange(sums.shape[1]), 2)
        columns = [np.repeat([0, 1], sums.shape[1]), places, sums.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["quality", "place", "value"])

    parts = labelled.select("vector", "quality").mapInArrow(add, "quality bigint, place bigint, value double")
    rows = parts.groupBy("quality", "place").agg(F.sum("value").alias("value")).toPandas()  # 2 x 273 numbers
    found = {}
    for k in (0, 1):
        own = rows[rows["quality"] == k].sort_values("place")["value"].to_numpy()
        if len(own) and own[0] > 0:
            found[k] = (int(own[0]), own[1 : 1 + size], own[1 + size :].reshape(size, size))
    return found


def fit(found: dict[int, tuple[int, np.ndarray, np.ndarray]], shrinkage: float) -> Model:
    """The discriminant of two classes' moments.

    A class's covariance is ``(1 - shrinkage)`` of its own and ``shrinkage`` of the diagonal spread of both classes.
    """
    total = sum(n for n, _, _ in found.values())
    if len(found) < 2:
        return Model(share=found[1][0] / total if 1 in found else 0.0 if found else 0.5)
    every = sum(np.diag(o) for _, _, o in found.values()) / total
    centre = sum(s for _, s, _ in found.values()) / total
    target = np.diag(np.maximum(every - centre**2, 1e-6))
    means, factors, constants = [], [], []
    for k in (0, 1):
        n, sums, outer = found[k]
        mean = sums / n
        own = outer / n - np.outer(mean, mean)
        lower = np.linalg.cholesky((1 - shrinkage) * own + shrinkage * target)
        means.append(mean)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(n / total) - np.log(np.diag(lower)).sum())
    return Model(found[1][0] / total, np.array(means), np.array(factors), np.array(constants))


def learn(measured: DataFrame, labels: DataFrame, shrinkage: float = 0.1) -> Model:
    """A model from ``measured (doc_id, vector)`` and ``labels (doc_id, quality)``; what must not be seen is filtered out before."""
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return fit(moments(measured.join(marked, "doc_id").select("vector", "quality").distinct()), shrinkage)


def score(measured: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``measured`` with ``score`` (0 to 1, higher: likelier good) and ``predicted`` (1 from ``threshold`` on)."""

    @F.arrow_udf("double")
    def rate(listed: pa.Array) -> pa.Array:
        flat = np.asarray(pc.list_flatten(listed)).reshape(len(listed), len(STATISTICS))
        return pa.array(model.score(flat))

    scored = measured.withColumn("score", rate("vector"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("vector")


def classify(docs: DataFrame, labels: DataFrame, shrinkage: float = 0.1, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, score, predicted)`` of every row of ``docs (doc_id, text)``."""
    measured = stored(vectors(docs), "quality-vectors")
    return score(measured, learn(measured, labels, shrinkage), threshold)


def held_out(id_column: str = "doc_id", folds: int = 5, fold_number: int = 0) -> Column:
    """True for the rows whose labels are for testing only."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds == fold_number, F.lit(False))
