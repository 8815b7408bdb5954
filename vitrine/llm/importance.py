"""Importance resampling towards a target: rows whose n-grams are likelier in the target are drawn more often.

Every text is cut into words and n-grams by Arrow kernels, a slice of a batch at a time: ``ascii_lower``,
``split_pattern_regex`` and ``list_flatten`` give the words, ``dictionary_encode`` numbers the distinct ones, and pairs of
numbers shifted against each other form the longer n-grams. The CRC of a distinct n-gram is its first part's CRC continued, so no
n-gram is ever spelled out. Its remainder is the n-gram's bucket. A task counts its buckets and hands on one row for each;
the gains that follow (one number a bucket) are taken by every occurrence and summed over the runs of a text.

A draw without replacement is a top-k of weights plus Gumbel noise, and the noise is a hash of the id, so a row's score depends
on nothing but its own text, its id and the corpus counts. Ranks are numbered by ranges, not in one task.

Null and empty texts have no words, no features and weight 0. Rows that repeat an id are judged by their own text; of equal scores the
smaller id goes first, a missing id before all, then fewer features. Rows equal in all of it take neighbouring ranks. Empty documents give
an empty result; without target texts every count of the target is zero. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import stored
from vitrine.operators.numbering import number_rows

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what no word holds, once A-Z are lower
SLICE_BYTES = 8 << 20


@dataclass(frozen=True)
class Setting:
    """N-grams of 1 to ``longest`` words, ``buckets`` of them told apart (this bounds what the driver and every task hold)."""

    longest: int = 1
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 10
    seed: str = "2024"


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """``(first row, rows)``: runs of whole texts of about ``limit`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, texts.slice(first, last - first)
        first = last


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and number of each word in order, and the distinct words by number."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SPLIT)
    words, rows = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(words, "")
    coded = pc.dictionary_encode(words.filter(real))
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return rows.filter(real).to_numpy().astype(np.int64), coded.indices.to_numpy().astype(np.int64), coded.dictionary


def hashed_ngrams(texts: pa.Array, setting: Setting) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The number of words of each text, and for every length ``(row, bucket)`` of each n-gram in order."""
    rows, numbers, distinct = words_of(texts)
    spelled = [w.as_buffer().to_pybytes() for w in distinct.cast(pa.binary())]
    crcs = np.fromiter((zlib.crc32(w) for w in spelled), np.int64, len(spelled))
    ids, found = numbers, [(rows, crcs[numbers] % setting.buckets)]
    for n in range(2, setting.longest + 1):
        ids, added, inside = ids[:-1], numbers[n - 1 :], rows[: max(0, len(rows) - n + 1)] == rows[n - 1 :]
        pairs, ids = np.unique(ids * max(1, len(spelled)) + added, return_inverse=True)
        starts, ends = np.divmod(pairs, max(1, len(spelled)))
        grown = (zlib.crc32(b" " + spelled[e], int(crcs[s])) for s, e in zip(starts, ends, strict=True))
        crcs = np.fromiter(grown, np.int64, len(pairs))
        found.append((rows[: len(inside)][inside], crcs[ids[inside]] % setting.buckets))
    return np.bincount(rows, minlength=len(texts)), found


def bucket_counts(texts: DataFrame, setting: Setting, text_column: str = "text") -> DataFrame:
    """``(bucket, n)``: features of all ``texts`` by bucket; a task hands on at most ``buckets`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(setting.buckets, np.int64)
        for batch in batches:
            for _, part in slices(batch.column(0)):
                for _, buckets in hashed_ngrams(part, setting)[1]:
                    total += np.bincount(buckets, minlength=setting.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])

    counted = texts.select(F.col(text_column).cast("string")).mapInArrow(count, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, setting: Setting, text_column: str = "text") -> np.ndarray:
    """Thousandths of the log-ratio of each bucket's share in the target to its share in the documents, rounded down."""
    counts = []
    for texts in (docs, target):
        found = bucket_counts(texts, setting, text_column).toPandas()  # a row a bucket
        held = np.zeros(setting.buckets)
        held[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(float)
        counts.append(held)
    source, wanted = counts
    ratio = (wanted + 1) * (source.sum() + setting.buckets) / ((source + 1) * (wanted.sum() + setting.buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, setting: Setting, id_column: str, text_column: str) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = np.zeros((3, batch.num_rows), np.int64)
            for first, part in slices(batch.column(1)):
                here = slice(first, first + len(part))
                columns[0, here], found = hashed_ngrams(part, setting)
                for rows, buckets in found:
                    ends = np.searchsorted(rows, np.arange(len(part)), "right")
                    sums = np.concatenate([[0], np.cumsum(pc.take(pa.array(gain), pa.array(buckets)).to_numpy())])
                    columns[1, here] += np.diff(ends, prepend=0)
                    columns[2, here] += np.diff(sums[ends], prepend=0)
            named = ["n_words", "n_features", "weight"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], ["doc_id", *named])

    kinds = "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    rows = docs.select(F.col(id_column).cast("bigint"), F.col(text_column).cast("string"))
    return rows.mapInArrow(measure, kinds)


def noise(id_column: str, seed: str) -> Column:
    """Thousandths of a Gumbel variate, rounded down, from the first 32 bits of a digest of the id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    setting: Setting = Setting(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every row of ``docs``; the drawn ones have a ``rank``.

    ``setting.percent`` of the rows with at least ``min_words`` words are drawn, rounded down.
    """
    gain = gains(docs, target, setting, text_column)
    weighed = weigh(docs, gain, setting, id_column, text_column)
    scored = stored(weighed.withColumn("score", F.col("weight") + noise("doc_id", setting.seed)), "importance-scores")
    long_enough = F.col("n_words") >= setting.min_words
    eligible = scored.where(long_enough)
    drawn = setting.percent * eligible.count() // 100
    order = [F.desc("score"), F.col("doc_id"), F.col("n_features")]
    ranked = number_rows(eligible, order, "rank", first=1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("bigint")))
    others = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(others).select("doc_id", "n_features", "weight", "score", "rank")
