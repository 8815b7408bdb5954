"""Vectors: hashed TF-IDF embedding, normalisation, exact nearest neighbours, model hook."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vitrine.functions import fixed
from vitrine.functions.text import split_words
from vitrine.operators.topk import BLOCK_CELLS, BROADCAST_CELLS, InnerProduct, blocked_topk

VECTOR = T.ArrayType(T.FloatType())
TEXT_ROWS = 1000  # texts whose buckets a task holds at once


def l2_normalize(vector: Column) -> Column:
    """Unit-length vector in double precision; a zero vector stays zero."""
    squares = F.aggregate(
        vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.when(squares == 0, F.transform(vector, lambda x: x.cast("double"))).otherwise(
        F.element_at(
            F.transform(
                F.array(F.sqrt(squares)),
                lambda norm: F.transform(vector, lambda x: x.cast("double") / norm),
            ),
            1,
        )
    )


def _cells(texts: pa.Array, dim: int) -> np.ndarray:
    """``text number * dim + bucket`` of every token of lower-case texts; each distinct token is hashed once."""
    row, words = split_words(texts)
    coded = words.dictionary_encode()
    bucket = np.array(
        [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dim for t in coded.dictionary.to_pylist()],
        dtype=np.int64,
    )
    return row * dim + bucket[coded.indices.to_numpy(zero_copy_only=False)]


def texts_per_bucket(texts: pa.Array, dim: int) -> np.ndarray:
    """In how many of the texts each bucket occurs."""
    held = np.zeros(len(texts) * dim, dtype=bool)
    held[_cells(texts, dim)] = True
    return np.count_nonzero(held.reshape(len(texts), dim), axis=0)


class HashedTfidf:
    """Text to a unit vector of ``dim`` floats: hashed term counts times smoothed idf.

    ``fit`` is one aggregation of ``dim + 1`` numbers a task; ``transform`` works row by row in
    Arrow batches and shuffles nothing.
    """

    def __init__(self, idf: list[float]):
        self.idf = idf
        self.dim = len(idf)

    @classmethod
    def fit(cls, df: DataFrame, col: str, dim: int = fixed.EMBEDDING_DIM) -> "HashedTfidf":
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(dim + 1, dtype=np.int64)  # one extra entry counts the texts
            for batch in batches:
                for start in range(0, batch.num_rows, TEXT_ROWS):
                    counts[:dim] += texts_per_bucket(batch.column(0).slice(start, TEXT_ROWS), dim)
                counts[dim] += batch.num_rows
            bucket = np.append(np.arange(dim), -1)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(counts)], ["bucket", "count"])

        counted = (
            df.select(F.lower(F.col(col)).alias("text"))
            .mapInArrow(count, "bucket bigint, count bigint")
            .groupBy("bucket")
            .agg(F.sum("count").alias("count"))
            .collect()  # at most dim + 1 rows
        )
        seen = {row["bucket"]: row["count"] for row in counted}
        n = seen.get(-1, 0)
        return cls([math.log((1 + n) / (1 + seen.get(b, 0))) + 1 for b in range(dim)])

    def transform(self, text: Column) -> Column:
        idf, dim = np.array(self.idf), self.dim

        @F.arrow_udf(VECTOR)
        def embed(texts: pa.Array) -> pa.Array:
            parts = [pa.array([], pa.list_(pa.float32()))]
            for start in range(0, len(texts), TEXT_ROWS):
                some = texts.slice(start, TEXT_ROWS)
                weights = np.bincount(_cells(some, dim), minlength=len(some) * dim).reshape(len(some), dim) * idf
                norms = np.sqrt(np.cumsum(weights * weights, axis=1)[:, -1:])
                norms[norms == 0] = 1.0
                unit = (weights / norms).astype(np.float32)
                offsets = np.arange(0, unit.size + 1, dim, dtype=np.int32)
                parts.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel())))
            return pa.concat_arrays(parts)

        return embed(F.lower(text))


def sparse_form(df: DataFrame, col: str = "embedding") -> DataFrame:
    """Long form ``(row_id, bucket, weight)`` of the non-zero numbers."""
    return df.select("row_id", F.posexplode(col).alias("bucket", "weight")).where("weight <> 0")


def knn(
    queries: DataFrame,
    index: DataFrame,
    k: int | Column,
    dim: int | None = None,
    broadcast_cells: int = BROADCAST_CELLS,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """Exact top-k by inner product: ``(query_id, row_id, score, rank)``, ties by ``row_id``.

    ``k`` is a number or a column of ``queries``.
    """
    if dim is None:
        sized = index.select(F.size("embedding").alias("dim")).first()
        dim = sized["dim"] if sized else 1
    return blocked_topk(
        queries,
        index,
        k,
        InnerProduct(dim),
        broadcast_cells=broadcast_cells,
        block_cells=block_cells,
    )


def index_stats(index: DataFrame) -> DataFrame:
    """Vector count and dimension (both ends, which must agree)."""
    size = F.size("embedding")
    return index.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.min(size).alias("min_dim"),
        F.max(size).alias("max_dim"),
    )


def apply_model(
    df: DataFrame,
    col: str,
    make_fn,
    return_type: T.DataType,
    out: str = "prediction",
    batch_size: int = fixed.MODEL_BATCH,
) -> DataFrame:
    """Run a user's model over a column.

    ``make_fn()`` loads the model and returns a function from a NumPy batch to predictions; it is called
    once per Python worker, and Spark feeds it batches of ``batch_size`` rows.
    """
    predict = predict_batch_udf(make_fn, return_type=return_type, batch_size=batch_size)
    return df.withColumn(out, predict(F.col(col)))
