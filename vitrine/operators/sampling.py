"""Seeded sampling and splitting by hash order: no random state, no full sort, no data shuffle."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions import fixed
from vitrine.functions.hashing import HASH_RANGE, digest_number, seeded_digest

SPLIT_BUCKETS = 1000
FINE_BUCKETS = 1 << 16


def sample_n(df: DataFrame, n: int, key: str, seed: int = fixed.SEED) -> DataFrame:
    """A fixed sample of n rows: the n smallest seeded digests (a distributed top-n)."""
    order = "__order"
    return (
        df.withColumn(order, seeded_digest(F.col(key), seed)).orderBy(order, key).limit(n).drop(order)
    )


def split(
    df: DataFrame, key: str, share: float = fixed.VALIDATION_SHARE, seed: int = fixed.SEED
) -> DataFrame:
    """Adds ``split`` ('train' / 'val') by a hash bucket of the key; row-local."""
    bucket = F.pmod(digest_number(seeded_digest(F.col(key), seed)), F.lit(SPLIT_BUCKETS))
    held_out = bucket < round(share * SPLIT_BUCKETS)
    return df.withColumn("split", F.when(held_out, "val").otherwise("train"))


def split_exact(
    df: DataFrame, key: str, share: float = fixed.VALIDATION_SHARE, seed: int = fixed.SEED
) -> DataFrame:
    """Adds ``split`` with exactly ``ceil(share * rows)`` validation rows.

    Validation is the rows with the smallest seeded digests. A histogram of 65,536 hash buckets finds
    the bucket in which the cut falls, only that bucket is ordered, and the cut itself is compared row by
    row; the rows are never sorted or moved.
    """
    cut = _cut(df, key, share, seed)
    held_out = _place(key, seed) <= cut if cut is not None else F.lit(False)
    return df.withColumn("split", F.when(held_out, "val").otherwise("train"))


def _place(key: str, seed: int) -> Column:
    return F.struct(seeded_digest(F.col(key), seed).alias("digest"), F.col(key).alias("key"))


def _cut(df: DataFrame, key: str, share: float, seed: int) -> Column | None:
    width = HASH_RANGE // FINE_BUCKETS
    bucket = F.floor(digest_number(seeded_digest(F.col(key), seed)) / width)
    sizes = dict(
        df.select(bucket.alias("bucket")).groupBy("bucket").count().collect()  # <= 65,536 rows
    )
    wanted = math.ceil(share * sum(sizes.values()))
    for number in sorted(sizes):
        if wanted <= sizes[number]:
            break
        wanted -= sizes[number]
    if not wanted:
        return None
    last = (
        df.where(bucket == number)
        .select(_place(key, seed).alias("place"))
        .orderBy("place")
        .limit(wanted)
        .agg(F.max("place").alias("place"))
    )
    return last.scalar()


def train_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == "train")


def validation_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == "val")


def complement(df: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``part``."""
    return df.join(part.select(key), key, "left_anti")


def preview(df: DataFrame, key: str, n: int = fixed.PREVIEW_ROWS) -> DataFrame:
    """The first n rows by key."""
    return df.orderBy(key).limit(n)
