"""A lookup join that survives hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HEAVY_KEYS = 10_000
HEAVY_ROWS = 10_000


def heavy_of(
    counts: DataFrame, key: str, count: str, total: Column, min_rows: int | None = None
) -> DataFrame:
    """``(key, __salts)``: the most frequent keys of a count table and into how many parts each is cut.

    ``total`` is the sum of the counts. A key gets as many parts as keep every part below 1 / ``HEAVY_KEYS`` of the rows, so there are
    at most ``2 * HEAVY_KEYS`` parts; any other key holds less than that share, or fewer than ``min_rows`` (``HEAVY_ROWS``).
    """
    min_rows = HEAVY_ROWS if min_rows is None else min_rows
    often = counts.where(F.col(count) >= min_rows).orderBy(F.desc(count), key).limit(HEAVY_KEYS)
    part = F.greatest(total / HEAVY_KEYS, F.lit(min_rows / 8))
    return often.select(key, F.ceil(F.col(count) / part).cast("int").alias("__salts"))


def heavy_keys(rows: DataFrame, key: str, min_rows: int | None = None) -> DataFrame:
    """``heavy_of`` the counts of ``rows``. Counting combines on the map side."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.select(F.coalesce(F.sum("__n"), F.lit(0)).alias("__total")).scalar()
    return heavy_of(counts, key, "__n", total, min_rows)


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Column,
    how: str = "inner",
    heavy: DataFrame | None = None,
) -> DataFrame:
    """``rows`` joined to a ``lookup`` of few rows per key, inner or left.

    Rows of a heavy key are spread over its parts by a hash of ``spread_by``, and only the lookup rows of
    those keys are repeated, so one key may hold any share of the rows. Rows without a key, which meet nothing, are spread
    alike. The list of heavy keys is bounded and travels by broadcast.
    """
    heavy = F.broadcast(heavy_keys(rows, key) if heavy is None else heavy)
    parts = F.when(F.col(key).isNull(), F.lit(HEAVY_KEYS)).otherwise(F.coalesce(F.col("__salts"), F.lit(1)))
    salt = F.pmod(F.xxhash64(spread_by), parts).cast("int")
    every = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    left = rows.join(heavy, key, "left").withColumn("__salt", salt).drop("__salts")
    right = lookup.join(heavy, key, "left").withColumn("__salt", F.explode(every)).drop("__salts")
    return left.join(right, [key, "__salt"], how).drop("__salt")
