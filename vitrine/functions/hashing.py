"""Deterministic hashing: the same rows are chosen whatever the partitioning or the engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_RANGE = 1 << 32


def seeded_digest(key: Column, seed: int) -> Column:
    """md5 text of ``seed:key``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def digest_number(digest: Column) -> Column:
    """The first 32 bits of an md5 text as a non-negative bigint."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
