"""N-grams and multiset overlap inside one row, without exploding to a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

GRAM_SEPARATOR = " "  # tokens never contain whitespace, so a blank cannot occur inside one


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a lambda variable, not a copied expression)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ngrams(tokens: Column, n: int) -> Column:
    """All n-grams of a token array as blank-joined strings, in order, duplicates kept."""
    if n == 1:
        return tokens
    shifted = [F.slice(tokens, i + 1, F.size(tokens) - (n - 1)) for i in range(n)]
    grams = F.transform(
        F.arrays_zip(*[s.alias(f"g{i}") for i, s in enumerate(shifted)]),
        lambda z: F.concat_ws(GRAM_SEPARATOR, *[z[f"g{i}"] for i in range(n)]),
    )
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def clipped_overlap(left: Column, right: Column) -> Column:
    """Size of the multiset intersection of two string arrays, inside the row.

    When one side has no repeats this is the size of the set intersection. Otherwise both sides are
    tagged, sorted together and folded once with a constant-size state: O(n log n) in the row's length.
    """

    def measure(sides: Column) -> Column:
        l, r = sides["l"], sides["r"]
        distinct = (F.size(F.array_distinct(l)) == F.size(l)) | (
            F.size(F.array_distinct(r)) == F.size(r)
        )
        return F.when(distinct, F.size(F.array_intersect(l, r))).otherwise(_folded_overlap(l, r))

    return let(F.struct(left.alias("l"), right.alias("r")), measure)


def _folded_overlap(left: Column, right: Column) -> Column:
    tag = lambda side: lambda g: F.struct(g.alias("g"), F.lit(side).alias("s"))
    merged = F.sort_array(F.concat(F.transform(left, tag(0)), F.transform(right, tag(1))))
    start = F.struct(
        F.lit(None).cast("string").alias("g"),
        F.lit(0).alias("l"),
        F.lit(0).alias("r"),
        F.lit(0).alias("t"),
    )

    def step(acc: Column, item: Column) -> Column:
        same = acc["g"].eqNullSafe(item["g"])
        is_left = item["s"] == 0
        return F.struct(
            item["g"].alias("g"),
            (F.when(same, acc["l"]).otherwise(0) + F.when(is_left, 1).otherwise(0)).alias("l"),
            (F.when(same, acc["r"]).otherwise(0) + F.when(is_left, 0).otherwise(1)).alias("r"),
            (acc["t"] + F.when(same, F.lit(0)).otherwise(F.least(acc["l"], acc["r"]))).alias("t"),
        )

    return F.aggregate(merged, start, step, lambda acc: acc["t"] + F.least(acc["l"], acc["r"]))
