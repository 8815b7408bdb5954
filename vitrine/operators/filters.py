"""Post-retrieval filters that never empty a request's hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def filter_with_fallback(hits: DataFrame, col: str, wanted: str) -> DataFrame:
    """Keep hits whose ``col`` contains the request's ``wanted`` text, ignoring case.

    All hits of a request stay when ``wanted`` is empty or none of its hits matches. A request has at
    most top-k hits, so each window partition is small by construction.
    """
    want = F.lower(F.coalesce(F.col(wanted), F.lit("")))
    match = F.contains(F.lower(F.coalesce(F.col(col), F.lit(""))), want)
    per_query = Window.partitionBy("query_id")
    return (
        hits.withColumn("__match", match)
        .withColumn("__any", F.max("__match").over(per_query))
        .where((want == "") | F.col("__match") | ~F.col("__any"))
        .drop("__match", "__any")
    )


def apply_filters(hits: DataFrame) -> DataFrame:
    """Colour filter, then category filter on what the first one left; one exchange serves both."""
    by_color = filter_with_fallback(hits, "colors_extracted", "color")
    return filter_with_fallback(by_color, "name_clean", "category")
