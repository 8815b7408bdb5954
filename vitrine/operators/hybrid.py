"""Merge of dense and keyword hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def merge_hits(
    dense: DataFrame, keyword: DataFrame, k: int | Column, once_per_name: Column | None = None
) -> DataFrame:
    """Dense hits in rank order, then keyword hits; first per name; first k.

    Both inputs have ``(query_id, rank, row_id, name_clean, score)`` and may have more columns in
    common. A query brings at most the two fetch limits of rows, so the windows are small. Scores of the
    two sources are on different scales; ``source`` tells which one a row has. Where ``once_per_name`` is false a
    query's dense hits stand as they are. ``k`` and ``once_per_name`` may be columns of the hits.
    """
    both = dense.withColumn("source", F.lit("dense")).unionByName(
        keyword.withColumn("source", F.lit("keyword"))
    )
    order = [F.col("source"), F.col("rank")]  # 'dense' sorts before 'keyword'
    per_name = Window.partitionBy("query_id", "name_clean").orderBy(*order)
    per_query = Window.partitionBy("query_id").orderBy(*order)
    return (
        both.repartition("query_id")  # one exchange for both windows
        .withColumn("__nth", F.row_number().over(per_name))
        .where((F.col("__nth") == 1) if once_per_name is None else (F.col("__nth") == 1) | ~once_per_name)
        .withColumn("__pos", F.row_number().over(per_query))
        .where(F.col("__pos") <= k)
        .withColumn("rank", F.col("__pos"))
        .drop("__nth", "__pos")
    )
