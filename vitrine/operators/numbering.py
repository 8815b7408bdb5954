"""Consecutive numbers in a given order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.session import materialize


def number_rows(df: DataFrame, order: list[Column], name: str, first: int = 0) -> DataFrame:
    """Adds ``name``: ``first``, ``first + 1``, ... by ``order``.

    Rows are range-partitioned by ``order`` and written once; each range is numbered by itself and moved by the sizes
    of the ranges before it, one number a range. Rows that are equal in ``order`` stay in one range.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ranged = materialize(ranged, name)
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    nth = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    numbered = ranged.withColumn("__nth", nth).join(F.broadcast(starts), "__range")
    return numbered.withColumn(name, F.col("__start") + F.col("__nth") + (first - 1)).drop(
        "__range", "__nth", "__start"
    )
