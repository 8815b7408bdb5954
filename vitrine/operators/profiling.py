"""Table and length profiles: one pass each, exact quartiles a few."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions import fixed
from vitrine.session import materialize

HELD_VALUES = 65_536  # numbers that one task may sort
GRID = 1000  # places of a sketch


def _per_column(df: DataFrame, measure, value: str) -> DataFrame:
    """One aggregation over all columns, turned into ``(column_name, value)`` rows."""
    one_row = df.agg(*[measure(c).cast("bigint").alias(c) for c in df.columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias(value)) for c in df.columns]
    return one_row.select(F.inline(F.array(*cells)))


def profile_sentinel(df: DataFrame, sentinel: str = fixed.EMPTY_LIST) -> DataFrame:
    """Count of cells equal to the sentinel, per column."""
    return _per_column(
        df,
        lambda c: F.count_if(F.coalesce(F.col(c).cast("string") == sentinel, F.lit(False))),
        "n_sentinel",
    )


def profile_nulls(df: DataFrame) -> DataFrame:
    return _per_column(df, lambda c: F.count_if(F.col(c).isNull()), "n_nulls")


def profile_table(df: DataFrame) -> DataFrame:
    """``(ordinal, column_name, data_type, n_rows)``: shape, columns and types."""
    fields = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.inline(F.array(*fields)), "n_rows")


def exact_quantiles(df: DataFrame, col: str, shares: list[float], held: int = HELD_VALUES) -> list[float | None]:
    """Exact linear quantiles of a number column, without a map of its values.

    Every pass counts the rows below and inside a bracket around each wanted place and sketches the bracket; the sketch
    gives the next bracket, a few thousandths as wide in rows. A bracket of one value is the answer, and one of at most
    ``held`` rows is sorted. So the state of a pass is some sketches, and the number of passes grows with the logarithm of the
    rows (10 million distinct numbers: three). Nulls don't count; without values the quantiles are null.
    """
    value = F.col(col).cast("double")
    rows = df.select(value.alias("v")).where("v IS NOT NULL")
    whole = rows.agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not whole["n"]:
        return [None] * len(shares)
    places = {math.floor(s * (whole["n"] - 1)) for s in shares} | {math.ceil(s * (whole["n"] - 1)) for s in shares}
    brackets = {place: (whole["lo"], whole["hi"]) for place in places}
    found = {place: whole["lo"] for place in places if whole["lo"] == whole["hi"]}
    counts = {place: (0, whole["n"]) for place in places}
    grid = [i / GRID for i in range(GRID + 1)]
    while open_places := sorted(places - set(found)):
        measures = []
        for place in open_places:
            lo, hi = (F.lit(x) for x in brackets[place])
            inside = F.when((F.col("v") >= lo) & (F.col("v") <= hi), F.col("v"))
            few = counts[place][1] <= held
            spread = F.sort_array(F.collect_list(inside)) if few else F.percentile_approx(inside, grid, 10 * GRID)
            measures += [F.count_if(F.col("v") < lo).alias(f"below{place}"), F.count(inside).alias(f"inside{place}")]
            measures.append(spread.alias(f"spread{place}"))
        seen = rows.agg(*measures).first()
        for place in open_places:
            below, inside, spread = (seen[f"{name}{place}"] for name in ("below", "inside", "spread"))
            was, counts[place] = counts[place][1], (below, inside)
            if was <= held:
                found[place] = spread[place - below]
                continue
            at = (place - below) / max(1, inside - 1) * GRID
            near = spread[max(0, math.floor(at) - 2)], spread[min(GRID, math.ceil(at) + 2)]
            if near == brackets[place]:  # many copies of both ends: count the values between
                counted = rows.where(F.col("v").between(*near)).groupBy("v").count()
                ends = {r["v"]: r["count"] for r in counted.where(F.col("v").isin(*near)).collect()}
                if place - below < ends[near[0]]:
                    found[place] = near[0]
                elif place - below >= inside - ends[near[1]]:
                    found[place] = near[1]
                else:  # only what lies strictly between
                    inner = rows.where((F.col("v") > near[0]) & (F.col("v") < near[1]))
                    near = tuple(inner.agg(F.min("v"), F.max("v")).first())
            brackets[place] = near
            if near[0] == near[1]:
                found.setdefault(place, near[0])
    answers = []
    for share in shares:
        place = share * (whole["n"] - 1)
        low, high = math.floor(place), math.ceil(place)
        same = low == high or found[low] == found[high]
        answers.append(found[low] if same else (high - place) * found[low] + (place - low) * found[high])
    return answers


def describe_numeric(df: DataFrame, col: str) -> DataFrame:
    """count, mean, std (n-1), min, quartiles (linear, exact), max of a number column.

    The numbers alone are written once: every pass reads them, none computes ``df`` again.
    """
    df = materialize(df.select(F.col(col).cast("double").alias(col)), "numbers")
    value = F.col(col)
    quartiles = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    named = dict(zip(("p25", "p50", "p75"), quartiles, strict=True))
    stats = df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    shown = [F.lit(q).cast("double").alias(name) for name, q in named.items()]
    return stats.select("count", "mean", "std", "min", *shown, "max")


def length_range(df: DataFrame, size: Column) -> DataFrame:
    return df.agg(F.min(size).alias("min_length"), F.max(size).alias("max_length"))


def histogram(df: DataFrame, col: str, bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins ``(bin, n)``, the last one closed; empty bins show 0; one value -> bin 0."""
    ends = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    low, high = ends.select("lo").scalar(), ends.select("hi").scalar()
    position = F.floor((F.col(col) - low) / (high - low) * bins)
    number = F.when(high == low, F.lit(0)).otherwise(F.least(position, F.lit(bins - 1))).cast("int")
    counted = (
        df.where(F.col(col).isNotNull())
        .groupBy(number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def stage_counts(**stages: DataFrame) -> DataFrame:
    """``(stage, n_rows)`` of named tables."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows")
        for name, df in stages.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result
