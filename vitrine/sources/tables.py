"""Readers and writers of catalogue, feature, prompt and split tables.

Parquet is the hand-off format. CSV is read with its header and without type inference; because CSV does
not tell '' from NULL, text columns read from it are never NULL.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions import fixed
from vitrine.operators.numbering import number_rows
from vitrine.session import materialize

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def require_columns(df: DataFrame, required: list[str], what: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; found {df.columns}")
    return df


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", multiline: bool = True
) -> DataFrame:
    """Parquet, or CSV with a header. Multi-line CSV reads one file per task: keep its files small."""
    try:
        if fmt == "csv":
            return spark.read.options(**CSV_OPTIONS, multiLine=multiline).csv(path)
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"nothing to read at {path}") from error


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS, emptyValue="")
    writer.format(fmt).save(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over all cores when its files offer fewer splits than that.

    Only inputs of a few row groups are moved; a large table has more splits than cores and stays in
    place. Meant for plain scans: the number of splits is read off the plan, nothing runs.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def with_row_id(df: DataFrame, name: str = "row_id", path: str | None = None) -> DataFrame:
    """Give every row of a scan a number that stays: in order of files and rows, written, and read back.

    Files count by path, the parts of a file by their place in it, so neither the number of cores nor the packing of
    files into tasks matters. Rows that don't come from files count in the order of their partitions.
    """
    if name in df.columns:
        return df.withColumn(name, F.col(name).cast("bigint"))
    columns = df.columns
    place = F.monotonically_increasing_id().alias("__place")
    try:
        file = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block")]
        placed = df.select(*columns, *file, place)
    except AnalysisException:
        placed = df.select(*columns, F.lit("").alias("__file"), F.lit(0).alias("__block"), place)
    order = [F.col("__file"), F.col("__block"), F.col("__place")]
    numbered = number_rows(materialize(placed, f"{name}-places"), order, name)
    return materialize(numbered.select(*columns, name), name, path)


def read_catalog(
    spark: SparkSession, path: str, fmt: str = "csv", multiline: bool = True
) -> DataFrame:
    """Raw catalogue: the three raw columns and ``row_id``; other columns are not read."""
    df = require_columns(read_table(spark, path, fmt, multiline), fixed.RAW_COLUMNS, "catalogue")
    ids = ["row_id"] if "row_id" in df.columns else []
    rows = with_row_id(df.select(*ids, *fixed.RAW_COLUMNS))
    return rows.select("row_id", *fixed.RAW_COLUMNS)


def write_features(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    ids = ["row_id"] if "row_id" in df.columns else []
    write_table(df.select(*ids, *fixed.FEATURE_COLUMNS), path, fmt, mode)


def read_features(
    spark: SparkSession, path: str, required: list[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    required = fixed.INDEX_METADATA if required is None else required
    df = require_columns(read_table(spark, path, fmt), required, "feature table")
    if fmt == "csv":
        df = df.na.fill("", subset=[c for c in fixed.INDEX_METADATA if c in df.columns])
        if "desc_word_count" in df.columns:
            df = df.withColumn("desc_word_count", F.col("desc_word_count").cast("int"))
    return with_row_id(df)


def write_splits(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    """Prompts below ``split=train`` and ``split=val``; a reader of one split lists only its folder."""
    ids = ["row_id"] if "row_id" in df.columns else []
    writer = df.select(*ids, "prompt", "split").write.mode(mode).partitionBy("split")
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS, emptyValue="")
    writer.format(fmt).save(path)


def read_prompts(
    spark: SparkSession, path: str, split: str | None = "val", fmt: str = "parquet"
) -> DataFrame:
    """Evaluation prompts; with ``split`` only that partition of a split table."""
    df = require_columns(read_table(spark, path, fmt), ["prompt"], "prompt table")
    if split is not None and "split" in df.columns:
        df = df.where(F.col("split") == split)
    return with_row_id(df)
