"""The vector index: one Parquet dataset of metadata and vectors, next to the fitted embedder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from vitrine.functions import fixed
from vitrine.operators.vectors import HashedTfidf
from vitrine.sources.tables import require_columns

INDEX_COLUMNS = ["row_id", *fixed.INDEX_METADATA, "embedding"]


def _rows(path: str) -> str:
    return f"{path.rstrip('/')}/rows"


def _model(path: str) -> str:
    return f"{path.rstrip('/')}/embedder"


def index_exists(spark: SparkSession, path: str) -> bool:
    """True once the rows are written to the end; the leftovers of a failed build are not."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{_rows(path)}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def write_index(df: DataFrame, path: str, model: HashedTfidf | None = None) -> bool:
    """Write the index unless it exists; returns whether it was written.

    The rows are written last, so an index that exists is complete.
    """
    spark = df.sparkSession
    require_columns(df, INDEX_COLUMNS, "index")
    if index_exists(spark, path):
        return False
    if model is not None:
        numbered = list(enumerate(float(x) for x in model.idf))
        spark.createDataFrame(numbered, "bucket int, idf double").coalesce(1).write.mode(
            "overwrite"
        ).parquet(_model(path))
    df.select(*INDEX_COLUMNS).write.mode("overwrite").parquet(_rows(path))
    return True


def read_index(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(_rows(path))
    except AnalysisException as error:
        raise FileNotFoundError(f"no index at {path}; build it first") from error


def read_embedder(spark: SparkSession, path: str) -> HashedTfidf:
    rows = spark.read.parquet(_model(path)).orderBy("bucket").collect()  # one row per dimension
    return HashedTfidf([row["idf"] for row in rows])
