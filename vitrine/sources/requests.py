"""Requests in (CSV, JSON) and results out (tables, response documents)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions import fixed
from vitrine.functions.text import strip_ws
from vitrine.sources import schemas
from vitrine.sources.tables import read_table, require_columns, with_row_id, write_table


TOP_K_TOO_SMALL = "top_k must be at least 1"


def normalize_requests(df: DataFrame) -> DataFrame:
    """Trim texts, '' for missing ones, default top-k."""
    have = set(df.columns)
    text = lambda c: (
        strip_ws(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in have else F.lit("")
    )
    top_k = F.col("top_k").try_cast("int") if "top_k" in have else F.lit(None).cast("int")
    return df.select(
        F.col("query_id"),
        text("name").alias("name"),
        text("color").alias("color"),
        text("category").alias("category"),
        F.coalesce(top_k, F.lit(fixed.DEFAULT_TOP_K)).alias("top_k"),
    )


def drop_blank_names(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("name") != "")


def read_requests(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Batch requests: ``name`` required, ``color`` optional, blank names dropped."""
    df = require_columns(read_table(spark, path, fmt), ["name"], "request table")
    kept = [c for c in schemas.REQUEST.fieldNames() if c in df.columns]
    return drop_blank_names(normalize_requests(with_row_id(df.select(*kept), "query_id")))


def parse_requests(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """JSON request bodies -> (accepted requests, rejected ``(query_id, body, error)``)."""
    parsed = df.select(
        "query_id",
        F.col(body).alias("body"),
        F.from_json(body, schemas.REQUEST_BODY).alias("r"),
        F.coalesce(
            F.array_contains(F.json_object_keys(F.col(body)), "name"), F.lit(False)
        ).alias("named"),
    )
    checked = parsed.withColumn(
        "error",
        F.when(~F.col("named"), fixed.MISSING_NAME).when(
            strip_ws(F.coalesce("r.name", F.lit(""))) == "", fixed.EMPTY_NAME
        ).when(F.col("r.top_k").try_cast("int") < 1, TOP_K_TOO_SMALL),
    )
    accepted = normalize_requests(checked.where("error IS NULL").select("query_id", "r.*"))
    rejected = checked.where("error IS NOT NULL").select("query_id", "body", "error")
    return accepted, rejected


def batch_results(results: DataFrame) -> DataFrame:
    """``(query_id, name, color, description, top_similar)`` of planned requests."""
    top = F.try_element_at("similar", F.lit(1))["name_clean"]
    return results.select(
        "query_id", "name", "color", "description", F.coalesce(top, F.lit("")).alias("top_similar")
    )


def write_results(
    results: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists"
) -> None:
    write_table(batch_results(results), path, fmt, mode)


def to_response(results: DataFrame) -> DataFrame:
    """``(query_id, response)``: the response document as JSON."""
    products = F.transform(
        F.coalesce("similar", F.array()),
        lambda hit: F.struct(
            hit["name_clean"].alias("name"),
            hit["colors_extracted"].alias("color"),
            hit["similarity_score"].alias("score"),
        ),
    )
    document = F.struct("name", "color", "description", products.alias("similar_products"))
    return results.select("query_id", F.to_json(document).alias("response"))
