"""Engine inputs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.operators import bm25, clusters
from vitrine.plans import jobs
from vitrine.session import scratch_path
from vitrine.sources.index import read_embedder, read_index
from vitrine.sources.tables import read_features, spread, write_features

_indexes: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    scan = table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), "text")
    return spread(scan)


def raw_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """One product per document, named by the part of the same number; some names give a colour."""
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("row_id"), "p_name")
    first = F.substring_index("p_name", " ", 1)
    color = F.when(first.isin("red", "blue"), F.concat(F.lit("['"), first, F.lit("']"))).otherwise(
        "[]"
    )
    return (
        documents(spark, folder)
        .join(part, "row_id")
        .select(
            "row_id",
            F.col("p_name").alias("name"),
            F.col("text").alias("fulldescription"),
            color.alias("colorname"),
        )
    )


def features(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.catalog_features(raw_catalog(spark, folder))


def prompted(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.prompts(features(spark, folder))


def index(spark: SparkSession, folder: str):
    """``(index rows, embedder)`` of the catalogue, written once per application and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _indexes:
        path = scratch_path(spark, "index")
        write_features(features(spark, folder), f"{path}/features")
        rows, _ = jobs.build_index(read_features(spark, f"{path}/features"), path)
        bm25.build_keyword_index(bm25.bm25_documents(rows), f"{path}/keywords")
        _indexes[key] = path
    return read_index(spark, _indexes[key]), read_embedder(spark, _indexes[key])


def keyword_index(spark: SparkSession, folder: str) -> bm25.KeywordIndex:
    """Terms and postings written next to the index."""
    index(spark, folder)
    key = (spark.sparkContext.applicationId, folder)
    return bm25.read_keyword_index(spark, f"{_indexes[key]}/keywords")


def vector_clusters(spark: SparkSession, folder: str) -> clusters.ClusteredIndex:
    """The stored vectors by cluster, written once per application and folder."""
    key = (spark.sparkContext.applicationId, f"{folder} clusters")
    if key not in _indexes:
        _indexes[key] = scratch_path(spark, "clusters")
        rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")
        clusters.write_clusters(rows, _indexes[key], cluster_rows=64)
    return clusters.read_clusters(spark, _indexes[key])


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per part: its name, first word as colour ('' for new and old), last as category."""
    first = F.substring_index("p_name", " ", 1)
    part = spread(table(spark, folder, "part").select("p_partkey", "p_name", "p_size"))
    return part.select(
        F.col("p_partkey").alias("query_id"),
        F.col("p_name").alias("name"),
        F.when(first.isin("new", "old"), "").otherwise(first).alias("color"),
        F.substring_index("p_name", " ", -1).alias("category"),
        F.ceil(F.col("p_size") / 10).cast("int").alias("top_k"),
    )


def request_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """JSON requests; those of two brands lack a name or have a blank one."""
    fields = ["name", "color", "category", "top_k"]
    brand = table(spark, folder, "part").select(F.col("p_partkey").alias("query_id"), "p_brand")
    asked = requests(spark, folder).join(brand, "query_id")
    full = F.to_json(F.struct(*fields))
    spaced = F.to_json(
        F.struct(
            F.concat(F.lit("  "), "name", F.lit("\t")).alias("name"),
            F.concat("color", F.lit(" ")).alias("color"),
        )
    )
    body = (
        F.when(F.col("p_brand") == "Brand#1", F.to_json(F.struct(*fields[1:])))
        .when(F.col("p_brand") == "Brand#2", F.to_json(F.struct(F.lit(" ").alias("name"), "color")))
        .when(F.col("p_brand") == "Brand#3", spaced)
        .otherwise(full)
    )
    return asked.select("query_id", body.alias("body"))


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """A user turn as reference and the assistant turn after it as generated text."""
    turns = spread(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("reference"))
    replies = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("generated")
    )
    return asked.join(replies, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"),
        F.lit("").alias("input"),
        "reference",
        "generated",
        (F.length("generated") / 100).alias("gen_seconds"),
    )


def losses(spark: SparkSession, folder: str) -> DataFrame:
    """Per-event losses; two event types stand for a failed and a diverged loss."""
    kind = F.col("event_type")
    loss = (
        F.when(kind == "error", F.lit(float("nan")))
        .when(kind == "click", F.lit(float("inf")))
        .otherwise(F.col("value") / 100)
    )
    return table(spark, folder, "events").select(F.col("event_id").alias("row_id"), loss.alias("loss"))
