"""BM25 keyword search over product name and colours."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.functions import fixed
from vitrine.functions.text import ws_tokens
from vitrine.operators.postings import Postings, build_segments
from vitrine.operators.topk import BLOCK_CELLS, BROADCAST_CELLS, blocked_topk
from vitrine.session import materialize, scratch_path


def bm25_tokens(name: Column, colors: Column) -> Column:
    """Lower-case whitespace tokens of ``name colours``; punctuation stays glued, copies are kept."""
    blank = F.lit("")
    return ws_tokens(F.lower(F.concat_ws(" ", F.coalesce(name, blank), F.coalesce(colors, blank))))


def bm25_documents(catalog: DataFrame) -> DataFrame:
    tokens = bm25_tokens(F.col("name_clean"), F.col("colors_extracted"))
    return catalog.select("row_id", tokens.alias("tokens"))


def bm25_totals(documents: DataFrame) -> DataFrame:
    """One row: number of documents and average document length."""
    return documents.agg(
        F.count(F.lit(1)).alias("n_docs"), F.avg(F.size("tokens")).alias("avgdl")
    )


def bm25_counts(documents: DataFrame) -> DataFrame:
    """``(term, df, length)``: documents per term, and one row with a NULL term for the whole corpus,
    whose ``df`` is the number of documents and ``length`` that of their tokens.

    One pass counts both. Counting combines on the map side, so a term of every document sends one row
    per task.
    """
    terms = F.transform(
        F.array_distinct("tokens"), lambda t: F.struct(t.alias("term"), F.lit(0).alias("length"))
    )
    corpus = F.struct(F.lit(None).cast("string").alias("term"), F.size("tokens").alias("length"))
    return (
        documents.select(F.inline(F.concat(F.array(corpus), terms)))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("length").alias("length"))
    )


def bm25_terms(counts: DataFrame, n_docs: Column) -> DataFrame:
    """``(term, df, idf)``; a negative idf becomes epsilon times the mean idf of all terms."""
    raw = counts.withColumn("raw", F.log(n_docs - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    floor = raw.agg((F.avg("raw") * fixed.BM25_EPSILON).alias("floor")).scalar()
    idf = F.when(F.col("raw") < 0, floor).otherwise(F.col("raw"))
    return raw.select("term", "df", idf.alias("idf"))


@dataclass
class KeywordIndex:
    """Term table, average document length and the stored segments of postings."""

    terms: DataFrame
    avgdl: float
    segments: DataFrame


def build_keyword_index(documents: DataFrame, path: str | None = None) -> KeywordIndex:
    """Count the corpus once and write its postings; searches then read these tables, not the corpus.

    The tokens are written first: counting, cutting into ranges and indexing read them, none computes ``documents`` again.
    """
    spark = documents.sparkSession
    path = path or scratch_path(spark, "keywords")
    documents = materialize(documents.select("row_id", "tokens"), "keyword-tokens")
    bm25_counts(documents).write.mode("overwrite").parquet(f"{path}/terms")
    _, avgdl = _read_terms(spark, path)
    segments = build_segments(documents, fixed.BM25_K1, fixed.BM25_B, avgdl)
    segments.write.mode("overwrite").parquet(f"{path}/segments")
    return read_keyword_index(spark, path)


def _read_terms(spark: SparkSession, path: str) -> tuple[DataFrame, float]:
    counts = spark.read.parquet(f"{path}/terms")
    corpus = counts.where("term IS NULL").first()
    n_docs, length = (corpus["df"], corpus["length"]) if corpus else (0, 0)
    terms = bm25_terms(counts.where("term IS NOT NULL"), F.lit(n_docs))
    return terms, length / n_docs if length else 1.0


def read_keyword_index(spark: SparkSession, path: str) -> KeywordIndex:
    terms, avgdl = _read_terms(spark, path)
    return KeywordIndex(terms, avgdl, spark.read.parquet(f"{path}/segments"))


def bm25_search(
    queries: DataFrame,
    documents: DataFrame | None,
    k: int | Column,
    index: KeywordIndex | None = None,
    broadcast_cells: int = BROADCAST_CELLS,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """Top-k documents per query: ``(query_id, row_id, score, rank)``, ties by ``row_id``.

    ``queries`` has ``(query_id, tokens)``; repeated query tokens count repeatedly. ``k`` is a number or a column of ``queries``. All
    documents are ranked: one that shares no token with the query scores zero. Segments are scored where they lie, so a
    term shared by many queries and many documents never becomes a join of all its pairs, and of their blocks only those that can
    bring a query one of its hits. Without a stored ``index`` one is made of ``documents (row_id, tokens)``.
    """
    index = build_keyword_index(documents) if index is None else index
    own = (F.lit(k) if isinstance(k, int) else k).cast("bigint").alias("k")
    asked = queries.select("query_id", own, "tokens")
    matched = (
        asked.select("query_id", F.explode("tokens").alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(index.terms, "term")
        .groupBy("query_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("term", (F.col("idf") * F.col("times")).alias("weight")))
            ).alias("entries")
        )
        .select(
            "query_id",
            F.col("entries.term").alias("terms"),
            F.col("entries.weight").alias("weights"),
        )
    )
    everyone = asked.groupBy("query_id").agg(F.max("k").alias("k")).join(matched, "query_id", "left")
    wanted = everyone.select(
        "query_id",
        "k",
        F.coalesce("terms", F.array().cast("array<string>")).alias("terms"),
        F.coalesce("weights", F.array().cast("array<double>")).alias("weights"),
    )
    return blocked_topk(
        wanted,
        index.segments,
        F.col("k"),
        Postings(),
        broadcast_cells=broadcast_cells,
        block_cells=block_cells,
    )
