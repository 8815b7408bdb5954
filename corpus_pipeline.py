"""The corpus pipeline: ``documents`` through toxicity, near duplicates, secret scans and packing.

Every stage takes all rows that its predecessor kept. The first three return the columns they got; packing returns the
placed token pieces. Null and empty texts pass the filters (they hold nothing to reject) and pack as an empty document.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm import jaccard_join, packing, secret_scan, toxicity
from vitrine.llm.common import stored, table

RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon model doesn't reject. It learns from ``labels``, without the test rows."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~toxicity.held_out())
    model = toxicity.learn(docs.select("doc_id", "text"), labels)
    whole = docs.select(F.struct("*").alias("row"), "text")  # so that no column of the input clashes
    return toxicity.score(whole, model).where("predicted = 0").select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates one row, the one with the least id.

    Decided by row, which is known by a hash of its id and text: rows that repeat an id with other texts are documents of their
    own, rows that repeat both are one document. Rows without an id are kept as they are.
    """
    row = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.col("text").isNull(), "text"))
    known = docs.where("doc_id is not null")
    found = stored(jaccard_join.near_duplicates(known.select(row.alias("doc_id"), "text")), "near-duplicates")
    rows = found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    ids = known.select(row.alias("row"), F.col("doc_id").alias("id")).groupBy("row").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")
    )
    placed = stored(rows.distinct().join(ids, "row"), "near-duplicate-rows")
    first = placed.groupBy("component").agg(F.min(F.struct("id", "row")).alias("first"))
    judged = stored(
        placed.join(first, "component").select("row", "copies", (F.col("row") == F.col("first.row")).alias("stays")),
        "near-duplicate-choice",
    )
    removed = judged.where("not stays").select(F.col("row").alias("__row"))
    if removed.count() <= jaccard_join.MAX_WANTED:  # numbers only; beyond that a shuffle
        removed = F.broadcast(removed)
    kept = docs.join(removed, row == F.col("__row"), "left_anti")
    repeated = judged.where("stays and copies > 1").select(F.col("row").alias("__row"))
    if not repeated.isEmpty():
        single = kept.join(repeated, row == F.col("__row"), "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(repeated, row == F.col("__row"), "left_anti").unionByName(single)
    return kept.select(docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; ``n_chars`` follows the text."""
    whole = docs.select(F.struct("*").alias("row"), "text")
    hidden = secret_scan.hide_secrets(whole, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    new = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text").cast("bigint"), F.col("row.n_chars"))}
    return hidden.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_BPE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_near_copies),
    ("secret_scan", hide_secrets),
    ("packing", pack_tokens),
]

ORACLE_SQL = None  # learned scores and a tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
