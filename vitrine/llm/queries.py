"""The registered queries ``opN_<name>``: thin readings of the operators over whole tables."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm import (
    bpe,
    chat,
    fingerprints,
    html_text,
    importance,
    jaccard_join,
    neighbours,
    packing,
    quality,
    repair,
    secret_scan,
    toxicity,
    url_filter,
)
from vitrine.llm.common import hex_sha256, table, text_or_empty

RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"

URL_RULES = {
    "com/": url_filter.ALLOW,
    "example.com/en/": url_filter.BLOCK,
    "www.example.com/en/": url_filter.ALLOW,
    "net/es/": url_filter.BLOCK,
    "net/fr/": url_filter.BLOCK,
}


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    extracted = html_text.extract_text(pages)
    return extracted.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))
    return packed.withColumn("length", F.col("length").cast("bigint"))


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic").where(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of ids and of decoded texts, made where the ids are: 300 million ids need not leave their task."""
    path = public_tokenizers.path(WORD_BPE)

    def digests(texts: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in texts.cast(pa.binary())])

    def summary(rows: pa.RecordBatch, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        columns = {
            "doc_id": rows.column(0),
            "n_tokens": pa.array(np.diff(bounds), pa.int64()),
            "ids_sha256": digests(bpe.joined(ids, bounds, bpe.numbers_of(path))),
            "decoded_sha256": digests(bpe.joined(ids, bounds, bpe.pieces_of(path))),
        }
        return pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    docs = table(spark, folder, "documents").select("doc_id", "text")
    kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return bpe.map_ids(docs, path, summary, kinds)


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", text_or_empty().alias("text"))
    found = secret_scan.find_secrets(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        hex_sha256(listed(base)).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    found = neighbours.search(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every row is a message event; rows of one turn follow each other in order of role and text."""
    both = chat.END + chat.START + "assistant ok"
    added = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(both).alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    formatted = chat.format_conversations(chat.turn_events(rows))
    turns = F.col("turns")
    said = F.array_join(
        F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    masked = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    return (
        formatted.withColumn("turns", chat.parse(F.col("formatted")))
        .withColumn("masked", masked)
        .select(
            "conv_id",
            F.size("turns").cast("bigint").alias("n_turns"),
            hex_sha256(said).alias("turns_sha256"),
            F.length("masked").cast("bigint").alias("loss_chars"),
            hex_sha256(F.col("masked")).alias("loss_sha256"),
            F.length("formatted").cast("bigint").alias("formatted_chars"),
        )
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair(repair.damage(conversations), conversations)


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = (table(spark, folder, name) for name in ("documents", "benchmark"))
    return importance.resample(docs, target, importance.Setting(longest=1, buckets=10_000, min_words=20, percent=10, seed="2024"))


def op13_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality").where(~quality.held_out())
    rated = quality.classify(docs, labels, threshold=0.3)
    return rated.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_url_filter": op4_url_filter,
    "op5_fingerprints": op5_fingerprints,
    "op6_toxicity": op6_toxicity,
    "op7_bpe": op7_bpe,
    "op8_secret_scan": op8_secret_scan,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_chat_format": op10_chat_format,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_quality_classifier": op13_quality_classifier,
}
