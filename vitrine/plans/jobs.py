"""The composite jobs: clean, featurise, prompt, prepare, index, retrieve, recommend, plan, evaluate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from vitrine.functions import fixed
from vitrine.functions.prompts import (
    fewshot_prompt,
    inference_prompt,
    product_text,
    query_text,
    split_prompt,
    strip_prefix,
    training_prompt,
)
from vitrine.functions.text import word_count
from vitrine.operators import bm25, cleaning, language_model, metrics, planning, sampling, sequences
from vitrine.operators.filters import apply_filters
from vitrine.operators.hybrid import merge_hits
from vitrine.operators.joins import salted_join
from vitrine.operators.profiling import describe_numeric
from vitrine.operators.vectors import HashedTfidf, knn
from vitrine.session import materialize
from vitrine.sources.index import INDEX_COLUMNS, index_exists, read_embedder, read_index, write_index
from vitrine.sources.tables import write_features

Generator = Callable[[DataFrame], DataFrame]  # adds `generated`, given `prompt`

HIT = ["rank", "row_id", "name_clean", "colors_extracted", "similarity_score"]
SHOWN = ["name_clean", "colors_extracted"]  # metadata of a hit; few-shot prompts add the description


# --- catalogue ---------------------------------------------------------------------------------


def preprocess(raw: DataFrame) -> DataFrame:
    """Raw catalogue -> cleaned text columns, one row per distinct cleaned description."""
    cleaned = cleaning.clean_columns(cleaning.parse_columns(cleaning.basic_cleaning(raw)))
    return cleaning.keep_first(cleaned, "fulldescription_clean")


def featurize(
    cleaned: DataFrame,
    min_words: int = fixed.MIN_WORDS,
    observation: Observation | None = None,
) -> DataFrame:
    """Adds word count and colours, then drops short descriptions."""
    counted = cleaning.add_colors(cleaning.add_word_count(cleaned))
    return cleaning.filter_short(counted, min_words, observation)


def catalog_features(raw: DataFrame, min_words: int = fixed.MIN_WORDS) -> DataFrame:
    return featurize(preprocess(raw), min_words).select("row_id", *fixed.FEATURE_COLUMNS)


def ingest_catalog(
    raw: DataFrame, path: str, min_words: int = fixed.MIN_WORDS, fmt: str = "parquet"
) -> dict[str, int]:
    """Clean, featurise and write a catalogue; returns the row counts of the stages.

    The last two counts are observed in the stage that writes, where Spark counts every task once even
    if it has to be repeated; the first is a count of its own, as stages before a shuffle lack that
    guarantee.
    """
    short = Observation()
    write_features(featurize(preprocess(raw), min_words, short), path, fmt)
    kept = short.get["remaining"]
    return {"raw": raw.count(), "preprocessed": kept + short.get["removed"], "features": kept}


# --- prompts and sequences ---------------------------------------------------------------------


def prompts(features: DataFrame) -> DataFrame:
    """Adds ``prompt`` and ``prompt_length`` (in words)."""
    text = training_prompt(
        F.col("name_clean"), F.col("colors_extracted"), F.col("fulldescription_clean")
    )
    prompted = features.withColumn("prompt", text)
    return prompted.withColumn("prompt_length", word_count(F.col("prompt")))


def prompt_stats(prompted: DataFrame) -> DataFrame:
    return describe_numeric(prompted, "prompt_length")


def prepare_sequences(
    prompted: DataFrame,
    share: float = fixed.VALIDATION_SHARE,
    max_vocabulary: int | None = None,
    max_length: int = fixed.SEQUENCE_LENGTH,
) -> DataFrame:
    """Split, learn the vocabulary from the training part, encode both parts.

    Prompts and vocabulary are written once: counting and encoding read them, neither computes its input again.
    """
    parted = materialize(sampling.split(sequences.prompts_only(prompted), "row_id", share), "prompts")
    vocab = materialize(sequences.build_vocab(sampling.train_rows(parted), "prompt", max_vocabulary), "vocabulary")
    return sequences.encode(parted, "prompt", vocab, max_length)


# --- index -------------------------------------------------------------------------------------


def with_product_text(features: DataFrame) -> DataFrame:
    text = product_text(
        F.col("name_clean"), F.col("colors_extracted"), F.col("fulldescription_clean")
    )
    return features.withColumn("product_text", text)


def embed_catalog(features: DataFrame, model) -> DataFrame:
    texts = with_product_text(features)
    vector = model.transform(F.col("product_text")).alias("embedding")
    return texts.select(*INDEX_COLUMNS[:-1], vector)


def build_index(
    features: DataFrame, path: str, dim: int = fixed.EMBEDDING_DIM
) -> tuple[DataFrame, HashedTfidf]:
    """Fit, embed and write once; an existing index is read as it is.

    The features are read twice (fit, embed): pass a written table rather than a long lineage.
    """
    spark = features.sparkSession
    if not index_exists(spark, path):
        model = HashedTfidf.fit(with_product_text(features), "product_text", dim)
        write_index(embed_catalog(features, model), path, model)
    return read_index(spark, path), read_embedder(spark, path)


# --- retrieval ---------------------------------------------------------------------------------


def _own(k: int | Column) -> Column:
    return (F.lit(k) if isinstance(k, int) else k).cast("bigint")


def _question(k: Column, text: Column) -> Column:
    """One key for what is asked: requests for the same text and number of hits share a search."""
    return F.concat(k.cast("string"), F.lit(":"), text)


def _with_metadata(hits: DataFrame, index: DataFrame, columns: list[str]) -> DataFrame:
    """Narrow hits meet the metadata columns asked for; the vectors are not read."""
    named = hits.join(index.select("row_id", *columns), "row_id")
    return named.withColumn("similarity_score", F.round("score", 4))


def _to_requests(
    requests: DataFrame, hits: DataFrame, key: str, distinct: bool = False
) -> DataFrame:
    """Hits of distinct query texts handed to all requests that ask the same, however many do.

    ``distinct`` promises that no text is asked often, which saves looking for hot ones.
    """
    kept = hits.withColumnRenamed("query_id", key)
    if distinct:
        return requests.join(kept, key).drop(key)
    return salted_join(requests, kept, key, F.col("query_id")).drop(key)


def text_hits(
    texts: DataFrame, index: DataFrame, model, k: int | Column = 5, columns: list[str] = SHOWN
) -> DataFrame:
    """Top-k catalogue rows per free text ``(query_id, text)`` by vector similarity.

    ``model`` offers ``dim`` and ``transform(text column) -> vector column``; ``k`` is a number or a column of ``texts``.
    """
    vectors = texts.select("query_id", _own(k).alias("k"), model.transform(F.col("text")).alias("embedding"))
    return _with_metadata(knn(vectors, index, F.col("k"), model.dim), index, columns)


def dense_hits(
    requests: DataFrame,
    index: DataFrame,
    model,
    k: int | Column,
    columns: list[str] = SHOWN,
    distinct: bool = False,
) -> DataFrame:
    """Top-k catalogue rows per request; equal query texts are embedded and searched once.

    ``k`` is a number or a column of ``requests``; a request whose k is null or below 1 has no hits.
    """
    text = query_text(F.col("name"), F.col("color"))
    asked = requests.withColumn("__asked", _question(_own(k), text))
    texts = asked.select(F.col("__asked").alias("query_id"), text.alias("text"), _own(k).alias("k"))
    texts = texts.where("k >= 1").dropDuplicates(["query_id"])
    return _to_requests(asked, text_hits(texts, index, model, F.col("k"), columns), "__asked", distinct)


def keyword_hits(
    requests: DataFrame,
    index: DataFrame,
    k: int | Column,
    keywords: bm25.KeywordIndex | None = None,
    columns: list[str] = SHOWN,
    distinct: bool = False,
) -> DataFrame:
    """Top-k catalogue rows per request by BM25 over name and colours, from the stored ``keywords``."""
    documents = bm25.bm25_documents(index) if keywords is None else None
    bag = F.array_join(F.sort_array(bm25.bm25_tokens(F.col("name"), F.col("color"))), " ")
    asked = requests.withColumn("__asked", _question(_own(k), bag))
    bags = asked.select(F.col("__asked").alias("query_id"), F.split(bag, " ").alias("tokens"), _own(k).alias("k"))
    queries = bags.where("k >= 1").dropDuplicates(["query_id"])
    found = bm25.bm25_search(queries, documents, F.col("k"), keywords)
    return _to_requests(asked, _with_metadata(found, index, columns), "__asked", distinct)


def retrieve(
    requests: DataFrame,
    index: DataFrame,
    model,
    k: int | None = None,
    columns: list[str] = SHOWN,
) -> DataFrame:
    """Dense hits of each request, at most its own ``top_k`` (``k`` bounds all of them)."""
    own = F.col("top_k") if k is None else F.least(F.col("top_k"), F.lit(k))
    return dense_hits(requests, index, model, own, columns)


def hybrid_retrieve(
    requests: DataFrame,
    index: DataFrame,
    model,
    k: int | Column,
    keywords: bm25.KeywordIndex | None = None,
) -> DataFrame:
    """Dense and keyword hits (2k each) merged, one per product name, first k.

    Both searches and the merge run once per distinct name, colour and k; requests meet the outcome last.
    """
    asked = requests.withColumn("__asked", F.to_json(F.struct("name", "color", _own(k).alias("k"))))
    unique = asked.groupBy(F.col("__asked").alias("query_id")).agg(
        F.first("name").alias("name"), F.first("color").alias("color"), F.first(_own(k)).alias("k")
    )
    dense = dense_hits(unique, index, model, 2 * F.col("k"), distinct=True)
    keyword = keyword_hits(unique, index, 2 * F.col("k"), keywords, distinct=True)
    merged = merge_hits(dense, keyword, F.col("k")).drop("name", "color", "k")
    return _to_requests(asked, merged, "__asked")


def planned_retrieve(
    requests: DataFrame,
    index: DataFrame,
    model,
    max_top_k: int = 5,
    keywords: bm25.KeywordIndex | None = None,
) -> DataFrame:
    """Each request by its planned strategy and planned top-k (2 to ``max_top_k``).

    One dense and one keyword search serve all requests, each with its own number of hits: a dense request its planned
    top-k, a hybrid one twice that from either source.
    """
    k = F.least(F.col("planned_top_k"), F.lit(max_top_k)).cast("bigint")
    planned = planning.plan_requests(requests).withColumn("planned_top_k", k)
    hybrid = F.col("retrieval_strategy") == "hybrid"
    asked = planned.withColumn("__asked", F.to_json(F.struct("name", "color", "planned_top_k")))
    unique = asked.groupBy(F.col("__asked").alias("query_id")).agg(
        *[F.first(c).alias(c) for c in ("name", "color", "planned_top_k", "retrieval_strategy")]
    )
    fetched = F.when(hybrid, 2 * F.col("planned_top_k")).otherwise(F.col("planned_top_k"))
    dense = dense_hits(unique, index, model, fetched, distinct=True)
    keyword = keyword_hits(unique.where(hybrid), index, 2 * F.col("planned_top_k"), keywords, distinct=True)
    merged = merge_hits(dense, keyword, F.col("planned_top_k"), hybrid)
    return _to_requests(asked, merged.drop("name", "color", "planned_top_k", "retrieval_strategy"), "__asked")


def nest_hits(hits: DataFrame, extra: list[str] = []) -> DataFrame:
    """``(query_id, similar)``: hits as one ranked array per request (at most top-k long)."""
    hit = F.struct(*HIT, *extra)
    return hits.groupBy("query_id").agg(F.sort_array(F.collect_list(hit)).alias("similar"))


def _no_similar() -> Column:
    return F.array().cast(
        "array<struct<rank:int,row_id:bigint,name_clean:string,colors_extracted:string,"
        "similarity_score:double>>"
    )


def _with_similar(
    requests: DataFrame, find: Callable[[DataFrame], DataFrame], extra: list[str] = []
) -> DataFrame:
    """Requests with the hits that ``find`` brings; a request without hits has an empty array.

    ``query_id`` is the user's and may repeat: hits are found and nested by the content of a request, once for all
    requests that ask the same, and only the nested arrays travel to them.
    """
    content = [c for c in requests.columns if c != "query_id"]
    asked = requests.withColumn("__asked", F.sha2(F.to_json(F.struct(*content)), 256))
    unique = asked.withColumn("query_id", F.col("__asked")).drop("__asked").dropDuplicates(["query_id"])
    found = nest_hits(find(unique), extra).withColumnRenamed("query_id", "__asked")
    nested = salted_join(asked, found, "__asked", F.col("query_id"), "left").drop("__asked")
    none = F.array().cast(nested.schema["similar"].dataType)
    return nested.withColumn("similar", F.coalesce("similar", none))


def _describe(prompted: DataFrame, generate: Generator | None) -> DataFrame:
    """The generator's text without the prompt; without a generator, ''."""
    if generate is None:
        return prompted.withColumn("description", F.lit(""))
    text = strip_prefix(F.col("generated"), F.col("prompt"))
    return generate(prompted).withColumn("description", text).drop("generated")


def recommend(
    requests: DataFrame,
    index: DataFrame,
    model,
    generate: Generator | None = None,
    fewshot: bool = False,
    k: int | None = None,
) -> DataFrame:
    """Retrieve, filter by colour and category, prompt, generate; one row per request.

    Filters run after top-k, so a request may keep fewer than ``top_k`` products.
    """
    extra = ["fulldescription_clean"] if fewshot else []
    nested = _with_similar(
        requests, lambda asked: apply_filters(retrieve(asked, index, model, k, SHOWN + extra)), extra
    )
    name, color = F.col("name"), F.col("color")
    prompt = fewshot_prompt(name, color, F.col("similar")) if fewshot else (
        inference_prompt(name, color)
    )
    described = _describe(nested.withColumn("prompt", prompt), generate)
    return described.select("query_id", "name", "color", "description", "prompt", "similar")


def plan_batch(
    requests: DataFrame,
    index: DataFrame | None = None,
    model=None,
    generate: Generator | None = None,
    top_k: int = fixed.DEFAULT_TOP_K,
) -> DataFrame:
    """Parse, retrieve, enrich, generate, with a trace of the four steps; no filters.

    Without an index the retrieval step is skipped and says so.
    """
    named = requests.where(F.col("name") != "").select("query_id", "name", "color")
    if index is None:
        nested = named.withColumn("similar", _no_similar())
    else:
        nested = _with_similar(named, lambda asked: dense_hits(asked, index, model, top_k))
    enriched = planning.enrich_color(nested)
    prompted = enriched.withColumn("prompt", inference_prompt(F.col("name"), F.col("final_color")))
    described = _describe(prompted, generate)
    traced = described.withColumn("plan_trace", planning.plan_trace(index is not None))
    return traced.select(
        "query_id", "name", F.col("final_color").alias("color"), "description", "prompt", "similar",
        "plan_trace",
    )


# --- evaluation --------------------------------------------------------------------------------


def evaluation_pairs(
    prompted: DataFrame,
    generate: Generator,
    sample: int | None = fixed.EVAL_SAMPLE,
    marker: str | None = None,
) -> DataFrame:
    """Prompts -> ``(pair_id, input, reference, generated[, gen_seconds])``; empty references skipped.

    The pairs are written once and read back, so that the metrics do not run the generator again.
    """
    if sample is not None:
        prompted = sampling.sample_n(prompted, sample, "row_id")
    text_in, reference = split_prompt(F.col("prompt"), marker)
    split = prompted.select(
        F.col("row_id").alias("pair_id"), text_in.alias("input"), reference.alias("reference")
    )
    asked = metrics.nonempty_references(split).withColumn("prompt", F.col("input"))
    text = strip_prefix(F.col("generated"), F.col("input"), always=True)
    return materialize(generate(asked).drop("prompt").withColumn("generated", text), "pairs")


def evaluate(
    pairs: DataFrame,
    train: DataFrame | None = None,
    test: DataFrame | None = None,
    text_col: str = "prompt",
    n: int = 1,
) -> DataFrame:
    """``(metric, value)``: BLEU, ROUGE, Distinct-n, mean time, and perplexity when texts are given."""
    losses = None
    if train is not None and test is not None:
        fitted = language_model.NgramModel.fit(train, text_col, n)
        losses = language_model.ngram_loss(fitted, test, text_col)
    return metrics.metrics_report(metrics.nonempty_references(pairs), losses)
