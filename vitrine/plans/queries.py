"""The registered queries: one or more per operator, each over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vitrine.functions import fixed, prompts, text
from vitrine.functions.lists import extract_colors, parse_list
from vitrine.operators import (
    bm25,
    cleaning,
    clusters,
    filters,
    language_model,
    metrics,
    planning,
    profiling,
    sampling,
    sequences,
    vectors,
)
from vitrine.plans import inputs, jobs
from vitrine.session import scratch_path
from vitrine.sources import requests as request_io, tables
from vitrine.streaming.scoring import score_stream

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _joined(col: str, sep: str = " ") -> Column:
    return F.array_join(F.col(col).cast("array<string>"), sep).alias(col)


# --- cleaning ----------------------------------------------------------------------------------


@query
def raw_columns(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.select_raw(inputs.raw_catalog(spark, sf))


@query
def null_sentinels(spark, sf):
    return cleaning.null_sentinels(inputs.raw_catalog(spark, sf))


@query
def basic_cleaning(spark, sf):
    return cleaning.basic_cleaning(inputs.raw_catalog(spark, sf))


@query
def parse_list_cells(spark, sf):
    part = inputs.table(spark, sf, "part")
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    plain = F.concat(F.lit("['"), name, F.lit("', \""), brand, F.lit("'s\"]"))
    mixed = F.concat(F.lit("['"), name, F.lit("', "), F.col("p_size"), F.lit(", None]"))
    tail = F.concat(F.lit("['"), name, F.lit("'] x"))
    pair = F.concat(F.lit("('"), name, F.lit("','b')"))
    cell = (
        F.when(kind == "ECONOMY", plain)
        .when(kind == "SMALL", mixed)
        .when(kind == "LARGE", tail)
        .when(kind == "MEDIUM", pair)
        .otherwise(name)
    )
    return part.select("p_partkey", parse_list(cell).alias("parsed"))


@query
def extract_color_cells(spark, sf):
    part = inputs.table(spark, sf, "part")
    name, kind = F.col("p_name"), F.col("p_type")
    first = F.substring_index(name, " ", 1)
    both = F.concat(F.lit("['"), F.initcap(first), F.lit(" ', 'BLUE']"))
    odd = F.concat(F.lit("['"), first, F.lit("', 1]"))
    cell = (
        F.when(kind == "ECONOMY", both)
        .when(kind == "SMALL", odd)
        .when(kind == "LARGE", fixed.UNKNOWN)
        .otherwise(first)
    )
    return part.select("p_partkey", extract_colors(cell).alias("colors"))


@query
def clean_documents(spark, sf):
    return inputs.documents(spark, sf).select(
        "row_id", text.clean_text(F.col("text")).alias("clean")
    )


@query
def clean_pages(spark, sf):
    return inputs.table(spark, sf, "pages").select(
        "page_id", text.clean_text(F.col("html")).alias("clean")
    )


@query
def clean_names(spark, sf):
    name = F.concat(F.lit("\t "), F.initcap("p_name"), F.lit("  "))
    return inputs.table(spark, sf, "part").select(
        "p_partkey", text.lower_strip(name).alias("name_clean")
    )


@query
def stopwords_removed(spark, sf):
    clean = text.clean_text(F.col("html"))
    return inputs.table(spark, sf, "pages").select(
        "page_id", text.remove_stopwords(clean).alias("kept")
    )


@query
def word_counts(spark, sf):
    return inputs.documents(spark, sf).select("row_id", text.word_count(F.col("text")).alias("words"))


@query
def filter_short_documents(spark, sf):
    counted = inputs.documents(spark, sf).withColumn(
        "desc_word_count", text.word_count(F.col("text"))
    )
    return cleaning.filter_short(counted).select("row_id", "desc_word_count")


@query
def dedup_documents(spark, sf):
    return cleaning.keep_first(inputs.documents(spark, sf), "text").select("row_id")


@query
def preprocess_catalog(spark, sf):
    return jobs.preprocess(inputs.raw_catalog(spark, sf)).select(
        "row_id", "name_clean", "fulldescription_clean", "colorname_clean"
    )


@query
def catalog_features(spark, sf):
    return inputs.features(spark, sf)


# --- sources and sinks -------------------------------------------------------------------------


@query
def catalog_csv(spark, sf):
    path = scratch_path(spark, "catalog-csv")
    raw = inputs.raw_catalog(spark, sf)
    tables.write_table(raw.withColumn("sku", F.lit("x")), path, "csv")
    return tables.read_catalog(spark, path, "csv")


@query
def features_parquet(spark, sf):
    path = scratch_path(spark, "features")
    tables.write_features(inputs.features(spark, sf), path)
    return tables.read_features(spark, path)


@query
def features_csv(spark, sf):
    path = scratch_path(spark, "features-csv")
    tables.write_features(inputs.features(spark, sf), path, "csv")
    return tables.read_features(spark, path, fmt="csv")


@query
def validation_prompts(spark, sf):
    path = scratch_path(spark, "splits")
    tables.write_splits(sampling.split(inputs.prompted(spark, sf), "row_id"), path)
    return tables.read_prompts(spark, path, "val").select("row_id", "prompt")


@query
def vector_index(spark, sf):
    rows, _ = inputs.index(spark, sf)
    filled = F.size(F.filter("embedding", lambda x: x != 0))
    return rows.select("row_id", *fixed.INDEX_METADATA, filled.alias("n_buckets"))


@query
def index_size(spark, sf):
    return vectors.index_stats(inputs.index(spark, sf)[0])


@query
def batch_requests(spark, sf):
    path = scratch_path(spark, "requests")
    asked = inputs.requests(spark, sf).select(
        "query_id",
        F.when(F.col("category") == "bolt", " ").otherwise(F.concat(F.lit(" "), "name")).alias("name"),
        "color",
    )
    tables.write_table(asked, path, "csv")
    return request_io.read_requests(spark, path)


@query
def batch_results(spark, sf):
    path = scratch_path(spark, "results")
    rows, model = inputs.index(spark, sf)
    request_io.write_results(jobs.plan_batch(inputs.requests(spark, sf), rows, model), path)
    written = tables.read_table(spark, path, "csv").na.fill("")
    return written.withColumn("query_id", F.col("query_id").cast("bigint"))


@query
def accepted_requests(spark, sf):
    return request_io.parse_requests(inputs.request_bodies(spark, sf))[0]


@query
def rejected_requests(spark, sf):
    rejected = request_io.parse_requests(inputs.request_bodies(spark, sf))[1]
    return rejected.select("query_id", "error")


@query
def response_documents(spark, sf):
    rows, model = inputs.index(spark, sf)
    answered = jobs.recommend(inputs.requests(spark, sf), rows, model)
    document = F.from_json(
        "response",
        "name string, color string, description string, "
        "similar_products array<struct<name:string, color:string, score:double>>",
    )
    opened = request_io.to_response(answered).select("query_id", document.alias("d"))
    return opened.select(
        "query_id", "d.name", "d.color", F.posexplode("d.similar_products").alias("pos", "p")
    ).select(
        "query_id",
        "name",
        "color",
        "pos",
        F.col("p.name").alias("product"),
        F.col("p.color").alias("product_color"),
        F.col("p.score").alias("score"),
    )


@query
def request_stream(spark, sf):
    """The batch recommendation, through JSON files read as a stream."""
    rows, model = inputs.index(spark, sf)
    folder = scratch_path(spark, "stream")
    inputs.request_bodies(spark, sf).write.json(f"{folder}/in")
    stream = spark.readStream.schema("query_id bigint, body string").json(f"{folder}/in")
    score_stream(stream, rows, model, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    answered = spark.read.parquet(f"{folder}/out/responses").select("query_id", "response")
    return answered.select(
        "query_id",
        F.get_json_object("response", "$.name").alias("name"),
        F.get_json_object("response", "$.color").alias("color"),
        F.regexp_count("response", F.lit('"score":')).alias("n_products"),
    )


# --- prompts -----------------------------------------------------------------------------------


@query
def training_prompts(spark, sf):
    return inputs.prompted(spark, sf).select("row_id", "prompt", "prompt_length")


@query
def prompt_length_stats(spark, sf):
    stats = jobs.prompt_stats(inputs.prompted(spark, sf))
    return stats.withColumns({c: F.round(c, 6) for c in ["mean", "std"]})


@query
def product_texts(spark, sf):
    return jobs.with_product_text(inputs.features(spark, sf)).select("row_id", "product_text")


@query
def query_texts(spark, sf):
    return inputs.requests(spark, sf).select(
        "query_id", prompts.query_text(F.col("name"), F.col("color")).alias("query_text")
    )


@query
def keyword_tokens(spark, sf):
    return bm25.bm25_documents(inputs.features(spark, sf)).select("row_id", _joined("tokens", "|"))


@query
def inference_prompts(spark, sf):
    return inputs.requests(spark, sf).select(
        "query_id", prompts.inference_prompt(F.col("name"), F.col("color")).alias("prompt")
    )


@query
def fewshot_prompts(spark, sf):
    rows, model = inputs.index(spark, sf)
    answered = jobs.recommend(inputs.requests(spark, sf), rows, model, fewshot=True)
    return answered.select("query_id", F.md5("prompt").alias("prompt_md5"))


@query
def split_prompts(spark, sf):
    text_in, reference = prompts.split_prompt(F.col("prompt"))
    return inputs.prompted(spark, sf).select(
        "row_id", text_in.alias("input"), reference.alias("reference")
    )


@query
def stripped_prefixes(spark, sf):
    """A reply that repeats its prompt loses it; one that does not stays whole."""
    pairs = inputs.pairs(spark, sf)
    prefix = F.col("reference")
    echoed = F.concat(prefix, F.lit(" "), F.col("generated"))
    return pairs.select(
        "pair_id",
        prompts.strip_prefix(echoed, prefix).alias("cut"),
        prompts.strip_prefix(F.col("generated"), prefix).alias("kept"),
        prompts.strip_prefix(echoed, prefix, always=True).alias("always_cut"),
    )


@query
def previews(spark, sf):
    return inputs.documents(spark, sf).select(
        "row_id",
        *[
            text.preview(F.col("text"), n).alias(f"preview_{name}")
            for name, n in fixed.PREVIEW_CHARS.items()
        ],
    )


@query
def metric_tokens(spark, sf):
    return metrics.score_tokens(inputs.pairs(spark, sf)).select(
        "pair_id",
        _joined("bleu_gen", "|"),
        _joined("rouge_gen", "|"),
        F.array_join(text.ws_tokens(F.lower("generated")), "|").alias("plain"),
    )


@query
def request_defaults(spark, sf):
    asked = inputs.requests(spark, sf)
    patchy = asked.select(
        "query_id",
        F.concat(F.lit(" "), "name", F.lit("\n")).alias("name"),
        F.nullif("color", F.lit("red")).alias("color"),
        F.nullif("top_k", F.lit(1)).alias("top_k"),
    )
    return request_io.normalize_requests(patchy)


# --- vectors and sequences ---------------------------------------------------------------------


@query
def hashed_tfidf(spark, sf):
    long_form = vectors.sparse_form(inputs.index(spark, sf)[0])
    return long_form.select(
        "row_id",
        F.col("bucket").cast("bigint").alias("bucket"),
        F.round(F.col("weight").cast("double"), 5).alias("weight"),
    )


@query
def normalized_vectors(spark, sf):
    scaled = F.transform("embedding", lambda x: (x * 3).cast("float"))
    unit = inputs.table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode(vectors.l2_normalize(scaled)).alias("dim", "x")
    )
    return unit.select("vec_id", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("x"))


@query
def vocabulary(spark, sf):
    return sequences.build_vocab(inputs.documents(spark, sf), "text").select(
        "token", F.col("id").cast("bigint").alias("id"), "count"
    )


def _sequences(spark, sf):
    return jobs.prepare_sequences(inputs.prompted(spark, sf))


@query
def encoded_sequences(spark, sf):
    return _sequences(spark, sf).select(
        "row_id", "split", _joined("input_ids"), _joined("attention_mask"), _joined("labels")
    )


@query
def sequence_length_range(spark, sf):
    return profiling.length_range(_sequences(spark, sf), F.size("input_ids"))


@query
def raw_length_range(spark, sf):
    size = F.size(sequences.sequence_tokens(F.col("prompt")))
    return profiling.length_range(inputs.prompted(spark, sf), size)


@query
def prompts_only(spark, sf):
    return sequences.prompts_only(inputs.prompted(spark, sf))


def _length_model():
    """A stand-in for a user's model: character and byte-free word counts of a batch of texts."""
    import numpy as np

    def predict(texts):
        return np.array([[len(t), len(t.split(" "))] for t in texts], dtype="float64")

    return predict


@query
def model_scores(spark, sf):
    scored = vectors.apply_model(
        inputs.documents(spark, sf), "text", _length_model, T.ArrayType(T.DoubleType())
    )
    return scored.select(
        "row_id",
        F.col("prediction")[0].cast("bigint").alias("chars"),
        F.col("prediction")[1].cast("bigint").alias("pieces"),
    )


# --- retrieval ---------------------------------------------------------------------------------


@query
def nearest_vectors(spark, sf):
    """Every vector against all vectors, best 5."""
    stored = inputs.table(spark, sf, "embeddings")
    asked = stored.select(F.col("vec_id").alias("query_id"), "embedding")
    rows = stored.select(F.col("vec_id").alias("row_id"), "embedding")
    return vectors.knn(asked, rows, 5).select(
        "query_id", "row_id", "rank", F.round("score", 4).alias("score")
    )


@query
def clustered_nearest_vectors(spark, sf):
    """Every vector against the clustered index, best 5."""
    stored = inputs.table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return clusters.clustered_knn(stored, inputs.vector_clusters(spark, sf), 5).select(
        "query_id", "row_id", "rank", F.round("score", 4).alias("score")
    )


@query
def dense_retrieval(spark, sf):
    rows, model = inputs.index(spark, sf)
    return jobs.retrieve(inputs.requests(spark, sf), rows, model).select(
        "query_id", "rank", "row_id", "name_clean", "colors_extracted", "similarity_score"
    )


@query
def text_retrieval(spark, sf):
    """Free texts against the catalogue, best 5."""
    rows, model = inputs.index(spark, sf)
    asked = inputs.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return jobs.text_hits(asked, rows, model).select(
        "query_id", "rank", "row_id", "name_clean", "similarity_score"
    )


@query
def color_filtered_hits(spark, sf):
    rows, model = inputs.index(spark, sf)
    hits = jobs.retrieve(inputs.requests(spark, sf), rows, model)
    return filters.filter_with_fallback(hits, "colors_extracted", "color").select(
        "query_id", "row_id"
    )


@query
def category_filtered_hits(spark, sf):
    rows, model = inputs.index(spark, sf)
    hits = jobs.retrieve(inputs.requests(spark, sf), rows, model)
    return filters.filter_with_fallback(hits, "name_clean", "category").select("query_id", "row_id")


@query
def filtered_hits(spark, sf):
    rows, model = inputs.index(spark, sf)
    hits = jobs.retrieve(inputs.requests(spark, sf), rows, model)
    return filters.apply_filters(hits).select("query_id", "row_id", "rank")


@query
def keyword_corpus(spark, sf):
    return bm25.bm25_totals(bm25.bm25_documents(inputs.features(spark, sf)))


@query
def keyword_terms(spark, sf):
    index = bm25.build_keyword_index(bm25.bm25_documents(inputs.features(spark, sf)))
    return index.terms.select("term", "df", F.round("idf", 6).alias("idf"))


@query
def keyword_retrieval(spark, sf):
    keywords = inputs.keyword_index(spark, sf)
    hits = jobs.keyword_hits(inputs.requests(spark, sf), inputs.index(spark, sf)[0], 6, keywords)
    return hits.select("query_id", "rank", "row_id", "name_clean", "similarity_score")


@query
def hybrid_retrieval(spark, sf):
    rows, model = inputs.index(spark, sf)
    keywords = inputs.keyword_index(spark, sf)
    hits = jobs.hybrid_retrieve(inputs.requests(spark, sf), rows, model, 5, keywords)
    return hits.select("query_id", "rank", "row_id", "name_clean", "source", "similarity_score")


def _planned_requests(spark, sf):
    """Requests of which some have a three-word name."""
    part = inputs.table(spark, sf, "part").select(F.col("p_partkey").alias("query_id"), "p_type")
    longer = F.when(
        F.col("p_type") == "ECONOMY", F.concat_ws(" ", "name", F.lower("p_type"))
    ).otherwise(F.col("name"))
    asked = inputs.requests(spark, sf).join(part, "query_id")
    return asked.withColumn("name", longer).drop("p_type")


@query
def retrieval_plans(spark, sf):
    return planning.plan_requests(_planned_requests(spark, sf)).select(
        "query_id", "retrieval_strategy", "planned_top_k", _joined("keywords")
    )


@query
def planned_retrieval(spark, sf):
    rows, model = inputs.index(spark, sf)
    keywords = inputs.keyword_index(spark, sf)
    hits = jobs.planned_retrieve(_planned_requests(spark, sf), rows, model, keywords=keywords)
    return hits.select("query_id", "rank", "row_id", "source")


@query
def color_inference(spark, sf):
    rows, model = inputs.index(spark, sf)
    asked = inputs.requests(spark, sf)
    nested = asked.join(jobs.nest_hits(jobs.dense_hits(asked, rows, model, 3)), "query_id", "left")
    return planning.enrich_color(nested).select(
        "query_id", "final_color", "enrich_status", "enrich_detail"
    )


@query
def recommendations(spark, sf):
    """Requests to hits, filters and prompts: the flagship."""
    rows, model = inputs.index(spark, sf)
    answered = jobs.recommend(inputs.requests(spark, sf), rows, model)
    scores = F.transform("similar", lambda hit: F.format_string("%.4f", hit["similarity_score"]))
    return answered.select(
        "query_id",
        "name",
        "color",
        "prompt",
        F.size("similar").alias("n_similar"),
        F.array_join("similar.name_clean", "|").alias("similar_names"),
        F.array_join(F.col("similar.row_id").cast("array<string>"), "|").alias("similar_rows"),
        F.array_join(scores, "|").alias("similar_scores"),
    )


@query
def planned_batch(spark, sf):
    rows, model = inputs.index(spark, sf)
    planned = jobs.plan_batch(inputs.requests(spark, sf), rows, model)
    return planned.select(
        "query_id", "name", "color", F.size("similar").alias("n_similar"), "prompt"
    )


@query
def plan_traces(spark, sf):
    rows, model = inputs.index(spark, sf)
    planned = jobs.plan_batch(inputs.requests(spark, sf), rows, model)
    return planned.select("query_id", F.inline("plan_trace"))


@query
def plan_traces_without_index(spark, sf):
    planned = jobs.plan_batch(inputs.requests(spark, sf))
    return planned.select("query_id", F.inline("plan_trace"))


# --- sampling ----------------------------------------------------------------------------------


@query
def sampled_documents(spark, sf):
    return sampling.sample_n(inputs.documents(spark, sf), fixed.EVAL_SAMPLE, "row_id").select(
        "row_id"
    )


@query
def split_documents(spark, sf):
    return sampling.split(inputs.documents(spark, sf), "row_id").select("row_id", "split")


@query
def split_documents_exact(spark, sf):
    return sampling.split_exact(inputs.documents(spark, sf), "row_id").select("row_id", "split")


@query
def training_complement(spark, sf):
    rows = inputs.documents(spark, sf)
    held_out = sampling.validation_rows(sampling.split(rows, "row_id"))
    return sampling.complement(rows, held_out, "row_id").select("row_id")


@query
def first_documents(spark, sf):
    return sampling.preview(inputs.documents(spark, sf), "row_id")


# --- metrics -----------------------------------------------------------------------------------


@query
def nonempty_reference_pairs(spark, sf):
    """Pairs whose reference is empty once cleaned are skipped."""
    pairs = inputs.pairs(spark, sf)
    cut = F.regexp_replace("reference", r"(?s)^[^a-zA-Z].*$", "")
    return metrics.nonempty_references(pairs.withColumn("reference", cut)).select("pair_id")


@query
def distinct_unigrams(spark, sf):
    return metrics.distinct_n(inputs.pairs(spark, sf), "generated", 1).withColumn(
        "value", F.round("value", 6)
    )


@query
def distinct_bigrams(spark, sf):
    return metrics.distinct_n(inputs.pairs(spark, sf), "generated", 2).withColumn(
        "value", F.round("value", 6)
    )


@query
def corpus_bleu(spark, sf):
    scored = metrics.corpus_bleu(inputs.pairs(spark, sf))
    names = [name.lower().replace("-", "_") for name in fixed.BLEU_WEIGHTS]
    return scored.withColumns({name: F.round(name, 6) for name in names})


@query
def pair_rouge(spark, sf):
    scored = metrics.pair_rouge(inputs.pairs(spark, sf))
    return scored.withColumns({c: F.round(c, 6) for c in scored.columns if c != "pair_id"})


@query
def finite_losses(spark, sf):
    rows = inputs.losses(spark, sf)
    return rows.where(metrics.finite(F.col("loss"))).select("row_id", "loss")


@query
def event_perplexity(spark, sf):
    rows = inputs.losses(spark, sf)
    return rows.agg(F.round(metrics.perplexity(F.col("loss")), 6).alias("perplexity"))


def _ngram_losses(spark, sf, n):
    parted = sampling.split(inputs.documents(spark, sf), "row_id")
    fitted = language_model.NgramModel.fit(sampling.train_rows(parted), "text", n)
    scored = language_model.ngram_loss(fitted, sampling.validation_rows(parted), "text")
    return scored.select("row_id", F.round("loss", 6).alias("loss"))


@query
def unigram_losses(spark, sf):
    return _ngram_losses(spark, sf, 1)


@query
def bigram_losses(spark, sf):
    return _ngram_losses(spark, sf, 2)


@query
def evaluation_report(spark, sf):
    parted = sampling.split(inputs.documents(spark, sf), "row_id")
    report = jobs.evaluate(
        inputs.pairs(spark, sf),
        sampling.train_rows(parted),
        sampling.validation_rows(parted),
        "text",
    )
    return report.withColumn("value", F.round("value", 4))


@query
def evaluation_pairs(spark, sf):
    """Prompts split into input and reference, answered by a model that repeats its input."""
    echo = lambda df: df.withColumn("generated", F.concat("prompt", F.lit("  "), "reference"))
    return jobs.evaluation_pairs(inputs.prompted(spark, sf), echo, sample=None)


@query
def mean_generation_time(spark, sf):
    return inputs.pairs(spark, sf).agg(F.round(F.avg("gen_seconds"), 6).alias("mean_seconds"))


# --- profiling ---------------------------------------------------------------------------------


@query
def document_length_stats(spark, sf):
    stats = profiling.describe_numeric(inputs.table(spark, sf, "documents"), "n_chars")
    return stats.withColumns({c: F.round(c, 4) for c in ["mean", "std"]})


@query
def document_length_histogram(spark, sf):
    return profiling.histogram(inputs.table(spark, sf, "documents"), "n_chars")


@query
def stage_counts(spark, sf):
    """Row counts before and after each stage of an ingest."""
    path = scratch_path(spark, "ingested")
    counts = jobs.ingest_catalog(inputs.raw_catalog(spark, sf), path)
    return spark.createDataFrame(list(counts.items()), "stage string, n_rows bigint")


@query
def table_counts(spark, sf):
    documents = inputs.documents(spark, sf)
    return profiling.stage_counts(
        documents=documents, distinct=cleaning.keep_first(documents, "text")
    )


@query
def sentinel_counts(spark, sf):
    return profiling.profile_sentinel(inputs.raw_catalog(spark, sf))


@query
def null_counts(spark, sf):
    return profiling.profile_nulls(cleaning.null_sentinels(inputs.raw_catalog(spark, sf)))


@query
def table_profile(spark, sf):
    return profiling.profile_table(inputs.table(spark, sf, "orders"))
