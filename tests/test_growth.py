"""Work that must not be repeated, or grow faster than its input."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from test_topk import brute_force, collected, frame
from vitrine.functions import text
from vitrine.operators import bm25, clusters, language_model, profiling, sequences, topk, vectors
from vitrine.plans import inputs, jobs


def counting(spark, df, column):
    """``df`` and an accumulator of how many rows of it were computed."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def same(value):
        seen.add(1)
        return value

    return df.withColumn(column, same.asNondeterministic()(column)), seen


def test_queries_travel_once_to_each_part(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((400, 8)).astype(np.float32)  # without structure: a query needs every cluster
    index = clusters.write_clusters(frame(spark, range(400), rows, "row_id"), str(tmp_path / "rows"), 10)
    cuts = clusters._parts({r["cluster"]: r["n"] for r in index.centres.orderBy("cluster").collect()}, 120)
    asked = frame(spark, range(30), rows[:30], "query_id").select("query_id", F.lit(3).cast("bigint").alias("k"), "embedding")
    chosen = asked.select(
        "*", F.lit(float("-inf")).alias("floor"), F.array(*[F.lit(c) for c in sorted(cuts)]).alias("clusters")
    )
    dealt = clusters._dealt(chosen, cuts)
    parts = {part for part, _ in cuts.values()}
    assert len(cuts) > 20 and len(parts) < 8
    assert dealt.count() == 30 * len(parts)
    listed = dealt.groupBy("query_id").agg(F.flatten(F.collect_list("clusters")).alias("c")).collect()
    assert all(sorted(r["c"]) == sorted(cuts) for r in listed)
    found = collected(clusters.clustered_knn(asked.drop("k"), index, 3, broadcast_cells=0, block_cells=1000))
    assert found == brute_force(rows[:30], rows, 3)


def test_large_clusters_are_cut():
    cuts = clusters._parts({0: 10, 1: 10, 2: 95, 3: 5, 4: 30}, 30)
    assert cuts == {0: (0, 1), 1: (0, 1), 2: (1, 4), 3: (5, 1), 4: (6, 1)}


@pytest.mark.parametrize("broadcast_cells", [10**6, 0])
def test_no_task_meets_more_than_its_share(spark, monkeypatch, broadcast_cells):
    monkeypatch.setattr(topk, "TASK_PRODUCTS", 2000)
    monkeypatch.setattr(topk, "CHUNK_QUERIES", 10)
    rng = np.random.default_rng(5)
    rows = rng.standard_normal((90, 8)).astype(np.float32)
    met = spark.sparkContext.accumulator(0)

    class Counted(topk.InnerProduct):
        def prepare(self, queries):
            met.add(1)
            return super().prepare(queries)

    asked, stored = frame(spark, range(40), rows[:40], "query_id"), frame(spark, range(90), rows, "row_id").coalesce(1)
    found = topk.blocked_topk(asked, stored, 3, Counted(8), broadcast_cells=broadcast_cells, block_cells=10**6)
    assert collected(found) == brute_force(rows[:40], rows, 3)
    assert met.value >= 90 * 8 * 40 / 2000  # one block at least in each of that many tasks


def test_grid():
    monkey = topk.TASK_PRODUCTS
    assert topk.grid_for(1, 1, 0) == (1, 1)
    assert topk.grid_for(3, 3, 9 * monkey) == (3, 3)
    queries, rows = topk.grid_for(3, 3, 240 * monkey)
    assert queries * rows >= 240 and queries == rows == 18


def test_numbers_are_computed_once(spark):
    df, seen = counting(spark, spark.range(500).select(F.col("id").cast("string").alias("v")), "v")
    row = profiling.describe_numeric(df.select(F.col("v").cast("int").alias("n")), "n").first()
    assert (row["count"], row["min"], row["p50"], row["max"]) == (500, 0.0, 249.5, 499.0)
    assert seen.value == 500


def test_prompts_are_computed_once(spark):
    words = F.concat_ws(" ", F.lit("a"), F.col("id") % 7, F.col("id") % 3)
    prompts, seen = counting(spark, spark.range(300).select(F.col("id").alias("row_id"), words.alias("prompt")), "prompt")
    assert jobs.prepare_sequences(prompts, max_length=4).count() == 300
    assert seen.value == 300


def test_dictionary_of_a_worker_is_bounded():
    assert sequences.BROADCAST_BYTES <= 16 << 20


def test_equal_requests_are_searched_once(spark):
    asked = spark.createDataFrame([(i, "hot bolt" if i < 8 else "cold bolt", "hot") for i in range(10)], "query_id bigint, name string, color string")
    seen = []

    def find(unique):
        seen.append(unique.count())
        hit = (F.lit(1).alias("rank"), F.lit(5).cast("bigint").alias("row_id"), F.col("name").alias("name_clean"))
        return unique.select("query_id", *hit, F.lit("").alias("colors_extracted"), F.lit(0.5).alias("similarity_score"))

    rows = jobs._with_similar(asked, find).collect()
    assert seen == [2]
    assert sorted(r["query_id"] for r in rows) == list(range(10))
    assert all(r["similar"][0]["name_clean"] == r["name"] for r in rows)


def test_every_match_of_a_rule_holds_a_sign():
    samples = ["#a { b }", "<b>", "http://x www.y", 'x "y" z', "a... b", "a,b, c", "a? b!", "a. b.", "a--b", "don't it's"]
    guarded = [r for r in text.CLEANING_RULES + text.TREEBANK_RULES if len(r) > 2]
    assert len(guarded) == 12
    for pattern, _, *signs in guarded:
        plain = pattern.replace(r"\p{L}\p{N}", "a-zA-Z0-9").replace(r"\p{Z}", " ")
        found = [m.group() for s in samples for m in re.finditer(plain, s)]
        assert found and all(any(sign in m for sign in signs) for m in found), pattern


def test_embedder_counts_each_text_once_a_bucket(spark):
    texts = ["B a b  B ", "", None, "\x1cc a\x85", "a b c d İ"]
    numbers = vectors.texts_per_bucket(pa.array([t and t.lower() for t in texts]), 5)
    held = [{int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 5 for w in (t or "").lower().split()} for t in texts]
    assert numbers.tolist() == [sum(b in h for h in held) for b in range(5)]
    model = vectors.HashedTfidf.fit(spark.createDataFrame([(t,) for t in texts], "t string").repartition(3), "t", 5)
    assert model.idf == [math.log((1 + len(texts)) / (1 + n)) + 1 for n in numbers.tolist()]
    assert vectors.HashedTfidf.fit(spark.createDataFrame([], "t string"), "t", 2).idf == [1.0, 1.0]


def test_words_between_single_blanks_are_counted_without_cutting(spark):
    texts = ["", " ", "a", "a b", " a b", "a b ", "a  b", "a\tb c", "a\x1cb", "a\u00a0b", "\u00e9 b c", "a\u3000 b", None]
    counted = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.word_count(F.col("t")).alias("n"))
    assert [(r["t"], r["n"]) for r in counted.collect()] == [(t, None if t is None else len(t.split())) for t in texts]
    assert dict(counted.dtypes)["n"] == "int"


def test_a_run_of_odd_signs_and_blanks_is_replaced_once(spark):
    unguarded = [r for r in text.CLEANING_RULES if len(r) == 2]
    assert len(unguarded) == 2  # others, than ASCII and odd signs, search no text without their signs
    rows = spark.createDataFrame([("a (b)\t:\x1c c\x00~d",)], "t string").select(text.clean_text(F.col("t")))
    assert rows.first()[0] == "a b c d"


def test_keyword_documents_are_computed_once(spark, tmp_path):
    named = spark.createDataFrame([(i, f"name {i % 3}") for i in range(30)], "row_id bigint, name string")
    df, seen = counting(spark, named, "name")
    documents = df.select("row_id", F.split("name", " ").alias("tokens"))
    index = bm25.build_keyword_index(documents, str(tmp_path / "keywords"))
    assert seen.value == 30
    assert {r["term"]: r["df"] for r in index.terms.collect()} == {"name": 30, "0": 10, "1": 10, "2": 10}


@pytest.mark.parametrize("n", [1, 2])
def test_a_batch_of_texts_sends_a_term_once(spark, n):
    texts = ["a b a b", "", None, "  ", "b", "\u00e9\u00a0a b \x1f"]
    want = Counter()
    for t in texts:
        words = (t or "").split()
        want.update(words if n == 1 else [f"{x} {y}" for x, y in zip(["<s>", *words], words)])
        want.update(["<s>", *words][: len(words)] if n == 2 else [])
    terms, counts = language_model.gram_counts(pa.array(texts), n).columns
    assert len(set(terms.to_pylist())) == len(terms)
    assert dict(zip(terms.to_pylist(), counts.to_pylist())) == want
    assert language_model.gram_counts(pa.array([None, ""], pa.string()), n).num_rows == 0
    model = language_model.NgramModel.fit(spark.createDataFrame([(t,) for t in texts], "t string").repartition(3), "t", n)
    assert {r["term"]: r["c"] for r in model.counts.collect()} == want


def test_requests_of_one_file_are_worked_on_by_all_cores(spark, small):
    asked = inputs.requests(spark, small)
    assert asked.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert asked.count() == inputs.table(spark, small, "part").count()
