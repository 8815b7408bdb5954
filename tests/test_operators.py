import math
import random

import pytest
from pyspark.sql import Observation, functions as F

from vitrine.operators import (
    cleaning, filters, hybrid, language_model, metrics, planning, profiling, sampling, sequences,
)
from vitrine.operators.numbering import number_rows


def hits(spark, color, category=""):
    rows = [
        (1, 1, "red shoe", "red", color, category),
        (1, 2, "blue shoe", "Blue, red", color, category),
        (1, 3, "green hat", "green", color, category),
    ]
    return spark.createDataFrame(
        rows, "query_id bigint, rank int, name_clean string, colors_extracted string, "
        "color string, category string",
    )


@pytest.mark.parametrize(
    "color, category, ranks",
    [
        ("RED", "", [1, 2]),
        ("black", "", [1, 2, 3]),
        ("", "", [1, 2, 3]),
        ("red", "hat", [1, 2]),  # no survivor of the colour filter is a hat: all of them stay
        ("", "Hat", [3]),
        ("blue", "shoe", [2]),
    ],
)
def test_filters(spark, color, category, ranks):
    kept = filters.apply_filters(hits(spark, color, category))
    assert sorted(r["rank"] for r in kept.collect()) == ranks


def test_filter_never_empties(spark):
    for color in ["", "red", "none", "o"]:
        kept = filters.filter_with_fallback(hits(spark, color), "colors_extracted", "color")
        assert kept.count() > 0


def test_keep_first_with_hot_copies(spark):
    rows = [(i, "copy" if i % 3 == 0 else f"text {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "row_id bigint, t string").repartition(7)
    kept = {r["row_id"] for r in cleaning.keep_first(df, "t").collect()}
    assert kept == {0} | {i for i in range(300) if i % 3}


def test_filter_short_reports(spark):
    seen = Observation("short")
    df = spark.createDataFrame([(19,), (20,), (25,)], "desc_word_count int")
    assert cleaning.filter_short(df, observation=seen).count() == 2
    assert seen.get == {"removed": 1, "remaining": 2}


def test_merge_prefers_dense(spark):
    schema = "query_id bigint, rank int, row_id bigint, name_clean string, score double"
    dense = spark.createDataFrame([(1, 1, 10, "a", 0.9), (1, 2, 11, "a", 0.8), (1, 3, 12, "b", 0.7)], schema)
    keyword = spark.createDataFrame([(1, 1, 20, "b", 9.0), (1, 2, 21, "c", 8.0), (1, 3, 22, "d", 7.0)], schema)
    merged = sorted(tuple(r) for r in hybrid.merge_hits(dense, keyword, 3).select("rank", "row_id", "source").collect())
    assert merged == [(1, 10, "dense"), (2, 12, "dense"), (3, 21, "keyword")]


def test_merge_has_no_repeated_name(spark):
    schema = "query_id bigint, rank int, row_id bigint, name_clean string, score double"
    rnd = random.Random(5)
    draw = lambda: spark.createDataFrame(
        [(q, r, r, rnd.choice("abcdefg"), 1.0) for q in range(20) for r in range(1, 9)], schema
    )
    merged = hybrid.merge_hits(draw(), draw(), 4)
    assert merged.groupBy("query_id", "name_clean").count().where("count > 1").count() == 0
    ranks = merged.groupBy("query_id").agg(F.sort_array(F.collect_list("rank")).alias("r"))
    assert all(r["r"] == list(range(1, len(r["r"]) + 1)) and len(r["r"]) <= 4 for r in ranks.collect())


@pytest.mark.parametrize(
    "color, best, expected",
    [
        ("", "black, blue", ("black, blue", "ok")),
        ("", "", ("", "warn")),
        ("Red", "blue", ("Red", "skipped")),
        ("", None, ("", "skipped")),
    ],
)
def test_enrich(spark, color, best, expected):
    similar = [] if best is None else [(1, best, 0.5)]
    df = spark.createDataFrame(
        [("n", color, similar)],
        "name string, color string, similar array<struct<rank:int,colors_extracted:string,"
        "similarity_score:double>>",
    )
    row = planning.enrich_color(df).first()
    assert (row["final_color"], row["enrich_status"]) == expected


def test_retrieval_plan(spark):
    df = spark.createDataFrame(
        [("Running Shoes", "Black", "shoes"), ("Floral Maxi Dress", "", "")],
        "name string, color string, category string",
    )
    first, second = planning.plan_requests(df).collect()
    assert (first["retrieval_strategy"], first["planned_top_k"]) == ("dense", 4)
    assert first["keywords"] == ["running", "shoes", "black"]
    assert (second["retrieval_strategy"], second["planned_top_k"]) == ("hybrid", 3)


# --- sampling ----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 9, 10, 11, 1000])
def test_exact_split(spark, n):
    df = spark.range(n).withColumnRenamed("id", "row_id").repartition(5)
    parts = sampling.split_exact(df, "row_id")
    counts = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert counts.get("val", 0) == math.ceil(n / 10)
    assert sum(counts.values()) == n


def test_split_is_disjoint_and_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "row_id")
    one = {tuple(r) for r in sampling.split(df.coalesce(1), "row_id").collect()}
    many = {tuple(r) for r in sampling.split(df.repartition(16), "row_id").collect()}
    assert one == many and len({r[0] for r in one}) == 2000


def test_sample_is_stable(spark):
    df = spark.range(500).withColumnRenamed("id", "row_id")
    a = [r[0] for r in sampling.sample_n(df.repartition(9), 50, "row_id").collect()]
    b = [r[0] for r in sampling.sample_n(df.coalesce(1), 50, "row_id").collect()]
    assert sorted(a) == sorted(b) and len(a) == 50
    assert sampling.sample_n(df, 900, "row_id").count() == 500


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    rows = number_rows(df, [F.desc("x")], "n", 5).collect()
    assert sorted((r.n, r.x) for r in rows) == [(5 + i, 999 - i) for i in range(1000)]


def test_vocabulary_keeps_every_token(spark):
    df = spark.range(40_000).select(F.concat(F.lit("common w"), "id").alias("prompt"))
    vocab = sequences.build_vocab(df, "prompt")
    assert vocab.count() == 40_001 and vocab.where("id = 2").first().token == "common"
    assert vocab.agg(F.max("id")).first()[0] == 40_002


# --- sequences ---------------------------------------------------------------------------------


def test_encode_both_ways(spark):
    texts = [(1, "a b a c"), (2, ""), (3, "zz a " * 200), (4, None)]
    df = spark.createDataFrame(texts, "row_id bigint, prompt string")
    vocab = sequences.build_vocab(df.where("row_id = 1"), "prompt", 2)
    assert [tuple(r) for r in vocab.orderBy("id").collect()] == [("a", 2, 2), ("b", 3, 1)]
    local = sequences.encode(df, "prompt", vocab, 8)
    joined = sequences.encode(df, "prompt", vocab, 8, broadcast_bytes=1)
    columns = ["row_id", "input_ids", "attention_mask", "labels"]
    got = {r[0]: r for r in local.select(columns).collect()}
    assert got == {r[0]: r for r in joined.select(columns).collect()}
    assert got[1]["input_ids"] == [2, 3, 2, 1, 0, 0, 0, 0]
    assert got[1]["attention_mask"] == [1, 1, 1, 1, 0, 0, 0, 0]
    assert got[2]["input_ids"] == [0] * 8
    assert got[3]["input_ids"] == [1, 2] * 4 and got[3]["labels"] == got[3]["input_ids"]


# --- metrics -----------------------------------------------------------------------------------


def pairs(spark, rows):
    return spark.createDataFrame(
        [(i, r, g) for i, (r, g) in enumerate(rows)], "pair_id bigint, reference string, generated string"
    )


def test_distinct(spark):
    df = spark.createDataFrame([("a b a",), ("b",)], "t string")
    assert metrics.distinct_n(df, "t", 1).first()["value"] == 0.5
    assert metrics.distinct_n(df, "t", 2).first()["value"] == 1.0
    assert metrics.distinct_n(df.limit(0), "t", 1).first()["value"] == 0.0


def report(spark, rows):
    return {r["metric"]: r["value"] for r in metrics.metrics_report(pairs(spark, rows)).collect()}


def test_identical_texts_score_one(spark):
    scores = report(spark, [("the red shoe is here now", "the red shoe is here now")])
    assert scores["BLEU-1"] == scores["BLEU-2"] == scores["BLEU-4"] == 1.0
    assert scores["ROUGE-1"] == scores["ROUGE-2"] == scores["ROUGE-L"] == 1.0


def test_bleu_by_hand(spark):
    # 2 of 4 words match, no longer n-gram does; the text is as long as its reference
    scores = report(spark, [("a b c d", "a x c y")])
    assert scores["BLEU-1"] == pytest.approx(0.5)
    assert scores["BLEU-2"] == pytest.approx(math.sqrt(0.5 * 0.1 / 3))
    assert report(spark, [("a b", "c d")])["BLEU-1"] == 0.0
    short = report(spark, [("a b c d", "a b")])
    assert short["BLEU-1"] == pytest.approx(math.exp(1 - 4 / 2))


def test_rouge_by_hand(spark):
    row = metrics.pair_rouge(pairs(spark, [("a b c d", "a c d e f"), ("a", "")])).orderBy("pair_id").collect()
    p, r = 3 / 5, 3 / 4
    assert row[0]["rouge_1"] == pytest.approx(2 * p * r / (p + r))
    assert row[0]["rouge_l"] == pytest.approx(2 * p * r / (p + r))
    p, r = 1 / 4, 1 / 3
    assert row[0]["rouge_2"] == pytest.approx(2 * p * r / (p + r))
    assert tuple(row[1])[1:] == (0.0, 0.0, 0.0)


def test_lcs_against_table(spark):
    rnd = random.Random(1)
    for _ in range(200):
        a = [rnd.choice("abc") for _ in range(rnd.randint(0, 80))]
        b = [rnd.choice("abcd") for _ in range(rnd.randint(0, 80))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert metrics._lcs(a, b) == table[-1][-1]


def test_perplexity(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (float("inf"),), (None,)], "loss double")
    value = lambda d: d.agg(metrics.perplexity(F.col("loss"))).first()[0]
    assert value(df) == pytest.approx(math.exp(2.0))
    assert value(df.limit(0)) == math.inf


def test_bigram_loss_by_hand(spark):
    train = spark.createDataFrame([(1, "a b a")], "row_id bigint, t string")
    test = spark.createDataFrame([(2, "a c")], "row_id bigint, t string")
    model = language_model.NgramModel.fit(train, "t", 2)
    assert (model.n_words, model.n_tokens) == (2, 3)
    loss = language_model.ngram_loss(model, test, "t").first()["loss"]
    # P(a | start) = (1 + 1) / (1 + 3), P(c | a) = (0 + 1) / (1 + 3): 'a' is followed once
    assert loss == pytest.approx(-(math.log(2 / 4) + math.log(1 / 4)) / 2)


# --- profiling ---------------------------------------------------------------------------------


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0,), (5,), (10,), (None,)], "n int")
    counts = {r["bin"]: r["n"] for r in profiling.histogram(df, "n", 10).collect()}
    assert counts == {b: int(b in (0, 5, 9)) for b in range(10)}
    same = {r["bin"]: r["n"] for r in profiling.histogram(df.where("n = 5"), "n", 3).collect()}
    assert same == {0: 1, 1: 0, 2: 0}


def test_describe(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "n int")
    row = profiling.describe_numeric(df, "n").first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (4, 2.5, 1.0, 4.0)
    assert (row["p25"], row["p50"], row["p75"]) == (1.75, 2.5, 3.25)
    assert row["std"] == pytest.approx(1.2909944487)
