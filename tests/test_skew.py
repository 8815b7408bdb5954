"""Hot keys, shuffled joins and repeated rows change the work, not the result."""

import math
import random
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from oracle_check import compare, connect
from vitrine.operators import joins, language_model
from vitrine.plans import inputs, jobs


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.fixture
def shuffled(spark):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
    ):
        yield


@pytest.mark.parametrize(
    "name",
    ["recommendations", "hybrid_retrieval", "unigram_losses", "bigram_losses", "catalog_features",
     "training_complement", "document_length_histogram", "batch_results"],
)
def test_queries_with_shuffled_joins(spark, small, shuffled, name):
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert compare(spark, connect(small), small, name, queries[name], oracles[name]) is None


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, shuffled, how, monkeypatch):
    monkeypatch.setattr(joins, "HEAVY_KEYS", 2)
    rows = spark.range(900).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
    )
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4)], "key string, v int")
    heavy = joins.heavy_keys(rows, "key", min_rows=50)
    assert heavy.count() == 2 and heavy.where("key = 'hot'").count() == 1
    columns = ["row_id", "key", "v"]
    got = joins.salted_join(rows, lookup, "key", F.col("row_id"), how, heavy).select(columns)
    want = rows.join(lookup, "key", how).select(columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_parts_follow_the_share(spark, monkeypatch):
    """A key of a third of the rows is cut until no part holds more than any other key may."""
    monkeypatch.setattr(joins, "HEAVY_KEYS", 30)
    rows = spark.range(9000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key")
    )
    heavy = joins.heavy_keys(rows, "key", min_rows=100).collect()
    assert [tuple(r) for r in heavy] == [("hot", 10)]
    lookup = spark.createDataFrame([("hot", 1), ("1", 2)], "key string, v int")
    monkeypatch.setattr(joins, "HEAVY_ROWS", 100)
    met = joins.salted_join(rows, lookup, "key", F.col("row_id"))
    assert met.groupBy("v").count().orderBy("v").collect() == [(1, 3000), (2, 1)]


@pytest.mark.parametrize("n", [1, 2])
def test_losses_of_hot_terms(spark, shuffled, n, monkeypatch):
    """Against counting by hand: texts of one hot word, unseen words and contexts, repeats, empty and null texts."""
    monkeypatch.setattr(joins, "HEAVY_ROWS", 2)
    rnd = random.Random(n)
    text = lambda words: " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 30)))
    train = [text("aaaab") for _ in range(40)] + [text("abcd") for _ in range(40)] + ["", None]
    test = [text("abce") for _ in range(40)] + ["a " * 50, "a", "f", "f f", "", None] + ["a"] * 20
    table = lambda texts: spark.createDataFrame(list(enumerate(texts)), "row_id bigint, t string")
    model = language_model.NgramModel.fit(table(train), "t", n)
    scored = language_model.ngram_loss(model, table(test), "t")
    plan = scored._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange hashpartitioning(term") == 2  # test terms, counts
    assert plan.count("Exchange hashpartitioning(row_id") == 1  # sums

    def grams(t):
        words = (["<s>"] if n == 2 else []) + (t or "").split()
        return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]

    seen = Counter(g for t in train for g in grams(t))
    before = Counter()
    for g, c in seen.items():
        before[g[:-1]] += c
    size = len({g[-1] for g in seen}) + 1
    want = {
        i: sum(-math.log((seen[g] + 1) / (before[g[:-1]] + size)) for g in found) / len(found)
        for i, t in enumerate(test)
        if (found := grams(t))
    }
    assert {r["row_id"]: r["loss"] for r in scored.collect()} == pytest.approx(want)


def test_hot_request_and_hot_product(spark, small, monkeypatch):
    """A third of the requests ask the same and a third of the catalogue is one product."""
    monkeypatch.setattr(joins, "HEAVY_ROWS", 5)
    rows, model = inputs.index(spark, small)
    one = rows.orderBy("row_id").limit(1).drop("row_id")
    n = rows.count()
    ids = F.explode(F.sequence(F.lit(10_000).cast("bigint"), F.lit(10_000 + n // 2).cast("bigint")))
    copies = one.select(ids.alias("row_id"), *one.columns)
    crowded = rows.unionByName(copies)
    asked = inputs.requests(spark, small)
    first = asked.orderBy("query_id").first()
    same = spark.range(asked.count() // 2).select(
        (F.col("id") + 10_000).alias("query_id"),
        *[F.lit(first[c]).alias(c) for c in ["name", "color", "category"]],
        F.lit(first["top_k"]).cast("int").alias("top_k"),
    )
    answers = jobs.recommend(asked.unionByName(same), crowded, model).select("query_id", "similar")
    by_id = {r["query_id"]: r["similar"] for r in answers.collect()}
    assert len(by_id) == asked.count() + asked.count() // 2
    assert all(v == by_id[first["query_id"]] for q, v in by_id.items() if q >= 10_000)
    hits = jobs.retrieve(asked, crowded, model, 5)
    assert hits.where("rank = 1").count() == asked.count()
