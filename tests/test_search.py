"""Own k of each query, the stored postings with block-max skips, one search for mixed plans."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from test_topk import BLOCKS, BROADCAST, brute_force, collected, frame, okapi
from vitrine.functions import fixed
from vitrine.operators import bm25, postings, topk, vectors
from vitrine.plans import inputs, jobs, queries


def own_k(query: int) -> int | None:
    return [1, 7, 2_000_000_000, 3, None, 0, -2][query % 7]


def cut(rows):
    return sorted(r for r in rows if (own_k(r[0]) or 0) >= r[3])


@pytest.fixture
def k_column(spark):
    ids = spark.createDataFrame([(q, own_k(q)) for q in range(40)], "query_id bigint, wanted bigint")
    return lambda df: df.join(ids, "query_id")


@pytest.mark.parametrize("way", [BROADCAST, BLOCKS])
@pytest.mark.parametrize("wide", [topk.WIDE, 2])
def test_each_query_has_its_own_k(spark, k_column, way, wide, monkeypatch):
    monkeypatch.setattr(topk, "WIDE", wide)
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((150, 6)).astype(np.float32)
    rows[20:70] = rows[2]
    asked = k_column(frame(spark, range(40), rows[:40], "query_id"))
    found = vectors.knn(asked, frame(spark, range(150), rows, "row_id").repartition(5), F.col("wanted"), **way)
    assert collected(found) == cut(brute_force(rows[:40], rows, 150))


def names(rng, n):
    words = ["red", "blue", "shoe", "bolt,", "new", "x", "y", *(f"w{i}" for i in range(60))]
    return [[rng.choice(words[: rng.choice([4, 7, 67])]) for _ in range(rng.randint(0, 6))] for _ in range(n)]


@pytest.mark.parametrize("way", [BROADCAST, {"broadcast_cells": 0, "block_cells": 900}])
@pytest.mark.parametrize("sizes", [(8192, 256), (64, 8), (1, 1)])
def test_postings_equal_brute_force(spark, k_column, tmp_path, way, sizes, monkeypatch):
    monkeypatch.setattr(bm25, "Postings", lambda: postings.Postings(sizes[1]))
    monkeypatch.setattr(
        bm25, "build_segments",
        lambda d, k1, b, avgdl: postings.build_segments(d.repartition(3), k1, b, avgdl, *sizes),
    )
    rng = random.Random(5)
    documents = names(rng, 300)
    documents[30:130] = [["red", "shoe"]] * 100  # a third are copies, and "red" is in most
    asked = [*names(rng, 36), ["absent"], [], ["red", "red", "shoe"], ["red"]]
    d = spark.createDataFrame(list(enumerate(documents)), "row_id bigint, tokens array<string>")
    q = spark.createDataFrame(list(enumerate(asked)), "query_id bigint, tokens array<string>")
    index = bm25.build_keyword_index(d, str(tmp_path / "keywords"))
    found = collected(bm25.bm25_search(k_column(q), None, F.col("wanted"), index, **way))
    want = cut(okapi(asked, documents, 300))
    assert [(a, b, e) for a, b, _, e in found] == [(a, b, e) for a, b, _, e in want]
    assert np.allclose([r[2] for r in found], [r[2] for r in want])


def one_task(documents, asked, k, block_rows=256):
    """Segments and a scorer without Spark, to see which blocks are opened."""
    avgdl = sum(map(len, documents)) / len(documents)
    rows = [(np.arange(i, min(i + 8192, len(documents)))) for i in range(0, len(documents), 8192)]
    held = [
        postings.segment(ids, pa.array([documents[i] for i in ids], pa.list_(pa.string())), fixed.BM25_K1, fixed.BM25_B, avgdl, block_rows)
        for ids in rows
    ]
    scorer = postings.Postings(block_rows)
    table = pa.table({
        "query_id": pa.array(range(len(asked)), pa.int64()),
        "k": pa.array([k] * len(asked), pa.int64()),
        "terms": pa.array([sorted(set(a)) for a in asked], pa.list_(pa.string())),
        "weights": pa.array([[float(1 + a.count(t)) for t in sorted(set(a))] for a in asked], pa.list_(pa.float64())),
    })
    return scorer, pa.Table.from_batches(topk._scan(scorer, table, iter(held)))


def test_blocks_that_cannot_matter_are_not_opened():
    rng = random.Random(6)
    documents = [["plain", f"w{rng.randrange(50)}"] for _ in range(40_000)]
    for i in rng.sample(range(40_000), 30):
        documents[i] = ["rare", "plain"]
    scorer, _ = one_task(documents, [["rare"], ["rare", "plain"], ["none"], ["plain"]], 5)
    pairs = 4 * -(-40_000 // 256)
    assert scorer.opened + scorer.skipped == pairs
    assert scorer.opened < 0.2 * pairs


def test_skipping_changes_no_hit(monkeypatch):
    rng = random.Random(7)
    documents, asked = names(rng, 3000), names(rng, 50)
    few = one_task(documents, asked, 4, 16)
    monkeypatch.setattr(topk.Best, "may_enter", lambda self, bounds, ids: np.ones(bounds.shape, bool))
    every = one_task(documents, asked, 4, 16)
    assert few[1].sort_by([("query_id", "ascending"), ("row_id", "ascending")]).equals(
        every[1].sort_by([("query_id", "ascending"), ("row_id", "ascending")])
    )
    assert few[0].skipped > 0 and every[0].skipped == 0


def test_empty_catalogue(spark, tmp_path):
    none = spark.createDataFrame([], "row_id bigint, tokens array<string>")
    asked = spark.createDataFrame([(1, ["a"])], "query_id bigint, tokens array<string>")
    assert bm25.bm25_search(asked, none, 3).collect() == []


def test_one_greedy_request_costs_itself_alone(spark, small):
    rows, model = inputs.index(spark, small)
    keywords = inputs.keyword_index(spark, small)
    asked = inputs.requests(spark, small)
    first = asked.orderBy("query_id").first()
    greedy = asked.limit(1).select(
        F.lit(-1).cast("bigint").alias("query_id"), *[F.lit(first[c]).alias(c) for c in ("name", "color", "category")],
        F.lit(2_000_000_000).alias("top_k"),
    )
    both = asked.unionByName(greedy)
    n = rows.count()
    sizes = Counter(r["query_id"] for r in jobs.retrieve(both, rows, model).select("query_id").collect())
    assert sizes.pop(-1) == n
    assert sizes == {r["query_id"]: min(n, r["top_k"]) for r in asked.collect()}
    few = jobs.keyword_hits(both, rows, F.col("top_k"), keywords).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in few} == {-1: n, **sizes}
    text = jobs.query_text(F.col("name"), F.col("color"))
    searched = both.select(text, "top_k").distinct().agg(F.sum(F.least("top_k", F.lit(n)))).first()[0]
    texts = both.select("query_id", text.alias("text"), "top_k").dropDuplicates(["text", "top_k"])
    assert jobs.text_hits(texts, rows, model, F.col("top_k")).count() == searched


def test_mixed_plans_share_their_searches(spark, small):
    plan = queries.QUERIES["planned_retrieval"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2
