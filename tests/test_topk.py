"""Exact top-k against brute force, on both ways to bring queries to the catalogue."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import bm25, vectors

BROADCAST = {}
BLOCKS = {"broadcast_cells": 0, "block_cells": 200}


def frame(spark, ids, rows, name):
    data = [(int(i), [float(x) for x in v]) for i, v in zip(ids, rows)]
    return spark.createDataFrame(data, f"{name} bigint, embedding array<float>")


def brute_force(queries, rows, k):
    found = []
    for q, qv in enumerate(queries):
        scored = [
            (-float(np.cumsum(qv.astype(float) * rv.astype(float))[-1]), i)
            for i, rv in enumerate(rows)
        ]
        for rank, (score, i) in enumerate(sorted(scored)[:k], 1):
            found.append((q, i, -score, rank))
    return sorted(found)


def collected(hits):
    return sorted(
        (r["query_id"], r["row_id"], r["score"], r["rank"]) for r in hits.collect()
    )


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    rows = rng.standard_normal((300, 8)).astype(np.float32)
    rows[50:150] = rows[3]  # a third of the rows are copies
    rows[200:220] = rows[4]
    return rows[:60], rows


@pytest.mark.parametrize("way", [BROADCAST, BLOCKS])
@pytest.mark.parametrize("parts", [1, 16])
@pytest.mark.parametrize("k", [1, 5])
def test_knn(spark, data, way, parts, k):
    queries, rows = data
    left = frame(spark, range(len(queries)), queries, "query_id")
    right = frame(spark, range(len(rows)), rows, "row_id").repartition(parts)
    assert collected(vectors.knn(left, right, k, **way)) == brute_force(queries, rows, k)


@pytest.mark.parametrize("way", [BROADCAST, BLOCKS])
def test_knn_with_text_keys(spark, data, way):
    queries, rows = data
    left = frame(spark, range(len(queries)), queries, "n")
    left = left.select(F.concat(F.lit("q"), "n").alias("query_id"), "embedding")
    right = frame(spark, range(len(rows)), rows, "row_id")
    got = [(int(q[1:]), i, s, r) for q, i, s, r in collected(vectors.knn(left, right, 3, **way))]
    assert sorted(got) == brute_force(queries, rows, 3)


def test_many_query_and_row_chunks(spark):
    rng = np.random.default_rng(11)
    rows = np.sort(rng.standard_normal((9000, 3)).astype(np.float32), axis=0)  # ever better rows
    rows[4000:7000] = rows[8999]
    left = frame(spark, range(2500), rows[:2500], "query_id")
    right = frame(spark, range(len(rows)), rows, "row_id").coalesce(1)
    exact = rows[:2500].astype(float) @ rows.T.astype(float)
    hits = {(r["query_id"], r["rank"]): r for r in vectors.knn(left, right, 4).collect()}
    assert len(hits) == 2500 * 4
    for q in range(0, 2500, 7):
        best = np.lexsort((np.arange(9000), -np.round(exact[q], 12)))[:4]
        assert [hits[q, r]["row_id"] for r in (1, 2, 3, 4)] == list(best)


def test_k_beyond_catalogue(spark, data):
    queries, rows = data
    left = frame(spark, range(2), queries[:2], "query_id")
    right = frame(spark, range(3), rows[:3], "row_id")
    assert vectors.knn(left, right, 10).count() == 6


def test_own_nearest_neighbour(spark, small):
    stored = spark.read.parquet(f"{small}/embeddings.parquet")
    left = stored.select(F.col("vec_id").alias("query_id"), "embedding")
    right = stored.select(F.col("vec_id").alias("row_id"), "embedding")
    best = vectors.knn(left, right, 1)
    assert best.where("abs(score - 1) > 1e-6").count() == 0
    assert best.count() == stored.count()


def test_vectors_of_other_length_are_refused(spark, data):
    queries, rows = data
    left = frame(spark, range(2), queries[:2], "query_id")
    right = frame(spark, range(2), rows[:2, :5], "row_id")
    with pytest.raises(Exception, match="every vector must have 8 numbers"):
        vectors.knn(left, right, 1, dim=8).collect()


def okapi(queries, documents, k):
    n = len(documents)
    avgdl = sum(map(len, documents)) / n
    df = Counter(t for d in documents for t in set(d))
    raw = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    floor = 0.25 * sum(raw.values()) / len(raw)
    idf = {t: floor if v < 0 else v for t, v in raw.items()}
    found = []
    for q, terms in enumerate(queries):
        scored = []
        for i, d in enumerate(documents):
            tf = Counter(d)
            score = sum(
                idf[t] * tf[t] * 2.5 / (tf[t] + 1.5 * (0.25 + 0.75 * len(d) / avgdl))
                for t in terms if t in tf
            )
            scored.append((-round(score, 9), i))
        found += [(q, i, -s, r) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("way", [BROADCAST, BLOCKS])
@pytest.mark.parametrize("parts", [1, 7])
def test_bm25(spark, way, parts):
    rnd = random.Random(3)
    words = ["red", "blue", "shoe", "bolt,", "new", "x", "y"]
    documents = [[rnd.choice(words) for _ in range(rnd.randint(0, 5))] for _ in range(200)]
    documents[:70] = [["red", "shoe"]] * 70  # a third are copies
    queries = [["red"], ["shoe", "shoe", "red"], ["absent"], ["blue", "bolt,", "x"], []]
    d = spark.createDataFrame(list(enumerate(documents)), "row_id bigint, tokens array<string>")
    q = spark.createDataFrame(list(enumerate(queries)), "query_id bigint, tokens array<string>")
    hits = bm25.bm25_search(q, d.repartition(parts), 5, **way)
    got = [(a, b, round(c, 9) + 0.0, e) for a, b, c, e in collected(hits)]
    want = okapi(queries, documents, 5)
    assert [(a, b, e) for a, b, _, e in got] == [(a, b, e) for a, b, _, e in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want])


def test_hashed_tfidf(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "")], "row_id bigint, t string")
    model = vectors.HashedTfidf.fit(df, "t", dim=16)
    rows = {r[0]: r[1] for r in df.select("row_id", model.transform(F.col("t"))).collect()}
    assert all(len(v) == 16 for v in rows.values())
    assert abs(sum(x * x for x in rows[1]) - 1) < 1e-6
    assert sum(rows[3]) == 0  # an empty text has the zero vector


def test_zero_vector_stays_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<float>")
    got = [r[0] for r in df.select(vectors.l2_normalize(F.col("v"))).collect()]
    assert got[0] == [0.0, 0.0] and np.allclose(got[1], [0.6, 0.8])
