"""The clustered index finds what a full scan finds, and reads less where the vectors have structure."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_search import cut, own_k
from test_topk import brute_force, collected, frame
from vitrine.operators import clusters, vectors

BROADCAST, BLOCKS = {}, {"broadcast_cells": 0, "block_cells": 150}


@pytest.fixture(scope="module")
def grouped():
    """Twelve groups of near vectors, one with a third of the rows, some of them copies."""
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((12, 8)) * 3
    group = np.where(np.arange(600) % 3 == 0, 0, rng.integers(0, 12, 600))
    rows = (centres[group] + 0.05 * rng.standard_normal((600, 8))).astype(np.float32)
    rows[30:60] = rows[0]
    return rows


@pytest.fixture(scope="module")
def index(spark, grouped, tmp_path_factory):
    rows = frame(spark, range(len(grouped)), grouped, "row_id").repartition(6)
    return clusters.write_clusters(rows, str(tmp_path_factory.mktemp("clusters")), cluster_rows=40)


@pytest.mark.parametrize("way", [BROADCAST, BLOCKS])
@pytest.mark.parametrize("k", [1, 7])
def test_equal_to_a_full_scan(spark, grouped, index, way, k):
    asked = frame(spark, range(80), np.concatenate([grouped[:60], -grouped[:20]]), "query_id")
    found = collected(clusters.clustered_knn(asked, index, k, **way))
    assert found == brute_force(np.concatenate([grouped[:60], -grouped[:20]]), grouped, k)


@pytest.mark.parametrize("way", [BROADCAST, BLOCKS])
@pytest.mark.parametrize("wide", [clusters.WIDE, 2])
def test_own_k(spark, grouped, index, way, wide, monkeypatch):
    monkeypatch.setattr(clusters, "WIDE", wide)
    ids = spark.createDataFrame([(q, own_k(q)) for q in range(20)], "query_id bigint, wanted bigint")
    asked = frame(spark, range(20), grouped[:20], "query_id").join(ids, "query_id")
    found = collected(clusters.clustered_knn(asked, index, F.col("wanted"), **way))
    assert found == cut(brute_force(grouped[:20], grouped, 600))


def test_clusters_that_cannot_matter_are_not_read(spark, grouped, index):
    asked = frame(spark, range(3), grouped[:3], "query_id")
    reads = clusters.cluster_reads(asked, index, 5)
    assert reads["clusters"] < 0.5 and reads["pairs"] < 0.5
    chosen = clusters._waves(asked, index, 5, 10**6, 10**6)[1]
    files = index.rows.where(F.col("cluster").isin(chosen.first()["clusters"])).inputFiles()
    plan = index.rows.where("cluster = 0")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cluster" in plan and files


def test_vectors_without_structure_and_small_tables(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((90, 16)).astype(np.float32)
    rows[40:50] = 0
    for n, folder in ((90, "a"), (3, "b"), (1, "c")):
        made = clusters.write_clusters(frame(spark, range(n), rows[:n], "row_id"), str(tmp_path / folder), 20)
        asked = frame(spark, range(50), rows[:50], "query_id")
        assert collected(clusters.clustered_knn(asked, made, 4)) == brute_force(rows[:50], rows[:n], 4)


def test_stored_vectors(spark, small, tmp_path):
    stored = spark.read.parquet(f"{small}/embeddings.parquet")
    asked = stored.select(F.col("vec_id").alias("query_id"), "embedding")
    rows = stored.select(F.col("vec_id").alias("row_id"), "embedding")
    made = clusters.write_clusters(rows, str(tmp_path / "stored"), 100)
    assert collected(clusters.clustered_knn(asked, made, 5)) == collected(vectors.knn(asked, rows, 5))


def test_empty_tables(spark, index, tmp_path):
    none = spark.createDataFrame([], "row_id bigint, embedding array<float>")
    made = clusters.write_clusters(none, str(tmp_path / "none"))
    asked = spark.createDataFrame([(1, [1.0] * 8)], "query_id bigint, embedding array<float>")
    assert clusters.clustered_knn(asked, made, 3).collect() == []
    assert clusters.clustered_knn(asked.limit(0), index, 3).collect() == []
