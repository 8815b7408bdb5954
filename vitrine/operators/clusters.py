"""A clustered vector index and exact top-k that reads only the clusters that can matter.

Rows are stored by cluster (one folder each), with every cluster's centre, radius and size in a small table of at most
``MAX_CLUSTERS`` rows. For a query q no row of a cluster scores more than ``q * centre + |q| * radius``, by the triangle inequality.
A search goes in two waves: the clusters nearest to a query that hold k rows give a score that the k-th hit has at least; after that
only clusters whose bound reaches this score are read, and of their rows each query meets only its own clusters. Centres come from a
sample of bounded size; they decide how much is read, never what is found.

Queries travel like those of ``topk``: by broadcast up to a checked size, beyond that in blocks that meet blocks of the clusters they
need. How much is saved depends on the data: clustered vectors leave most of the index unread, vectors without structure in many
dimensions leave next to nothing (``cluster_reads`` tells).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vitrine.operators.topk import (
    BLOCK_CELLS,
    BROADCAST_CELLS,
    CHUNK_QUERIES,
    TASK_PRODUCTS,
    WIDE,
    Best,
    InnerProduct,
    blocks_for,
    hits_of,
    ranked,
    total,
    whole,
)
from vitrine.session import materialize

MAX_CLUSTERS = 4096
CLUSTER_ROWS = 1024
SAMPLE_ROWS = 32  # sampled rows for each centre
SPAN = 1e-9  # relative room for rounding in the bounds


@dataclass
class ClusteredIndex:
    """``rows (row_id, embedding, cluster)`` and ``centres (cluster, centre, radius, n)``."""

    rows: DataFrame
    centres: DataFrame


def _centres(index: DataFrame, n: int, clusters: int) -> np.ndarray:
    one_of = max(1, n // (clusters * SAMPLE_ROWS))
    sample = index.where(F.pmod(F.xxhash64("row_id"), F.lit(one_of)) == 0)
    points = sample.select(F.col("embedding").cast("array<double>").alias("point")).distinct()
    clusters = min(clusters, points.count())  # copies make no clusters of their own
    if clusters < 2:
        return np.array(points.first()["point"])[None, :]
    features = points.select(array_to_vector("point").alias("features"))
    model = KMeans(k=clusters, seed=1, maxIter=10, initMode="random").fit(features)
    return np.array(model.clusterCenters())


def write_clusters(
    index: DataFrame, path: str, cluster_rows: int = CLUSTER_ROWS, max_clusters: int = MAX_CLUSTERS
) -> ClusteredIndex:
    """Cluster ``index (row_id, embedding)`` and write it; a cluster of many rows is written by many tasks."""
    n = index.count()
    centres = _centres(index, n, min(max_clusters, -(-n // cluster_rows))) if n else np.zeros((1, 0))
    squares = np.square(centres).sum(axis=1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = InnerProduct(centres.shape[1])
        for batch in batches:
            matrix = scorer.matrix(batch.column("embedding")).astype(np.float64)
            nearest = (2 * matrix @ centres.T - squares).argmax(axis=1)
            away = np.linalg.norm(matrix - centres[nearest], axis=1)
            columns = [batch.column("row_id"), batch.column("embedding"), pa.array(nearest, pa.int32()), pa.array(away)]
            yield pa.RecordBatch.from_arrays(columns, names=["row_id", "embedding", "cluster", "away"])

    kinds = "row_id bigint, embedding array<float>, cluster int, away double"
    placed = index.select("row_id", F.col("embedding").cast("array<float>")).mapInArrow(assign, kinds)
    sorted_rows = placed.repartitionByRange("cluster", "row_id").sortWithinPartitions("cluster", "row_id")
    sorted_rows.write.mode("overwrite").partitionBy("cluster").parquet(f"{path}/rows")
    spark = index.sparkSession
    sizes = _rows(spark, path, "away double").groupBy("cluster").agg(F.max("away").alias("radius"), F.count("*").alias("n"))
    listed = spark.createDataFrame(
        [(i, c.tolist()) for i, c in enumerate(centres)], "cluster int, centre array<double>"
    )
    listed.join(sizes, "cluster").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    return read_clusters(spark, path)


def _rows(spark: SparkSession, path: str, more: str = "embedding array<float>") -> DataFrame:
    return spark.read.schema(f"row_id bigint, {more}, cluster int").parquet(f"{path}/rows")


def read_clusters(spark: SparkSession, path: str) -> ClusteredIndex:
    return ClusteredIndex(_rows(spark, path), spark.read.parquet(f"{path}/centres"))


class _Centres:
    """The table of centres in the driver and, by broadcast, in the tasks."""

    def __init__(self, centres: DataFrame):
        rows = centres.orderBy("cluster").collect()  # at most MAX_CLUSTERS rows
        self.numbers = np.array([r["cluster"] for r in rows], dtype=np.int32)
        self.matrix = np.array([r["centre"] for r in rows]).reshape(len(rows), len(rows[0]["centre"]) if rows else 0)
        self.radius = np.array([r["radius"] for r in rows])
        self.n = np.array([r["n"] for r in rows], dtype=np.int64)
        self.norms = np.linalg.norm(self.matrix, axis=1)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest score that a row of each cluster can have with each query."""
        norms = np.linalg.norm(queries, axis=1)[:, None]
        room = SPAN * norms * (self.norms + self.radius) + 1e-30
        return queries @ self.matrix.T + norms * self.radius + room

    def nearest(self, queries: np.ndarray, k: np.ndarray) -> np.ndarray:
        """A mask of the clusters with the nearest centres that hold k rows."""
        order = np.argsort(-(queries @ self.matrix.T), axis=1, kind="stable")
        held = np.cumsum(self.n[order], axis=1) - self.n[order]  # rows in the clusters before
        chosen = np.zeros(order.shape, dtype=bool)
        np.put_along_axis(chosen, order, held < k[:, None], axis=1)
        return chosen


def _choose(queries: DataFrame, centres, dim: int) -> DataFrame:
    """``queries`` with the ``clusters`` to read: the nearest ones or, given a ``floor``, the others that reach it."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = centres.value
        # An empty index has no centres. A query has a number for every centre: few queries at once.
        pieces = (b.slice(at, CHUNK_QUERIES) for b in batches for at in range(0, b.num_rows, CHUNK_QUERIES))
        for batch in pieces if dim else ():
            matrix = InnerProduct(dim).matrix(batch.column("embedding")).astype(np.float64)
            k, floor = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "floor"))
            chosen = table.nearest(matrix, k)
            if len(floor) and not np.isnan(floor).any():
                chosen = (table.bounds(matrix) >= floor[:, None]) & ~chosen
            ends = np.concatenate([[0], np.cumsum(chosen.sum(axis=1))]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(table.numbers[np.nonzero(chosen)[1]]))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=[*batch.schema.names, "clusters"])

    schema = T.StructType([*queries.schema.fields, T.StructField("clusters", T.ArrayType(T.IntegerType()))])
    return queries.mapInArrow(choose, schema)


def _scan(scorer: InnerProduct, queries: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Score every row against the queries that chose its cluster."""
    blocks = []
    for start in range(0, queries.num_rows, CHUNK_QUERIES):
        block = queries.slice(start, CHUNK_QUERIES)
        k = whole(block, "k").to_numpy(zero_copy_only=False)
        best = Best(np.minimum(k, WIDE))
        best.floor[:] = whole(block, "floor").to_numpy(zero_copy_only=False)
        clusters = whole(block, "clusters")
        owner = np.repeat(np.arange(len(k)), clusters.value_lengths().to_numpy(zero_copy_only=False))
        chosen = clusters.flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(chosen, kind="stable")
        blocks.append((block, scorer.prepare(block), best, owner[order], chosen[order]))
    for batch in batches:
        here = batch.column("cluster").to_numpy(zero_copy_only=False)
        for cluster in np.unique(here):
            part = batch.filter(pa.array(here == cluster)).select(["row_id", "embedding"])
            for rows in scorer.chunks(part):
                for block, state, best, owner, chosen in blocks:
                    asking = owner[slice(*np.searchsorted(chosen, [cluster, cluster + 1]))]
                    wide = best.k[asking] >= WIDE  # keep none of theirs here, see topk
                    if len(asking[~wide]):
                        scorer.score(state, rows, best, asking[~wide])
                    for query in asking[wide]:
                        scores = scorer.exact(state, rows, query)
                        yield hits_of(block, np.full(len(scores), query), rows.ids, scores)
    for block, _, best, _, _ in blocks:
        yield hits_of(block, best.query, best.ids, best.scores)


def _meet(chosen: DataFrame, index: ClusteredIndex, table: _Centres, dim: int, broadcast_cells: int, block_cells: int):
    """``(query_id, k, row_id, score)``: what ``chosen`` queries find in their clusters."""
    scorer, kind = InnerProduct(dim), chosen.schema["query_id"].dataType
    names = [("query_id", kind), ("k", T.LongType()), ("row_id", T.LongType()), ("score", T.DoubleType())]
    schema = T.StructType([T.StructField(n, t) for n, t in names])
    pairs = chosen.select("query_id", F.explode("clusters").alias("cluster"))
    needed = {r["cluster"]: r["count"] for r in pairs.groupBy("cluster").count().collect()}  # at most MAX_CLUSTERS
    rows = index.rows.where(F.col("cluster").isin(*needed)) if needed else index.rows.limit(0)
    if total(chosen, F.lit(dim) + F.size("clusters")) <= broadcast_cells:
        shared = chosen.sparkSession.sparkContext.broadcast(chosen.toArrow())

        def scan(batches):
            return _scan(scorer, shared.value, batches)

        return rows.mapInArrow(scan, schema)

    # Neighbouring clusters make parts of like size; a query travels once to each part that it needs, with its clusters there.
    sizes = dict(zip(table.numbers.tolist(), table.n.tolist(), strict=True))
    cells = sum(sizes[c] for c in needed) * dim
    tasks = blocks_for(sum(sizes[c] * n for c, n in needed.items()) * dim, TASK_PRODUCTS)
    parts = max(blocks_for(cells, block_cells), math.isqrt(tasks - 1) + 1)
    query_blocks = max(blocks_for(total(chosen, F.lit(dim)), block_cells), blocks_for(tasks, parts))
    cuts = _parts({c: sizes[c] for c in sorted(needed)}, blocks_for(cells, parts) // max(1, dim))
    width = max(1, sum(dict(cuts.values()).values()))
    listed = chosen.sparkSession.createDataFrame([(c, *cut) for c, cut in cuts.items()], "cluster int, part int, cut int")
    own = F.col("part") + F.pmod(F.xxhash64("row_id"), F.col("cut")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("__query")
    left = rows.join(F.broadcast(listed), "cluster").select(*rows.columns, own.alias("__part"), every)
    right = _dealt(chosen, cuts).withColumn("__query", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))
    keys = ("__part", "__query")
    # A number of its own: partitions are dealt by work, and would be joined by size.
    left, right = (d.repartition(2 * width * query_blocks, *keys) for d in (left, right))

    def meet(part: pa.Table, block: pa.Table) -> pa.Table:
        found = [("query_id", block.schema.field("query_id").type), ("k", pa.int64()), ("row_id", pa.int64())]
        batches = part.combine_chunks().to_batches()
        return pa.Table.from_batches(_scan(scorer, block, batches), schema=pa.schema([*found, ("score", pa.float64())]))

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)


def _parts(sizes: dict[int, int], most: int) -> dict[int, tuple[int, int]]:
    """``(part, cut)`` of each cluster: neighbours share a part of ``most`` rows, a larger cluster is cut into parts of its own."""
    cuts, part, held = {}, 0, 0
    for cluster, n in sizes.items():
        cut = blocks_for(n, max(1, most))
        if held and (cut > 1 or held + n > most):
            part, held = part + 1, 0
        cuts[cluster] = (part, cut)
        part, held = (part + cut, 0) if cut > 1 else (part, held + n)
    return cuts


def _dealt(chosen: DataFrame, cuts: dict[int, tuple[int, int]]) -> DataFrame:
    """``chosen`` once for each part that holds some of its clusters, with those; ``__part`` tells which."""
    last = max(cuts, default=-1) + 1
    part_of, cut_of = np.zeros(last, np.int32), np.ones(last, np.int32)
    for cluster, (part, cut) in cuts.items():
        part_of[cluster], cut_of[cluster] = part, cut

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (b.slice(at, CHUNK_QUERIES) for b in batches for at in range(0, b.num_rows, CHUNK_QUERIES))
        for batch in pieces:
            lists = batch.column("clusters")
            clusters = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            part = part_of[clusters]
            first = np.ones(len(part), dtype=bool)  # clusters are listed in order, so those of a part are neighbours
            first[1:] = (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])
            starts = np.flatnonzero(first)
            ends = np.append(starts, len(part)).astype(np.int32)
            runs = pa.ListArray.from_arrays(pa.array(ends), pa.array(clusters, pa.int32()))
            cut = cut_of[clusters[starts]]
            run = np.repeat(np.arange(len(starts)), cut)
            nth = np.arange(len(run)) - np.repeat(np.cumsum(cut) - cut, cut)
            columns = {n: batch.column(n).take(pa.array(owner[starts][run])) for n in names}
            dealt = [*columns.values(), runs.take(pa.array(run)), pa.array(part[starts][run] + nth, pa.int32())]
            yield pa.RecordBatch.from_arrays(dealt, names=[*names, "clusters", "__part"])

    names = ["query_id", "k", "embedding", "floor"]
    kinds = T.StructType([*[chosen.schema[n] for n in (*names, "clusters")], T.StructField("__part", T.IntegerType())])
    return chosen.mapInArrow(deal, kinds)


def _waves(queries: DataFrame, index: ClusteredIndex, k: int | Column, broadcast_cells: int, block_cells: int):
    """The queries with what each wave reads, and the hits of both waves."""
    spark, table = queries.sparkSession, _Centres(index.centres)
    dim = table.matrix.shape[1]
    centres = spark.sparkContext.broadcast(table)
    own = (F.lit(k) if isinstance(k, int) else k).cast("bigint").alias("k")
    asked = queries.select("query_id", own, F.col("embedding").cast("array<float>")).where("k >= 1")
    unknown = F.lit(float("nan")).alias("floor")
    first = materialize(_choose(asked.select("*", unknown), centres, dim), "cluster-first")
    started = first.withColumn("floor", F.lit(float("-inf")))
    partial = _meet(started, index, table, dim, broadcast_cells, block_cells)
    found = materialize(ranked(partial).join(asked.select("query_id", "k"), "query_id"), "cluster-hits")
    last = found.where("rank = k").select("query_id", F.col("score").alias("last"))
    floor = F.coalesce("last", F.lit(float("-inf"))).alias("floor")
    again = asked.join(last, "query_id", "left").select("query_id", "k", "embedding", floor)
    second = materialize(_choose(again, centres, dim), "cluster-second")
    more = _meet(second.where(F.size("clusters") > 0), index, table, dim, broadcast_cells, block_cells)
    both = found.select("query_id", "k", "row_id", "score").unionByName(more)
    return table, first, second, ranked(both)


def clustered_knn(
    queries: DataFrame,
    index: ClusteredIndex,
    k: int | Column,
    broadcast_cells: int = BROADCAST_CELLS,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """Exact top-k by inner product, as ``vectors.knn``: ``(query_id, row_id, score, rank)``, ties by ``row_id``."""
    return _waves(queries, index, k, broadcast_cells, block_cells)[-1]


def cluster_reads(queries: DataFrame, index: ClusteredIndex, k: int | Column) -> dict[str, float]:
    """How much a search reads: the share of clusters opened at all, and of (query, row) pairs that are scored."""
    table, first, second, _ = _waves(queries, index, k, BROADCAST_CELLS, BLOCK_CELLS)
    opened = first.unionByName(second).select(F.explode("clusters").alias("cluster")).groupBy("cluster").count()
    counts = {r["cluster"]: r["count"] for r in opened.collect()}  # at most MAX_CLUSTERS
    scored = sum(counts.get(c, 0) * n for c, n in zip(table.numbers.tolist(), table.n.tolist(), strict=True))
    pairs = first.count() * int(table.n.sum())
    return {"clusters": len(counts) / max(1, len(table.n)), "pairs": scored / max(1, pairs)}
