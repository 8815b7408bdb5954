"""Exact top-k of every query against every catalogue row, without materialising the pairs.

Spark partitions the catalogue; each task scores its rows against a block of queries with NumPy and
keeps only k candidates per query. The candidates (k per query and task) meet in one narrow
shuffle, where ``row_number() <= k`` gives the final ranking. Ties go to the smaller ``row_id``.

Two ways bring the queries to the catalogue, and both give the same rows:

* ``queries`` within ``broadcast_cells`` numbers (checked by a sum): one broadcast, the catalogue is
  scanned in place and not shuffled;
* beyond that: both sides are cut into evenly hashed blocks and every (catalogue block, query block)
  pair meets once in a co-grouped task of bounded size.

Every query has its own k. One that asks for more than ``WIDE`` hits keeps none in the task: its scores leave
chunk by chunk, and only its own rows meet in the ranking, so it costs the other queries nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

BROADCAST_CELLS = 8_000_000  # 64 MB of doubles
BLOCK_CELLS = 16_000_000  # numbers per side of one co-grouped task
TASK_PRODUCTS = 100_000_000_000  # catalogue numbers times queries that one task meets
CHUNK_ROWS = 4096
CHUNK_QUERIES = 1024
WIDE = 65_536  # hits of a query above which a task doesn't hold them
CROWDED = 8  # candidates per wanted hit above which a chunk is narrowed down first


class Best:
    """The best (score, row id) seen so far for each query, as many as its own ``k``."""

    def __init__(self, k: np.ndarray):
        self.n, self.k = len(k), k
        self.query = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.int64)
        self.scores = np.empty(0, dtype=np.float64)
        self.floor = np.full(self.n, -np.inf)  # score and row id of the last hit, once all k are known
        self.floor_id = np.full(self.n, np.iinfo(np.int64).max)

    def may_enter(self, bounds: np.ndarray, first_ids: np.ndarray) -> np.ndarray:
        """Whether rows of at most this score (one row a query) and at least this id (one a column) can be hits."""
        floor = self.floor[:, None]
        return (bounds > floor) | ((bounds == floor) & (first_ids < self.floor_id[:, None]))

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(ids):
            return
        query = np.concatenate([self.query, query])
        ids = np.concatenate([self.ids, ids])
        scores = np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        keep = rank < self.k[query]
        full = rank == self.k[query] - 1
        self.query, self.ids, self.scores = query[keep], ids[keep], scores[keep]
        self.floor[query[full]] = scores[full]
        self.floor_id[query[full]] = ids[full]


def crowded(candidates: np.ndarray, k: np.ndarray) -> bool:
    return np.count_nonzero(candidates) > CROWDED * k.sum()


def kth_largest(scores: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The k-th largest of each row, as a column; -inf for shorter rows."""
    width, found = scores.shape[1], np.full((len(scores), 1), -np.inf)
    for own in np.unique(k[k <= width]):
        rows = k == own
        found[rows] = np.partition(scores[rows], width - own, axis=1)[:, [width - own]]
    return found


def whole(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks()


def hits_of(block: pa.Table, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    asked = pa.array(query)
    columns = [whole(block, "query_id").take(asked), whole(block, "k").take(asked), pa.array(ids), pa.array(scores)]
    return pa.RecordBatch.from_arrays(columns, names=["query_id", "k", "row_id", "score"])


def _scan(scorer, queries: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Score all rows against all queries, block by block; the k hits of a query come out at the end."""
    wide = pc.greater(queries.column("k"), WIDE)
    blocks, streamed = [], []
    for part, kept in ((queries.filter(pc.invert(wide)), blocks), (queries.filter(wide), streamed)):
        for start in range(0, part.num_rows, CHUNK_QUERIES):
            block = part.slice(start, CHUNK_QUERIES)
            best = Best(whole(block, "k").to_numpy(zero_copy_only=False))
            kept.append((block, scorer.prepare(block), best))
    for batch in batches:
        for rows in scorer.chunks(batch):
            for _, state, best in blocks:
                scorer.score(state, rows, best)
            for block, state, best in streamed:
                for first in range(best.n):  # a query at a time: its scores of one chunk
                    scores = scorer.exact(state, rows, first)
                    yield hits_of(block, np.full(len(scores), first), rows.ids, scores)
    for block, _, best in blocks:
        yield hits_of(block, best.query, best.ids, best.scores)


def blocked_topk(
    queries: DataFrame,
    catalog: DataFrame,
    k: int | Column,
    scorer,
    *,
    broadcast_cells: int = BROADCAST_CELLS,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """Rows ``(query_id, row_id, score, rank)``, at most k per query.

    ``k`` is a number or a column of ``queries``, each query's own; a query whose k is null or below 1 has no hits.
    ``queries`` has a unique ``query_id`` and the scorer's query columns; ``catalog`` a unique bigint
    ``row_id`` and the scorer's catalogue columns. ``scorer.query_cells`` and ``scorer.catalog_cells``
    count the numbers a row holds; their sums decide how the queries travel.
    """
    if isinstance(k, int) and k < 1:
        raise ValueError("k must be at least 1")
    own = (F.lit(k) if isinstance(k, int) else k).cast("bigint").alias("k")
    queries = queries.select("query_id", own, *scorer.query_columns).where("k >= 1")
    catalog = catalog.select("row_id", *scorer.catalog_columns)
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("k", T.LongType()),
            T.StructField("row_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    asked = queries.agg(F.sum(scorer.query_cells()), F.count(F.lit(1))).first()
    query_cells, n_queries = asked[0] or 0, asked[1]
    if query_cells <= broadcast_cells:
        if n_queries > CHUNK_QUERIES:  # fewer make no long task
            tasks = blocks_for(total(catalog, scorer.catalog_cells()) * n_queries, TASK_PRODUCTS)
            if tasks > catalog.rdd.getNumPartitions():
                catalog = catalog.repartition(tasks)
        shared = catalog.sparkSession.sparkContext.broadcast(queries.toArrow())

        def scan(batches):
            return _scan(scorer, shared.value, batches)

        partial = catalog.mapInArrow(scan, schema)
    else:
        catalog_cells = total(catalog, scorer.catalog_cells())
        query_blocks, catalog_blocks = grid_for(
            blocks_for(query_cells, block_cells),
            blocks_for(catalog_cells, block_cells),
            catalog_cells * n_queries,
        )
        partial = _block_join(queries, catalog, scorer, schema, query_blocks, catalog_blocks)
    return ranked(partial)


def ranked(partial: DataFrame) -> DataFrame:
    """The k best of ``(query_id, k, row_id, score)`` with their ranks."""
    ranking = Window.partitionBy("query_id").orderBy(F.desc("score"), "row_id")
    numbered = partial.withColumn("rank", F.row_number().over(ranking))
    return numbered.where("rank <= k").drop("k")


def total(df: DataFrame, cells: Column) -> int:
    return df.agg(F.sum(cells)).first()[0] or 0


def blocks_for(cells: int, block_cells: int) -> int:
    return max(1, math.ceil(cells / block_cells))


def grid_for(query_blocks: int, catalog_blocks: int, products: int) -> tuple[int, int]:
    """Blocks of both sides, so many more of each that no pair of them meets in more than ``TASK_PRODUCTS``."""
    finer = math.ceil(math.sqrt(products / TASK_PRODUCTS / (query_blocks * catalog_blocks)))
    return query_blocks * max(1, finer), catalog_blocks * max(1, finer)


def _block_join(queries, catalog, scorer, schema, query_blocks, catalog_blocks) -> DataFrame:
    def place(df, key, own, own_blocks, other, other_blocks):
        block = F.pmod(F.xxhash64(key), F.lit(own_blocks)).cast("int")
        return df.withColumn(own, block).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1)))
        )

    left = place(catalog, "row_id", "__cb", catalog_blocks, "__qb", query_blocks)
    right = place(queries, "query_id", "__qb", query_blocks, "__cb", catalog_blocks)

    def meet(rows: pa.Table, block: pa.Table) -> pa.Table:
        batches = rows.combine_chunks().to_batches()
        key = block.schema.field("query_id").type
        kinds = [("query_id", key), ("k", pa.int64()), ("row_id", pa.int64()), ("score", pa.float64())]
        return pa.Table.from_batches(_scan(scorer, block, batches), schema=pa.schema(kinds))

    # A number of its own: partitions are dealt by work, and would be joined by size.
    left, right = (d.repartition(2 * query_blocks * catalog_blocks, "__cb", "__qb") for d in (left, right))
    return (
        left.groupBy("__cb", "__qb").cogroup(right.groupBy("__cb", "__qb")).applyInArrow(meet, schema)
    )


class _Vectors:
    """Catalogue rows of one chunk, in id order."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        self.longest = np.linalg.norm(matrix.astype(np.float64), axis=1).max(initial=0.0)
        self._trimmed: dict[int, "_Vectors"] = {}

    def without_surplus(self, k: int) -> "_Vectors":
        """Only the first k of each group of identical vectors; no other can be among the best k."""
        if k not in self._trimmed:
            width = self.matrix.dtype.itemsize * self.matrix.shape[1]
            raw = np.ascontiguousarray(self.matrix).view(np.dtype((np.void, width))).ravel()
            _, group = np.unique(raw, return_inverse=True)
            order = np.argsort(group, kind="stable")
            keep = np.empty(len(raw), dtype=bool)
            first = np.searchsorted(group[order], group[order], side="left")
            keep[order] = np.arange(len(raw)) - first < k
            self._trimmed[k] = _Vectors(self.ids[keep], self.matrix[keep])
        return self._trimmed[k]


class InnerProduct:
    """Dense float vectors; the score is the double sum of products in dimension order.

    A matrix product in the vectors' own precision picks candidates with its rounding error bounded;
    candidates are scored again by an ordered double sum, so the result does not depend on block
    shape or partitioning.
    """

    query_columns = ["embedding"]
    catalog_columns = ["embedding"]

    def __init__(self, dim: int):
        self.dim = dim

    def query_cells(self) -> Column:
        return F.lit(self.dim)

    catalog_cells = query_cells

    def matrix(self, column: pa.Array) -> np.ndarray:
        flat = column.flatten().to_numpy(zero_copy_only=False)
        if len(flat) != len(column) * self.dim:
            raise ValueError(f"every vector must have {self.dim} numbers")
        return flat.reshape(len(column), self.dim)

    def prepare(self, queries: pa.Table):
        matrix = self.matrix(whole(queries, "embedding"))
        return matrix, np.linalg.norm(matrix.astype(np.float64), axis=1)

    def chunks(self, batch: pa.RecordBatch) -> Iterator[_Vectors]:
        for start in range(0, batch.num_rows, CHUNK_ROWS):
            rows = batch.slice(start, CHUNK_ROWS).sort_by("row_id")
            ids = rows.column("row_id").to_numpy(zero_copy_only=False)
            yield _Vectors(ids, self.matrix(rows.column("embedding")))

    def exact(self, state, rows: _Vectors, query: int) -> np.ndarray:
        return np.cumsum(state[0][query].astype(np.float64) * rows.matrix, axis=1)[:, -1]

    def score(self, state, rows: _Vectors, best: Best, asking: np.ndarray | None = None) -> None:
        """Offer ``rows`` to all queries, or to those numbered in ``asking``."""
        asking = np.arange(best.n) if asking is None else asking
        queries, norms, k, floors = state[0][asking], state[1][asking], best.k[asking], best.floor[asking]
        eps = np.finfo(np.result_type(queries, rows.matrix)).eps
        # |computed - true| <= dim * eps * |q| * |v|, doubled for safety
        slack = (2 * self.dim * eps * norms * rows.longest)[:, None]
        floor = floors[:, None] - slack
        rough = queries @ rows.matrix.T
        near = rough >= floor
        if crowded(near, k):
            near = rough >= np.maximum(floor, kth_largest(rough, k) - 2 * slack)
        if crowded(near, k):  # many copies of one vector
            rows = rows.without_surplus(int(k.max()))
            rough = queries @ rows.matrix.T
            near = rough >= np.maximum(floor, kth_largest(rough, k) - 2 * slack)
        query, row = np.nonzero(near)
        exact = np.empty(len(query))
        for at in range(0, len(query), CHUNK_ROWS):
            piece = slice(at, at + CHUNK_ROWS)
            products = queries[query[piece]].astype(np.float64) * rows.matrix[row[piece]]
            exact[piece] = np.cumsum(products, axis=1)[:, -1]
        best.add(asking[query], rows.ids[row], exact)
