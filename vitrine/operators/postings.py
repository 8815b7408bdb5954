"""A stored inverted index for BM25 and block-max top-k over it.

The catalogue is sorted by ``row_id`` and cut into segments of at most ``SEGMENT_ROWS`` rows, each one table row:

* ``ids``: its row ids in order; ``terms``: its distinct terms in order;
* ``starts``, ``places``, ``gains``: for every term the rows that hold it and what the term adds to their score
  per unit of query weight;
* ``block_starts``, ``blocks``, ``tops``: for every term the blocks of ``BLOCK_ROWS`` rows in which it occurs, with
  the largest gain in each.

A search adds up the tops of its terms: no row of a block scores more. Blocks that cannot bring a query one of its k best
are not opened for it, and the others only for the queries that need them. Both sums add the terms in the same order, and rounding
keeps the order of sums, so the bound holds to the last bit and results are exact. Rows that hold no term of a query score zero;
they are found as any others, in the first blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.operators.topk import Best, kth_largest

SEGMENT_ROWS = 8192
BLOCK_ROWS = 256

SEGMENT = (
    "row_id bigint, n_postings int, ids array<bigint>, terms array<string>, starts array<int>, places array<int>, "
    "gains array<double>, block_starts array<int>, blocks array<int>, tops array<double>"
)


def _listed(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def segment(ids: np.ndarray, tokens: pa.Array, k1: float, b: float, avgdl: float, block_rows: int) -> pa.RecordBatch:
    """The index of some rows in order of their ids."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    flat = tokens.flatten()
    vocabulary = pc.unique(flat)
    vocabulary = vocabulary.take(pc.sort_indices(vocabulary))
    term = pc.index_in(flat, value_set=vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(ids)), sizes)
    cell, count = np.unique(term * len(ids) + row, return_counts=True)
    term, row = np.divmod(cell, max(1, len(ids)))
    damping = k1 * (1 - b + b * sizes[row] / avgdl)
    gains = count * (k1 + 1) / (count + damping)
    numbers = np.arange(len(vocabulary) + 1)
    blocks_of_all = -(-max(1, len(ids)) // block_rows)
    block, first = np.unique(term * blocks_of_all + row // block_rows, return_index=True)
    block_term, block = np.divmod(block, blocks_of_all)
    tops = np.maximum.reduceat(gains, first) if len(first) else np.empty(0)
    kinds = [np.int32, np.int32, np.float64, np.int32, np.int32, np.float64]
    lists = [
        np.searchsorted(term, numbers), row, gains, np.searchsorted(block_term, numbers), block, tops
    ]
    columns = [pa.array(ids[:1]), pa.array([len(gains)], pa.int32()), _listed(ids.astype(np.int64))]
    columns.append(pa.ListArray.from_arrays(pa.array([0, len(vocabulary)], pa.int32()), vocabulary))
    columns += [_listed(np.asarray(v, k)) for v, k in zip(lists, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SEGMENT.split(", ")])


def build_segments(
    documents: DataFrame,
    k1: float,
    b: float,
    avgdl: float,
    segment_rows: int = SEGMENT_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Segments of ``documents (row_id, tokens)``, sorted by ranges of ``row_id``; no task holds more than one segment."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            while sum(w.num_rows for w in waiting) + batch.num_rows >= segment_rows:
                taken = segment_rows - sum(w.num_rows for w in waiting)
                yield one([*waiting, batch.slice(0, taken)])
                waiting, batch = [], batch.slice(taken)
            if batch.num_rows:
                waiting.append(batch)
        if waiting:
            yield one(waiting)

    def one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        ids = rows.column(0).combine_chunks().to_numpy(zero_copy_only=False)
        return segment(ids, rows.column(1).combine_chunks(), k1, b, avgdl, block_rows)

    sorted_rows = documents.select("row_id", "tokens").repartitionByRange("row_id").sortWithinPartitions("row_id")
    return sorted_rows.mapInArrow(build, SEGMENT)


class Segment:
    """One segment in a task."""

    def __init__(self, row: int, batch: pa.RecordBatch, block_rows: int):
        def numbers(name: str) -> np.ndarray:
            return batch.column(name)[row].values.to_numpy(zero_copy_only=False)

        self.ids, self.terms = numbers("ids"), batch.column("terms")[row].values
        self.starts, self.places, self.gains = numbers("starts"), numbers("places"), numbers("gains")
        self.block_starts, self.blocks, self.tops = numbers("block_starts"), numbers("blocks"), numbers("tops")
        self.block_rows = block_rows
        self.block_ids = self.ids[::block_rows]


class Postings:
    """BM25 over segments; rows that share no term with the query score zero, like any other score.

    A query row carries its distinct ``terms`` and ``weights`` (idf times the number of times the term occurs in the query).
    ``skipped`` and ``opened`` count (query, block) pairs of this process.
    """

    query_columns = ["terms", "weights"]
    catalog_columns = [c.split()[0] for c in SEGMENT.split(", ")][1:]

    def __init__(self, block_rows: int = BLOCK_ROWS):
        self.block_rows, self.skipped, self.opened = block_rows, 0, 0

    def query_cells(self) -> Column:
        return 2 * F.size("terms") + 1

    def catalog_cells(self) -> Column:
        return 2 * F.col("n_postings") + F.size("ids")

    def prepare(self, queries: pa.Table):
        """Terms in ascending order, and for each the queries that have it with their weights."""
        terms = queries.column("terms").combine_chunks()
        weight = queries.column("weights").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(terms)), sizes)
        flat = terms.flatten()
        vocabulary = pc.unique(flat)
        vocabulary = vocabulary.take(pc.sort_indices(vocabulary))
        term = pc.index_in(flat, value_set=vocabulary).to_numpy(zero_copy_only=False)
        order = np.argsort(term, kind="stable")
        bounds = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
        return vocabulary, owner[order], weight[order], bounds

    def chunks(self, batch: pa.RecordBatch) -> Iterator[Segment]:
        for row in range(batch.num_rows):
            yield Segment(row, batch, self.block_rows)

    def _met(self, state, rows: Segment) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """For each term of the queries that the segment holds: its number there, the queries and their weights."""
        vocabulary, owner, weight, bounds = state
        own = pc.fill_null(pc.index_in(vocabulary, value_set=rows.terms), -1).to_numpy(zero_copy_only=False)
        return [
            (own[t], owner[bounds[t] : bounds[t + 1]], weight[bounds[t] : bounds[t + 1]])
            for t in np.flatnonzero(own >= 0)
        ]

    def exact(self, state, rows: Segment, query: int) -> np.ndarray:
        scores = np.zeros(len(rows.ids))
        for term, owner, weight in self._met(state, rows):
            for w in weight[owner == query]:
                span = slice(rows.starts[term], rows.starts[term + 1])
                scores[rows.places[span]] += w * rows.gains[span]
        return scores

    def score(self, state, rows: Segment, best: Best) -> None:
        met = self._met(state, rows)
        bound = np.zeros((best.n, len(rows.block_ids)))
        for term, owner, weight in met:  # ascending terms: the order in which scores are summed
            span = slice(rows.block_starts[term], rows.block_starts[term + 1])
            bound[owner[:, None], rows.blocks[span]] += np.maximum(weight, 0.0)[:, None] * rows.tops[span]
        at, step = 0, 1  # few blocks at first: their hits close most of the others
        while at < len(rows.block_ids):
            if np.isfinite(best.floor).all():
                step = len(rows.block_ids)
            may = best.may_enter(bound[:, at : at + step], rows.block_ids[at : at + step])
            blocks, asking = at + np.flatnonzero(may.any(axis=0)), np.flatnonzero(may.any(axis=1))
            self.opened += len(blocks) * len(asking)
            self.skipped += may.size - len(blocks) * len(asking)
            if len(asking):
                self._open(met, rows, blocks, asking, best)
            at, step = at + step, 2 * step

    def _open(self, met: list, rows: Segment, blocks: np.ndarray, asking: np.ndarray, best: Best) -> None:
        """Score the rows of ``blocks`` for the queries ``asking``."""
        opened = np.flatnonzero(np.isin(np.arange(len(rows.ids)) // rows.block_rows, blocks))
        column, line = np.full(len(rows.ids), -1), np.full(best.n, -1)
        column[opened], line[asking] = np.arange(len(opened)), np.arange(len(asking))
        scores = np.zeros((len(asking), len(opened)))
        for term, owner, weight in met:
            kept = line[owner] >= 0
            if kept.any():
                span = slice(rows.starts[term], rows.starts[term + 1])
                where = column[rows.places[span]]
                gains = rows.gains[span][where >= 0]
                scores[line[owner[kept]][:, None], where[where >= 0]] += weight[kept, None] * gains
        k = best.k[asking]
        bar = np.maximum(best.floor[asking][:, None], kth_largest(scores, k))
        level = scores == bar  # rows are in id order: the first k ties suffice
        level &= np.cumsum(level, axis=1) <= k[:, None]
        query, hit = np.nonzero((scores > bar) | level)
        best.add(asking[query], rows.ids[opened[hit]], scores[query, hit])
