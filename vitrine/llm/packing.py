"""Best-fit packing of items into sequences, in bulk-synchronous rounds.

Sorted by size, documents and gaps are runs of equal size: there are at most ``capacity`` runs of documents, and a few
thousand of gaps, however many documents there are. The rounds work on these runs:

1. range-sort the runs of the waiting documents and of the open gaps by size;
2. successor sweep: every document aims at the first gap that is as large as itself or larger;
3. conflicts are resolved by rank: document i of the sorted order gets the place max(its aim, the place of document
   i - 1, plus one), which a running maximum gives for whole runs at once;
4. update the gaps by what they took; when nothing fits any more, the waiting documents open new sequences, as many
   equal ones in each as fit; repeat.

Documents wait in waves of falling size, as in best-fit decreasing. The rounds yield intervals ``(length, first rank,
count) -> (first sequence, offset)``. Documents then get a rank within their length, counted in hashed buckets so that a
length of a third of all documents is no single task, and look their interval up.

Lengths of 1 to ``capacity`` are expected; others raise. Repeated rows are items of their own. Ties in length are ranked by
hash and id. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vitrine.llm.bpe import word_table
from vitrine.llm.common import arrow_rows, give_back, shuffle_width, slices, stored

CAPACITY = 2048
ROWS = 1000  # texts that reach a worker at once
ITEMS = "size int, length int, per int, first bigint, count bigint"
GAPS = "gap int, sequence bigint, count bigint"
# Documents first .. first + count - 1 of a length, ``per`` to a sequence, from ``sequence`` and ``offset`` on.
PLACED = "length int, first bigint, count bigint, per int, sequence bigint, offset int"


def waves(capacity: int) -> list[tuple[int, int]]:
    """Falling ranges (low, high] of lengths: those over a half, then a sixth less each time, the small ones a third."""
    bounds = [capacity, capacity - 1, capacity // 2]
    while bounds[-1] > 1:
        bounds.append(min(bounds[-1] - 1, int(bounds[-1] / (1.2 if bounds[-1] > capacity // 20 else 1.6))))
    bounds[-1] = 0
    falling = sorted(set(bounds), reverse=True)
    return [(low, high) for high, low in zip(falling, falling[1:], strict=False)]


def sweep(items: DataFrame, gaps: DataFrame) -> DataFrame:
    """One round: runs of ``items`` (``count`` bundles of ``per`` documents, ``size`` tokens each) into runs of ``gaps``.

    Returns segments: equal neighbours ``(gap, sequence, count)`` of a gap run with what they take
    ``(size, length, per, first)``, null if nothing.
    """
    carried = F.struct("length", "per", "first")
    both = items.select("size", F.lit(0).alias("is_gap"), carried.alias("run"), "count").unionByName(
        gaps.select(
            F.col("gap").alias("size"),
            F.lit(1).alias("is_gap"),
            F.struct(F.lit(0).alias("length"), F.lit(1).alias("per"), F.col("sequence").alias("first")).alias("run"),
            "count",
        )
    )
    both = both.coalesce(1)  # a few thousand runs
    by_size = Window.orderBy("size", "is_gap", "run")
    before = by_size.rowsBetween(Window.unboundedPreceding, -1)
    is_gap = F.col("is_gap") == 1
    swept = both.select(
        "*",
        F.coalesce(F.sum(F.when(is_gap, F.col("count")).otherwise(0)).over(before), F.lit(0)).alias("aim"),
        F.coalesce(F.sum(F.when(is_gap, F.lit(0)).otherwise(F.col("count"))).over(before), F.lit(0)).alias("ahead"),
    )
    lag = F.when(~is_gap, F.col("aim") - F.col("ahead"))
    place = F.when(is_gap, F.col("aim")).otherwise(F.col("ahead") + F.max(lag).over(by_size))
    placed = swept.withColumn("place", place).withColumn("until", F.col("place") + F.col("count"))
    # Cut the line of gap places wherever a run of gaps or of documents begins or ends.
    info = F.struct("size", "run", "place", "until")
    starts = placed.select(
        "place", F.when(is_gap, info).alias("gap_run"), F.when(~is_gap, info).alias("doc_run")
    )
    nothing = F.lit(None).cast(starts.schema["gap_run"].dataType)
    ends = placed.where(~is_gap).select(
        F.col("until").alias("place"), nothing.alias("gap_run"), nothing.alias("doc_run")
    )
    cuts = (
        starts.unionByName(ends)
        .groupBy("place")
        .agg(F.max("gap_run").alias("gap_run"), F.max("doc_run").alias("doc_run"))
    )
    line = Window.orderBy("place")
    filled = cuts.select(
        "place",
        F.last("gap_run", True).over(line).alias("g"),
        F.last("doc_run", True).over(line).alias("d"),
        F.lead("place").over(line).alias("next"),
    )
    takes = F.coalesce(F.col("place") < F.col("d.until"), F.lit(False))
    rank = F.col("d.run.first") + (F.col("place") - F.col("d.place")) * F.col("d.run.per")
    return filled.where(F.col("place") < F.col("g.until")).select(
        F.col("g.size").alias("gap"),
        (F.col("g.run.first") + F.col("place") - F.col("g.place")).alias("sequence"),
        (F.least(F.coalesce("next", "g.until"), F.col("g.until")) - F.col("place")).alias("count"),
        F.when(takes, F.col("d.size")).alias("size"),
        F.when(takes, F.col("d.run.length")).alias("length"),
        F.when(takes, F.col("d.run.per")).alias("per"),
        F.when(takes, rank).alias("first"),
    )


def _bundles(waiting: dict[int, list[int]], open_gaps: int, widest: int) -> list[tuple]:
    """Runs of ``ITEMS`` of the waiting documents that fit some gap.

    Where more documents wait than gaps are open, several equal ones travel together.
    """
    share = -(-sum(count for _, count in waiting.values()) // max(1, open_gaps))
    rows = []
    for length, (first, count) in waiting.items():
        per = min(share, count, widest // length)
        if per:
            rows.append((per * length, length, per, first, count // per))
    return rows


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    kinds = {"int": pa.int32(), "bigint": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = {name: pa.array(c, kinds[k]) for (name, k), c in zip(fields, columns, strict=True)}
    return spark.createDataFrame(pa.table(arrays), schema)


def _joined(gaps: list[tuple]) -> list[tuple]:
    """Runs of gaps with equal neighbours put together."""
    out: list[tuple] = []
    for gap, sequence, count in sorted(gaps, key=lambda g: g[1]):
        if out and out[-1][0] == gap and out[-1][1] + out[-1][2] == sequence:
            out[-1] = (gap, out[-1][1], out[-1][2] + count)
        else:
            out.append((gap, sequence, count))
    return out


def _opened(waiting: dict[int, list[int]], sequences: int, capacity: int) -> list[tuple]:
    """Rows of ``PLACED`` for documents that open new sequences.

    Of each length as many full sets as fill a sequence; of what is left over the longest ones, one for each sequence
    that the rest needs at least, so the shorter ones can join them in the next round.
    """
    rows, over = [], 0
    for length, wait in waiting.items():
        per = capacity // length
        full = wait[1] // per
        if full:
            rows.append((length, wait[0], full * per, per, sequences, 0))
            sequences += full
            wait[0] += full * per
            wait[1] -= full * per
        over += length * wait[1]
    needed = -(-over // capacity)
    for length in sorted(waiting, reverse=True):
        wait = waiting[length]
        alone = min(needed, wait[1])
        if alone:
            rows.append((length, wait[0], alone, 1, sequences, 0))
            sequences += alone
            needed -= alone
            wait[0] += alone
            wait[1] -= alone
    return rows


def plan(spark: SparkSession, counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Intervals ``PLACED`` for ``counts`` documents of each length.

    Between rounds the runs pass the driver, as the barrier of a superstep: their number depends on ``capacity`` and the
    number of rounds, not on the number of documents.
    """
    all_waiting = {length: [0, count] for length, count in sorted(counts.items())}
    placed: list[tuple] = []
    gaps: list[tuple] = []
    sequences = 0
    for low, high in waves(capacity):
        waiting = {n: w for n, w in all_waiting.items() if low < n <= high}
        while waiting:
            widest = max((g[0] for g in gaps), default=0)
            items = _bundles(waiting, sum(g[2] for g in gaps if g[0] >= min(waiting)), widest)
            taken = 0
            if items:
                # Gaps below all items stay as they are.
                least = min(item[0] for item in items)
                small = [g for g in gaps if g[0] < least]
                large = [g for g in gaps if g[0] >= least]
                found = sweep(_frame(spark, items, ITEMS), _frame(spark, large, GAPS)).collect()
                gaps = small
                for r in found:
                    if r["length"] is None:
                        gaps.append((r["gap"], r["sequence"], r["count"]))
                        continue
                    docs = r["count"] * r["per"]
                    placed.append((r["length"], r["first"], docs, r["per"], r["sequence"], capacity - r["gap"]))
                    if r["gap"] > r["size"]:
                        gaps.append((r["gap"] - r["size"], r["sequence"], r["count"]))
                    waiting[r["length"]][0] += docs
                    waiting[r["length"]][1] -= docs
                    taken += docs
                gaps = _joined(gaps)
            waiting = {n: w for n, w in waiting.items() if w[1]}
            if waiting and (not taken or min(waiting) > max((g[0] for g in gaps), default=0)):
                for row in _opened(waiting, sequences, capacity):
                    length, _, docs, per, sequence, _ = row
                    placed.append(row)
                    sequences = sequence + docs // per
                    if capacity > per * length:
                        gaps.append((capacity - per * length, sequence, docs // per))
                waiting = {n: w for n, w in waiting.items() if w[1]}
    return placed


def with_rank(items: DataFrame, order: list[str], length: str = "length", out: str = "__rank") -> DataFrame:
    """``out``: the rank of each item among those of its length, from 0.

    Items are counted per hashed bucket of their length and numbered within it, so no length is one task.
    """
    width = shuffle_width(items.sparkSession)
    dealt = items.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(width)).cast("int"))
    sizes = dealt.groupBy(length, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy(length).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(length, "__bucket", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    inside = Window.partitionBy(length, "__bucket").orderBy(*order)
    numbered = dealt.withColumn("__nth", F.row_number().over(inside) - 1)
    return (
        numbered.join(offsets, [length, "__bucket"])
        .withColumn(out, F.col("__ahead") + F.col("__nth"))
        .drop("__bucket", "__nth", "__ahead")
    )


def pack(items: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset`` (columns of these names are replaced).

    ``items`` should be a stored table: it is read three times. ``order`` names columns that tell items apart. The
    intervals are bounded by the number of lengths and rounds, so they are broadcast whatever the size of ``items``.
    """
    items = items.drop("sequence_id", "offset")
    rows = items.groupBy("length").agg(F.count(F.lit(1)).alias("__n")).limit(capacity + 1).collect()
    counts = {r["length"]: r["__n"] for r in rows}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths from 1 to {capacity} can be packed")
    placed = _frame(items.sparkSession, plan(items.sparkSession, counts, capacity), PLACED)
    at = placed.select(*[F.col(c).alias(f"__{c}") for c in placed.columns])
    ranked = with_rank(items, order)
    nth = F.col("__rank") - F.col("__first")
    found = ranked.join(
        F.broadcast(at), (F.col("length") == F.col("__length")) & (nth >= 0) & (nth < F.col("__count"))
    )
    return found.select(
        *items.columns,
        (F.col("__sequence") + F.floor(nth / F.col("__per"))).alias("sequence_id"),
        (F.col("__offset") + (nth % F.col("__per")) * F.col("length")).cast("bigint").alias("offset"),
    )


PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint"


def token_pieces(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Every text of ``(doc_id, text)`` as token ids and ``end_id``, cut into pieces of at most ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with word_table(path) as table:
            for batch in batches:
                for first, last in slices(batch.column(1)):
                    part = batch.slice(first, last - first)
                    ids, bounds = table.encode(part.column(1))
                    numbers = ids.astype("<u4")
                    rows = ([], [], [], [], [])
                    for doc, a, b in zip(part.column(0).to_pylist(), bounds[:-1], bounds[1:], strict=True):
                        own = np.append(numbers[a:b], np.uint32(end_id))
                        for piece, start in enumerate(range(0, len(own), capacity)):
                            taken = own[start : start + capacity]
                            crc = zlib.crc32(taken.tobytes())
                            for column, value in zip(rows, (doc, piece, start, len(taken), crc), strict=True):
                                column.append(value)
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
                    columns = [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]
                    del ids, numbers, own, taken
                    give_back()  # two workers share an executor with a heap that stays as large as it was
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``."""
    with arrow_rows(docs.sparkSession, ROWS):
        pieces = stored(token_pieces(docs, path, end_id, capacity), "packing-pieces")
    return pack(pieces, ["doc_id", "piece", "start", "ids_crc32"], capacity)
