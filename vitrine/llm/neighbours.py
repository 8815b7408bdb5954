"""Approximate nearest neighbours by NN-descent.

The index is a graph in which every vector points to its ``k`` nearest found so far. It starts from the nearest in a random group
and in groups by hyperplanes, more turns of larger groups in larger tables. In each round every vector introduces its neighbours
and those that point to it (a hashed choice of ``k`` of these) to each other: joins of the graph with itself and with the vectors.
Pairs of which one side is new are compared, and what is nearer than a list's last entry gets in. The rounds end when few
entries change. Nodes are dealt into parts by hash; a list is one row, and what goes from part to part is packed into one message.

A query walks the graph greedily: of the ``width`` nearest vectors it knows, it looks at the neighbours of those it has not
opened yet, until none is left. All queries take their steps together, one join a step. For a sample of the queries the true
nearest are found by a scan of all vectors; while the walk has too few of them, ``width`` is doubled and the walk goes on
from what it found and did not open.

Equal vectors are one node, so copies neither fill lists nor make hubs; results are spread over the copies again, the
smaller ids first. Graph and walk hold unit vectors in single precision and compare them by their differences (about a
common centre), which tell near copies apart; all that a walk found is compared anew in double precision.
Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do those of another length
than the most frequent one. Fewer candidates than asked for give all of them. An empty table gives no rows. Rows that repeat an
id are asked each by itself and leave rows of their id out; as candidates, rows that repeat id and vector are one. Columns other than id and vector are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vitrine.llm.common import give_back, stored

K = 28
WIDTH = 224
ROUNDS = 12  # at least; more where there are more than 2 ** ROUNDS vectors
SAMPLE = 128  # queries whose true nearest are found by a scan
RECALL = 0.95  # of these, or the walk goes on
PART_BYTES = 64 << 20  # of vectors that the nodes of one part mention
PART_QUERIES = 512
SPARE = 4  # times its width, a walk keeps that many, for a wider one
CHUNK_PAIRS = 1 << 20  # of guests that are held at once
FOUND = 1 << 21  # entries that are held before the nearest are chosen
GROUP = 64  # nodes that are compared with each other for the first graph; more in large tables
LARGEST_GROUP = 4096


def valid_vectors(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(id, vector)`` of the rows that take part."""
    vector = F.col(column).cast("array<double>")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    nonzero = F.exists(vector, lambda x: x != 0)
    plain = F.transform(vector, lambda x: x + F.lit(0.0))  # a zero has no sign
    kept = rows.select(F.col(id_column).alias("id"), plain.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & nonzero
    )
    return kept.withColumn("length", F.size("vector"))


@F.arrow_udf(T.BinaryType())
def _units(vectors: pa.Array) -> pa.Array:
    """Unit vectors in single precision."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    scaled = values / np.abs(values).max(1, keepdims=True)
    unit = (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype("<f4")
    return pa.array([row.tobytes() for row in unit], pa.binary())


def _matrix(units: pa.Array, kind: str = "<f4") -> np.ndarray:
    values = units.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _nearness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine less one, from the difference of unit vectors: close to zero the digits stay."""
    return -np.square(a - b).sum(1) / 2


def nodes_of(vectors: DataFrame, members: int) -> tuple[DataFrame, DataFrame]:
    """``(node, vector, unit)`` per distinct vector, and ``(node, id)`` with the ``members`` least ids of each."""
    lengths = vectors.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), "length").limit(1).collect()
    length = usual[0]["length"] if usual else 0
    keyed = vectors.where(F.col("length") == length).withColumn(
        "key", F.md5(F.concat_ws(",", F.col("vector").cast("array<string>")))
    )
    keyed = keyed.dropDuplicates(["key", "id"])
    # Of a vector with any number of copies only the first few ids leave a task.
    by_id = Window.partitionBy("key").orderBy("id")
    first = keyed.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= members)
    first = stored(
        first.withColumn("node", F.min("id").over(Window.partitionBy("key"))).select("node", "id", "vector", "nth"),
        "vector-members",
    )
    nodes = first.where("nth = 1").select("node", "vector").withColumn("unit", _units("vector"))
    return stored(nodes, "vector-nodes"), first.select("node", "id")


MESSAGE = "part int, a binary, b binary, c binary, d binary"  # packed entries on their way to a part of the nodes
LISTS = "node bigint, neighbours binary, near binary, fresh binary, floor float, changed int"


def mixed(ids: np.ndarray, turn: int = 0) -> np.ndarray:
    """A hash of each id."""
    x = ids.astype("<i8").view("<u8") + np.uint64(turn)
    for factor in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(ids) % np.uint64(parts)).astype(np.int32)


def _dealt(rows: DataFrame, parts: int, column: str = "node") -> DataFrame:
    """``rows`` with the ``part`` of their node, each part in one task."""

    @F.arrow_udf("int")
    def part(ids: pa.Array) -> pa.Array:
        return pa.array(part_of(ids.to_numpy(zero_copy_only=False), parts), pa.int32())

    return rows.withColumn("part", part(column)).repartition(parts, "part")


def _message(part, *columns: list) -> pa.Table:
    columns = [*columns, *[[None] * len(part)] * (4 - len(columns))]
    return pa.table([pa.array(part, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], ["part", *"abcd"])


def packed(part: np.ndarray, *columns: np.ndarray) -> pa.Table:
    """One message for each part in ``part``: the entries that go there, column by column as bytes."""
    order = np.argsort(part.astype(np.int16) if part.max(initial=0) < 1 << 15 else part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    named = part[np.concatenate([[0], cuts])] if len(part) else part
    return _message(named, *([x.tobytes() for x in np.split(c[order], cuts)] if len(part) else [] for c in columns))


def _flat(values: pa.ChunkedArray | pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The entries of all rows one after the other, and how many each row has."""
    rows = [b for b in values.to_pylist() if b is not None]
    width = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(rows), kind), np.array([len(b) // width for b in rows], np.int64)


def _ragged(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A row of bytes for each count of entries."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * flat.dtype.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(flat.tobytes())]
    )


def _places(sorted_keys: np.ndarray) -> np.ndarray:
    """The place of each entry among those of its key."""
    starts = np.flatnonzero(np.concatenate([[True], np.diff(sorted_keys) != 0])) if len(sorted_keys) else np.empty(0, int)
    return np.arange(len(sorted_keys)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(sorted_keys)]])).astype(int))


def _part_count(nodes: DataFrame, count: int, k: int) -> int:
    """So many parts that the vectors a part's hosts mention fit in ``PART_BYTES``."""
    first = nodes.select(F.octet_length("unit")).first()
    return max(1, -(-count * 2 * k * first[0] // PART_BYTES)) if first else 1


def merged(lists: DataFrame, entries: DataFrame, k: int, parts: int) -> DataFrame:
    """``lists`` (``LISTS``, or ``node`` alone) with the ``entries`` (messages of node, neighbour, nearness): the ``k`` nearest of
    each node's, each neighbour once; an entry that was there stays not fresh."""

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = np.sort(left["node"].to_numpy())
        (node, _), (other, _), (near, _) = (_flat(right[c], kind) for c, kind in zip("abc", ("<i8", "<i8", "<f4"), strict=True))
        at = np.searchsorted(ids, node)
        fresh = np.ones(len(at), bool)
        if "neighbours" in left.column_names:
            old, counts = _flat(left["neighbours"], "<i8")
            at = np.concatenate([np.repeat(np.searchsorted(ids, left["node"].to_numpy()), counts), at])
            other, fresh = np.concatenate([old, other]), np.concatenate([np.zeros(len(old), bool), fresh])
            near = np.concatenate([_flat(left["near"], "<f4")[0], near])
        order = np.lexsort((-near, fresh, other, at))
        at, other, near, fresh = at[order], other[order], near[order], fresh[order]
        once = np.ones(len(at), bool)
        once[1:] = (np.diff(at) != 0) | (np.diff(other) != 0)
        at, other, near, fresh = at[once], other[once], near[once], fresh[once]
        order = np.lexsort((other, -near, at))
        order = order[_places(at[order]) < k]
        at, other, near, fresh = at[order], other[order], near[order], fresh[order]
        counts = np.bincount(at, minlength=len(ids))
        floor = np.full(len(ids), -3, np.float32)
        floor[counts >= k] = near[np.cumsum(counts)[counts >= k] - 1]
        changed = np.bincount(at, fresh, len(ids)).astype(np.int32)
        rows = [pa.array(ids, pa.int64()), *(_ragged(x, counts) for x in (other, near, fresh)), floor, changed]
        return pa.table(rows, ["node", "neighbours", "near", "fresh", "floor", "changed"])

    mine = _dealt(lists, parts)
    return mine.groupBy("part").cogroup(entries.repartition(parts, "part").groupBy("part")).applyInArrow(merge, LISTS)


def _group_table(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each code its first group and its number of groups: codes that follow each other share one, large ones are split."""
    first, split = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    group = held = 0
    for code, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            group, held = group + 1, 0
        first[code] = group
        if size > most:
            split[code] = -(-size // most)
            group += split[code]
        else:
            held += size
    return first, split


def first_graph(nodes: DataFrame, count: int, k: int) -> DataFrame:
    """``LISTS``: each node with the nearest of its groups, one by hash and the others by random hyperplanes about the mean."""
    most = min(LARGEST_GROUP, max(GROUP, 2 * math.isqrt(count)))
    turns = max(3, count.bit_length() - 8)
    planes = max(0, (2 * count // most).bit_length() - 1)
    reach = max(4, k // 4)

    def add(batches):
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array([x.sum(0, np.float64).tobytes()], pa.binary())], ["total"])

    totals = [np.frombuffer(r[0]) for r in nodes.select("unit").mapInArrow(add, "total binary").collect()]
    mean = (np.sum(totals, 0) / max(1, count)).astype(np.float32)

    def codes(x: np.ndarray, turn: int) -> np.ndarray:
        directions = np.random.default_rng(turn).standard_normal((planes if turn else 0, x.shape[1])).astype(np.float32)
        return ((x - mean) @ directions.T > 0) @ (1 << np.arange(len(directions), dtype=np.int64))

    def tally(batches):
        for batch in batches:
            x = _matrix(batch.column(0))
            for turn in range(turns if len(x) else 0):
                code, n = np.unique(codes(x, turn), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), turn)), pa.array(code), pa.array(n)], ["turn", "code", "n"])

    tallied = nodes.select("unit").mapInArrow(tally, "turn bigint, code bigint, n bigint").groupBy("turn", "code").agg(F.sum("n").alias("n"))
    sizes = np.zeros((turns, 1 << planes), np.int64)
    for r in tallied.collect():  # at most 2 * count / most codes a turn
        sizes[r["turn"], r["code"]] = r["n"]
    tables = [_group_table(s, most) for s in sizes]

    def deal(batches):
        for batch in batches:
            x, ids = _matrix(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
            for turn in range(turns if len(ids) else 0):
                code = codes(x, turn)
                first, split = (t[code] for t in tables[turn])
                group = first + (mixed(ids, turn + 1) % split.astype("<u8")).astype(np.int64) + (turn << 40)
                yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(ids, pa.int64()), batch.column(1)], ["group", "node", "unit"])

    parts = _part_count(nodes, count, k)

    def compare(rows: pa.Table) -> pa.Table:
        ids = rows["node"].to_numpy()
        order = np.argsort(ids)
        ids, x = ids[order], _matrix(rows["unit"])[order]
        own = x - x.mean(0)
        sims = own @ own.T
        squares = np.diagonal(sims) / 2
        sims -= squares[:, None]
        sims -= squares[None, :]
        np.fill_diagonal(sims, -np.inf)
        wanted = min(reach, len(ids) - 1)
        if not wanted:
            return packed(np.empty(0, np.int32), ids[:0], ids[:0], ids[:0])
        least = np.partition(sims, -wanted, axis=1)[:, -wanted]
        a, b = np.nonzero(sims >= least[:, None])
        few = _places(a) < wanted  # of equal ones at the end, the first
        a, b = a[few], b[few]
        near = np.concatenate([_nearness(x[a[s : s + 65536]], x[b[s : s + 65536]]) for s in range(0, len(a), 65536)])
        return packed(part_of(ids[a], parts), ids[a], ids[b], near.astype("<f4"))

    dealt = nodes.select("node", "unit").mapInArrow(deal, "group bigint, node bigint, unit binary")
    return merged(nodes.select("node"), dealt.groupBy("group").applyInArrow(compare, MESSAGE), k, parts)


def nearest_of(node: np.ndarray, other: np.ndarray, near: np.ndarray, count: int, k: int):
    """The ``k`` nearest entries of each node, each once."""
    _, once = np.unique(node * np.int64(count) + other, return_index=True)  # sorted by node
    node, other, near = node[once], other[once], near[once]
    order = np.lexsort((-near, node))
    node, other, near = node[order], other[order], near[order]
    nth = _places(node)
    return node[nth < k], other[nth < k], near[nth < k]


def _pointing(edges: DataFrame, parts: int) -> DataFrame:
    """Messages to each neighbour's part: the neighbour, the node that points to it, and whether the entry is fresh."""

    def turn(batches):
        for batch in batches:
            other, counts = _flat(batch.column(1), "<i8")
            node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False).astype("<i8"), counts)
            yield from packed(part_of(other, parts), other, node, _flat(batch.column(2), "?")[0]).to_batches()

    return edges.select("node", "neighbours", "fresh").mapInArrow(turn, MESSAGE).repartition(parts, "part")


def introduced(edges: DataFrame, nodes: DataFrame, k: int, parts: int) -> DataFrame:
    """Messages of new entries (node, neighbour, nearness) from introducing the neighbours of every node to each other."""

    def host(left: pa.Table, right: pa.Table) -> pa.Table:
        """A message of all hosts with their guests, and to each part that holds guests one with their names."""
        ids = left["node"].to_numpy()
        own, counts = _flat(left["neighbours"], "<i8")
        at, fresh = np.repeat(np.arange(len(ids)), counts), _flat(left["fresh"], "?")[0]
        (to, _), (back, _), (new, _) = (_flat(right[c], kind) for c, kind in zip("abc", ("<i8", "<i8", "?"), strict=True))
        sorter = np.argsort(ids)
        to_at = sorter[np.searchsorted(ids, to, sorter=sorter)]
        order = np.lexsort((mixed(to ^ mixed(back).view("<i8")), ~new, to_at))
        order = order[_places(to_at[order]) < k]
        at, guest = np.concatenate([at, to_at[order]]), np.concatenate([own, back[order]])
        fresh = np.concatenate([fresh, new[order]])
        order = np.lexsort((~fresh, guest, at))
        at, guest, fresh = at[order], guest[order], fresh[order]
        once = np.ones(len(at), bool)
        once[1:] = (np.diff(at) != 0) | (np.diff(guest) != 0)
        news = np.bincount(at[once], fresh[once], len(ids)) > 0  # others have nobody to introduce
        once &= news[at]
        at, guest, fresh = at[once], guest[once], fresh[once]
        if not len(at):
            return _message([])
        part = int(left["part"][0].as_py())
        names, index = np.unique(guest, return_inverse=True)
        sizes = np.bincount(at)
        hosts = [names, index.astype("<i4"), sizes[sizes > 0].astype("<i4"), fresh]
        asked = packed(part_of(names, parts), names)
        asked = asked.set_column(2, "b", pa.array([np.int32(part).tobytes()] * len(asked), pa.binary()))
        return pa.concat_tables([_message([part], *([c.tobytes()] for c in hosts)), asked])

    mine = _dealt(edges.select("node", "neighbours", "fresh"), parts).groupBy("part")
    hosts = stored(mine.cogroup(_pointing(edges, parts).groupBy("part")).applyInArrow(host, MESSAGE), "introductions")

    def asked(rows: pa.Table) -> pa.Table:
        """Of each name the parts that ask for it."""
        names, counts = _flat(rows["a"], "<i8")
        takers = np.repeat(_flat(rows["b"], "<i4")[0], counts)
        order = np.argsort(names, kind="stable")
        ids, counts = np.unique(names, return_counts=True)
        return pa.table({"node": ids, "takers": _ragged(takers[order], counts)})

    asked_for = hosts.where("d is null").select("part", "a", "b").repartition(parts, "part").groupBy("part")
    guests = (
        nodes.select("node", "unit")
        .join(edges.select("node", "floor"), "node")
        .join(asked_for.applyInArrow(asked, "node bigint, takers binary"), "node")
    )

    def send(batches):
        """A vector travels once to each part that mentions it."""
        for batch in batches:
            takers, counts = _flat(batch.column("takers"), "<i4")
            row = np.repeat(np.arange(len(counts)), counts)
            ids, x = batch.column("node").to_numpy(zero_copy_only=False).astype("<i8"), _matrix(batch.column("unit"))
            floor = batch.column("floor").to_numpy(zero_copy_only=False)
            order = np.argsort(takers, kind="stable")
            for some in np.split(row[order], np.flatnonzero(np.diff(takers[order])) + 1) if len(row) else []:
                to = takers[order[:1]]
                order = order[len(some) :]
                yield from _message(to, *([c[some].tobytes()] for c in (ids, x, floor))).to_batches()

    sent = guests.mapInArrow(send, MESSAGE).repartition(parts, "part")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _message([])
        names, guest, counts, fresh = (_flat(left[c], kind)[0] for c, kind in zip("abcd", ("<i8", "<i4", "<i4", "?"), strict=True))
        x, floor = None, np.empty(len(names), np.float32)
        for a, b, c in zip(right["a"], right["b"], right["c"], strict=True):
            at = np.searchsorted(names, np.frombuffer(a.as_buffer(), "<i8"))
            units = np.frombuffer(b.as_buffer(), "<f4").reshape(len(at), -1)
            x = np.empty((len(names), units.shape[1]), np.float32) if x is None else x
            x[at], floor[at] = units, np.frombuffer(c.as_buffer(), "<f4")
        best, found, held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)), [], 0
        ends = np.cumsum(counts.astype(np.int64))
        chunk = max(1, CHUNK_PAIRS // int(counts.max()) ** 2)
        for start in range(0, len(counts), chunk):
            size = counts[start : start + chunk]
            slots = np.arange(size.max())[None, :] < size[:, None]  # hosts with fewer guests have empty seats
            begin, end = ends[start] - size[0], ends[min(start + chunk, len(ends)) - 1]
            g, f = np.zeros(slots.shape, np.int64), np.zeros(slots.shape, bool)
            g[slots], f[slots] = guest[begin:end], fresh[begin:end]
            own = x[g]
            own[~slots] = 0
            own -= (own.sum(1) / size[:, None])[:, None, :]
            squares = np.einsum("hgd,hgd->hg", own, own) / 2
            squares[~slots] = np.inf
            sims = np.matmul(own, own.transpose(0, 2, 1))
            sims -= squares[:, :, None]
            sims -= squares[:, None, :]
            least = floor[g]
            passed = sims > np.minimum(least[:, :, None], least[:, None, :])
            passed &= f[:, :, None] | f[:, None, :]
            h, a, b = np.nonzero(passed)
            kept = a < b
            h, a, b = h[kept], a[kept], b[kept]
            near, a, b = sims[h, a, b], g[h, a], g[h, b]
            for node, other in ((a, b), (b, a)):
                kept = near > floor[node]
                found.append((node[kept], other[kept], near[kept]))
                held += len(found[-1][0])
            if held > FOUND:
                best = nearest_of(*(np.concatenate(c) for c in zip(best, *found, strict=True)), len(names), k)
                found, held = [], 0
        node, other, near = nearest_of(*(np.concatenate(c) for c in zip(best, *found, strict=True)), len(names), k)
        give_back()
        return packed(part_of(names[node], parts), names[node], names[other], near)

    meeting = hosts.where("d is not null").repartition(parts, "part").groupBy("part")
    return meeting.cogroup(sent.groupBy("part")).applyInArrow(meet, MESSAGE)


def introduce(edges: DataFrame, nodes: DataFrame, k: int, parts: int) -> DataFrame:
    """``introduced`` as rows ``(node, neighbour, near)``."""

    def rows(batches):
        for batch in batches:
            flat = [_flat(batch.column(c), kind)[0] for c, kind in zip("abc", ("<i8", "<i8", "<f4"), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in flat], ["node", "neighbour", "near"])

    return introduced(edges, nodes, k, parts).mapInArrow(rows, "node bigint, neighbour bigint, near float")


def build_graph(nodes: DataFrame, k: int = K, rounds: int | None = None, least_change: float = 0.01) -> DataFrame:
    """``LISTS``: the graph after NN-descent. ``nodes`` is a stored table ``(node, unit)``."""
    count = nodes.count()
    parts = _part_count(nodes, count, k)
    edges = stored(first_graph(nodes, count, k), "graph")
    for _ in range(rounds or max(ROUNDS, count.bit_length())):
        edges = stored(merged(edges, introduced(edges, nodes, k, parts), k, parts), "graph")
        if (edges.agg(F.sum("changed")).first()[0] or 0) <= least_change * k * count:
            break
    return edges


def _part(column: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def compared(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pairs (query, node)`` with ``near``, the cosine in double precision: from whole ``vectors (node, vector)``.

    The pairs of a part of the queries meet each vector once.
    """
    count = pairs.select("query").distinct().count()
    parts = -(-count // PART_QUERIES) or 1

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        """left: (part, query, node); right: (v_part, v_node, vector) of both sides' nodes."""
        ids = right["v_node"].to_numpy()
        order = np.argsort(ids)
        x, ids = _matrix(right["vector"].combine_chunks(), "<f8")[order], ids[order]
        query, node = left["query"].to_numpy(), left["node"].to_numpy()
        a, b = np.searchsorted(ids, query), np.searchsorted(ids, node)
        near = np.empty(len(a))
        for at in range(0, len(a), 65536):
            near[at : at + 65536] = _cosine(x[a[at : at + 65536]], x[b[at : at + 65536]])
        return pa.table({"query": query, "node": node, "near": near})

    pairs = pairs.select(_part("query", parts).alias("part"), "query", "node")
    needed = pairs.select("part", "node").unionByName(pairs.select("part", F.col("query").alias("node")))
    met = needed.distinct().join(vectors, "node").select(
        F.col("part").alias("v_part"), F.col("node").alias("v_node"), "vector"
    )
    return pairs.groupBy("part").cogroup(met.groupBy("v_part")).applyInArrow(
        compare, "query bigint, node bigint, near double"
    )


def graph_ways(graph: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int]:
    """``(part, node, unit, ways)``, stored: every node with its neighbours and those that point to it; and the number of parts."""
    parts = max(1, _part_count(nodes, nodes.count(), K) // 2)  # these hold their own vectors and ways alone

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = np.sort(left["node"].to_numpy())
        own, counts = _flat(left["neighbours"], "<i8")
        at = np.repeat(np.searchsorted(ids, left["node"].to_numpy()), counts)
        at = np.concatenate([at, np.searchsorted(ids, _flat(right["a"], "<i8")[0])])
        other = np.concatenate([own, _flat(right["b"], "<i8")[0]])
        order = np.lexsort((other, at))
        at, other = at[order], other[order]
        once = np.ones(len(at), bool)
        once[1:] = (np.diff(at) != 0) | (np.diff(other) != 0)
        return pa.table({"node": ids, "ways": _ragged(other[once], np.bincount(at[once], minlength=len(ids)))})

    mine = _dealt(graph.select("node", "neighbours"), parts).groupBy("part")
    ways = mine.cogroup(_pointing(graph, parts).groupBy("part")).applyInArrow(both, "node bigint, ways binary")
    joined = nodes.select("node", "unit").join(ways, "node")
    return stored(_dealt(joined, parts).select("part", "node", "unit", "ways"), "graph-ways"), parts


def walk(graph: DataFrame, nodes: DataFrame, queries: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(query, node, near)``: up to ``width`` nearest found of every ``(query, node)``, which names where it starts.

    ``query`` is the node with the query's vector. A node that fell out of the beam cannot come back, as the beam only gets
    nearer: the walk ends by itself.
    """
    ways = graph_ways(graph, nodes)
    return beam_rows(walk_on(None, ways, nodes, queries, width, width), width)


def beam_rows(beam: DataFrame, width: int) -> DataFrame:
    """``(query, node, near)``: the ``width`` nearest of each beam."""

    def rows(batches):
        for batch in batches:
            node, counts = _flat(batch.column("node"), "<i8")
            query = np.repeat(batch.column("query").to_numpy(zero_copy_only=False).astype("<i8"), counts)
            few = _places(query) < width  # the nearest are first, and a query has one beam
            columns = [c[few] for c in (query, node, _flat(batch.column("near"), "<f4")[0])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "node", "near"])

    return beam.mapInArrow(rows, "query bigint, node bigint, near float")


def walk_on(
    beam: DataFrame | None, ways: tuple[DataFrame, int], nodes: DataFrame, queries: DataFrame, width: int, kept: int
) -> DataFrame:
    """The beams after a walk by ``ways``, stored: the ``kept`` nearest found of each query, of which the first ``width`` are opened.

    Without a ``beam`` to go on with, the walk begins at ``queries (query, node)``.
    """
    ways, parts = ways
    starts = queries.select("query", "node").distinct()
    asking = starts.select("query").distinct()
    query_parts = max(-(-asking.count() // PART_QUERIES), 1)

    def pack(batches):
        for batch in batches:
            ids = batch.column("query").to_numpy(zero_copy_only=False).astype("<i8")
            yield from _message([0], [ids.tobytes()], [_matrix(batch.column("unit")).tobytes()]).to_batches()

    own = asking.join(nodes.select(F.col("node").alias("query"), "unit"), "query").mapInArrow(pack, MESSAGE)
    own = stored(own.drop("part"), "walk-queries").select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "*")

    def first(batches):
        for batch in batches:
            query, node = (batch.column(c).to_numpy(zero_copy_only=False).astype("<i8") for c in ("query", "node"))
            floor = np.full(len(node), -3, "<f4")
            yield from packed(part_of(node, parts), query, node, floor).to_batches()

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        """The neighbours of the opened nodes."""
        ids = left["node"].to_numpy()
        order = np.argsort(ids)
        other, counts = _flat(left["ways"], "<i8")
        starts = np.cumsum(counts) - counts
        query, node, floor = (_flat(right[c], kind)[0] for c, kind in zip("abc", ("<i8", "<i8", "<f4"), strict=True))
        at = order[np.searchsorted(ids, node, sorter=order)]
        seen = counts[at]
        way = np.repeat(starts[at] - (np.cumsum(seen) - seen), seen) + np.arange(seen.sum())
        return packed(part_of(other[way], parts), np.repeat(query, seen), other[way], np.repeat(floor, seen))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        """The nearness of each query and node, once, if it can get into the query's beam."""
        asks, own = (right.filter(c) for c in (pc.is_valid(right["c"]), pc.is_null(right["c"])))
        if not len(asks) or not len(left):
            return _message([])
        query, node, floor = (_flat(asks[c], kind)[0] for c, kind in zip("abc", ("<i8", "<i8", "<f4"), strict=True))
        names, y = _flat(own["a"], "<i8")[0], _flat(own["b"], "<f4")[0]
        by_name = np.argsort(names)
        names, y = names[by_name], y.reshape(len(names), -1)
        ids, x = left["node"].to_numpy(), _matrix(left["unit"])
        order = np.argsort(ids)
        q = np.searchsorted(names, query)
        pair, once = np.unique(q * np.int64(len(ids)) + order[np.searchsorted(ids, node, sorter=order)], return_index=True)
        q, n, floor = pair // len(ids), pair % len(ids), floor[once]
        near = np.empty(len(q), "<f4")
        for at in range(0, len(q), 65536):
            some = slice(at, at + 65536)
            near[some] = _nearness(x[n[some]], y[by_name[q[some]]])
        kept = near >= floor
        q, n = names[q[kept]], ids[n[kept]]
        give_back()
        return packed(part_of(q, query_parts), q, n, near[kept])

    def lead(left: pa.Table | None, right: pa.Table) -> pa.Table:
        """The beams with what was found. Of what was there the first ``width`` have been opened."""
        query, node, near = (_flat(right[c], kind)[0] for c, kind in zip("abc", ("<i8", "<i8", "<f4"), strict=True))
        opened = np.zeros(len(query), bool)
        if left is not None and len(left):
            old, counts = _flat(left["node"], "<i8")
            query = np.concatenate([np.repeat(left["query"].to_numpy(), counts), query])
            node, near = np.concatenate([old, node]), np.concatenate([_flat(left["near"], "<f4")[0], near])
            before = _flat(left["opened"], "?")[0] | (_places(query[: len(old)]) < width)
            opened = np.concatenate([before, opened])
        order = np.lexsort((~opened, node, query))
        query, node, near, opened = query[order], node[order], near[order], opened[order]
        once = np.ones(len(query), bool)
        once[1:] = (np.diff(query) != 0) | (np.diff(node) != 0)
        query, node, near, opened = query[once], node[once], near[once], opened[once]
        order = np.lexsort((node, -near, query))
        order = order[_places(query[order]) < kept]
        query, node, near, opened = query[order], node[order], near[order], opened[order]
        ids, counts = np.unique(query, return_counts=True)
        rows = [pa.array(ids, pa.int64()), *(_ragged(c, counts) for c in (node, near, opened))]
        return pa.table(rows, ["query", "node", "near", "opened"])

    beams = "query bigint, node binary, near binary, opened binary"

    @F.arrow_udf("boolean")
    def waiting(opened: pa.Array) -> pa.Array:
        return pa.array([0 in b[:width] for b in opened.to_pylist()], pa.bool_())

    def opening(batches):
        for batch in batches:
            node, counts = _flat(batch.column("node"), "<i8")
            near, opened = _flat(batch.column("near"), "<f4")[0], _flat(batch.column("opened"), "?")[0]
            last = near[np.cumsum(counts) - 1]
            floor = np.repeat(np.where(counts < kept, np.float32(-3), last), counts)
            query = np.repeat(batch.column("query").to_numpy(zero_copy_only=False).astype("<i8"), counts)
            asked = ~opened & (_places(query) < width)
            yield from packed(part_of(node[asked], parts), query[asked], node[asked], floor[asked]).to_batches()

    def compared_by_part(asks: DataFrame) -> DataFrame:
        met = asks.unionByName(own).repartition(parts, "part").groupBy("part")
        units = ways.select("part", "node", "unit").repartition(parts, "part").groupBy("part")
        return units.cogroup(met).applyInArrow(compare, MESSAGE).repartition(query_parts, "part").groupBy("part")

    if beam is None:
        found = compared_by_part(starts.mapInArrow(first, MESSAGE))
        beam = stored(found.applyInArrow(lambda rows: lead(None, rows), beams), "walk")
    adjacent = ways.select("part", "node", "ways").repartition(parts, "part").groupBy("part")
    while not (open_ones := beam.where(waiting("opened"))).isEmpty():
        asks = open_ones.mapInArrow(opening, MESSAGE).repartition(parts, "part").groupBy("part")
        found = compared_by_part(adjacent.cogroup(asks).applyInArrow(look, MESSAGE))
        held = _dealt(beam, query_parts, "query").groupBy("part")
        beam = stored(held.cogroup(found).applyInArrow(lead, beams), "walk")
    return beam


def _cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    # Scaling by a power of two changes no digit and keeps squares of extreme values in range.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    y = np.ldexp(y, -np.frexp(np.abs(y).max(1, keepdims=True))[1])
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


@F.arrow_udf(T.BinaryType())
def _doubles(vectors: pa.Array) -> pa.Array:
    values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype("<f8")
    return pa.array([row.tobytes() for row in values], pa.binary())


def sampled_truth(nodes: DataFrame, starts: DataFrame, k: int) -> DataFrame:
    """``(query, least)``: the nearness of the ``k``-th of all other nodes to each of ``SAMPLE`` queries."""
    sample = starts.select("query").distinct().orderBy(F.xxhash64("query"), "query").limit(SAMPLE)
    taken = sample.join(nodes.select(F.col("node").alias("query"), "unit"), "query").collect()
    own = np.array([r["query"] for r in taken], np.int64)
    x = np.array([np.frombuffer(r["unit"], "<f4") for r in taken])

    def scan(batches):
        for batch in batches:
            ids, y = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for q, vector in zip(own, x, strict=True):
                near = _nearness(y[ids != q], vector[None])
                near = np.sort(near)[::-1][:k]
                columns = [pa.array(np.full(len(near), q)), pa.array(near, pa.float32())]
                yield pa.RecordBatch.from_arrays(columns, ["query", "near"])

    every = nodes.select("node", "unit").mapInArrow(scan, "query bigint, near float")
    nearest = Window.partitionBy("query").orderBy(F.desc("near"))
    ranked = every.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= k)
    return ranked.groupBy("query").agg(F.min("near").alias("least"), F.count(F.lit(1)).alias("n"))


def recall(found: DataFrame, truth: DataFrame) -> float:
    """The share of the true nearest of ``sampled_truth`` that ``found`` has."""
    hits = found.where("query != node").join(F.broadcast(truth), "query").where("near >= least")
    had = hits.groupBy("query").agg(F.least(F.count(F.lit(1)), F.max("n")).alias("had"))
    wanted = truth.agg(F.sum("n")).first()[0] or 0
    return (had.agg(F.sum("had")).first()[0] or 0) / wanted if wanted else 1.0


def walked(graph: DataFrame, nodes: DataFrame, starts: DataFrame, k: int, width: int) -> DataFrame:
    """The walk from ``starts``, widened until the sample's recall of the ``k`` nearest is ``RECALL``.

    A beam as wide as the table that still lacks some has no way to them.
    """
    truth = stored(sampled_truth(nodes, starts, k), "walk-sample")
    count = nodes.count()
    ways, kept = graph_ways(graph, nodes), SPARE * width
    beam = walk_on(None, ways, nodes, starts, width, kept)
    while width < count and recall(beam_rows(beam, width), truth) < RECALL:
        width *= 2
        again = width > kept  # what was found beyond is not known any more
        kept = SPARE * width if again else kept
        beam = walk_on(None if again else beam, ways, nodes, beam_rows(beam, width) if again else starts, width, kept)
    return beam_rows(beam, width)


def search(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    degree: int | None = None,
    width: int | None = None,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest found of every row that ``is_query``, itself left out.

    ``is_query`` is a condition on ``id``. Degree and width are the least ones, and by default at least ``K`` and ``WIDTH`` and
    more where ``k`` asks for it.
    """
    degree = degree or max(K, k + 8)
    width = max(width or WIDTH, 4 * (k + 1))
    vectors = valid_vectors(rows, id_column, column)
    nodes, members = nodes_of(vectors, k + 1)
    graph = stored(build_graph(nodes, degree), "graph-done")
    # A query's node is known by its vector: ids beyond the first copies are looked up by it.
    asked = stored(
        vectors.where(is_query)
        .join(nodes.select("node", "vector"), "vector")
        .select(F.col("id").alias("query_id"), F.col("node").alias("query"), F.monotonically_increasing_id().alias("row")),
        "vector-queries",
    )
    starts = asked.select("query", F.col("query").alias("node")).distinct()
    found = walked(graph, nodes, starts, k, width)
    doubles = nodes.select("node", _doubles("vector").alias("vector"))
    scored = compared(found.select("query", "node"), doubles).withColumnRenamed("near", "score")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    listed = (
        scored.join(members, "node")
        .withColumn("nth", F.row_number().over(best))
        .where(F.col("nth") <= k + 1)  # one may be the query itself
        .select("query", "id", "score")
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    return (
        asked.join(listed, "query")
        .where("id != query_id")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )
