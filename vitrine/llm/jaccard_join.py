"""Near-duplicate join on word shingles, with count vectors in R-trees.

Two texts link when the Jaccard similarity of their sets of five-word shingles is at least 0.75 (exact, in integers).
The result is one row per document: its number of shingles, its class and its component.

1. Texts with equal sets are one class from the start. Everything below works on classes, so copies cost nothing.
2. Shingles are hashed into ``GROUPS`` groups; a class is the point of its group counts. The summed coordinate minima of
   two points bound the overlap of their sets from above.
3. Two similar sets share one of the first quarter (``n - ceil(3n/4) + 1``) of their shingles in any fixed order. Classes
   meet by these; the order puts the most frequent shingles last (passages of many documents), then goes by hash.
4. In each meeting group all members are compared with one of them: bound first, then the sets. The links found give
   first components, so most large groups of copies are settled with one pair per member.
5. What is left are members of different components in one group. The members outside the largest component go into
   R-trees of count vectors, in blocks of bounded size; all others are searched against them. A node's box bounds
   the overlap of everything below it. Of a class's surviving pairs a block hands on the ``QUOTA`` with the highest bounds; they are
   verified on their sets and the components grow. Where a block held pairs back that still cross components, it is searched
   again with a larger quota, until none holds any back. So a family of near copies costs a few pairs a member, not all.
6. All similar pairs lie inside one component. The classes of each are dealt to blocks, every two blocks of a component
   are compared once, whole sets by whole sets, and only the number of links of each class leaves the comparison.

No pair that passes the threshold can be lost: steps 3 to 5 leave out only pairs that are in one component already or
whose bound is too low. Null texts and texts without words have no shingles and are components of their own, as are rows
with a null ``doc_id`` (component null). Rows that repeat a ``doc_id`` are kept; they are classes by their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm.common import arrow_rows, slices, stored, tidy
from vitrine.llm.components import components
from vitrine.llm.shingles import shingle_sets

GROUPS = 256
FINE_GROUPS = 1024  # for the last bound before sets are moved
PERCENT = 75
FREQUENT = 16  # a shingle in more classes' first quarters than this comes last in the order ...
MAX_FREQUENT = 1_000_000  # ... where the limit rises so that each count lists at most so many (8 MB)
MAX_WANTED = 4_000_000  # ids that a scan gets by broadcast (32 MB); more are joined by a shuffle
SETS = 256  # rows with whole sets that a Python worker gets at once
QUOTA = 4  # pairs that a class tries in a block before components are joined; grows ...
GROWTH = 8  # ... by this factor a round
BLOCK = 512  # points of an R-tree
QUERIES = 256  # searched at once
PAIRS = 32768  # of a query and a node whose counts are held at once
MEMBERS = 1024  # sets of a component's block ...
HELD = 2_000_000  # ... and their shingles (16 MB)
COLUMNS = 4096  # shingles whose marks are held at once
SALTS = 32  # parts of a frequent shingle's meeting before it is summed up

FACTS = "doc_id bigint, n_shingles bigint, key bigint, counts binary"


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and shingle sets, a few MB of text at a time."""
    for batch in batches:
        for first, last in slices(batch.column(1)):
            part = batch.slice(first, last - first)
            texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
            yield part.column(0).to_pylist(), shingle_sets(texts)


def _key(shingles: np.ndarray) -> int:
    """64 bits of a digest of the whole set, signed."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def count_vector(shingles: np.ndarray, groups: int = GROUPS) -> bytes:
    """Counts per group, one byte each; four bytes each where a count needs more than one."""
    counts = np.bincount((shingles & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else "<u4").tobytes()


def needed_overlap(a: int, b: int) -> int:
    """Least overlap of sets of these sizes at the threshold: 100 i >= p (a + b - i)."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted ``listed``."""
    if not len(listed):
        return np.zeros(len(values), bool)
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def first_quarter(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The shingles by which a set meets others: frequent ones last, else by hash."""
    n = len(shingles)
    size = n + 1 + (-PERCENT * n) // 100
    if not len(frequent):
        return shingles[:size]
    late = among(shingles, frequent)
    return np.concatenate([shingles[~late], shingles[late]])[:size]


def facts(docs: DataFrame) -> DataFrame:
    """``FACTS`` of every document; ``key`` is null where there are no shingles."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _batches(batches):
            some = [len(s) > 0 for s in sets]
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_key(s) if x else None for s, x in zip(sets, some, strict=True)], pa.int64()),
                pa.array([count_vector(s) for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FACTS.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, FACTS)


def meetings(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``(shingle, key, late)``: by which shingles each class meets others. A task tells a class once."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # MAX_FREQUENT numbers at most

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        often = shared.value
        for _, sets in _batches(batches):
            keys, parts = [], []
            for s in sets:
                if len(s) and (key := _key(s)) not in seen:
                    seen.add(key)
                    keys.append(key)
                    parts.append(first_quarter(s, often))
            if not keys:
                continue
            flat = np.concatenate(parts)
            owner = np.repeat(np.array(keys, np.int64), [len(p) for p in parts])
            late = among(flat, often)
            columns = [pa.array(flat.view(np.int64)), pa.array(owner), pa.array(late)]
            yield pa.RecordBatch.from_arrays(columns, ["shingle", "key", "late"])

    return docs.select("doc_id", "text").mapInArrow(run, "shingle bigint, key bigint, late boolean")


def extensions(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``shingle``: those that come into the first quarters (and a little beyond) when ``frequent`` ones go last."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, none = shared.value, np.empty(0, np.uint64)
        for _, sets in _batches(batches):
            parts = [none]
            for s in sets:
                first = first_quarter(s, none)
                share = among(first, often).mean() if len(first) else 0
                if share:
                    reach = int(1.25 * len(first) / max(1 - share, 0.25)) + 1
                    parts.append(s[len(first) : reach])
            found = np.concatenate(parts)
            found = found[~among(found, often)]
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["shingle"])

    return docs.select("doc_id", "text").mapInArrow(run, "shingle bigint")


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the shingles that come last in the order: a bounded list, which only steers the work.

    Counted in the first quarters by hash; then once more among what takes the place of the ones found.
    """

    def listed(rows: DataFrame) -> np.ndarray:
        counts = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
        often = stored(counts.where(F.col("n") > FREQUENT), "frequent-shingles")
        limit = max(FREQUENT, (often.agg(F.sum("n")).first()[0] or 0) // MAX_FREQUENT)
        names = often.where(F.col("n") > limit).select("shingle").toPandas()["shingle"]
        return np.sort(names.to_numpy(np.int64).view(np.uint64))

    first = listed(meetings(docs, np.empty(0, np.uint64)))
    return np.union1d(first, listed(extensions(docs, first))) if len(first) else first


def shared_meetings(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``(shingle, key, late, leader)`` of the shingles by which two classes or more meet; the leader is the least key.

    Shingles of the frequent list may hold any share of the rows: they are dealt out in parts, what is left of the parts
    is summed up on the map side and joined back. The others are grouped by the same shuffle.
    """
    salt = F.when(F.col("late"), F.pmod(F.xxhash64("key"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    rows = meetings(docs, frequent).withColumn("part", salt)
    inside = Window.partitionBy("shingle", "part")
    found = rows.select(
        "shingle",
        "key",
        "late",
        F.min("key").over(inside).alias("leader"),
        F.max("key").over(inside).alias("other"),
    )
    met = stored(
        found.where("late or leader != other").select("shingle", "key", "late", "leader").distinct(), "meetings"
    )
    late = met.where("late").drop("leader")
    leaders = late.groupBy("shingle").agg(F.min("key").alias("leader"), F.max("key").alias("other"))
    led = late.join(leaders.where("leader != other").drop("other"), "shingle")
    return met.where("not late").unionByName(led)


def min_sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a, b).sum(-1, dtype=np.int64)


class CountTree:
    """A packed R-tree over count vectors.

    Only the upper corners of boxes matter: the overlap with any set below a node is at most the sum of the minima of the
    query and the corner. Points are packed by splitting at the median of the coordinate that varies most.
    """

    LEAF = 8

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        order = self._packed(points, np.arange(len(points)))
        self.order, self.points, self.sizes = order, points[order], sizes[order]
        self.levels = [(self.points, self.sizes)]
        while len(self.levels[-1][0]) > self.LEAF:
            corners, least = self.levels[-1]
            cuts = np.arange(0, len(corners), self.LEAF)
            self.levels.append((np.maximum.reduceat(corners, cuts), np.minimum.reduceat(least, cuts)))

    def _packed(self, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if len(rows) <= self.LEAF:
            return rows
        spread = points[rows].astype(np.float32).var(0).argmax()
        half = -(-len(rows) // (2 * self.LEAF)) * self.LEAF  # whole leaves on the left
        by = rows[np.argsort(points[rows, spread], kind="stable")]
        return np.concatenate([self._packed(points, by[:half]), self._packed(points, by[half:])])

    def search(self, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs ``(query, point)`` whose bound reaches the overlap that the threshold needs."""
        parts = [
            (q + at, point)
            for at in range(0, len(queries), QUERIES)
            for q, point in [self._search(queries[at : at + QUERIES], sizes[at : at + QUERIES])]
        ]
        none = np.empty(0, np.int64)
        return tuple(np.concatenate([none, *column]) for column in zip(*parts, strict=True)) if parts else (none, none)

    def _search(self, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q = np.repeat(np.arange(len(queries)), len(self.levels[-1][0]))
        at = np.tile(np.arange(len(self.levels[-1][0])), len(queries))
        for level in range(len(self.levels) - 1, -1, -1):
            corners, least = self.levels[level]
            parts = [slice(i, i + PAIRS) for i in range(0, len(q), PAIRS)]
            sums = [min_sums(queries[q[part]], corners[at[part]]) for part in parts]
            bound = np.minimum(np.concatenate([np.empty(0, np.int64), *sums]), sizes[q])
            # A set of size b needs an overlap of p (a + b) / (100 + p), which grows with b.
            fits = (100 + PERCENT) * bound >= PERCENT * (sizes[q] + least[at])
            q, at = q[fits], at[fits]
            if level:
                below = len(self.levels[level - 1][0])
                q = np.repeat(q, self.LEAF)
                at = (at[:, None] * self.LEAF + np.arange(self.LEAF)).ravel()
                q, at = q[at < below], at[at < below]
        return q, self.order[at]


def _vectors(counts: list[bytes], groups: int = GROUPS) -> np.ndarray:
    """Points of count vectors, in the width that the largest count of them needs."""
    if all(len(c) == groups for c in counts):
        return np.frombuffer(b"".join(counts), np.uint8).reshape(-1, groups)
    wide = [np.frombuffer(c, np.uint8 if len(c) == groups else "<u4").astype(np.uint32) for c in counts]
    return np.stack(wide)


def bounded(pairs: DataFrame, groups: int = GROUPS) -> DataFrame:
    """Rows of ``(a, b, n_a, n_b, counts_a, counts_b)`` whose summed minima reach the needed overlap."""

    @F.arrow_udf("boolean")
    def reaches(n_a: pa.Array, n_b: pa.Array, counts_a: pa.Array, counts_b: pa.Array) -> pa.Array:
        a, b = n_a.to_numpy(zero_copy_only=False), n_b.to_numpy(zero_copy_only=False)
        sums = min_sums(_vectors(counts_a.to_pylist(), groups), _vectors(counts_b.to_pylist(), groups))
        sums = np.minimum(sums, np.minimum(a, b))
        return pa.array((100 + PERCENT) * sums >= PERCENT * (a + b))

    alike = (F.col("n_a") * PERCENT <= F.col("n_b") * 100) & (F.col("n_b") * PERCENT <= F.col("n_a") * 100)
    return pairs.where(alike).where(reaches("n_a", "n_b", "counts_a", "counts_b"))


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``pairs (a, b)`` of class keys whose sets are similar, decided on the whole sets; stored.

    Sets are made again from the texts of one document per class; only those of ``pairs`` are moved.
    """
    with arrow_rows(docs.sparkSession, SETS):
        return stored(_similar(pairs, docs, classes), "links")


def _similar(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    pairs = stored(pairs.select("a", "b").distinct(), "candidate-pairs")
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    sets = sets_of(keys, docs, classes)

    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * common >= PERCENT * (len(x) + len(y) - common))
        return pa.array(out, pa.bool_())

    # The sets are large: a finer count vector of each goes first and leaves few pairs to them.
    @F.arrow_udf("binary")
    def fine(sets: pa.Array) -> pa.Array:
        vectors = [count_vector(np.frombuffer(s, np.uint64), FINE_GROUPS) for s in sets.to_pylist()]
        return pa.array(vectors, pa.binary())

    size = (F.octet_length("shingles") / 8).cast("bigint")
    points = sets.select("key", size.alias("n_shingles"), fine("shingles").alias("counts"))
    pairs = stored(bounded(with_points(pairs, points), FINE_GROUPS).select("a", "b"), "bounded-pairs")
    both = pairs.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("set_b")), "b").join(
        sets.select(F.col("key").alias("a"), F.col("shingles").alias("set_a")), "a"
    )
    return both.where(similar("set_a", "set_b")).select("a", "b")


def sets_of(keys: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``(key, shingles)`` of the classes in ``keys (key)``, stored."""
    wanted = stored(keys.join(classes.select("key", "first_id"), "key"), "wanted-classes")
    few = wanted.count() <= MAX_WANTED
    mine = F.broadcast(wanted) if few else wanted
    texts = docs.select("doc_id", "text").join(mine, docs["doc_id"] == mine["first_id"])

    # A document id may repeat with other texts: only the set that makes the key counts.
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, sets in _batches(batches):
            made = [(k, s.tobytes()) for k, s in zip(keys, sets, strict=True) if _key(s) == k]
            columns = [pa.array([k for k, _ in made], pa.int64()), pa.array([s for _, s in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "shingles"])

    sets = stored(texts.select("key", "text").mapInArrow(run, "key bigint, shingles binary"), "wanted-sets")
    if sets.count() == wanted.count():  # else a document is there twice
        return sets
    return stored(sets.dropDuplicates(["key"]), "wanted-sets")


def with_points(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    for side in "ab":
        points = classes.select(
            F.col("key").alias(side),
            F.col("n_shingles").alias(f"n_{side}"),
            F.col("counts").alias(f"counts_{side}"),
        )
        pairs = pairs.join(points, side)
    return pairs


def cross_pairs(met: DataFrame, labels: DataFrame, classes: DataFrame, quota: int) -> DataFrame:
    """Pairs ``(a, b, more)`` of different components that meet, passed by the R-trees; pairs with the leader are left out.

    A class brings at most ``quota`` pairs a block; ``more`` says that it has others.
    Classes that meet by frequent shingles meet by many of them, mostly under the same leader: those meetings are put
    together by leader, so that a pair is not found again for every shingle.
    """
    rest = met.where("key != leader")
    by_shingle = rest.where("not late").select(F.col("shingle").alias("group"), "key")
    by_leader = rest.where("late").select(F.col("leader").alias("group"), "key").distinct()
    few, many = (_searched(m, labels, classes, quota) for m in (by_shingle, by_leader))
    return few.unionByName(many).groupBy("a", "b").agg(F.max("more").alias("more"))


def _best(q: np.ndarray, at: np.ndarray, likeness: np.ndarray, quota: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the ``quota`` likeliest pairs of each query, and whether the query has more."""
    order = np.lexsort((-likeness, q))
    nth = np.arange(len(q)) - np.searchsorted(q[order], q[order])
    many = np.bincount(q, minlength=1)[q[order]] > quota
    return order[nth < quota], many[nth < quota]


def _searched(members: DataFrame, labels: DataFrame, classes: DataFrame, quota: int) -> DataFrame:
    """The pairs that survive the R-trees of ``members (group, key)``."""
    marked = members.join(labels, members["key"] == labels["node"], "left").select(
        "group", "key", F.coalesce("label", "key").alias("label")
    )
    sizes = marked.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))
    groups = sizes.groupBy("group").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels")
    )
    open_groups = groups.where("labels > 1").select(
        "group",
        F.col("top.label").alias("top"),
        F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("blocks"),
    )
    rows = marked.join(open_groups, "group").join(
        classes.select("key", "n_shingles", "counts"), "key"
    )
    outside = F.col("label") != F.col("top")
    kept = ["group", "key", "label", "n_shingles", "counts"]
    built = rows.where(outside).select(
        *kept, F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role")
    )
    asked = rows.select(*kept, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"))
    dealt = built.unionByName(asked).repartition("group", "block").sortWithinPartitions("group", "block", "role")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, points, tree = None, [], None  # the block at hand: its points, then their tree
        for batch in batches:
            rows = zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True)
            asked: list[tuple] = []
            found: dict[tuple[int, int], bool] = {}

            def answer() -> None:
                nonlocal tree
                for first in range(0, len(asked) if points else 0, QUERIES):  # so many queries' pairs are held at once
                    part = asked[first : first + QUERIES]
                    if tree is None:
                        sizes = np.array([p[3] for p in points], np.int64)
                        tree = CountTree(_vectors([p[4] for p in points]), sizes)
                    sizes, vectors = np.array([r[3] for r in part], np.int64), _vectors([r[4] for r in part])
                    q, at = tree.search(vectors, sizes)
                    crossing = np.array([r[2] for r in part])[q] != np.array([p[2] for p in points])[at]
                    q, at = q[crossing], at[crossing]
                    place = np.argsort(tree.order)[at]  # where the tree keeps a point
                    sums = [
                        min_sums(vectors[q[i : i + PAIRS]], tree.points[place[i : i + PAIRS]]) for i in range(0, len(q), PAIRS)
                    ]
                    likeness = np.concatenate([np.empty(0), *sums]) / np.maximum(1, sizes[q] + tree.sizes[place])
                    kept, more = _best(q, at, likeness, quota)
                    for i, j, others in zip(q[kept].tolist(), at[kept].tolist(), more.tolist(), strict=True):
                        pair = min(part[i][1], points[j][1]), max(part[i][1], points[j][1])
                        found[pair] = found.get(pair, False) or others
                asked.clear()

            for row in rows:
                if (row[0], row[5]) != group:
                    answer()
                    group, points, tree = (row[0], row[5]), [], None
                if row[6] == 0:
                    points.append(row)
                else:
                    asked.append(row)
            answer()
            if found:
                columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found.values(), pa.bool_())], ["a", "b", "more"])

    return dealt.mapInArrow(run, "a bigint, b bigint, more boolean")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of a set of ``left`` and one of ``right``."""
    out = np.zeros((len(left), len(right)), np.int64)
    flat = [np.concatenate(side) for side in (left, right)]
    common = np.intersect1d(*flat)
    cells = []
    for side, values in zip((left, right), flat, strict=True):
        owner = np.repeat(np.arange(len(side)), [len(s) for s in side])
        at = np.minimum(np.searchsorted(common, values), max(0, len(common) - 1))
        hit = common[at] == values if len(common) else np.zeros(len(values), bool)
        order = np.argsort(at[hit], kind="stable")
        cells.append((at[hit][order], owner[hit][order]))
    for start in range(0, len(common), COLUMNS):
        marks = []
        for (at, owner), side in zip(cells, (left, right), strict=True):
            first, last = np.searchsorted(at, [start, start + COLUMNS])
            mark = np.zeros((len(side), min(COLUMNS, len(common) - start)), np.float32)
            mark[owner[first:last], at[first:last] - start] = 1
            marks.append(mark)
        out += (marks[0] @ marks[1].T).astype(np.int64)  # at most COLUMNS, exact
    return out


def link_counts(labels: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``(node, n_links)``: with how many other classes the set of each class in ``labels (node, label)`` is similar.

    Components of two need no comparison. A larger one is cut into blocks by hash, so that a comparison holds about
    ``MEMBERS`` sets or ``HELD`` shingles a side however large the component is.
    """
    sized = labels.join(classes.select(F.col("key").alias("node"), "n_shingles"), "node")
    parts = sized.groupBy("label").agg(
        F.count(F.lit(1)).alias("members"),
        F.ceil(F.greatest(F.count(F.lit(1)) / MEMBERS, F.sum("n_shingles") / HELD)).cast("int").alias("blocks"),
    )
    placed = stored(
        labels.join(parts, "label").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")),
        "component-blocks",
    )
    sets = sets_of(placed.where("members > 2").select(F.col("node").alias("key")), docs, classes)
    block, other = F.col("block"), F.col("other")
    asked = (
        placed.where("members > 2")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("label", F.least(block, other).alias("low"), F.greatest(block, other).alias("high"), "block", "node")
        .join(sets.withColumnRenamed("key", "node"), "node")
        .select("label", "low", "high", "block", "node", "shingles")
    )

    def compare(rows: pa.Table) -> pa.Table:
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        blocks, keys = rows["block"].to_numpy(), rows["node"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        a, b = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
        if not len(a) or not len(b):
            return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        common = overlaps([sets[i] for i in a], [sets[i] for i in b])
        alike = (100 + PERCENT) * common >= PERCENT * (sizes[a][:, None] + sizes[b][None, :])
        if low == high:
            np.fill_diagonal(alike, False)
            return pa.table({"node": keys[a], "n": alike.sum(1).astype(np.int64)})
        sums = np.concatenate([alike.sum(1), alike.sum(0)]).astype(np.int64)
        return pa.table({"node": np.concatenate([keys[a], keys[b]]), "n": sums})

    counted = asked.groupBy("label", "low", "high").applyInArrow(compare, "node bigint, n bigint")
    pairs = placed.where("members = 2").select("node", F.lit(1).cast("bigint").alias("n"))
    return pairs.unionByName(counted).groupBy("node").agg(F.sum("n").alias("n_links"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, class_id, n_links, component_id)`` for every row of ``docs (doc_id, text)``.

    ``class_id`` is the least ``doc_id`` with the same set; ``n_links`` is the number of other classes whose sets are
    similar to its own.
    """
    known = stored(facts(docs), "shingle-facts")
    classes = stored(
        known.where("key is not null")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("counts").alias("counts"),
        ),
        "shingle-classes",
    )
    met = stored(shared_meetings(docs, frequent_shingles(docs)), "meetings")
    stars = met.where("key != leader").select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct()
    links = verified(bounded(with_points(stars, classes)), docs, classes)
    labels = stored(components(links), "star-components")
    quota, refuted = QUOTA, links.limit(0)
    while True:
        crossing = stored(cross_pairs(met, labels, classes, quota), "cross-pairs")
        tried = stored(crossing.select("a", "b").join(refuted, ["a", "b"], "left_anti"), "tried-pairs")
        more = verified(tried, docs, classes)
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = stored(components(links), "link-components")
        if crossing.where("more").isEmpty():
            break
        quota, refuted = quota * GROWTH, refuted.unionByName(tried.join(more, ["a", "b"], "left_anti"))
    return _placed(known, classes, labels, link_counts(labels, docs, classes))


def _placed(known: DataFrame, classes: DataFrame, labels: DataFrame, degrees: DataFrame) -> DataFrame:
    """Every document with its class and component: labels of keys become least document ids."""
    named = labels.join(classes.select(F.col("key").alias("node"), "first_id"), "node")
    least = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    linked = named.join(least, "label").join(degrees, "node").select("node", "component_id", "n_links")
    full = classes.join(linked, classes["key"] == linked["node"], "left").select(
        "key",
        F.col("first_id").alias("class_id"),
        F.coalesce("component_id", "first_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    # A class may hold any share of the documents: the join's skewed side is split at run time.
    return known.join(full, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
