"""Conversation structure repair: the cheapest edits that make the roles of a conversation read ``(s?(ua)+)?``.

A row is kept (0), given the role user or assistant (1), deleted (2; a must for blank and repeated rows), and empty turns of user or
assistant are inserted (5); a row whose text breaks off costs 5 unless it is deleted. Among the cheapest edits those count whose
initials (``D I K R``), written in order, are least.

``cheapest_edits`` searches depth first with an explicit stack. Lower bounds of every suffix are made first, by a backward pass that
lets a conversation end after any role; a dive along them gives the first limit. Branches are taken in order of their initials, so
prefixes are met in that order: one that reaches a node (row, role before it) at no less cost than an earlier one is dominated, and a
later end that costs as much as the incumbent has the larger audit. The search ends when nothing is left below the incumbent, which
then is proved. The limit is at most two insertions above the first bound, so a node is opened a bounded number of times and work
and memory grow with the rows of a conversation.

In Spark, rows are sorted by ranges of (conversation, turn), so a long conversation is dealt over tasks, and every task writes one byte
a row: role and fault. Only these bytes meet by conversation. A second, sorted pass streams texts through the digest of the
repaired text; that is a chain over the whole conversation and runs in one task for each, holding its audit and one batch.

Null roles and texts read as one space, a null turn comes first, null ``conv_id`` is a conversation of its own. Rows of one turn are ordered
by role, then by a digest of role and text; equal rows are neighbours and all but the first are duplicates. A conversation
without rows has zeros, an empty audit and the digest of nothing. Empty tables give an empty result. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import per_worker, stored

SPACE = " \t\n\x0b\x0c\r"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
ROLES = "sua"  # a row's byte is 4 * its initial's place (3: any other) + its fault
RENAME, DELETE, INSERT, BROKEN = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)  # what the last row so far was
ENDS = (START, ASSISTANT)
FOLLOWS = (USER, USER, ASSISTANT, USER)  # whose turn may be inserted, or take another role, after each
KEEPS = ((SYSTEM, -1, -1, -1), (USER, USER, -1, USER), (-1, -1, ASSISTANT, -1), (-1,) * 4)  # by initial, then by state
REMEMBERED = 16_384
LEGAL = {(0, 1), (1, 2), (2, 1)}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def suffix_bounds(rows: bytes) -> list[tuple[int, int, int, int]]:
    """For each row and the end, by state: the least cost of all that follows if any role may be the last."""
    after = (0, 0, 0, 0)
    bounds = [after]
    for code in reversed(rows):
        initial, fault = code >> 2, code & 3
        least = [DELETE + b for b in after]
        if fault in (FINE, TRUNCATED):
            extra = BROKEN if fault == TRUNCATED else 0
            kept = KEEPS[initial]
            for state in range(4):
                cost = extra + RENAME + after[FOLLOWS[state]]
                if kept[state] >= 0:
                    cost = min(cost, extra + after[kept[state]])
                least[state] = min(least[state], cost)
        start, system, user, assistant = least
        user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
        after = (min(start, INSERT + user), min(system, INSERT + user), user, assistant)
        bounds.append(after)
    return bounds[::-1]


def moves(rows: bytes, at: int, state: int) -> list[tuple[str, int, int, int]]:
    """What can be done before or with row ``at``: (initial, cost, next row, next state), by initial."""
    found = []
    if at < len(rows):
        found.append(("D", DELETE, at + 1, state))
    found.append(("I", INSERT, at, FOLLOWS[state]))
    if at < len(rows) and rows[at] & 3 in (FINE, TRUNCATED):
        extra = BROKEN if rows[at] & 3 == TRUNCATED else 0
        kept = KEEPS[rows[at] >> 2][state]
        if kept >= 0:
            found.append(("K", extra, at + 1, kept))
        found.append(("R", extra + RENAME, at + 1, FOLLOWS[state]))
    return found


def first_limit(rows: bytes, bounds: list[tuple[int, int, int, int]]) -> int:
    """The cost of the edits that always take the step of the least bound; what is missing in the end is inserted."""
    at, state, cost = 0, START, 0
    while at < len(rows):
        _, paid, at, state = min(moves(rows, at, state), key=lambda m: (m[1] + bounds[m[2]][m[3]], -m[2]))
        cost += paid
    while state not in ENDS:
        cost, state = cost + INSERT, FOLLOWS[state]
    return cost


def cheapest_edits(rows: bytes) -> tuple[int, str]:
    """``(cost, audit)`` of the best edits of a conversation given by one byte a row."""
    bounds = suffix_bounds(rows)
    limit = first_limit(rows, bounds) + 1  # costs below this are of interest
    audit = None
    reached: list[list[int | None]] = [[None] * 4 for _ in range(len(rows) + 1)]  # cheapest prefix of each node so far
    path: list[str] = []
    stack = [(0, "", 0, 0, START)]
    while stack:
        depth, letter, cost, at, state = stack.pop()
        best = reached[at][state]
        if cost + bounds[at][state] >= limit or best is not None and cost >= best:
            continue
        reached[at][state] = cost
        if depth:
            del path[depth - 1 :]
            path.append(letter)
        if at == len(rows) and state in ENDS:
            limit, audit = cost, "".join(path)
        for letter, paid, following, then in reversed(moves(rows, at, state)):
            if cost + paid + bounds[following][then] < limit:
                stack.append((depth + 1, letter, cost + paid, following, then))
    return limit, audit


def edits(rows: bytes) -> tuple[int, str]:
    """``cheapest_edits``; up to ``REMEMBERED`` short conversations, which look alike, are remembered by a worker."""
    if len(rows) > 32:
        return cheapest_edits(rows)
    known = per_worker(("repair",), dict)
    if rows not in known:
        if len(known) >= REMEMBERED:
            known.clear()
        known[rows] = cheapest_edits(rows)
    return known[rows]


def damage(conversations: DataFrame) -> DataFrame:
    """The stated damage by a check sum of conversation and turn; a conversation may lose all its rows."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    text = F.coalesce("text", F.lit(" "))
    damaged = conversations.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        kind.alias("kind"),
    )
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return damaged.where("kind != 0").withColumn("kind", F.explode(copies)).drop("kind")


def _said() -> Column:
    """A digest that is equal for rows of one conversation with equal role and text."""
    named = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    parts = [named, F.lit(":"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


ORDER = ("conv_id", "turn", "role", "said")  # nulls first


def row_codes(rows: DataFrame) -> DataFrame:
    """``(conv_id, part, codes, low, high, turns)``: a run of a conversation's rows in one range as bytes.

    ``turns`` counts distinct turns between ``low`` and ``high``; a run's first turn may be the last of the run before.
    """
    trimmed = F.rtrim("text", F.lit(SPACE))
    rows = rows.select(
        "conv_id",
        "turn",
        "role",
        _said().alias("said"),
        F.when(trimmed == "", BLANK)
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(FINE)
        .alias("fault"),
    )
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.groupBy("said").agg(F.min(turn).alias("first"))
    judged = rows.join(first, "said").select(
        *ORDER, "fault", (F.struct(F.col("turn").isNotNull(), "turn") > F.col("first")).alias("later")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, before = TaskContext.get().partitionId(), None, None
        names = ["conv_id", "part", "codes", "low", "high", "turns"]

        def closed(runs: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*runs, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            done = []
            for conv, turn, role, said, fault, later in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run is None or run[0] != conv:
                    if run is not None:
                        done.append(run)
                    run, before = [conv, part, bytearray(), None, None, 0], None
                if fault != BLANK and (later or before == (turn, said)):
                    fault = DUPLICATE
                place = ROLES.find(role[:1]) if role else -1
                run[2].append(4 * (3 if place < 0 else place) + fault)
                if turn is not None and run[4] != turn:
                    run[3:] = [turn if run[3] is None else run[3], turn, run[5] + 1]
                before = turn, said
            if done:
                yield closed([[*r[:2], bytes(r[2]), *r[3:]] for r in done])
        if run is not None:
            yield closed([[*run[:2], bytes(run[2]), *run[3:]]])

    kinds = "conv_id bigint, part int, codes binary, low bigint, high bigint, turns bigint"
    by = [F.col(c) for c in ORDER]
    return judged.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(write, kinds)


def _judge(runs: list[dict]) -> tuple:
    """``COUNTS`` and the audit of a conversation from its runs."""
    rows = b"".join(r["codes"] for r in runs)
    turns, low, high = 0, None, None
    for run in runs:
        if run["turns"]:
            turns += run["turns"] - (run["low"] == high)
            low, high = run["low"] if low is None else low, run["high"]
    faults = rows.translate(bytes(i & 3 for i in range(256)))
    initials = rows.translate(bytes(i >> 2 for i in range(256)))
    illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:], strict=False))
    cost, audit = edits(rows)
    gaps = high - low + 1 - turns if turns else 0
    return gaps, *(faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal, cost, audit


def audits(runs: DataFrame) -> DataFrame:
    """``(conv_id, *COUNTS, audit)`` of each conversation from ``row_codes``."""
    parts = F.array_sort(F.collect_list(F.struct("part", "codes", "low", "high", "turns")))
    whole = runs.groupBy("conv_id").agg(parts.alias("runs"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [*zip(*(_judge(r) for r in batch.column(1).to_pylist()), strict=True)] or [()] * (len(COUNTS) + 1)
            arrays = [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["conv_id", *COUNTS, "audit"])

    kinds = ", ".join(f"{c} bigint" for c in ("conv_id", *COUNTS))
    return whole.mapInArrow(judge, f"{kinds}, audit string")


class Repaired:
    """The rows that an audit leaves of a conversation, one after the other, as digest."""

    def __init__(self, audit: str):
        self.audit, self.place, self.state, self.digest, self.empty = audit, 0, START, hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def _turn(self, text: str) -> None:
        self.state = FOLLOWS[self.state]
        self._put("user" if self.state == USER else "assistant", text)

    def _inserted(self) -> None:
        while self.audit[self.place : self.place + 1] == "I":
            self.place += 1
            self._turn("")

    def row(self, role: str, text: str) -> None:
        self._inserted()
        letter = self.audit[self.place]
        self.place += 1
        if letter == "R":
            self._turn(text)
        elif letter == "K":
            self.state = KEEPS[ROLES.find(role[:1])][self.state]
            self._put(role, text)

    def end(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


def with_digests(judged: DataFrame, rows: DataFrame) -> DataFrame:
    """``judged`` with ``repaired_sha256``, the digest of ``role:text`` of the repaired rows joined by newlines."""
    carried = ("conv_id", *COUNTS, "audit")
    heads = judged.select(*carried, *(F.lit(None).cast(k).alias(c) for c, k in (("turn", "bigint"), ("role", "string"))))
    heads = heads.withColumns({"said": F.lit(None).cast("binary"), "text": F.lit(None).cast("string"), "body": F.lit(0)})
    bodies = rows.withColumns({"said": _said(), "body": F.lit(1)})
    both = heads.unionByName(bodies, allowMissingColumns=True).select(*carried, "turn", "said", "body", "role", "text")
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "body", "turn", "role", "said")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, repaired = None, None
        names = [*carried, "repaired_sha256"]
        kinds = [pa.int64()] * (1 + len(COUNTS)) + [pa.string()] * 2

        def written(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            done = []
            columns = [c.to_pylist() for c in batch.columns]
            body, role, text = columns[-3:]
            for i in range(batch.num_rows):
                if body[i]:
                    repaired.row(role[i], text[i])
                    continue
                if repaired is not None:
                    done.append((*head, repaired.end()))
                head = tuple(c[i] for c in columns[: len(carried)])
                repaired = Repaired(head[-1])
            if done:
                yield written(done)
        if repaired is not None:
            yield written([(*head, repaired.end())])

    numbers = ", ".join(f"{c} bigint" for c in carried[:-1])
    return ordered.mapInArrow(digest, f"{numbers}, audit string, repaired_sha256 string")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``(conv_id, *COUNTS, audit, repaired_sha256)`` of every conversation of ``rows (conv_id, turn, role, text)``.

    Those of ``conversations`` without a row in ``rows`` are listed too.
    """
    runs = row_codes(rows)
    if conversations is not None:
        nothing = {"codes": "binary", "low": "bigint", "high": "bigint"}
        ids = conversations.select(F.col("conv_id").cast("bigint")).distinct().withColumn("part", F.lit(-1))
        ids = ids.withColumns({c: F.lit(b"" if c == "codes" else None).cast(k) for c, k in nothing.items()})
        runs = runs.unionByName(ids.withColumn("turns", F.lit(0).cast("bigint")))
    return with_digests(stored(audits(runs), "repair-audits"), rows)
