"""Conversation repair, importance resampling and the quality classifier."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitrine.llm import importance, quality, queries, repair

ODD = [None, "", " ", "one", "a b", "ß İ é", "x " * 3000, "日本 語   z", "A-B_c 9é\x00 Ab", "a b a b " * 30, "one"]


# --- Conversation repair ------------------------------------------------------------------------------------------


def brute_force(rows: bytes):
    """The least (cost, audit) over all edits, by trying every letter at every row with up to two insertions before it."""
    best = {(0, 0): (0, "")}
    for at in range(len(rows) + 1):
        for _ in range(2):
            for state in range(4):
                if (at, state) in best:
                    cost, audit = best[at, state]
                    then = 3 if state == 2 else 2
                    best[at, then] = min(best.get((at, then), (math.inf, "")), (cost + 5, audit + "I"))
        if at == len(rows):
            break
        initial, fault = divmod(rows[at], 4)
        for state in range(4):
            if (at, state) not in best:
                continue
            cost, audit = best[at, state]
            options = [("D", 2, state)]
            if fault in (0, 3):
                options.append(("R", 1 + 5 * (fault == 3), 3 if state == 2 else 2))
                kept = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}.get((state, initial))
                if kept is not None:
                    options.append(("K", 5 * (fault == 3), kept))
            for letter, paid, then in options:
                best[at + 1, then] = min(best.get((at + 1, then), (math.inf, "")), (cost + paid, audit + letter))
    return min(best[len(rows), s] for s in (0, 3) if (len(rows), s) in best)


def test_edits_equal_brute_force():
    for size in range(4):
        for codes in itertools.product(range(16), repeat=size):
            assert repair.cheapest_edits(bytes(codes)) == brute_force(bytes(codes)), codes
    rng = random.Random(1)
    for _ in range(1500):
        codes = bytes(rng.choice([4, 8, 4, 8, 0, 12, 5, 7, 11, 9, 3, 10]) for _ in range(rng.randrange(4, 40)))
        assert repair.cheapest_edits(codes) == brute_force(codes), codes


def test_long_conversations_take_time_by_their_rows():
    rng = random.Random(2)
    codes = bytes(rng.choice([4, 8, 4, 8, 12, 5, 7, 11]) for _ in range(40_000))
    start = time.perf_counter()
    cost, audit = repair.cheapest_edits(codes)
    assert time.perf_counter() - start < 20
    assert sum(letter != "I" for letter in audit) == len(codes)
    assert (cost, audit) == brute_force_tail(codes)


def brute_force_tail(rows: bytes):
    """Cost by a forward pass, audit by walking the cheapest remainders in order of the letters."""
    rest = [[0, math.inf, math.inf, 0]]
    for state in (1, 2):
        rest[0][state] = 5 if state == 2 else 10
    for code in reversed(rows):
        initial, fault = divmod(code, 4)
        after, now = rest[-1], []
        for state in range(4):
            then, cost = (3 if state == 2 else 2), 2 + after[state]
            if fault in (0, 3):
                cost = min(cost, 1 + 5 * (fault == 3) + after[then])
                kept = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}.get((state, initial))
                if kept is not None:
                    cost = min(cost, 5 * (fault == 3) + after[kept])
            now.append(cost)
        for _ in range(2):
            now = [min(now[s], 5 + now[3 if s == 2 else 2]) for s in range(4)]
        rest.append(now)
    rest.reverse()
    at, state, letters = 0, 0, []
    while at < len(rows) or state in (1, 2):
        left, then = rest[at][state], 3 if state == 2 else 2
        initial, fault = divmod(rows[at], 4) if at < len(rows) else (3, 1)
        kept = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}.get((state, initial))
        extra = 5 * (fault == 3)
        if at < len(rows) and left == 2 + rest[at + 1][state]:
            letters.append("D")
            at += 1
        elif left == 5 + rest[at][then]:
            letters.append("I")
            state = then
        elif kept is not None and fault in (0, 3) and left == extra + rest[at + 1][kept]:
            letters.append("K")
            at, state = at + 1, kept
        else:
            letters.append("R")
            at, state = at + 1, then
    return rest[0][0], "".join(letters)


def talk(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_repair_of_odd_rows(spark):
    rows = [
        (1, 0, "system", "S."),
        (1, 1, "user", "Q?"),
        (1, 2, "assistant", "A."),
        (1, 2, "assistant", "A."),  # repeated, same turn
        (1, 7, "user", "Q?"),  # seen earlier
        (2, None, None, None),  # one space: blank, no role
        (2, 3, "user", "hello! \n"),
        (2, 4, "user", "more."),
        (3, 0, "assistant", "cut"),
        (None, 0, "user", "x" * 200_000 + "."),
        (None, 1, "assistant", "y."),
    ]
    odd = talk(spark, rows).withColumn("audit", F.lit("clash")).withColumn("text2", F.lit(1))
    odd = odd.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    ids = talk(spark, [(9, 0, "user", "gone"), *rows])
    found = {r["conv_id"]: r for r in repair.repair(odd, ids).collect()}
    sha = lambda *said: hashlib.sha256("\n".join(said).encode()).hexdigest()
    assert sorted(found, key=str) == [1, 2, 3, 9, None]
    one = found[1]
    assert [one[c] for c in repair.COUNTS] == [4, 0, 2, 0, 1, 4] and one["audit"] == "KKKDD"
    assert one["repaired_sha256"] == sha("system:S.", "user:Q?", "assistant:A.")
    two = found[2]
    assert [two[c] for c in repair.COUNTS] == [0, 1, 0, 0, 2, 3] and two["audit"] == "DKR"
    assert two["repaired_sha256"] == sha("user:hello! \n", "assistant:more.")
    assert [found[3][c] for c in repair.COUNTS] == [0, 0, 0, 1, 0, 2] and found[3]["repaired_sha256"] == sha()
    assert found[None]["cost"] == 0 and found[None]["audit"] == "KK"
    assert [found[9][c] for c in repair.COUNTS] == [0] * 6 and found[9]["repaired_sha256"] == sha()


def test_damage(spark):
    rows = [(c, t, None if t == 1 else "assistant", None if t == 2 else f"Text {t}. Yes!") for c in range(40) for t in range(5)]
    found = Counter(map(tuple, repair.damage(talk(spark, rows)).collect()))
    wanted = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        role, text = role or " ", " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            wanted[c, t, "user" if kind == 4 else role, text] += 2 if kind == 3 else 1
    assert found == wanted


def test_a_conversation_over_many_ranges(spark):
    """A third of all rows in one conversation, sorted by several tasks, as one task would have it."""
    rng = random.Random(4)
    rows = [(0 if i % 3 else i, i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", " ", f"{i}!"])) for i in range(900)]
    rows += rows[:40]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r["conv_id"]: r for r in repair.repair(talk(spark, rows)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for conv in (0, 3, 6):
        own = [r for r in rows if r[0] == conv]
        said = lambda r: hashlib.sha256(f"{r[0]}:{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
        own.sort(key=lambda r: (r[1], r[2], said(r)))
        seen, codes = set(), bytearray()
        for _, _, role, text in own:
            fault = 1 if not text.strip() else 2 if (role, text) in seen else 0 if text[-1] in ".!?" else 3
            seen.add((role, text))
            codes.append(4 * "sua".index(role[0]) + fault)
        cost, audit = brute_force_tail(bytes(codes))
        assert (found[conv]["cost"], found[conv]["audit"]) == (cost, audit)
        assert found[conv]["duplicate"] == sum(c % 4 == 2 for c in codes)
        turns = {r[1] for r in own}
        assert found[conv]["gaps"] == max(turns) - min(turns) + 1 - len(turns)


def test_repair_of_nothing(spark):
    none = talk(spark, [])
    assert repair.repair(repair.damage(none), none).collect() == []


# --- Importance resampling ----------------------------------------------------------------------------------------


def features_of(text, longest):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def by_hand(rows, target, setting):
    bucket = lambda feature: zlib.crc32(feature.encode()) % setting.buckets
    source, wanted = Counter(), Counter()
    for _, text in rows:
        source.update(map(bucket, features_of(text, setting.longest)[1]))
    for text in target:
        wanted.update(map(bucket, features_of(text, setting.longest)[1]))
    s, t, b = sum(source.values()), sum(wanted.values()), setting.buckets
    gain = lambda k: math.floor(1000 * math.log((wanted[k] + 1) * (s + b) / ((source[k] + 1) * (t + b))))
    found = []
    for i, text in rows:
        words, features = features_of(text, setting.longest)
        weight = sum(gain(bucket(f)) for f in features)
        h = int(hashlib.sha256(f"{setting.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([i, len(features), weight, score, len(words) >= setting.min_words])
    able = sorted((r for r in found if r[4]), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1]))
    places = {id(r): k for k, r in enumerate(able[: setting.percent * len(able) // 100], 1)}
    return sorted(((*r[:4], places.get(id(r))) for r in found), key=repr)


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_resampling_equals_counting_by_hand(spark, longest):
    rng = random.Random(longest)
    texts = ODD + [" ".join(rng.choice("The an Of to é b1 _ zu".split()) for _ in range(rng.randrange(60))) for _ in range(80)]
    rows = [(None if i == 3 else i % 60, t) for i, t in enumerate(texts)]
    setting = importance.Setting(longest=longest, buckets=50, min_words=5, percent=40)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df = df.withColumns({c: F.lit(7) for c in ("score", "rank", "n_words", "bucket", "__range")})
    target = spark.createDataFrame([(0, "an an é b1"), (1, None), (2, "")], "item_id bigint, text string")
    found = sorted((tuple(r) for r in importance.resample(df, target, setting).collect()), key=repr)
    assert found == by_hand(rows, ["an an é b1", None, ""], setting)


def test_slices_change_nothing(monkeypatch):
    texts = pa.array(ODD * 3)
    setting = importance.Setting(longest=2)
    whole = importance.hashed_ngrams(texts, setting)[0]
    for limit in (1, 10, 7000):
        parts = [importance.hashed_ngrams(p, setting)[0] for _, p in importance.slices(texts, limit)]
        assert np.concatenate(parts).tolist() == whole.tolist()


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert importance.resample(none, some).collect() == []
    assert [r["rank"] for r in importance.resample(some, none).collect()] == [None]


# --- Quality ------------------------------------------------------------------------------------------------------


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = queries.op13_quality_classifier(spark, folder).join(labels, "doc_id").where("held_out").collect()
    for kind in (0, 1):
        own = [r["predicted"] == kind for r in rows if r["quality"] == kind]
        assert sum(own) >= 0.97 * len(own)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_statistics_do_not_depend_on_the_other_texts():
    whole = quality.statistics(pa.array(ODD))
    assert np.isfinite(whole).all()
    for i, text in enumerate(ODD):
        np.testing.assert_allclose(quality.statistics(pa.array([text], pa.string()))[0], whole[i])


def test_the_discriminant_equals_the_densities():
    rng = np.random.default_rng(0)
    size = len(quality.STATISTICS)
    data = [rng.normal(k, 1 + k, (200 + 100 * k, size)) for k in (0, 1)]
    model = quality.fit({k: (len(x), x.sum(axis=0), x.T @ x) for k, x in enumerate(data)}, shrinkage=0.2)
    spread = np.diag(np.concatenate(data).var(axis=0))
    points, logs = rng.normal(0.5, 2, (50, size)), []
    for x in data:
        cov = 0.8 * np.cov(x.T, bias=True) + 0.2 * spread
        away = points - x.mean(axis=0)
        distance = (away @ np.linalg.inv(cov) * away).sum(axis=1)
        logs.append(np.log(len(x) / 500) - 0.5 * (np.linalg.slogdet(cov)[1] + distance))
    np.testing.assert_allclose(model.score(points), 1 / (1 + np.exp(logs[0] - logs[1])), rtol=1e-8)


def test_quality_of_odd_tables(spark):
    df = spark.createDataFrame([*enumerate(ODD), (None, "no id"), (4, "again")], "doc_id bigint, text string")
    df = df.withColumns({"vector": F.lit(1), "quality": F.lit(0), "score": F.lit("x")})
    marks = "doc_id bigint, quality int"
    both = spark.createDataFrame([(3, 1), (4, 1), (5, 0), (6, 0), (6, None), (None, 1), (7, 5), (99, 0)], marks)
    rows = quality.classify(df, both).collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r["score"] <= 1 for r in rows)
    scores = {}
    for r in rows:
        scores.setdefault(r["doc_id"], set()).add(round(r["score"], 9))
    assert scores[0] == scores[1] and scores[3] == scores[10]  # null as empty; equal texts
    for labels, share in ([(3, 1)], 1.0), ([(5, 0)], 0.0), ([], 0.5):
        given = spark.createDataFrame(labels, marks)
        assert {r["score"] for r in quality.classify(df, given).collect()} == {share}
    assert quality.classify(df.limit(0), both).collect() == []
