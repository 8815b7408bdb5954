"""Packing, near duplicates, URL filters, nearest neighbours, chat formatting and the pipeline."""

import bisect
import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from vitrine.llm import (
    chat,
    components,
    jaccard_join,
    neighbours,
    packing,
    queries,
    shingles,
    sql,
    url_filter,
)

WORD_BPE = public_tokenizers.path(queries.WORD_BPE)


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@pytest.mark.parametrize("name", sql.SQL)
def test_sql_twins(spark, small, name):
    assert compare(spark, connect(small), small, name, queries.QUERIES[name], sql.SQL[name]) is None


# --- packing --------------------------------------------------------------------------------------------------------


def best_fit_decreasing(lengths, capacity):
    gaps, count = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        if at == len(gaps):
            count, gap = count + 1, capacity - length
        else:
            gap = gaps.pop(at) - length
        bisect.insort(gaps, gap)
    return count


def check_packing(rows, capacity):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


@pytest.mark.parametrize("kind", ["mixed", "small", "equal", "halves"])
def test_packing_is_gapless_and_tight(spark, kind):
    rng = random.Random(kind)
    lengths = {
        "mixed": [min(100, int(rng.lognormvariate(3, 1)) + 1) for _ in range(600)],
        "small": [rng.choice([1, 1, 1, 2, 3]) for _ in range(700)] + [90, 95],
        "equal": [34] * 301,
        "halves": [rng.randint(45, 55) for _ in range(200)],
    }[kind]
    items = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "id bigint, length int, offset string")
    rows = packing.pack(items, ["id"], 100).collect()
    assert sorted(r.id for r in rows) == list(range(len(lengths)))
    assert check_packing(rows, 100) <= 1.02 * best_fit_decreasing(lengths, 100) + 1


def test_no_more_sequences_are_opened_than_needed():
    for sequences in (0, 4000, 10**6):
        rows = packing._opened({10: [0, 5], 3: [0, 4]}, sequences, 100)
        assert sum(-(-count // per) for _, _, count, per, _, _ in rows) == 1


def test_packing_of_many_sequences(spark):
    rng = random.Random(7)
    lengths = [min(100, int(rng.lognormvariate(3, 1)) + 1) for _ in range(12_000)]
    placed = packing.plan(spark, collections.Counter(lengths), 100)
    sequences = {s + i for _, _, count, per, s, _ in placed for i in range(-(-count // per))}
    assert sum(p[2] for p in placed) == len(lengths) and sequences == set(range(len(sequences)))
    assert 2000 < len(sequences) <= 1.01 * -(-sum(lengths) // 100)


def test_packing_edges(spark):
    empty = spark.createDataFrame([], "id bigint, length int")
    assert packing.pack(empty, ["id"]).count() == 0
    twice = spark.createDataFrame([(1, 3), (1, 3), (None, 5)], "id bigint, length int")
    assert check_packing(packing.pack(twice, ["id"]).collect(), 2048) == 1
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0)], "id bigint, length int"), ["id"])


def test_pieces_of_documents(spark):
    texts = [None, "", "one two", "word " * 5000, "one two"]
    rows = packing.pack_documents(docs(spark, texts), WORD_BPE).collect()
    check_packing(rows, 2048)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = set()
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want.add((i, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want


def test_few_texts_reach_a_packing_worker_at_once(spark, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    stored = packing.stored

    def watched(df, label):
        seen.append(int(spark.conf.get(key)))
        return stored(df, label)

    monkeypatch.setattr(packing, "stored", watched)
    before = spark.conf.get(key)
    rows = packing.pack_documents(docs(spark, ["one two"] * 2500), WORD_BPE).collect()
    assert len(rows) == 2500 and max(seen) <= 1000 and spark.conf.get(key) == before


# --- near duplicates --------------------------------------------------------------------------------------------------


def word_shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(texts):
    sets = [word_shingles(t) for t in texts]
    label = list(range(len(texts)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {i: (len(sets[i]), find(i)) for i in range(len(sets))}


def edited(rng, words, share):
    return [rng.choice("uvwxyz") + str(rng.randint(0, 99)) if rng.random() < share else w for w in words]


def corpus(seed):
    """Unrelated texts with shared passages, families of near copies of every closeness, copies and odd texts."""
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcdefg')}{rng.randint(0, 500)}"
    passage = [word() for _ in range(60)]
    texts = [" ".join([word() for _ in range(rng.randint(20, 80))] + passage) for _ in range(60)]
    for _ in range(6):
        base = [word() for _ in range(rng.randint(30, 200))]
        texts += [" ".join(edited(rng, base, rng.choice([0, 0.005, 0.02, 0.04, 0.06]))) for _ in range(25)]
    base = [word() for _ in range(100)]
    texts += [" ".join(base[i : i + 60]) for i in range(0, 40, 2)]  # a chain: only neighbours are similar
    texts += [None, "", " \t\n", "a b", "A  B", "a b c", "x y z w", "\x1c a b c d e"] * 2
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    texts = corpus(seed)
    rows = jaccard_join.near_duplicates(docs(spark, texts).withColumn("key", F.lit("clash"))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts)
    assert len(rows) == len(texts)


def test_a_family_costs_few_pairs_a_member(spark, monkeypatch):
    """Members of a family are similar to some of the others, seldom to the leader: far fewer pairs than links are tried."""
    tried, cross_pairs = [], jaccard_join.cross_pairs
    monkeypatch.setattr(jaccard_join, "cross_pairs", lambda *a: tried.append(p := jaccard_join.stored(cross_pairs(*a), "t")) or p)
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(150)]
    texts = [" ".join(edited(rng, base, rng.choice([0.01, 0.02, 0.03]))) for _ in range(400)]
    rows = jaccard_join.near_duplicates(docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts)
    assert sum(p.count() for p in tried) < 20 * len(texts) < sum(r.n_links for r in rows) / 2


@pytest.mark.parametrize("members", [7, 1024])
def test_links_are_counted_in_full(spark, members, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MEMBERS", members)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 50)
    texts = corpus(3)
    sets = [frozenset(word_shingles(t)) for t in texts]
    want = {}
    for own in set(sets):
        similar = [o for o in set(sets) if o != own and 175 * len(o & own) >= 75 * (len(o) + len(own)) and o & own]
        want[own] = len(similar)
    rows = jaccard_join.near_duplicates(docs(spark, texts)).collect()
    assert {r.doc_id: r.n_links for r in rows} == {i: want[s] for i, s in enumerate(sets)}
    assert max(want.values()) > 5


def test_given_documents(spark, small):
    rows = queries.op3_jaccard_join(spark, small).collect()
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts)


def test_near_duplicate_edges(spark):
    assert jaccard_join.near_duplicates(docs(spark, [])).count() == 0
    rows = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c"), (4, None)], "doc_id bigint, text string")
    got = sorted((r.doc_id or -1, r.component_id) for r in jaccard_join.near_duplicates(rows).collect())
    assert got == [(-1, 3), (3, 3), (3, 3), (4, 4)]


def test_tree_search_loses_nothing():
    rng = np.random.default_rng(3)
    points = rng.poisson(3, (200, jaccard_join.GROUPS)).astype(np.uint8)
    points[50:] = np.maximum(points[rng.integers(0, 50, 150)].astype(int) + rng.integers(-1, 2, (150, jaccard_join.GROUPS)), 0)
    sizes = points.sum(1).astype(np.int64)
    tree = jaccard_join.CountTree(points, sizes)
    q, at = tree.search(points, sizes)
    bound = np.minimum(points[:, None], points[None]).sum(2)
    want = {(i, j) for i, j in zip(*np.nonzero(175 * bound >= 75 * (sizes[:, None] + sizes[None])), strict=True)}
    assert set(zip(q.tolist(), at.tolist(), strict=True)) == {(int(i), int(j)) for i, j in want}


def test_near_copies_of_very_long_documents(spark):
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(100_000)]
    copy = list(base)
    for at in range(0, len(copy), 2000):
        copy[at] = "changed"
    other = [f"v{rng.randint(0, 10**6)}" for _ in range(100_000)]
    rows = jaccard_join.near_duplicates(docs(spark, [" ".join(t) for t in (base, copy, other)])).collect()
    assert {r.doc_id: r.component_id for r in rows} == {0: 0, 1: 0, 2: 2}


@pytest.mark.parametrize("groups", [jaccard_join.GROUPS, jaccard_join.FINE_GROUPS])
def test_bounds_of_very_large_sets(spark, groups):
    rng = np.random.default_rng(5)
    near = rng.integers(0, 2**63, 400_000).astype(np.uint64)
    sets = [np.unique(near), np.unique(near[1000:]), np.unique(near[:400]), np.unique(near[:350])]
    counts = [jaccard_join.count_vector(s, groups) for s in sets]
    pairs = [(a, b, len(sets[a]), len(sets[b]), counts[a], counts[b]) for a in range(4) for b in range(a)]
    kind = "a bigint, b bigint, n_a bigint, n_b bigint, counts_a binary, counts_b binary"
    kept = jaccard_join.bounded(spark.createDataFrame(pairs, kind), groups).collect()
    assert {(r.a, r.b) for r in kept} == {(1, 0), (3, 2)}
    sizes = np.array([len(s) for s in sets], np.int64)
    if groups == jaccard_join.GROUPS:
        points = jaccard_join._vectors(counts)
        q, at = jaccard_join.CountTree(points, sizes).search(points, sizes)
        assert {(0, 1), (1, 0), (2, 3), (3, 2)} <= set(zip(q.tolist(), at.tolist(), strict=True))


def test_shingle_hashes():
    a, b, c = shingles.shingle_sets([b"A b  c\td e f", b"a b c d e f", b"b c d e f"])
    assert a.tolist() == b.tolist() and len(a) == 2 and set(c.tolist()) < set(a.tolist())


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 140)] + [(5, 5)] + [(200, i) for i in range(201, 260)]
    links += [(rng.randint(300, 330), rng.randint(300, 330)) for _ in range(25)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.label for r in components.components(frame).collect()}
    label = {n: n for pair in links for n in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    assert got == {n: v for n, v in label.items() if n != 5}
    assert components.components(frame.limit(0)).count() == 0


# --- URLs -------------------------------------------------------------------------------------------------------------


def test_url_parts_and_rules(spark):
    urls = {
        "https://WWW.Example.com/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://a.example.com/en": ("a.example.com", "/en", "com/", "allow"),
        "http://net/es/x://y": ("net", "/es/x://y", "net/es/", "block"),
        "x://internet/es/": ("internet", "/es/", None, "allow"),
        "http://com": ("com", "", None, "allow"),
        "ftp://b.net?/fr/": ("b.net", "", None, "allow"),
        "no url": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    rows = [(i, u) for i, u in enumerate([*urls, None])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in url_filter.filter_urls(pages, queries.URL_RULES).collect()}
    for i, want in enumerate([*urls.values(), ("", "", None, "allow")]):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want
    assert url_filter.filter_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_templates_learn_from_labels(spark):
    rows = [("h", f"/bad/{i}", 1) for i in range(30)] + [("h", f"/good/{i}", 0) for i in range(30)]
    rows += [("h", f"/user/name{chr(97 + i % 26)}{i}x/p", None) for i in range(40)]
    rows += [("h", f"/bad/{i}.html", None) for i in range(5)] + [("g", "/new/1", None)]
    frame = spark.createDataFrame(rows, "host string, path string, label int").withColumn(
        "segments", url_filter.segments_of(F.col("path"))
    )
    judged = url_filter.judge_templates(url_filter.template_stats(frame))
    got = {(r.host, "/".join(r.segments)): r for r in judged.collect()}
    assert got["h", "bad/*"].method_verdict == "block" and got["h", "good/*"].method_verdict == "allow"
    assert got["g", "new/*"].method_verdict == "allow"
    names = {r.template for key, r in got.items() if key[1].startswith("user/")}
    assert names == {"user/*/p"}


def test_hosts_without_a_rule_are_judged_by_their_templates(spark):
    rows = [(f"http://{h}.net/es/{i}", 0) for h in "abc" for i in range(12)]  # blocked by a rule
    rows += [(f"http://{h}.org/{lang}/{i}", 0) for h in "xy" for lang in ("es", "it") for i in range(5)]
    rows += [(f"http://d.com/ok/{i}", 0) for i in range(30)] + [("http://z.org/ok/7", 0), ("http://a.net/new/7", 0)]
    deep = "/".join(f"s{chr(97 + i % 26)}" for i in range(1500))
    rows += [(f"http://x.org/{deep}", 0), (f"http://d.com/{deep}/end.html", 0), (f"http://{'h' * 50_000}.org/{'p' * 200_000}", 0)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id bigint, url string")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, queries.URL_RULES).collect()}
    verdicts = {u: (got[i].rule, got[i].template, got[i].verdict) for i, (u, _) in enumerate(rows)}
    assert verdicts["http://x.org/es/1"] == (None, "es/*", "block")  # as the template elsewhere
    assert verdicts["http://x.org/it/1"][2] == verdicts["http://z.org/ok/7"][2] == "allow"
    assert verdicts["http://a.net/new/7"] == (None, "new/*", "block")  # as the rest of its host
    assert verdicts[f"http://x.org/{deep}"][1] == deep and verdicts[f"http://d.com/{deep}/end.html"][1] == deep + "/end.html"
    again = url_filter.filter_urls(pages.unionByName(pages.where("page_id = 0")), queries.URL_RULES)
    assert again.where("page_id = 0").count() == 2


# --- neighbours ---------------------------------------------------------------------------------------------------------


def test_recall_and_scores(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((1500, 16))
    x[900:1400] = x[7]  # a third are copies
    ids = rng.permutation(3000)[:1500]
    rows = [(int(i), [float(v) for v in row], "c") for i, row in zip(ids, x, strict=True)]
    rows += [(5001, None, "c"), (5050, [0.0] * 16, "c"), (5100, [float("nan")] + [1.0] * 15, "c"), (5150, [1.0, None] * 8, "c"), (5200, [], "c")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, vector string")
    got = collections.defaultdict(list)
    for r in neighbours.search(frame, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.id, r.score))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = wanted = 0
    for at in np.flatnonzero(ids % 50 == 0):
        scores = unit @ unit[at]
        order = sorted((i for i in range(1500) if i != at), key=lambda i: (-round(scores[i], 12), ids[i]))[:5]
        mine = got.pop(int(ids[at]))
        assert len(mine) == 5
        hits += len({ids[i] for i in order} & {i for i, _ in mine})
        wanted += 5
        by_id = {int(ids[i]): scores[i] for i in range(1500)}
        assert all(abs(by_id[i] - s) < 1e-12 for i, s in mine)
    assert not got and hits >= 0.9 * wanted


def test_cluster_of_near_copies(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal(64) + 0.01 * rng.standard_normal((1500, 64))
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(set)
    for r in neighbours.search(frame, F.col("id") % 50 == 0, k=20).collect():
        got[r.query_id].add(r.id)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for at in range(0, 1500, 50):
        far = np.square(unit - unit[at]).sum(1)
        assert len(got[at]) == 20
        hits += len(got[at] & set(np.argsort(far)[1:21].tolist()))
    assert hits >= 0.9 * 20 * 30


def test_walk_is_widened_until_recall(spark):
    rng = np.random.default_rng(4)
    rows = [(i, row.tolist()) for i, row in enumerate(rng.standard_normal((1200, 32)))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    nodes, _ = neighbours.nodes_of(neighbours.valid_vectors(frame), 6)
    graph = neighbours.stored(neighbours.build_graph(nodes, 8), "test-graph")
    starts = nodes.where("node % 50 = 0").select(F.col("node").alias("query"), "node")
    truth = neighbours.sampled_truth(nodes, starts, 5)
    assert neighbours.recall(neighbours.walk(graph, nodes, starts, 8), truth) < neighbours.RECALL
    assert neighbours.recall(neighbours.walked(graph, nodes, starts, 5, 8), truth) >= neighbours.RECALL


def joined_rows(df):
    """The rows that the joins of ``df`` made when it was collected."""
    rows, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        else:
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
        if kind.endswith("JoinExec"):
            rows += plan.metrics().get("numOutputRows").get().value()
    return rows


def test_introductions_join_as_many_rows_in_any_number_of_parts(spark):
    rng = np.random.default_rng(8)
    rows = [(i, row.tolist()) for i, row in enumerate(rng.standard_normal((400, 16)))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    nodes, _ = neighbours.nodes_of(neighbours.valid_vectors(frame), 6)
    edges = neighbours.stored(neighbours.first_graph(nodes, 400, 6), "test-graph")
    met, found = {}, {}
    for parts in (1, 10):
        new = neighbours.introduce(edges, nodes, 6, parts)
        pairs = {(r.node, r.neighbour): r.near for r in new.collect()}
        met[parts], found[parts] = joined_rows(new), pairs
    assert 400 < met[1] == met[10] <= 400 * (2 * 6 + 1)
    # Ten parts list the best of each part: those of all are among them.
    assert found[1] and found[1].keys() <= found[10].keys()
    assert all(abs(near - found[10][pair]) < 1e-5 for pair, near in found[1].items())


def test_introductions_bring_few_entries(spark):
    rng = np.random.default_rng(12)
    rows = [(i, row.tolist()) for i, row in enumerate(rng.standard_normal((2000, 16)))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    nodes, _ = neighbours.nodes_of(neighbours.valid_vectors(frame), 6)
    edges = neighbours.stored(neighbours.first_graph(nodes, 2000, 8), "test-graph")
    # Nodes compared with their whole groups have lists that few of those who meet get into, in any number of parts.
    assert 0 < neighbours.introduce(edges, nodes, 8, 40).count() <= 20 * 2000


def test_wider_walk_goes_on(spark):
    rng = np.random.default_rng(6)
    rows = [(i, row.tolist()) for i, row in enumerate(rng.standard_normal((900, 24)))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    nodes, _ = neighbours.nodes_of(neighbours.valid_vectors(frame), 6)
    ways = neighbours.graph_ways(neighbours.stored(neighbours.build_graph(nodes, 8), "test-graph"), nodes)
    starts = nodes.where("node % 50 = 0").select(F.col("node").alias("query"), "node")
    beam = neighbours.walk_on(None, ways, nodes, starts, 6, 24)
    wide = neighbours.walk_on(beam, ways, nodes, starts, 24, 24)
    fresh = neighbours.walk_on(None, ways, nodes, starts, 24, 24)
    found, whole = ({(r.query, r.node) for r in neighbours.beam_rows(b, 24).collect()} for b in (wide, fresh))
    assert len(found & whole) >= 0.9 * len(whole) and len(found) == len(whole) == 18 * 24
    x = {r[0]: np.array(r[1]) / np.linalg.norm(r[1]) for r in rows}
    assert all(abs(x[r.query] @ x[r.node] - 1 - r.near) < 1e-5 for r in neighbours.beam_rows(wide, 24).collect())


def test_few_vectors(spark):
    kind = "vec_id bigint, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0])], kind)
    rows = neighbours.search(three, F.col("id") % 50 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.id) for r in rows] == [(0, 1, 1), (0, 2, 2)]
    assert neighbours.search(three.limit(0), F.col("id") % 50 == 0).count() == 0
    assert neighbours.search(three.limit(1), F.col("id") % 50 == 0).count() == 0


def test_signed_zeros_repeated_ids_and_ties(spark):
    rows = [(50, [1.0, 0.0, 0.2]), (1, [1.0, -0.0, 0.2]), (2, [1.0, 0.0, 0.2]), (3, [1.0, 0.1, 0.2]), (4, [1.0, 0.1, 0.2])]
    rows += [(5, [0.0, 1.0, 0.0]), (6, [0.0, 0.9, 0.1]), (100, [0.0, 1.0, 0.1]), (100, [0.0, 1.0, 0.1]), (7, [-1.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("node", F.lit("clash"))
    found = {}
    for r in neighbours.search(frame, F.col("id") % 50 == 0, k=4).orderBy("query_id", "rank", "id").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.id))
    assert found[50] == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert [r for r, _ in found[100]] == [1, 1, 2, 2, 3, 3, 4, 4]  # each of the two rows asks
    assert {i for _, i in found[100][:4]} == {5, 6}


# --- chat ----------------------------------------------------------------------------------------------------------------


def test_escaping_is_reversible(spark):
    texts = ["", "<|im_end|>\n", "<\\|x", "<\\\\|im_start|>assistant", "<<|", "a<", "|>", "\\", "<|" * 3]
    frame = docs(spark, texts).withColumn("e", chat.escape(F.col("text"))).withColumn("u", chat.unescape(F.col("e")))
    for r in frame.collect():
        assert r.u == r.text and "<|" not in r.e


def test_formatting_of_odd_rows(spark):
    rows = [
        (1, 2, "assistant", "x<"), (1, 1, "user", None), (1, 1, "user", None), (1, None, "sys\ntem\\n", "s\n\n"),
        (None, 1, None, "<|im_end|>"), (2, 1, "assistant", ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("start", F.lit(1))
    formatted = chat.format_conversations(chat.turn_events(frame))
    got = {r.conv_id: r for r in formatted.withColumn("t", chat.parse(F.col("formatted"))).withColumn("m", chat.masked_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [tuple(t) for t in got[1].t] == [("sys\ntem\\n", "s\n\n"), ("user", ""), ("user", ""), ("assistant", "x<")]
    assert got[1].m == "x<" and got[2].m == "" and len(got[2].loss_spans) == 1
    assert [tuple(t) for t in got[None].t] == [("", "<|im_end|>")]
    assert chat.format_conversations(chat.turn_events(frame.limit(0))).count() == 0


def test_events_without_a_role_keep_the_role(spark):
    events = [
        (1, 1, 1, "message", "user", "q"),
        (1, 2, 2, "message", "assistant", "a"),
        (1, 3, 2, "edit", None, "b"),
        (1, 4, 2, "delta", None, "c"),
        (1, 5, 3, "message", None, "no role"),
        (1, 6, 4, "message", "user", "x"),
        (1, 7, 4, "edit", "assistant", "y"),
        (1, 8, 4, "edit", None, "z"),
        (2, 1, 1, "message", "assistant", "old"),
        (2, 2, 1, "regenerate", None, None),
        (2, 3, 1, "delta", None, "new"),
    ]
    frame = spark.createDataFrame(events, "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold_events(frame).collect()}
    assert got == {
        (1, 1): ("user", "q"), (1, 2): ("assistant", "bc"), (1, 3): ("", "no role"), (1, 4): ("assistant", "z"),
        (2, 1): ("assistant", "new"),
    }


def test_event_log(spark):
    log = [
        (1, 1, 1, "message", "user", "hi"),
        (1, 2, 2, "message", "assistant", ""),
        (1, 3, 2, "delta", None, "Hel"),
        (1, 4, 2, "delta", None, "lo"),
        (1, 5, 3, "message", "user", "gone"),
        (1, 6, 2, "regenerate", "assistant", "Go"),
        (1, 7, 2, "delta", None, "od"),
        (1, 8, 3, "message", "user", "more"),
        (1, 9, 1, "edit", "user", "hey"),
        (2, 1, 1, "delta", "assistant", "a"),
        (2, 2, 1, "delta", "assistant", "b"),
    ]
    frame = spark.createDataFrame(log, "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold_events(frame).collect()}
    assert got == {(1, 1): ("user", "hey"), (1, 2): ("assistant", "Good"), (1, 3): ("user", "more"), (2, 1): ("assistant", "ab")}


# --- pipeline --------------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, small):
    given = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    odd = [
        (9001, None, "en", None, None), (9002, "", "en", "s", 0), (None, "no id here", None, None, 10),
        (9003, "the same short text of six words", "en", "s", 1), (9004, "the same short text of six words", "en", "s", 1),
        (9003, "the same short text of six words", "en", "s", 1), (9005, "idiot moron scum idiot", "en", "s", 22),
        (9006, "my password=abcdefgh12 x", "en", "s", 24),
    ]
    docs = given.unionByName(spark.createDataFrame(odd, given.schema))
    for name in ("score", "secrets", "row", "ids", "key"):
        docs = docs.withColumn(name, F.lit(name))
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, kept, small), f"test-{name}")
        assert kept.columns == columns
    rows = {r.doc_id: r for r in kept.collect()}
    assert {None, 9001, 9002, 9003, 9006} <= set(rows) and not {9004, 9005} & set(rows)
    assert kept.where("doc_id = 9003").count() == 1
    assert rows[9006].text == "my [secret] x" and rows[9006].n_chars == 13 and rows[9006].score == "score"
    packed = corpus_pipeline.pack_tokens(spark, kept, small).collect()
    assert {r.doc_id for r in packed} == set(rows)
    check_packing(packed, 2048)


def test_repeated_ids_of_other_texts(spark, small):
    word = lambda name: " ".join(f"{name}{i}" for i in range(60))
    rows = [(3, word("y")), (5, word("x")), (5, word("y") + " z"), (9, word("x") + " z"), (5, word("v")), (5, word("v") + " z")]
    rows += [(5, None), (5, None), (None, word("x"))]
    kept = corpus_pipeline.keep_one_of_near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), small)
    got = collections.Counter((r.doc_id, (r.text or "-")[0]) for r in kept.collect())
    assert got == {(3, "y"): 1, (5, "x"): 1, (5, "v"): 1, (5, "-"): 1, (None, "x"): 1}


def test_pipeline_of_nothing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, small), f"none-{name}")
    assert docs.count() == 0


