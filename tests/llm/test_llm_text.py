"""HTML extraction, fingerprints, toxicity, BPE and secret scans."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitrine.llm import bpe, fingerprints, html_text, queries, secret_scan, toxicity

WORD_BPE = public_tokenizers.path(queries.WORD_BPE)
ODD = [None, "", " ", "one", "a b", "ß İ é", "x " * 3000, "日本 語   z", "it's <|endoftext|>x 123", "a\x1cb c d"]


def docs(spark, texts, extra=""):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


# --- HTML ---------------------------------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title><script>if (a < b) document.write("<p>no</p>")</script></head><body>
<header>top</header><nav><ul><li><a href=x>menu</a></ul></nav><div class="cookie-notice">We use cookies on this site, really.</div>
<div><h1>Head line</h1><p>First &amp; long   paragraph with <b>bold</b> and <a href=y>a link</a> inside it, of some length.
<p>Second<br>paragraph, also with quite some text in it to be the main part &#8212; yes.</p></div>
<aside>side bar text that is long enough to look like an article but isn't one at all</aside>
<form>name <input name=q></form><div id="comments"><p>A reader says something long about this article here.</div>
<footer>&copy; bottom</footer></body></html>"""


def test_main_text_of_an_unmarked_page():
    assert html_text.main_text(PAGE) == (
        "Head line\nFirst & long paragraph with bold and a link inside it, of some length.\n"
        "Second paragraph, also with quite some text in it to be the main part — yes."
    )


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<article>", ""),
        ("no markup at all", "no markup at all"),
        ("<article><h1>A</h1><p>b", "A\nb"),
        ("<p>out</p><main><p>x</p><div class=ad>buy</div><p>y &lt;z&gt;</main>", "x\ny <z>"),
        ("<article><p>1 < 2 and <b>3</article>", "1 < 2 and 3"),
        ("<article><!-- <p>no</p> --><p>a\n\t b</p><ul><li><a href=1>l</a></ul><p>c", "a b\nc"),
        ("<article><p>cut off <a href='x", "cut off"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LONG = "".join(f"<p>Paragraph {i} of the main text, which goes on for quite a while.</p>" for i in range(12))
LONG_TEXT = "\n".join(f"Paragraph {i} of the main text, which goes on for quite a while." for i in range(12))


def test_marks_are_weighed_against_other_text():
    text = "\n".join(f"Paragraph {i} of the main text, which goes on for quite a while." for i in range(12))
    teaser = "<article><h2>Teaser</h2><p>One more story you may like.</p></article>"
    assert html_text.main_text(f"<div>{LONG}</div>{teaser}") == text
    middle = LONG.replace("<p>Paragraph 6", f"{teaser}<p>Paragraph 6")
    assert html_text.main_text(f"<div>{middle}</div>") == text
    assert html_text.main_text(f"<div><p>Some unrelated line of text, not short at all, outside.</p></div><main>{LONG}</main>") == text


def test_link_lists_inside_the_text():
    item = "<li>Smith: <a href=x>A very long title of a work that is referred to here, as the text says so</a></li>"
    got = html_text.main_text(f"<article>{LONG}<ul>{item * 4}</ul><p>The end.</article>").split("\n")
    assert len(got) == 17 and got[12].startswith("Smith: A very") and got[-1] == "The end."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<form action=x>{LONG}<input name=q></form>", LONG_TEXT),
        (f"<div>{LONG}</div><form><p>Write to us</p><label>name</label><input></form>", LONG_TEXT),
        (f"<form><nav><a href=x>home</a></nav><article>{LONG}</article></form>", LONG_TEXT),
        (f"<nav><ul><li><a href=x>home</a></ul>{LONG}", LONG_TEXT),
        (f"<form>{LONG}", LONG_TEXT),
        (f"<div>{LONG}</div><footer>All rights reserved by the owner of this long line of text", LONG_TEXT),
        (f"<footer>top<article>{LONG}", LONG_TEXT),
        ("<article><p>Body <label>x</label> after.</p></article>", "Body after."),
        ("<article><p>one<svg><text>no</text></svg>word</p><math><mi>x</mi></math>", "oneword\nx"),
        ("<article><header><h1>Title</h1><p>by line</p></header><p>Text</article>", "Title\nText"),
        ("<article><p class='tag-line'>a</p><div id='article-comments-enabled'>b</div><div class='has-sidebar'>c</div>", "a\nb\nc"),
        ("<article><p>a</p><div class='comments-list'>b</div><div class='x left-sidebar'>c</div><ul id=share_buttons><li>d</ul>", "a"),
        (f"<div>{LONG}<ul>{'<li><a href=x>short</a>' * 4}</ul>{LONG}</div>", f"{LONG_TEXT}\n{LONG_TEXT}"),
        (f"<article><p>a</p><ul>{'<li><a href=x>A long title of some work</a>' * 4}</ul><p>b", "a\n" + "A long title of some work\n" * 4 + "b"),
    ],
)
def test_misleading_marks(page, text):
    assert html_text.main_text(page) == text


def test_runs_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n, window, threshold = int(rng.integers(0, 40)), int(rng.integers(1, 5)), int(rng.integers(1, 80))
        lengths = rng.integers(1, 60, n) * (rng.random(n) < rng.random())
        want = set()
        for surge in range(n):
            if lengths[surge] and sum(lengths[surge : surge + window]) >= threshold:
                for i in range(surge, n):
                    if not any(lengths[i : i + window]):
                        break
                    want.add(i)
        found = html_text.runs(lengths, np.zeros(n, bool), window, threshold)
        assert [i for a, b in found for i in range(a, b)] == sorted(want)


def test_long_pages_take_linear_time():
    page = "<article>" + "<p>text <b>of</b> a line" * 60_000 + "<div class='ad'><ul><li>" * 3_000
    assert html_text.main_text(page).count("\n") >= 59_999


def test_extraction_of_a_table(spark, small):
    got = {r.page_id: r for r in queries.op1_html_extraction(spark, small).collect()}
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        inside = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", p.html, re.S)[1]
        import html

        blocks = [
            " ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split())
            for b in re.split(r"</?(?:p|h1)>", inside)
        ]
        assert got[p.page_id].text == "\n".join(b for b in blocks if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


def test_extraction_edges(spark):
    rows = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (2, "<p>a", None)], "page_id int, html string, text string")
    assert sorted(r.text for r in html_text.extract_text(rows).collect()) == ["", "", "a"]
    assert html_text.extract_text(rows.limit(0)).count() == 0


# --- fingerprints ---------------------------------------------------------------------------------------------------


def _long(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def _xx(values, seed=42):
    """Spark's chained 64-bit xxhash of strings, 64-bit and 32-bit numbers."""
    for v in values:
        if isinstance(v, str):
            data = v.encode()
        else:
            number, size = v
            data = number.to_bytes(size, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return _long(seed)


def brute_codes(text, words=3, bins=64, tuple_size=2):
    if text == "":
        return []
    tokens = re.split(r"[\x09-\x0D\x20]+", text)
    grams = [_xx(tokens[i : i + words]) >> 24 for i in range(max(1, len(tokens) - words + 1))]
    count, ranked = {}, []
    for at, g in enumerate(grams):
        n = count[g] = count.get(g, -1) + 1
        key = g if n == 0 else _xx([(g, 8), (n, 4)]) >> 24
        ranked.append((key, at))
    groups = {}
    for key, at in sorted(ranked):
        groups.setdefault(key >> 34, []).append((key, at))
    out = []
    for number, members in sorted(groups.items()):
        kept = sorted((at, key) for key, at in members[:tuple_size])
        low = _xx([(key, 8) for _, key in kept]) & 0xFFFFFFFF
        out.append((number & (bins - 1)) << 32 | low)
    return out


def test_codes_equal_brute_force(spark):
    rng = random.Random(5)
    texts = ["", "a", "a b c", "a b c d", " x  y ", "w " * 500, "é ö ü ß é ö ü ß é ö ü"]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (10, 100, 1000)]
    texts += [" ".join(str(rng.random()) for _ in range(400))]
    rows = fingerprints.fingerprint(docs(spark, texts)).collect()
    for r in rows:
        assert sorted(r.codes) == sorted(brute_codes(r.text)), r.text[:40]


def test_edited_texts_and_order(spark):
    texts = ["alpha beta gamma delta " * 5, None, "", "zz", "the quick brown fox jumps over it all again", "zz"]
    rows = {r.doc_id: r for r in fingerprints.compare_edited(docs(spark, texts).withColumn("next", F.lit(1))).collect()}
    assert len(rows) == 6
    for i, text in enumerate(texts):
        own, following = text or "", texts[(i - 1) % 6] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i].n_chars == len(own)
    assert rows[3].fingerprint == rows[5].fingerprint
    assert rows[1].fingerprint == "" and rows[2].near_next == 1.0 and rows[3].near_next == 0.0
    assert fingerprints.compare_edited(docs(spark, [])).count() == 0


def test_order_matters(spark):
    a, b = " ".join(map(str, range(300))), " ".join(map(str, range(300, 600)))
    same, turned, other = [a + " " + b, b + " " + a, " ".join(map(str, range(900, 1500)))], None, None
    rows = fingerprints.fingerprint(docs(spark, same)).select("doc_id", "codes").collect()
    codes = {r.doc_id: set(r.codes) for r in rows}
    turned, other = len(codes[0] & codes[1]), len(codes[0] & codes[2])
    assert other < turned < 0.95 * len(codes[0])


# --- toxicity -------------------------------------------------------------------------------------------------------


def test_folding_and_exceptions():
    built = toxicity.automaton(toxicity.Model({"idiot": 3.0, "lowe*": 2.0, "scum": 3.0}))
    for text in ("an IDIOT", "an 1d10t!", "ѕсum", "lowenest", "i$$ sc|_um scum."):
        assert toxicity.findings(text, built), text
    for text in ("idiotic", "10107", "the class clown", "allowed", "", "$$$ &&& %%%", "scum line"):
        assert not toxicity.findings(text, built), text
    assert len(toxicity.fold("İstanbul ẞ 1d")) == len("İstanbul ẞ 1d")


def test_scores(spark):
    texts = ["idiot " * 5, "idiot " + "fine " * 2000, "fine", None, "", "fine"]
    rows = {r.doc_id: r for r in toxicity.score(docs(spark, texts), toxicity.Model(toxicity.SEEDS)).collect()}
    assert rows[0].predicted == 1 and rows[0].score > rows[1].score > rows[2].score
    assert rows[2].score == rows[3].score == rows[4].score == rows[5].score and rows[2].predicted == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    scored = queries.op6_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    wrong = sum(r.toxic != r.predicted for r in rows)
    assert len(rows) > 100 and wrong <= 0.05 * len(rows)
    assert scored.count() == 1000


def test_learning_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.learn(docs(spark, ["a", None]), none)
    assert model.entries == toxicity.SEEDS
    odd = spark.createDataFrame([(0, 1), (0, None), (None, 1), (1, 0), (1, 0), (7, 1)], "doc_id bigint, toxic int")
    assert toxicity.learn(docs(spark, ["a b", None, "c"]), odd).entries


# --- BPE ------------------------------------------------------------------------------------------------------------


def test_encoding_equals_the_tokenizer(spark, small):
    texts = ODD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    tokenizer = Tokenizer.from_file(WORD_BPE)
    given = docs(spark, texts).withColumn("ids", F.lit("clash"))
    rows = bpe.decode(bpe.encode(given, WORD_BPE), WORD_BPE).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids, repr(r.text)[:60]
        assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_small_word_table(spark, monkeypatch):
    table = bpe.WordTable(WORD_BPE)
    monkeypatch.setattr(bpe, "TABLE_WORDS", 4)
    import pyarrow as pa

    for text in ("a b c d", "e f", "a g", "", "b"):
        ids, bounds = table.encode(pa.array([text]))
        assert ids.tolist() == table.encoder.encode(text, add_special_tokens=False).ids and bounds[-1] == len(ids)


def test_word_table_holds_each_part_once():
    import pyarrow as pa

    table = bpe.WordTable(WORD_BPE)
    text = "ab ab. AB, ab! \u00e9ab!! a1. ."
    for _ in range(2):  # the second time adds nothing
        ids, _ = table.encode(pa.array([text, None, ""]))
        assert ids.tolist() == table.encoder.encode(text, add_special_tokens=False).ids
        parts = ["", "ab", ".", ",", "!", "\u00e9ab", "!!", "a1."]
        assert sorted(table.known.to_pylist()) == sorted(parts)
        assert table.used == sum(len(table.encoder.encode(p, add_special_tokens=False).ids) for p in parts)


def test_few_encodings_are_held_at_once():
    import pyarrow as pa

    class Watched:
        def __init__(self, own):
            self.own, self.most = own, 0

        def encode_batch_fast(self, words, **how):
            self.most = max(self.most, len(words))
            return self.own.encode_batch_fast(words, **how)

        def encode(self, *what, **how):
            return self.own.encode(*what, **how)

    table, text = bpe.WordTable(WORD_BPE), " ".join(f"a{i}b" for i in range(5000))
    table.encoder = Watched(table.encoder)
    ids, _ = table.encode(pa.array([text]))
    assert ids.tolist() == table.encoder.encode(text, add_special_tokens=False).ids
    assert 0 < table.encoder.most <= 2000


def test_words_with_marks_and_signs():
    """Fuzzed words of letters, capitals that fall apart when lowered, marks and signs."""
    import pyarrow as pa

    rng, table = random.Random(12), bpe.WordTable(WORD_BPE)
    signs = [*"aAzéÉßİIıİĞŞ'’-_0 9.,!?;:%&#$*|\"\u0301\u0307\u00ad\u200dµªǅΣςΆ日", "GELDİ", "EVİ,", "'s", "ﬁ"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 14))) for _ in range(4000)]
    texts += ["GELDİ!", "GELDİ.", "EVİ, İYİ.", "İ!", "x İ", "İ"]
    ids, bounds = table.encode(pa.array(texts))
    for i, encoded in enumerate(table.encoder.encode_batch(texts, add_special_tokens=False)):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == encoded.ids, repr(texts[i])


def test_repeated_rows_are_encoded_alike(spark):
    rows = bpe.encode(spark.createDataFrame([(1, "A b"), (1, "A b"), (None, "A b")], "doc_id int, text string"), WORD_BPE)
    assert len({tuple(r.ids) for r in rows.collect()}) == 1 and rows.count() == 3


def test_decoding_edges(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [320, -1, 10**7, 320])], "doc_id int, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(rows, WORD_BPE).collect()}
    assert got[1] == got[2] == "" and got[3].count(" ") == 1
    assert bpe.decode(bpe.encode(docs(spark, []), WORD_BPE), WORD_BPE).count() == 0


# --- secrets --------------------------------------------------------------------------------------------------------

KEY = "AKIA" + "ABCDEFGH12345678"


def found(spark, texts):
    rows = secret_scan.find_secrets(
        docs(spark, texts).withColumn("secrets", F.lit(1)), public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN
    )
    return {r.doc_id: r for r in rows.withColumn("was", F.col("text")).transform(secret_scan.redact).collect()}


def test_base_patterns(spark):
    texts = [
        f"é password = 'abcdefgh' and {KEY}",
        "token=short token: longenough",
        "f" * 31 + " " + "0" * 32 + "g",
        "API_KEY:" + "a" * 40,
        "AKIAABC AKIA",
        None,
        "",
        "passwd=api_key=12345678",
        "to\u212aen=abcdefgh",  # the Kelvin sign is no k
    ]
    rows = found(spark, texts)
    spans = {i: [(s.kind, s.start, s.end) for s in r.secrets] for i, r in rows.items()}
    assert spans[0] == [("assign", 2, 22), ("access", 28, 48)]
    assert spans[1] == [("assign", 12, 29)]
    assert spans[2] == [("hex", 32, 64)]
    assert spans[3] == [("assign", 0, 48), ("hex", 8, 48)]
    assert spans[4] == spans[5] == spans[6] == spans[8] == []
    assert spans[7] == [("assign", 0, 23)]
    assert rows[0].text == "é [secret]' and [secret]" and rows[3].text == "[secret]"
    assert rows[5].text is None and rows[6].text == ""


def test_random_strings_and_harmless_ones(spark):
    random_one = "xK9vQ2mZ7pLw4RtY8bNc3JhG"
    harmless = "d41d8cd98f00b204e9800998ecf8427e 123e4567-e89b-12d3-a456-426614174000 some_long_identifier_name_12 4041894974608795"
    rows = found(spark, [f"see {random_one} here", harmless.upper(), "bosbt.long.name.42@mail8.example.com"])
    assert [(s.kind, s.start, s.end) for s in rows[0].secrets] == [("random", 4, 28)]
    assert rows[1].secrets == [] and rows[2].secrets == []


def test_secrets_beside_dots_colons_and_at_signs():
    encode = secret_scan.encoder(public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN).encode_ordinary
    one, two = "xK9vQ2mZ7pLw4RtY8bNc3JhG", "Tq7Zr2Xw9Lp4Vk8Nm3Bs6Hd1"
    jwt = ["eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9", "eyJzdWIiOiIxMjM0NTY3ODkwIn0", "SflKxwRJSMeKKF2QT4fwpMeJf36POk6yJV"]
    letters = ["kQwZxVbnTrPmLsDfGh", "qzxvkjhwpfmbtrnc", "QWZXKVJHGPTRBNMLD"]
    for text, secrets in [
        (f"see {'.'.join(jwt)}", jwt),
        (f"https://user:{one}@db.example.com/x", [one]),
        (f"{one}:{two}", [one, two]),
        (f"to {one}@example.com", [one]),
        *[(f"key {x} end", [x]) for x in letters],
        ("internationalization Donaudampfschifffahrtsgesellschaft getElementsByClassName INTERNATIONALIZATION", []),
        ("Schpfgegebeunger some_long_identifier_name_12", []),
        ("write-to-qrst-4217-wxyz@mail8.example.com or open long-qx17-zk22-vw03.notes.txt", []),
    ]:
        spans = secret_scan.scan_text(text, encode, 2.2)
        assert [(s["kind"], text[s["start"] : s["end"]]) for s in spans] == [("random", x) for x in secrets], text


def plain_scan(text, encode, ratio):
    """The scan without its shortcuts: every candidate looks at all base spans and walks its whole run."""
    taken = secret_scan.base_spans(text)
    found = [(s, kind, e) for s, e, kind in taken]
    for m in secret_scan.CANDIDATE.finditer(text):
        run, start, end = m[0], m.start(), m.end()
        if secret_scan.HARMLESS.fullmatch(run) or any(a < end and start < b for a, b, _ in taken):
            continue
        least = secret_scan.WORDS_RATIO if secret_scan.WORDS.fullmatch(run) else ratio
        if len(run) / len(encode(run)) >= least:
            continue
        first, last = start, end
        while first and re.match(r"[A-Za-z0-9+/_=.@-]", text[first - 1]):
            first -= 1
        while last < len(text) and re.match(r"[A-Za-z0-9+/_=.@-]", text[last]):
            last += 1
        whole = text[first:last]
        parts = secret_scan.SEPARATORS.split(whole)
        text_like = all(
            secret_scan.ADDRESS_PART.fullmatch(p) and (len(p) < 8 or len(p) / len(encode(p)) >= least) for p in parts
        )
        if whole == run or not secret_scan.ADDRESS.fullmatch(whole) or not text_like:
            found.append((start, "random", end))
    return sorted((s, secret_scan.KINDS.index(k), e) for s, k, e in found)


def test_scan_equals_a_plain_one():
    rng = random.Random(13)
    encode = secret_scan.encoder(public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN).encode_ordinary
    bits = ["xK9vQ2mZ7pLw4RtY8bNc3JhG", "password=", "abcdefgh12", ".", "@", ":", " ", "mail8.example.com", "f" * 33, KEY, "é"]
    bits += ["internationalization", "some_long_identifier_name", "-", "/", "qzxvkjhwpfmbtrnc", "token: ", "\n"]
    for _ in range(1500):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 12)))
        spans = [(s["start"], secret_scan.KINDS.index(s["kind"]), s["end"]) for s in secret_scan.scan_text(text, encode, 2.2)]
        assert spans == plain_scan(text, encode, 2.2), text


def test_long_texts_of_random_parts_take_linear_time():
    import time

    rng = random.Random(14)
    encode = secret_scan.encoder(public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN).encode_ordinary
    part = lambda: "".join(rng.choice("abcdefgXYZ0123456789") for _ in range(20))
    for text in (".".join(part() for _ in range(50_000)), " ".join(f"token={part()}" for _ in range(40_000)), "aB3" * 350_000):
        start = time.perf_counter()
        assert secret_scan.scan_text(text, encode, 2.2)
        assert time.perf_counter() - start < 30


def test_secrets_of_empty_tables_and_repeated_rows(spark):
    assert found(spark, []) == {}
    rows = spark.createDataFrame([(1, f"see {KEY}"), (1, f"see {KEY}"), (None, f"see {KEY}")], "doc_id int, text string")
    scanned = secret_scan.find_secrets(rows, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN).collect()
    assert [[(s.kind, s.start, s.end) for s in r.secrets] for r in scanned] == [[("access", 4, 24)]] * 3


def test_hiding_equals_scan_and_redaction(spark):
    texts = [f"é password = 'abcdefgh' and {KEY}", None, "", "plain words", "API_KEY:" + "a" * 40, "x " * 2000 + KEY]
    paths = public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN
    hidden = {r.doc_id: r.text for r in secret_scan.hide_secrets(docs(spark, texts), *paths).collect()}
    assert hidden == {i: r.text for i, r in found(spark, texts).items()}
    assert secret_scan.hide_secrets(docs(spark, []), *paths).count() == 0
