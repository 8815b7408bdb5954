import ast

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
import pytest

from vitrine.functions import lists, ngrams, prompts, text


def one(spark, value, expression):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "cell, expected",
    [
        ("['Soft cotton', 'Machine wash']", "Soft cotton Machine wash"),
        ("""["it's", 'a']""", "it's a"),
        ("['a', 1, None]", "a 1 None"),
        ("['a'] x", "['a'] x"),
        ("plain text", "plain text"),
        ("('a','b')", "('a', 'b')"),
        ("[]", ""),
        ("['a',]", "a"),
        ("['a' 'b']", "ab"),
        (r"['it\'s']", "it's"),
        ("  ['a']", "a"),
        ("[S]", "[S]"),
        ("['a\nb']", "['a\nb']"),
        ("u'x'", "x"),
        ("12", "12"),
        ("1.50", "1.5"),
        ("None", "None"),
        ("5 red shoes", "5 red shoes"),
        ("[\u0001]", "[\u0001]"),
        ("['tab\there', 'é']", "tab\there é"),
        ("{'a': 1}", "{'a': 1}"),
    ],
)
def test_parse_list(spark, cell, expected):
    assert one(spark, cell, lists.parse_list) == expected


@pytest.mark.parametrize(
    "cell, expected",
    [
        ("['Black ', 'BLUE']", "black, blue"),
        ("unknown", ""),
        ("['a', 1]", "unknown"),
        ("Black", "unknown"),
        ("[]", ""),
        ("('a',)", "unknown"),
        ("(['Red'])", "red"),
        ("['a'", "unknown"),
    ],
)
def test_extract_colors(spark, cell, expected):
    assert one(spark, cell, lists.extract_colors) == expected


def _reference_text(cell):
    try:
        value = ast.literal_eval(cell)
    except Exception:
        return cell
    return " ".join(map(str, value)) if isinstance(value, list) else str(value)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.lists(st.text(alphabet="ab'\" ,\\é\t[]", max_size=4), max_size=4).map(repr),
            st.text(alphabet="[]'\", a1()\\u0", max_size=8),
        ),
        min_size=40,
        max_size=60,
    )
)
def test_parse_list_equals_literal_eval(spark, cells):
    rows = [(i, c) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, "i int, x string")
    got = dict(df.select("i", lists.parse_list(F.col("x"))).collect())
    assert got == {i: _reference_text(c) for i, c in rows}


def test_clean_text(spark):
    dirty = "a\u00a0b http://x.y\u00a0z #café {c:1} <b>t</b> é END\t"
    assert one(spark, dirty, text.clean_text) == "ab z t end"
    assert one(spark, "Tom & Jerry (50%) [x] a_b; c:d @e", text.clean_text) == (
        "tom jerry 50 x a b c d e"
    )
    assert one(spark, "", text.clean_text) == ""


def test_remove_stopwords(spark):
    source = "don't it's \"quote\" 1,000, a, b... ok? no! x--y 5."
    expected = "do n't 's `` quote '' 1,000 , , b ... ok ? no ! x -- y 5 ."
    assert one(spark, source, text.remove_stopwords) == expected
    assert one(spark, "the cat that is", text.remove_stopwords) == "cat"


def test_word_count(spark):
    assert one(spark, "", text.word_count) == 0
    assert one(spark, " a b \n", text.word_count) == 2


def test_split_prompt(spark):
    def both(value, marker=None):
        df = spark.createDataFrame([(value,)], "x string")
        return tuple(df.select(*prompts.split_prompt(F.col("x"), marker)).first())

    assert both("x Description:\n y ", "Description:\n") == ("x Description:\n", "y")
    assert both("x Description:\n y ") == ("x Description:\n", "y")
    assert both("Description: t Description: u") == ("Description: ", "t Description: u")
    assert both("no marker") == ("no marker", "")


def test_strip_prefix(spark):
    df = spark.createDataFrame([("ab cd ", "ab"), ("xb cd", "ab")], "t string, p string")
    careful = [r[0] for r in df.select(prompts.strip_prefix(F.col("t"), F.col("p"))).collect()]
    always = [r[0] for r in df.select(prompts.strip_prefix(F.col("t"), F.col("p"), True)).collect()]
    assert careful == ["cd", "xb cd"]
    assert always == ["cd", "cd"]


def test_prompt_formats(spark):
    df = spark.createDataFrame([("n", "c", "d"), ("n", "", None)], "n string, c string, d string")
    n, c, d = F.col("n"), F.col("c"), F.col("d")
    train = [r[0] for r in df.select(prompts.training_prompt(n, c, d)).collect()]
    assert train == [
        "Product: n\n    Color: c\n    Description: d\n    ",
        "Product: n\n    Color: \n    Description: \n    ",
    ]
    asked = [r[0] for r in df.select(prompts.query_text(n, c)).collect()]
    assert asked == ["Product: n\nColor: c", "Product: n"]
    assert df.select(prompts.inference_prompt(n, c)).first()[0] == (
        "Product: n\n    Color: c\n    Description: "
    )


def test_fewshot_prompt(spark):
    df = spark.createDataFrame(
        [("n", "c", [(1, "p", "red", "d1"), (4, "q", "", "d2")]), ("n", "c", [])],
        "n string, c string, similar array<struct<rank:int,name_clean:string,"
        "colors_extracted:string,fulldescription_clean:string>>",
    )
    shown, bare = [
        r[0]
        for r in df.select(
            prompts.fewshot_prompt(F.col("n"), F.col("c"), F.col("similar"))
        ).collect()
    ]
    assert shown == (
        "Here are similar products for reference:\n\n"
        "Example 1:\nProduct: p\n    Color: red\n    Description: d1\n\n"
        "Example 2:\nProduct: q\n    Description: d2\n\n"
        "---\n\nNow generate a description for this product:\n\n"
        "Product: n\n    Color: c\n    Description: "
    )
    assert bare == "Product: n\n    Color: c\n    Description: "


def test_clipped_overlap(spark):
    rows = [
        (["a", "b", "a", "a"], ["a", "a", "c", "b", "b"]),
        ([], ["a"]),
        (["a", "b"], ["b", "b", "a"]),
        ([], []),
    ]
    df = spark.createDataFrame(rows, "l array<string>, r array<string>")
    got = [r[0] for r in df.select(ngrams.clipped_overlap(F.col("l"), F.col("r"))).collect()]
    assert got == [3, 0, 2, 0]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(ngrams.ngrams(F.col("t"), 2)).collect()]
    assert got == [["a b", "b c"], [], []]
