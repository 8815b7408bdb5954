"""Document fingerprints by Order MinHash.

A text is a sequence of k-mers of words (runs between white space). The i-th k-mer with the same words gets occurrence
number i, so repeats count. One hash of (k-mer, occurrence) both deals the k-mers into ``bins`` and ranks them within
their bin; each bin keeps its ``tuple_size`` smallest, puts them back into text order and hashes the ordered tuple.
Because the order of the kept k-mers matters, moving passages lowers the likeness as edits do, which is what makes the
fingerprint follow edit distance rather than mere word overlap. Likeness is the share of equal bins among those that
either text fills.

A fingerprint is a string of ten hexadecimal digits per filled bin. An empty text has the empty fingerprint; it is like
another empty text (1) and unlike any other (0). A text shorter than one k-mer is a single k-mer. Null text counts as
empty. Equal texts have equal fingerprints. Everything is DataFrame functions over one row at a time; a text may have
up to 2**24 words before positions wrap, which only blurs the order of ties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm.common import shuffle_width, text_or_empty

WORDS, BINS, TUPLE = 3, 64, 2
BIN_BITS = 6
POSITION_BITS = 24
_POSITIONS = (1 << POSITION_BITS) - 1


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _key(packed: Column) -> Column:
    return F.shiftright(packed, POSITION_BITS)


def _bin(packed: Column) -> Column:
    return F.shiftright(packed, 64 - BIN_BITS)


def _pack(digest: Column, position: Column) -> Column:
    return digest.bitwiseAND(F.lit(~_POSITIONS)).bitwiseOR(position.bitwiseAND(F.lit(_POSITIONS)))


def _smallest(packed: Column, count: int) -> Column:
    """The first ``count`` entries of each bin of a sorted array."""
    return let(
        packed,
        lambda all_: F.filter(
            all_, lambda x, i: (i < count) | (_bin(x) != _bin(F.get(all_, i - count)))
        ),
    )


def _repeats(ranked: Column) -> Column:
    """Entries that are not the first of their k-mer, hashed again with their exact occurrence number."""
    size = F.size(ranked)
    later = F.filter(
        F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))),
        lambda i: _key(F.get(ranked, i)) == _key(F.get(ranked, i - 1)),
    )

    def numbered(i: Column) -> Column:
        own = F.get(ranked, i)
        # Equal keys are adjacent: double steps back, largest first, count the earlier ones.
        steps = F.sequence(F.floor(F.log2(size)).cast("int"), F.lit(0), F.lit(-1))

        def back(count: Column, bit: Column) -> Column:
            further = count + F.call_function("shiftleft", F.lit(1), bit)
            same = F.coalesce(_key(F.get(ranked, i - further)) == _key(own), F.lit(False)) & (further <= i)
            return F.when(same, further).otherwise(count)

        occurrence = F.aggregate(steps, F.lit(0), back)
        return _pack(F.xxhash64(_key(own), occurrence), own)

    return F.sort_array(F.transform(later, numbered))


def _tuples(chosen: Column, tuple_size: int) -> Column:
    """One number per filled bin: the bin and 32 bits of the hash of its k-mers in text order."""
    firsts = F.filter(
        F.sequence(F.lit(0), F.size(chosen) - 1),
        lambda i: (i == 0) | (_bin(F.get(chosen, i)) != _bin(F.get(chosen, i - 1))),
    )

    def code(i: Column) -> Column:
        group = _bin(F.get(chosen, i))
        members = F.filter(F.slice(chosen, i + 1, F.lit(tuple_size)), lambda x: _bin(x) == group)
        ordered = F.sort_array(
            F.transform(
                members,
                lambda x: F.struct(x.bitwiseAND(F.lit(_POSITIONS)).alias("at"), _key(x).alias("key")),
            )
        )
        digest = F.xxhash64(F.transform(ordered, lambda x: x["key"]))
        low = digest.bitwiseAND(F.lit(0xFFFFFFFF))
        return F.shiftleft(group.bitwiseAND(F.lit(BINS - 1)), 32).bitwiseOR(low)

    return F.transform(firsts, code)


def codes(text: Column, words: int = WORDS, tuple_size: int = TUPLE) -> Column:
    """The fingerprint as an array of numbers, at most one per bin."""

    def of_words(tokens: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - words, F.lit(0)))
        return F.transform(
            starts,
            lambda i: _pack(F.xxhash64(*[F.get(tokens, i + j) for j in range(words)]), i.cast("bigint")),
        )

    def of_ranked(ranked: Column) -> Column:
        unique = F.filter(ranked, lambda x, i: (i == 0) | (_key(x) != _key(F.get(ranked, i - 1))))
        both = F.concat(_smallest(unique, tuple_size), _smallest(_repeats(ranked), tuple_size))
        return let(_smallest(F.sort_array(both), tuple_size), lambda chosen: _tuples(chosen, tuple_size))

    hashed = let(F.split(text, r"[\x09-\x0D\x20]+"), lambda tokens: F.sort_array(of_words(tokens)))
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(let(hashed, of_ranked))


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda c: F.lower(F.lpad(F.hex(c), 10, "0"))), "")


def likeness(left: Column, right: Column) -> Column:
    """Share of equal bins among the bins that either side fills."""
    bins = lambda side: F.transform(side, lambda c: F.shiftright(c, 32))
    filled = F.size(F.array_union(bins(left), bins(right)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(left, right)) / filled.cast("double")
    )


def fingerprint(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the columns ``codes`` and ``fingerprint``."""
    with_codes = docs.withColumn("codes", codes(text_or_empty(text_column)))
    return with_codes.withColumn("fingerprint", as_text(F.col("codes")))


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``value``, by bisection; null counts as below all."""
    limits = F.array(*[F.lit(b).cast("bigint") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    bits = list(range(max(1, len(bounds).bit_length()) - 1, -1, -1))

    def step(low: Column, bit: Column) -> Column:
        further = low + F.call_function("shiftleft", F.lit(1), bit)
        fits = F.coalesce(F.get(limits, further - 1) <= value, F.lit(False))
        return F.when(fits, further).otherwise(low)

    return F.aggregate(F.array(*[F.lit(b) for b in bits]), F.lit(0), step)


def with_next(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Every row of ``(id, text)`` with ``codes`` and those of the next row by descending id (after the last: the first).

    Rows are dealt once into ranges of ids (bounds from an approximate quantile sketch, two ranges per shuffle
    partition). Within a range the next row is a window away; the last row of each range needs the head of the next
    range, so the heads, one row a range, are joined back. Equal ids follow each other by a hash of the text, then text.
    """
    width = shuffle_width(docs.sparkSession)
    ranges = 2 * width
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    sketch = docs.agg(F.percentile_approx(id_column, shares, 10_000)).first()[0]
    dealt = docs.withColumn("bucket", _range_of(F.col(id_column), sorted(set(sketch or []))))

    order = [F.desc_nulls_last(id_column), F.xxhash64("text"), F.col("text")]
    inside = Window.partitionBy("bucket").orderBy(*order)
    rows = dealt.repartition(width, "bucket").withColumn("codes", codes(F.col("text")))
    led = rows.withColumns(
        {
            "next": F.lead(F.struct("text", "codes")).over(inside),
        }
    )
    # Heads: the largest id of each range, one row of it, and which range follows.
    tops = dealt.groupBy("bucket").agg(F.max(id_column).alias("top"))
    heads = dealt.join(F.broadcast(tops), "bucket").where(F.col(id_column).eqNullSafe(F.col("top")))
    first = Window.partitionBy("bucket").orderBy(*order)
    heads = heads.withColumn("n", F.row_number().over(first)).where("n = 1").select("bucket", "text")
    lower = Window.orderBy(F.desc("bucket"))  # one row a range
    whole = lower.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = heads.select(
        "bucket", F.coalesce(F.lead("text").over(lower), F.first("text").over(whole)).alias("head_text")
    ).withColumn("head", F.struct(F.col("head_text").alias("text"), codes(F.col("head_text")).alias("codes")))
    joined = led.join(F.broadcast(following.select("bucket", "head")), "bucket")
    return joined.withColumn("next", F.coalesce("next", "head")).drop("head", "bucket")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``(doc_id, text)`` and of each text with its second half replaced by the next document's start."""
    rows = with_next(docs.select("doc_id", text_or_empty().alias("text")))
    length = F.length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), length - half), F.substr("next.text", F.lit(1), half))
    named = rows.select(
        "doc_id",
        length.cast("bigint").alias("n_chars"),
        edited.alias("edited"),
        "codes",
        F.col("next.codes").alias("next_codes"),
    ).withColumn("edited_codes", codes(F.col("edited")))
    return named.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("codes")).alias("fingerprint"),
        as_text(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )
