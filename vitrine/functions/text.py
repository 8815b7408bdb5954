"""Text cleaning and tokenising as native column expressions.

The regular expressions avoid ``\\s``, ``\\S`` and ``\\w`` on uncleaned text: those are ASCII-only in
Java and would miss Unicode whitespace and letters. ``WS`` is Unicode whitespace spelled out.
"""

from __future__ import annotations

import string
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from vitrine.functions import fixed

WS = r"[\x09\x0A\x0B\x0C\x0D\x1C\x1D\x1E\x1F\x20\x85\xA0\p{Z}]"
NWS = "[^" + WS[1:]
WORD = r"[\p{L}\p{N}_-]"

KEPT_ASCII = string.ascii_letters + string.digits + ".,!?'\"-" + "\t\n\v\f\r\x1c\x1d\x1e\x1f "


def _any_of(characters) -> str:
    """A class of single characters; java.util.regex looks these up in a table, unlike ranges."""
    return "[" + "".join(f"\\x{ord(c):02X}" for c in characters) + "]"


BREAKS = "\t\n\v\f\r\x1c\x1d\x1e\x1f"  # ASCII white space but for the blank
ODD_OR_WS = _any_of(c for c in map(chr, range(128)) if c not in KEPT_ASCII or c in BREAKS + " ")

# (pattern, replacement, signs) in order; the text is trimmed and lower-cased afterwards. Every match of a pattern holds one of
# its signs: a text without them is not searched, which costs a regular expression far more than the look for the sign.
CLEANING_RULES = [
    (rf"#{WORD}+{WS}*\{{[^}}]*\}}", "", "#"),  # style rules such as `#id { ... }`
    (r"<[^>]+>", "", "<"),
    (rf"http{NWS}+|www{NWS}+", "", "http", "www"),
    (r"[^\x00-\x7F]+", ""),
    (f"{ODD_OR_WS}+", " "),
]

# (pattern, replacement, signs) in order; tokens are then the runs of non-blanks
TREEBANK_RULES = [
    (r'(^|\s)"', "$1`` ", '"'),
    (r'"', " '' ", '"'),
    (r"(\.{2,})", " $1 ", ".."),
    (r",([^0-9]|$)", " , $1", ","),
    (r"([?!])", " $1 ", "?", "!"),
    (r"([^.])\.(\s|$)", "$1 . $2", "."),
    (r"--", " -- ", "--"),
    (r"([^' ])(n't)(\s|$)", "$1 $2$3", "n't"),
    (r"([^' ])('(?:s|m|d|ll|re|ve))(\s|$)", "$1 $2$3", "'"),
]


def _rewrite(col: Column, rules: list[tuple[str, ...]]) -> Column:
    for pattern, replacement, *signs in rules:

        def replaced(text: Column) -> Column:
            new = F.regexp_replace(text, F.lit(pattern), F.lit(replacement))
            found = [F.contains(text, F.lit(sign)) for sign in signs]
            return F.when(reduce(Column.__or__, found), new).otherwise(text) if found else new

        # The array binds the text, so that it is one expression in the plan, however often a rule names it.
        col = F.element_at(F.transform(F.array(col), replaced), 1) if signs else replaced(col)
    return col


def _between(col: Column, gaps: str) -> Column:
    """The runs of characters between matches of ``gaps``."""
    return F.array_remove(F.split(col, gaps), "")


def strip_ws(col: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` removes spaces only)."""
    return F.regexp_replace(col, F.lit(f"^{WS}+|{WS}+$"), F.lit(""))


def lower_strip(col: Column) -> Column:
    return strip_ws(F.lower(col))


def clean_text(col: Column) -> Column:
    return F.lower(F.trim(_rewrite(col, CLEANING_RULES)))


def treebank_tokens(col: Column) -> Column:
    """Split punctuation and English contractions from words."""
    return _between(_rewrite(col, TREEBANK_RULES), r"\s+")


def ws_tokens(col: Column) -> Column:
    """Whitespace tokens; an empty text has none."""
    return _between(col, f"{WS}+")


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The tokens of ``ws_tokens`` of Arrow texts, all in a row, and the number of the text that each is of."""
    words = pc.utf8_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    row = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    flat = words.flatten()
    kept = pc.not_equal(flat, "")  # the split leaves empty words at the ends
    return row[kept.to_numpy(zero_copy_only=False)], flat.filter(kept)


def alnum_tokens(col: Column) -> Column:
    """Lower-case runs of ``[a-z0-9]``, the token rule of ROUGE."""
    return F.regexp_extract_all(F.lower(col), F.lit("([a-z0-9]+)"), F.lit(1))


def remove_stopwords(col: Column, words: list[str] | None = None) -> Column:
    words = fixed.LIGHT_STOPWORDS if words is None else words
    return F.array_join(
        F.filter(treebank_tokens(col), lambda token: ~token.isin(words)), " "
    )


def word_count(col: Column) -> Column:
    """The number of tokens. Between single blanks, as in cleaned texts, they need not be cut out to be counted."""

    def count(text: Column) -> Column:
        blank = F.lit(" ")
        single = (F.octet_length(text) == F.length(text)) & (text != "") & ~F.contains(text, F.lit("  "))
        single &= ~F.startswith(text, blank) & ~F.endswith(text, blank) & ~text.rlike(_any_of(BREAKS))
        blanks = F.length(text) - F.length(F.replace(text, blank, F.lit("")))
        return F.when(single, blanks + 1).otherwise(F.regexp_count(text, F.lit(f"{NWS}+")))

    return F.element_at(F.transform(F.array(col), count), 1)


def preview(col: Column, chars: int) -> Column:
    return F.substring(col, 1, chars)
