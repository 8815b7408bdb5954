"""Toxicity by a weighted lexicon.

Texts are folded first: case, look-alike letters of other scripts and digits or signs that stand for letters, each
replaced by one letter so that offsets stay. An Aho-Corasick automaton finds the lexicon's words and stems; a word must
stand alone, a stem must begin a word, and a run without any real letter (a number) never matches. A finding inside
an exception phrase does not count. Of several findings that begin at one place the heaviest counts. The sum of weights
per word of text goes through a fitted logistic curve, so one insult weighs less in a long text than in a short one.

The lexicon is learned from labelled rows: for words and their first letters, the log-odds of occurring in toxic against
clean texts. ``MAX_TRAIN_ROWS`` bounds the labelled rows that are read for it (the ones with the smallest hashes of their
ids; of near copies only one counts), ``MAX_ENTRIES`` the size of the lexicon, so the model is small enough to travel
with the task. Scoring covers all rows and all of each text.

Null and empty texts have no findings and get the curve's lowest score. Without labelled rows of both kinds the seed lexicon and
a fixed curve are used. Repeated rows are scored alike. Labels, language, source and id are not inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import stored, tidy

MAX_TRAIN_ROWS = 20_000
MAX_ENTRIES = 5_000
STEMS = (4, 5, 6)  # lengths of word beginnings that are learned

# Letters that look like Latin ones, and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "ɡ": "g", "ӏ": "l", "ո": "n", "ս": "u", "α": "a", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ℓ": "l",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "l"}
SEEDS = {word: 3.0 for word in "idiot moron scum loser pathetic worthless stupid disgusting trash clown".split()}
EXCEPTIONS = ("class clown", "clown fish", "trash can", "trash bin", "scum line", "sore loser clause")

_WIDE = {chr(0xFEE0 + ord(c)): c for c in "abcdefghijklmnopqrstuvwxyz0123456789"}
_TABLE = str.maketrans({**LOOKALIKES, **DIGITS, **{w: DIGITS.get(c, c) for w, c in _WIDE.items()}})
_ASCII = bytes.maketrans("".join(DIGITS).encode(), "".join(DIGITS.values()).encode())
_SIGN = re.compile(r"(?<=[^\W_])[@$!|](?=[^\W_])|[@$](?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """``text`` with every sign of a word as one plain lower-case letter; the length stays."""
    low = text.lower()
    if len(low) != len(text):  # a few capitals grow when lowered
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    if any(s in low for s in SIGNS):
        low = _SIGN.sub(lambda m: SIGNS[m[0]], low)
    if low.isascii():
        return low.encode().translate(_ASCII).decode()
    return low.translate(_TABLE)


@dataclass
class Model:
    """``entries``: pattern -> weight (a stem ends in ``*``); the score is 1 / (1 + exp(-(bias + slope * density)))."""

    entries: dict[str, float]
    bias: float = -3.0
    slope: float = 2.5
    exceptions: tuple[str, ...] = EXCEPTIONS


def automaton(model: Model):
    """Values are ``(length, weight, is a stem)`` of each pattern; a weight of None marks an exception phrase."""
    import ahocorasick

    built = ahocorasick.Automaton()
    patterns: dict[str, list] = {}
    for entry, weight in model.entries.items():
        patterns.setdefault(entry.rstrip("*"), []).append((weight, entry.endswith("*")))
    for phrase in model.exceptions:
        patterns.setdefault(fold(phrase), []).append((None, False))
    for pattern, kinds in patterns.items():
        built.add_word(pattern, (len(pattern), kinds))
    built.make_automaton()
    return built


def findings(text: str, built) -> dict[int, float]:
    """Start -> weight of what counts in ``text``."""
    folded, found, excepted = fold(text), {}, []
    size = len(folded)
    for last, (length, kinds) in built.iter(folded):
        start, end = last - length + 1, last + 1
        if start and folded[start - 1].isalpha():
            continue
        closed = end == size or not folded[end].isalpha()
        if text[start:end].isdigit():
            continue
        for weight, stem in kinds:
            if weight is None:
                if closed:
                    excepted.append((start, end))
            elif (closed or stem) and weight > found.get(start, 0.0):
                found[start] = weight
    for a, b in excepted:
        for start in [s for s in found if a <= s < b]:
            del found[start]
    return found


def density(text: str | None, built) -> float:
    """log(1 + weight per hundred words); a text counts as twenty words at least."""
    if not text:
        return 0.0
    weight = sum(findings(text, built).values()) if len(built) else 0.0
    return math.log1p(100 * weight / max(20, len(text.split()))) if weight else 0.0


def _with_densities(docs: DataFrame, model: Model, text_column: str, name: str) -> DataFrame:
    @F.arrow_udf("double")
    @tidy
    def measure(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        built = automaton(model)
        for batch in texts:
            yield pa.array([density(t.as_py(), built) for t in batch], pa.float64())

    return docs.withColumn(name, measure(F.col(text_column)))


def score(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    measured = _with_densities(docs, model, text_column, "__density")
    value = 1 / (1 + F.exp(-(F.lit(model.bias) + F.lit(model.slope) * F.col("__density"))))
    return (
        measured.withColumn("score", value)
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
        .drop("__density")
    )


def _entries(text: str) -> set[str]:
    words = set(_WORD.findall(fold(text)))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def _copy_key(text: str) -> int:
    """Equal for most near copies: the smallest hash of three words in a row."""
    import xxhash

    words = text.lower().split()
    rows = zip(words, words[1:], words[2:]) if len(words) > 2 else [words]
    return min(xxhash.xxh64_intdigest(" ".join(r)) for r in rows) >> 1


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``(doc_id, text, toxic)`` of at most ``max_rows`` labelled rows, by hash of the id; near copies count once."""
    marked = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )

    @F.arrow_udf("bigint")
    def copies(texts: pa.Array) -> pa.Array:
        return pa.array([_copy_key(t.as_py()) for t in texts], pa.int64())

    rows = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")  # max_rows ids at most
    rows = rows.where(F.col("text").isNotNull())
    first = F.min_by(F.struct("doc_id", "text", "toxic"), F.struct("doc_id", "text"))
    return rows.groupBy(copies("text").alias("key")).agg(first.alias("row")).select("row.*")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_TRAIN_ROWS,
    max_entries: int = MAX_ENTRIES,
    min_docs: int = 5,
    min_weight: float = 2.0,
) -> Model:
    """A model from ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``; what must not be seen is filtered out before."""
    sample = stored(training_sample(docs, labels, max_rows), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                seen[toxic].update(_entries(text))
        names = [*{*seen[0], *seen[1]}]
        columns = [pa.array(names, pa.string())]
        columns += [pa.array([c[n] for n in names], pa.int64()) for c in seen]
        yield pa.RecordBatch.from_arrays(columns, ["entry", "clean", "toxic"])

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}  # two rows
    clean_docs, toxic_docs = sizes.get(0, 0), sizes.get(1, 0)
    if not clean_docs or not toxic_docs:
        return Model(dict(SEEDS))
    counted = (
        sample.mapInArrow(count, "entry string, clean bigint, toxic bigint")
        .groupBy("entry")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    odds = F.log(
        ((F.col("toxic") + 0.5) / (toxic_docs + 1)) / ((F.col("clean") + 0.5) / (clean_docs + 1))
    )
    weighted = counted.withColumn("weight", odds)
    least = max(min_docs, 0.004 * toxic_docs)
    kept = weighted.where((F.col("toxic") >= least) & (F.col("weight") >= min_weight))
    rows = kept.orderBy(F.desc(F.col("weight") * F.log1p("toxic")), "entry").limit(max_entries).collect()
    entries = {r["entry"]: r["weight"] for r in rows}
    known = {r["entry"] for r in weighted.where(F.col("entry").isin(*SEEDS)).collect()}
    entries.update({word: weight for word, weight in SEEDS.items() if word not in known})
    model = Model(entries)
    measured = _with_densities(sample, model, "text", "x").select("x", "toxic").toPandas()  # max_rows numbers
    model.bias, model.slope = fit_curve(measured["x"].to_numpy(), measured["toxic"].to_numpy())
    return model


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Logistic regression on one feature, both kinds weighted alike, by Newton steps with a small ridge."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    design, beta = np.column_stack([np.ones_like(x), x]), np.array([-1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (p - y)) + ridge * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 1e-6))


def held_out(id_column: str = "doc_id", folds: int = 3, fold_number: int = 1):
    """True for the rows whose labels are for testing only."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds == fold_number, F.lit(False))
