"""Per-text loss under an add-k n-gram model counted from training texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.ngrams import GRAM_SEPARATOR, ngrams
from vitrine.functions.text import split_words, ws_tokens
from vitrine.operators.joins import heavy_of, salted_join
from vitrine.session import scratch_path

START = "<s>"


def _terms(
    df: DataFrame, col: str, n: int, keep: list[str], max_tokens: int | None = None
) -> DataFrame:
    """``keep`` columns and one row per n-gram and per context of the column (``place``, ``term``).

    A context is the word before the last one of a bigram. Tokens hold no blank, bigrams one, so the two never meet.
    """
    tokens = ws_tokens(F.lower(F.col(col)))
    if max_tokens is not None:
        tokens = F.slice(tokens, 1, max_tokens)
    if n == 2:
        tokens = F.concat(F.array(F.lit(START)), tokens)
    cut = df.select(*keep, tokens.alias("tokens"))
    terms = ngrams(F.col("tokens"), n)
    if n == 2:
        contexts = F.slice("tokens", 1, F.greatest(F.size("tokens") - 1, F.lit(0)))
        terms = F.concat(terms, contexts)
    return cut.select(*keep, F.posexplode(terms).alias("place", "term"))


def gram_counts(texts: pa.Array, n: int) -> pa.RecordBatch:
    """``(term, c)``: how often the lower-case texts hold each n-gram and each context; terms as of ``_terms``."""
    row, words = split_words(texts)
    coded = words.dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = pa.concat_arrays([coded.dictionary, pa.array([START], coded.dictionary.type)])  # the start comes last
    if n == 1:
        terms, counts = coded.dictionary, np.bincount(word, minlength=len(coded.dictionary))
    else:
        before = np.append(len(names) - 1, word[:-1])[: len(word)]
        before[1:][row[1:] != row[:-1]] = len(names) - 1
        pair, of_pair = np.unique(before * len(names) + word, return_counts=True)
        context, of_context = np.unique(before, return_counts=True)
        left, right = (names.take(pa.array(numbers)) for numbers in np.divmod(pair, len(names)))
        bigrams = pc.binary_join_element_wise(left, right, pa.scalar(GRAM_SEPARATOR, names.type))
        terms, counts = pa.concat_arrays([bigrams, names.take(pa.array(context))]), np.append(of_pair, of_context)
    return pa.RecordBatch.from_arrays([terms.cast(pa.string()), pa.array(counts, pa.int64())], ["term", "c"])


def _is_context(n: int) -> Column:
    return F.lit(False) if n == 1 else ~F.contains("term", F.lit(GRAM_SEPARATOR))


@dataclass
class NgramModel:
    """Counts of training n-grams and of the words before them, in one table."""

    n: int
    counts: DataFrame  # (term, c)
    n_words: int  # distinct training words
    n_tokens: int

    @classmethod
    def fit(cls, train: DataFrame, col: str, n: int = 1, path: str | None = None) -> "NgramModel":
        """Count once into a table; scoring any number of texts then reads the table.

        Each batch of texts sends a term once with its count. Nearly all bigrams are rare, so the rest is counted after
        the shuffle: a table of all terms of a task would outgrow its memory, which costs a sort of them.
        """
        if n not in (1, 2):
            raise ValueError("n must be 1 or 2")
        path = path or scratch_path(train.sparkSession, "ngrams")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield gram_counts(batch.column(0), n)

        terms = train.select(F.lower(F.col(col)).alias("text")).mapInArrow(count, "term string, c bigint")
        terms.repartition("term").groupBy("term").agg(F.sum("c").alias("c")).write.parquet(path)
        counts = train.sparkSession.read.parquet(path)
        words = counts
        if n == 2:  # a word is counted as often as it ends a bigram
            last = F.substring_index("term", GRAM_SEPARATOR, -1)
            words = counts.where(~_is_context(n)).groupBy(last.alias("word")).agg(F.sum("c").alias("c"))
        size = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
        return cls(n, counts, size[0], size[1])


def ngram_loss(
    model: NgramModel,
    test: DataFrame,
    col: str,
    add_k: float = 1.0,
    max_tokens: int | None = None,
) -> DataFrame:
    """``(row_id, loss)``: mean ``-ln((c + k) / (context + k (V + 1)))`` over a test text's n-grams.

    V counts the training words and 1 stands for all unseen ones. Texts are read whole unless
    ``max_tokens`` sets a window. The logarithm of a fraction is a difference, so a text's n-grams and their contexts
    look up their counts in one join, each term for itself; the test side crosses the network once before
    its sums. Terms that the model's own counts show as hot are salted, AQE splits others.
    """
    terms = _terms(test, col, model.n, ["row_id"], max_tokens)
    total = F.lit(model.n_tokens * model.n)
    hot = heavy_of(model.counts, "term", "c", total)
    spread_by = F.struct("row_id", "place")  # a text may repeat one term
    met = salted_join(terms, model.counts, "term", spread_by, "left", hot)
    count = F.coalesce(F.col("c"), F.lit(0))
    beyond = add_k * (model.n_words + 1)
    context = _is_context(model.n)
    nll = F.when(context, F.log(count + beyond)).otherwise(-F.log(count + add_k))
    alone = F.lit(0.0) if model.n == 2 else F.log(F.lit(model.n_tokens + beyond))  # the same context for all
    summed = met.groupBy("row_id").agg((F.sum(nll) / F.count_if(~context)).alias("loss"))
    return summed.withColumn("loss", F.col("loss") + alone)
