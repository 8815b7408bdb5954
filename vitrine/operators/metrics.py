"""Scores of generated text against references.

BLEU, ROUGE and the means come from one pass: n-gram overlaps are computed inside each row, and only sums
leave the tasks. Distinct-n counts n-grams over the corpus with map-side combining.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vitrine.functions import fixed
from vitrine.functions.ngrams import clipped_overlap, ngrams
from vitrine.functions.text import alnum_tokens, treebank_tokens, ws_tokens

ORDERS = [1, 2, 3, 4]


def _lcs(left, right) -> int:
    """Length of the longest common subsequence; one machine-word operation covers 64 cells."""
    where: dict = {}
    for i, token in enumerate(left):
        where[token] = where.get(token, 0) | (1 << i)
    full = free = (1 << len(left)) - 1
    for token in right:
        hit = free & where.get(token, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(left) - free.bit_count()


@F.arrow_udf(T.IntegerType())
def _lcs_length(left: pa.Array, right: pa.Array) -> pa.Array:
    both = zip(left.to_pylist(), right.to_pylist())
    return pa.array([_lcs(a, b) for a, b in both], pa.int32())


def lcs_length(left: Column, right: Column) -> Column:
    return _lcs_length(left, right)


def score_tokens(pairs: DataFrame) -> DataFrame:
    """Adds the token arrays that BLEU and ROUGE read; a missing text has no tokens."""
    ref, gen = (F.coalesce(F.col(c), F.lit("")) for c in ("reference", "generated"))
    return pairs.withColumns(
        {
            "bleu_ref": treebank_tokens(F.lower(ref)),
            "bleu_gen": treebank_tokens(F.lower(gen)),
            "rouge_ref": alnum_tokens(ref),
            "rouge_gen": alnum_tokens(gen),
        }
    )


def nonempty_references(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("reference") != "")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Adds what BLEU and ROUGE need of each pair: token numbers and overlaps, computed in the row."""
    ref, gen = F.col("bleu_ref"), F.col("bleu_gen")
    rouge_ref, rouge_gen = F.col("rouge_ref"), F.col("rouge_gen")
    return score_tokens(pairs).withColumns(
        {
            "ref_len": F.size(ref),
            "gen_len": F.size(gen),
            **{f"match_{n}": clipped_overlap(ngrams(ref, n), ngrams(gen, n)) for n in ORDERS},
            "rouge_ref_len": F.size(rouge_ref),
            "rouge_gen_len": F.size(rouge_gen),
            "common_1": clipped_overlap(rouge_ref, rouge_gen),
            "common_2": clipped_overlap(ngrams(rouge_ref, 2), ngrams(rouge_gen, 2)),
            "lcs": lcs_length(rouge_ref, rouge_gen),
        }
    )


# --- BLEU --------------------------------------------------------------------------------------


def bleu_sums() -> list[Column]:
    """Aggregates of the corpus BLEU over ``pair_counts``: lengths, clipped matches, totals."""
    sums = [F.sum("ref_len").alias("ref_len"), F.sum("gen_len").alias("gen_len")]
    for n in ORDERS:
        sums.append(F.sum(f"match_{n}").alias(f"match_{n}"))
        sums.append(F.sum(F.greatest(F.lit(1), F.col("gen_len") - n + 1)).alias(f"total_{n}"))
    return sums


def bleu_from_sums(weights: list[float]) -> Column:
    def log_precision(n: int) -> Column:
        match, total = F.col(f"match_{n}"), F.col(f"total_{n}")
        smoothed = F.when(match == 0, F.lit(fixed.BLEU_SMOOTHING)).otherwise(match)
        return F.log(smoothed / total)

    brevity = F.when(F.col("gen_len") > F.col("ref_len"), F.lit(1.0)).otherwise(
        F.exp(1 - F.col("ref_len") / F.col("gen_len"))
    )
    mean = sum((F.lit(w) * log_precision(n) for n, w in zip(ORDERS, weights)), F.lit(0.0))
    return F.when(F.coalesce(F.col("match_1"), F.lit(0)) == 0, F.lit(0.0)).otherwise(
        brevity * F.exp(mean)
    )


def corpus_bleu(pairs: DataFrame) -> DataFrame:
    """One row: the sums and a column per BLEU order."""
    scores = {
        name.lower().replace("-", "_"): bleu_from_sums(weights)
        for name, weights in fixed.BLEU_WEIGHTS.items()
    }
    return pair_counts(pairs).agg(*bleu_sums()).withColumns(scores)


# --- ROUGE -------------------------------------------------------------------------------------


def f_measure(overlap: Column, n_ref: Column, n_gen: Column) -> Column:
    precision = overlap / F.greatest(n_gen, F.lit(1))
    recall = overlap / F.greatest(n_ref, F.lit(1))
    return F.when(overlap == 0, F.lit(0.0)).otherwise(
        2 * precision * recall / (precision + recall)
    )


def rouge_n(n: int) -> Column:
    grams = lambda c: F.greatest(F.col(c) - (n - 1), F.lit(0))
    return f_measure(F.col(f"common_{n}"), grams("rouge_ref_len"), grams("rouge_gen_len"))


def rouge_l() -> Column:
    return f_measure(F.col("lcs"), F.col("rouge_ref_len"), F.col("rouge_gen_len"))


def pair_rouge(pairs: DataFrame) -> DataFrame:
    """``(pair_id, rouge_1, rouge_2, rouge_l)``."""
    return pair_counts(pairs).select(
        "pair_id",
        rouge_n(1).alias("rouge_1"),
        rouge_n(2).alias("rouge_2"),
        rouge_l().alias("rouge_l"),
    )


# --- Distinct-n, perplexity --------------------------------------------------------------------


def distinct_n(df: DataFrame, col: str, n: int) -> DataFrame:
    """One row ``(n_unique, n_total, value)``; 0 when there are no n-grams."""
    return distinct_table(df, col, [n]).drop("n")


def distinct_table(df: DataFrame, col: str, orders: list[int]) -> DataFrame:
    """``(n, n_unique, n_total, value)`` per n-gram order, all orders from one pass over the texts."""
    tokens = df.select(ws_tokens(F.lower(F.col(col))).alias("tokens"))

    def tagged(n: int) -> Column:
        entry = lambda g: F.struct(F.lit(n).alias("n"), g.alias("gram"))
        return F.transform(ngrams(F.col("tokens"), n), entry)

    counted = (
        tokens.select(F.inline(F.concat(*[tagged(n) for n in orders])))
        .groupBy("n", "gram")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    mine = lambda n: F.when(F.col("n") == n, F.col("c"))
    sums = counted.agg(
        *[F.count(mine(n)).alias(f"u{n}") for n in orders],
        *[F.coalesce(F.sum(mine(n)), F.lit(0)).alias(f"t{n}") for n in orders],
    )
    rows = [
        F.struct(
            F.lit(n).alias("n"),
            F.col(f"u{n}").alias("n_unique"),
            F.col(f"t{n}").alias("n_total"),
            F.when(F.col(f"t{n}") == 0, F.lit(0.0))
            .otherwise(F.col(f"u{n}") / F.col(f"t{n}"))
            .alias("value"),
        )
        for n in orders
    ]
    return sums.select(F.inline(F.array(*rows)))


def finite(loss: Column) -> Column:
    return F.coalesce(~F.isnan(loss) & (F.abs(loss) < F.lit(math.inf)), F.lit(False))


def perplexity(loss: Column) -> Column:
    """exp of the mean finite per-text loss; infinity when there is none."""
    return F.coalesce(F.exp(F.avg(F.when(finite(loss), loss))), F.lit(math.inf))


# --- report ------------------------------------------------------------------------------------


def metrics_report(pairs: DataFrame, losses: DataFrame | None = None) -> DataFrame:
    """``(metric, value)`` for ``(reference, generated[, gen_seconds])`` pairs and per-text losses."""
    timed = "gen_seconds" in pairs.columns
    sums = pair_counts(pairs).agg(
        *bleu_sums(),
        F.avg(rouge_n(1)).alias("ROUGE-1"),
        F.avg(rouge_n(2)).alias("ROUGE-2"),
        F.avg(rouge_l()).alias("ROUGE-L"),
        *([F.avg("gen_seconds").alias("Avg Generation Time")] if timed else []),
    )
    values = {name: bleu_from_sums(w) for name, w in fixed.BLEU_WEIGHTS.items()}
    values |= {name: F.col(f"`{name}`") for name in ["ROUGE-1", "ROUGE-2", "ROUGE-L"]}
    if timed:
        values["Avg Generation Time"] = F.col("`Avg Generation Time`")
    cells = [F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in values.items()]
    report = sums.select(F.inline(F.array(*cells)))
    shares = distinct_table(pairs, "generated", [1, 2])
    label = F.concat(F.lit("Distinct-"), F.col("n"))
    report = report.unionByName(shares.select(label.alias("metric"), "value"))
    if losses is not None:
        total = losses.agg(perplexity(F.col("loss")).alias("value"))
        report = report.unionByName(total.select(F.lit("Perplexity").alias("metric"), "value"))
    return report
