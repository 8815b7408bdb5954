"""Vocabulary and fixed-length token sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vitrine.functions import fixed
from vitrine.functions.text import ws_tokens
from vitrine.operators.numbering import number_rows
from vitrine.session import materialize

BROADCAST_BYTES = 16 << 20  # a worker's dictionary of as many bytes of tokens takes ten times that
IDS = T.ArrayType(T.IntegerType())
MISSED = -1


def prompts_only(df: DataFrame) -> DataFrame:
    return df.select("row_id", "prompt")


def sequence_tokens(text: Column) -> Column:
    return ws_tokens(F.lower(text))


def build_vocab(df: DataFrame, col: str, max_size: int | None = None) -> DataFrame:
    """``(token, id, count)`` of all tokens, ids from 2 (0 pad, 1 unknown), the most frequent first.

    ``max_size`` keeps that many of them. Counting combines on the map side, numbering goes range by range.
    """
    counted = (
        df.select(F.explode(sequence_tokens(F.col(col))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    first = fixed.UNKNOWN_ID + 1
    numbered = number_rows(counted, [F.desc("count"), F.col("token")], "id", first)
    if max_size is not None:
        numbered = numbered.where(F.col("id") < first + max_size)
    return numbered.select("token", F.col("id").cast("int").alias("id"), "count")


def encode(
    df: DataFrame,
    col: str,
    vocab: DataFrame,
    max_length: int = fixed.SEQUENCE_LENGTH,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds ``input_ids``, ``attention_mask`` and ``labels``, each of exactly ``max_length`` numbers.

    Longer texts are truncated, shorter ones padded on the right; labels are the ids including padding.
    The most frequent tokens, ``broadcast_bytes`` of them at most, are looked up inside the row. If the vocabulary has more, the
    tokens that are not among them meet the rest in a join, by a key that each row gets here; such rows are written once
    for that. The result is the same, whether ``row_id`` is unique or not.
    """
    tokens = F.slice(sequence_tokens(F.col(col)), 1, max_length)
    words = vocab.select("token", "id")
    size = words.agg(F.sum(_bytes())).first()[0] or 0
    if size <= broadcast_bytes:
        coded = df.withColumn("__ids", _known_ids(df.sparkSession, tokens, words.toArrow(), fixed.UNKNOWN_ID))
    else:
        coded = _split_ids(df, tokens, words, broadcast_bytes)
    missing = F.lit(max_length) - F.size("__ids")
    return coded.withColumns(
        {
            "input_ids": F.concat("__ids", F.array_repeat(F.lit(fixed.PAD_ID), missing)),
            "attention_mask": F.concat(
                F.array_repeat(F.lit(1), F.size("__ids")), F.array_repeat(F.lit(0), missing)
            ),
            "labels": F.concat("__ids", F.array_repeat(F.lit(fixed.PAD_ID), missing)),
        }
    ).drop("__ids")


def _bytes() -> Column:
    return F.octet_length("token") + 12


def _known_ids(spark: SparkSession, tokens: Column, words: pa.Table, unknown: int) -> Column:
    """Ids of the tokens in ``words``; a task builds its dictionary once and asks it once for each distinct token of a batch."""
    shared = spark.sparkContext.broadcast(words)

    @F.arrow_udf(IDS)
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = dict(zip(*(shared.value.column(c).to_pylist() for c in ("token", "id")), strict=True))
        for texts in batches:
            coded = texts.flatten().dictionary_encode()
            ids = np.array([known.get(t, unknown) for t in coded.dictionary.to_pylist()], dtype=np.int32)
            sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            found = ids[coded.indices.to_numpy(zero_copy_only=False)]
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))

    return look_up(tokens)


def _split_ids(df: DataFrame, tokens: Column, words: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Frequent tokens (the small ids) by dictionary, the others by join on the token."""
    sizes = words.groupBy(F.floor(F.log2("id")).alias("level")).agg(F.sum(_bytes()).alias("bytes"))
    taken, cut = 0, fixed.UNKNOWN_ID + 1
    for row in sizes.orderBy("level").collect():  # one row for each doubling of the ids
        taken += row["bytes"]
        if taken > broadcast_bytes:
            break
        cut = 2 ** (int(row["level"]) + 1)
    frequent, rare = words.where(F.col("id") < cut), words.where(F.col("id") >= cut)
    coded = df.withColumn("__ids", _known_ids(df.sparkSession, tokens, frequent.toArrow(), MISSED))
    keyed = materialize(coded.withColumn("__key", F.monotonically_increasing_id()), "token-ids")
    missed = F.filter(F.arrays_zip("__ids", tokens.alias("token"), F.sequence(F.lit(1), F.size("__ids")).alias("pos")),
                      lambda t: t["__ids"] == MISSED)
    rows = keyed.where(F.array_contains("__ids", MISSED))
    placed = rows.select("__key", F.inline(missed).alias("__ids", "token", "pos")).drop("__ids")
    entries = placed.join(rare, "token").groupBy("__key").agg(  # at most max_length tokens per text
        F.map_from_entries(F.collect_list(F.struct("pos", "id"))).alias("__rare")
    )
    found = lambda i, at: F.coalesce(F.try_element_at("__rare", at + 1), F.lit(fixed.UNKNOWN_ID))
    ids = F.transform("__ids", lambda i, at: F.when(i == MISSED, found(i, at)).otherwise(i))
    return keyed.join(entries, "__key", "left").withColumn("__ids", ids).drop("__key", "__rare")
