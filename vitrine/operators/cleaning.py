"""Row cleaning, feature columns and keep-first deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window, functions as F

from vitrine.functions import fixed
from vitrine.functions.lists import extract_colors, parse_list
from vitrine.functions.text import clean_text, lower_strip, remove_stopwords, word_count


def select_raw(df: DataFrame) -> DataFrame:
    """The row id and the three raw columns; the scan reads nothing else."""
    return df.select("row_id", *fixed.RAW_COLUMNS)


def null_sentinels(
    df: DataFrame, cols: list[str] | None = None, sentinel: str = fixed.EMPTY_LIST
) -> DataFrame:
    cols = fixed.RAW_COLUMNS if cols is None else cols
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in cols})


def drop_missing_descriptions(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["fulldescription"])


def fill_missing_colors(df: DataFrame) -> DataFrame:
    return df.na.fill({"colorname": fixed.UNKNOWN})


def basic_cleaning(df: DataFrame) -> DataFrame:
    return fill_missing_colors(drop_missing_descriptions(null_sentinels(select_raw(df))))


def parse_columns(df: DataFrame) -> DataFrame:
    """List cells to text; product name lower-cased and stripped."""
    return df.withColumns(
        {
            "fulldescription_clean": parse_list(F.col("fulldescription")),
            "colorname_clean": parse_list(F.col("colorname")),
            "name_clean": lower_strip(F.col("name")),
        }
    )


def clean_columns(df: DataFrame) -> DataFrame:
    """The cleaning chain on description and name, then stopword removal on the description."""
    return df.withColumns(
        {
            "fulldescription_clean": remove_stopwords(clean_text(F.col("fulldescription_clean"))),
            "name_clean": clean_text(F.col("name_clean")),
        }
    )


def keep_first(df: DataFrame, text_col: str, order_col: str = "row_id") -> DataFrame:
    """One row per distinct text: the one with the smallest ``order_col``.

    Rows meet by a 256-bit digest of the text. ``row_number() = 1`` makes Spark keep one row per
    digest in every map task before the shuffle, so a text that is copied a billion times sends one
    row per task, and the surviving rows cross the network once.
    """
    digest = "__digest"
    first = Window.partitionBy(digest).orderBy(order_col)
    return (
        df.withColumn(digest, F.sha2(F.col(text_col), 256))
        .withColumn("__nth", F.row_number().over(first))
        .where("__nth = 1")
        .drop(digest, "__nth")
    )


def add_word_count(df: DataFrame) -> DataFrame:
    return df.withColumn("desc_word_count", word_count(F.col("fulldescription_clean")))


def add_colors(df: DataFrame) -> DataFrame:
    return df.withColumn("colors_extracted", extract_colors(F.col("colorname")))


def filter_short(
    df: DataFrame, min_words: int = fixed.MIN_WORDS, observation: Observation | None = None
) -> DataFrame:
    """Keep descriptions of at least ``min_words`` words.

    ``observation`` receives ``removed`` and ``remaining`` when the result is first computed, so the
    report costs no second pass. The numbers are exact when no shuffle follows before the action.
    """
    keep = F.col("desc_word_count") >= min_words
    if observation is not None:
        df = df.observe(
            observation,
            F.count_if(~keep).alias("removed"),
            F.count_if(keep).alias("remaining"),
        )
    return df.where(keep)
