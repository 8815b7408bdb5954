"""Quantiles without a map of values; large vocabularies split by frequency."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import profiling, sequences


@pytest.mark.parametrize("kind", ["distinct", "copies", "two", "wide", "one", "few"])
def test_quantiles_equal_sorting(spark, kind, monkeypatch):
    monkeypatch.setattr(profiling, "GRID", 50)
    rng = np.random.default_rng(8)
    values = {
        "distinct": rng.standard_normal(20_000),
        "copies": np.round(rng.standard_normal(20_000), 1),
        "two": np.where(np.arange(20_000) % 3 == 0, 1.5, -2.0),
        "wide": np.exp(rng.standard_normal(20_000) * 100),
        "one": np.full(5000, 7.25),
        "few": np.array([3.0, 1.0, 2.0, 10.0]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 10, "v double").repartition(7)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    for held in (4, 1000):
        found = profiling.exact_quantiles(df, "v", shares, held)
        np.testing.assert_allclose(found, np.quantile(values, shares), rtol=1e-12)


def test_many_distinct_numbers(spark):
    n = 2_000_000
    df = spark.range(n, numPartitions=8).select((F.pmod(F.col("id") * 1_000_003, F.lit(n)) / 7).alias("v"))
    row = profiling.describe_numeric(df, "v").first()
    assert row["count"] == n
    np.testing.assert_allclose([row["p25"], row["p50"], row["p75"]], np.array([0.25, 0.5, 0.75]) * (n - 1) / 7)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert profiling.exact_quantiles(df, "v", [0.5]) == [None]
    assert profiling.describe_numeric(df, "v").first()["p50"] is None


@pytest.mark.parametrize("limit", [0, 60, 400])
def test_both_ways_to_encode_agree(spark, limit):
    rng = random.Random(1)
    words = [f"t{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words[: rng.choice([5, 300])]) for _ in range(rng.randrange(12))) for _ in range(200)]
    texts += [None, "", "unseen t1 unseen", "t1 " * 500, texts[3]]
    rows = [(None if i % 17 == 0 else i % 90, t, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "row_id bigint, prompt string, nr int").withColumn("token", F.lit("clash"))
    vocab = sequences.build_vocab(df.where("nr < 150"), "prompt")
    shown = ["nr", "row_id", "input_ids", "attention_mask", "labels"]
    whole = sequences.encode(df, "prompt", vocab, 8).select(*shown)
    parted = sequences.encode(df, "prompt", vocab, 8, broadcast_bytes=limit).select(*shown)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, parted.collect()), key=repr)
    assert whole.count() == len(rows)
