"""Headline queries on ``$BENCH_SF_DIR``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from vitrine.operators import bm25, metrics, sampling, vectors  # noqa: E402
from vitrine.plans import inputs, jobs  # noqa: E402
from vitrine.session import build_session, scratch_path  # noqa: E402
from vitrine.sources.index import read_embedder, read_index  # noqa: E402
from vitrine.sources.tables import read_features  # noqa: E402


def run(df) -> None:
    """Compute every row without moving results to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.range(1000).withColumn("x", F.rand()))  # start the executors

    path = scratch_path(spark, "bench")
    requests = inputs.requests(spark, folder)
    turns = inputs.pairs(spark, folder)
    documents = inputs.documents(spark, folder)
    stored = inputs.table(spark, folder, "embeddings")
    parted = sampling.split(documents, "row_id")

    def ingest():
        jobs.ingest_catalog(inputs.raw_catalog(spark, folder), f"{path}/features")

    def features():
        return read_features(spark, f"{path}/features")

    def index():
        return read_index(spark, path), read_embedder(spark, path)

    def keyword():
        keywords = bm25.build_keyword_index(bm25.bm25_documents(index()[0]))
        run(jobs.keyword_hits(requests, index()[0], 6, keywords))

    steps = {
        "ingest_features": ingest,
        "build_index": lambda: jobs.build_index(features(), path),
        "self_knn": lambda: run(
            vectors.knn(
                stored.select(F.col("vec_id").alias("query_id"), "embedding"),
                stored.select(F.col("vec_id").alias("row_id"), "embedding"),
                5,
            )
        ),
        "recommend": lambda: run(jobs.recommend(requests, *index())),
        "keyword_search": keyword,
        "hybrid_search": lambda: run(jobs.hybrid_retrieve(requests, *index(), 5)),
        "plan_batch": lambda: run(jobs.plan_batch(requests, *index())),
        "prepare_sequences": lambda: run(jobs.prepare_sequences(jobs.prompts(features()))),
        "evaluate": lambda: run(
            jobs.evaluate(
                turns, sampling.train_rows(parted), sampling.validation_rows(parted), "text"
            )
        ),
        "distinct_bigrams": lambda: run(metrics.distinct_n(turns, "generated", 2)),
    }
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
    ingest_seconds = seconds["ingest_features"] + seconds["build_index"]
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder).removeprefix("sf"),
        "products_per_second": round(documents.count() / ingest_seconds, 1),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
