"""Continuous request scoring with the batch functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vitrine.plans.jobs import Generator, recommend
from vitrine.sources.requests import parse_requests, to_response


def score_stream(
    requests: DataFrame,
    index: DataFrame,
    model,
    sink: str,
    checkpoint: str,
    generate: Generator | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score a stream of ``(query_id, body)`` JSON requests.

    Responses go to ``sink/responses``, refused requests to ``sink/rejected``. Each micro-batch overwrites
    its own ``batch_id`` folder, so a batch replayed after a failure replaces its rows and does not
    double them. No state is kept between batches.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            accepted, rejected = parse_requests(batch)
            answered = to_response(recommend(accepted, index, model, generate))
            folder = f"batch_id={batch_id}"
            answered.write.mode("overwrite").parquet(f"{sink}/responses/{folder}")
            rejected.write.mode("overwrite").parquet(f"{sink}/rejected/{folder}")
        finally:
            batch.unpersist()

    return (
        requests.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
