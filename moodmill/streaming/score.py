"""Score new texts as files arrive, with a fitted model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def score_stream(
    texts: DataFrame,
    score_batch: Callable[[DataFrame], DataFrame],
    out_path: str,
    checkpoint_path: str,
) -> StreamingQuery:
    """Run ``score_batch`` on every micro-batch and store its rows under ``out_path``."""
    return store_batches(texts, lambda batch, _: score_batch(batch), out_path, checkpoint_path)


def store_batches(
    rows: DataFrame,
    make: Callable[[DataFrame, int], DataFrame],
    out_path: str,
    checkpoint_path: str,
) -> StreamingQuery:
    """Store what ``make`` gives for every micro-batch and its number.

    Each batch overwrites a folder named by its number, so that a batch repeated after a
    failure leaves one copy.
    """

    def write(batch: DataFrame, number: int) -> None:
        make(batch, number).write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
