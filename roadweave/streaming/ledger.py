"""The ledger as a stream: each micro-batch is a pass that is merged into the canonical anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from roadweave.operators.dedup import level1, level2


def follow(observations: DataFrame, path: str, checkpoint: str, order: list[str], once: bool = True) -> StreamingQuery:
    """Folds every batch and writes the next ledger version ``path/v=<batch>``; a replayed batch rewrites its own version."""

    def merge(batch: DataFrame, number: int) -> None:
        new = level1(batch, order).drop("track_id")
        spark = batch.sparkSession
        merged = new if number == 0 else level2(spark.read.parquet(f"{path}/v={number - 1}"), new)
        merged.write.mode("overwrite").parquet(f"{path}/v={number}")

    writer = observations.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
