"""Event-time twin of the period counters for a live step log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.monitor import period_aggregates, with_rates


def windowed(steps: DataFrame, devices: int, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counters per event-time window; works on batch and streaming input (column ts)."""
    source = steps.withWatermark("ts", late) if steps.isStreaming else steps
    grouped = source.groupBy(F.window("ts", window).alias("w")).agg(*period_aggregates())
    return with_rates(grouped, devices).withColumn("period_start", F.col("w.start")).drop("w")


def start(steps: DataFrame, devices: int, table: str, checkpoint: str, window: str = "1 hour",
          late: str = "10 minutes") -> StreamingQuery:
    """Keep a table of all windows current, open ones included.

    Each trigger rewrites only the windows it changed, each in a partition folder of its own, so a repeated
    batch writes the same rows again; windows that the watermark has passed leave the state.
    """
    def replace(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period_start").parquet(table)

    return (windowed(steps, devices, window, late).writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint).foreachBatch(replace).trigger(availableNow=True).start())
