"""Readings as they arrive: a file source, late data behind a watermark, and features kept fresh.

The batch pipeline needs none of this; it serves tables that are appended to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_summary(stream: DataFrame, *, ts: str, by: list[str], value: str, width: str, lateness: str) -> DataFrame:
    """Tumbling-window count, mean and extremes per key; a window closes when the watermark passes its end."""
    rows = stream.withWatermark(ts, lateness).groupBy(F.window(ts, width), *by)
    out = rows.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"))
    return out.select(*by, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", "mean", "low", "high")


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Takes in all that is there, appends the closed windows to path and stops; a later run goes on from the checkpoint."""
    stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def refresh_touched(stream: DataFrame, *, history: Callable[[], DataFrame], key: str, features: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Recomputes the features of the keys in each micro-batch over their whole history and writes them to path/batch=N.

    A batch that is run again overwrites its own folder, so the output has each batch once.
    """

    def step(batch: DataFrame, number: int) -> None:
        keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
        features(history().join(keys, key, "left_semi")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
