"""Streams: windowed counts with late data, block statistics that arrive in parts, and sessions with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """New Parquet files of a folder or pattern, so many at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_counts(events: DataFrame, time: str, key: str, window: str, late: str) -> DataFrame:
    """(start, key, n, total): by tumbling windows. In update or append mode, as finish() has it, rows later than the watermark are dropped and so is the state of windows before it."""
    own = events.withWatermark(time, late)
    return own.groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), key, "n", "total")


def finish(stream: DataFrame, checkpoint: str, path: str, keys: tuple[str, ...]) -> DataFrame:
    """Runs what is there to its end; gives the last row of each key, from files.

    Each batch writes the rows that it changed to a folder of its own, which replaces what the batch left if it runs
    again. The checkpoint folder lets a lost run go on.
    """
    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = stream.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = stream.sparkSession.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in stream.schema)}, batch long").parquet(path)
    values = [c for c in stream.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in stream.columns])


def merge_block_stats(batch: DataFrame, batch_id: int, path: str) -> None:
    """For foreachBatch: one folder a batch, replaced if the batch runs again, so sums over the folders count each batch once."""
    sums = batch.groupBy("segment_id", "z", "y", "x").agg(F.sum("count").alias("count"))
    sums.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def block_stats(spark: SparkSession, path: str) -> DataFrame:
    """What merge_block_stats has gathered."""
    return spark.read.parquet(path).groupBy("segment_id", "z", "y", "x").agg(F.sum("count").alias("count"))


def running_totals(events: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, total) after each batch that has rows of the key, from state that is kept for it."""

    def update(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for p in parts:
            n, total = n + len(p), total + float(p[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    kind = dict(events.dtypes)[key]
    return events.select(key, F.col(value).cast("double").alias(value)).groupBy(key).applyInPandasWithState(update, f"{key} {kind}, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)
