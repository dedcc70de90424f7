"""Incremental forms of the batch operators, on Structured Streaming.

Watermarks need `timestamp`, so streams cast `ts` under a UTC session. Each function takes a streaming or a batch DataFrame where that
makes sense; `run_available` drains what is there now and stops, as a scheduled job does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.quality import merge_rows


def source(spark: SparkSession, path: str, schema, *, files_per_batch: int = 100) -> DataFrame:
    """A stream of the parquet files that arrive under a path, with `ts` as an instant."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def hourly(stream: DataFrame, delay: str = "10 days", column: str = "value") -> DataFrame:
    """(ts, price): means of tumbling hours, final once the watermark has passed (T4)."""
    got = stream.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour").alias("w")).agg(F.avg(column).alias("price"))
    return got.select(F.col("w.start").alias("ts"), "price")


def trailing_mean(stream: DataFrame, hours: int = 24, delay: str = "10 days", column: str = "value") -> DataFrame:
    """(ts, mean, n): means of the hours before each full hour, as sliding windows (T5)."""
    got = stream.withWatermark("ts", delay).groupBy(F.window("ts", f"{hours} hours", "1 hour").alias("w")).agg(F.avg(column).alias("mean"), F.count("*").alias("n"))
    return got.select(F.col("w.end").alias("ts"), "mean", "n")


def revised(stream: DataFrame, keys: Sequence[str], delay: str = "10 days") -> DataFrame:
    """The first row of each key within the healing window."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def late_rows(rows: DataFrame, covered_until, delay_days: int = 10) -> tuple[DataFrame, DataFrame]:
    """Rows inside the healing window before `covered_until`, and those that are too late for it."""
    edge = covered_until - F.expr(f"INTERVAL '{delay_days}' DAY")
    return rows.where(F.col("ts") >= edge), rows.where(F.col("ts") < edge)


def append_once(path: str, keys: Sequence[str], value: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that adds rows of new keys to a parquet table and writes contradictions beside it (T3). A repeated batch changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        try:
            existing = spark.read.schema(batch.schema).parquet(path)
        except Exception as e:  # the table begins with the first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
            existing = spark.createDataFrame([], batch.schema)
        merged, conflicts = merge_rows(existing, batch, keys, value)
        new = merged.join(existing.select(*keys), list(keys), "left_anti")
        new.write.mode("append").parquet(path)
        conflicts.write.mode("append").parquet(f"{path}.conflicts")

    return write


def first_full_coverage(stream: DataFrame, key: str, expected: int, delay_days: int = 10) -> DataFrame:
    """(key, slots, complete_at): when each key has been seen at all its `expected` slots for the first time; later probes of it are not read on.

    ts is a timestamp. A key's state goes delay_days after its last probe, when the watermark has passed that.
    """
    delay_ms = delay_days * 86_400_000

    def update(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, done, newest = (set(state.get[0]), state.get[1], state.get[2]) if state.exists else (set(), None, 0)
        told = False
        for pdf in batches:
            newest = max(newest, int(pdf["ts"].max().timestamp() * 1000))
            if done is None:
                for slot, at in sorted(zip(pdf["slot"], pdf["ts"], strict=True), key=lambda x: x[1]):
                    seen.add(int(slot))
                    if len(seen) >= expected:
                        done, told = at.isoformat(), True
                        break
        state.update((sorted(seen), done, newest))
        state.setTimeoutTimestamp(max(newest + delay_ms, state.getCurrentWatermarkMs() + 1))
        if told:
            yield pd.DataFrame({key: [k[0]], "slots": [len(seen)], "complete_at": [done]})

    kind = stream.schema[key].dataType.simpleString()
    marked = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", f"{delay_days} days")
    return marked.groupBy(key).applyInPandasWithState(update, f"{key} {kind}, slots long, complete_at string", "seen array<int>, done string, newest long", "append", "EventTimeTimeout")


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append", batch: Callable[[DataFrame, int], None] | None = None) -> None:
    """Read what is there now, write it, and stop."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    w = w.foreachBatch(batch) if batch else w.format("parquet").option("path", path)
    q = w.start()
    q.awaitTermination()
