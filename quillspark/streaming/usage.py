"""Structured Streaming over usage records: the same expressions as in batch.

A stream reads a folder to which a collector writes; the checkpoint folder owns its
progress. Records older than the watermark are late and dropped; without a watermark
duplicates are remembered for ever, which is the unbounded form.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.session import shared_dir


def windowed(events: DataFrame, size: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """(window, event_type, n, total) of tumbling, or with ``slide`` sliding, windows. Works on both kinds of DataFrame."""
    rows = events.withWatermark("ts", late) if late and events.isStreaming else events
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return rows.groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def gap_sessions(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """(session_window, user_id, n, total): sessions that end after a gap without events."""
    rows = events.withWatermark("ts", late) if late and events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def deduplicated(records: DataFrame, key: str, late: str | None = "1 day") -> DataFrame:
    """The first record of each key within the watermark; records without a key all pass."""
    keyed, free = records.where(F.col(key).isNotNull()), records.where(F.col(key).isNull())
    if records.isStreaming and late:
        keyed = keyed.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])
        free = free.withWatermark("ts", late)
    else:
        keyed = keyed.dropDuplicates([key])
    return keyed.unionByName(free)


def running_totals(records: DataFrame) -> DataFrame:
    """(grp, model, tokens_in, tokens_out, first_ts, last_ts): the state a collector shows after each batch."""
    return records.groupBy("grp", "model").agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """The files of a folder as a stream; of a table that is one file, the file, through its folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())


def snapshot_sink(rows: DataFrame, out: str, checkpoint: str, mode: str = "update"):
    """Writes every batch's changed groups under ``out``; a batch that is repeated overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()


def replayed(spark: SparkSession, path: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``build``, an aggregate over a stream, shows once all of a table has gone through the streaming engine."""
    place = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = event_stream(spark, path, spark.read.parquet(path).schema)
    snapshot_sink(build(events), f"{place}/out", f"{place}/state", "complete").awaitTermination()
    last = spark.read.parquet(f"{place}/out")
    newest = last.agg(F.max("batch")).first()[0]
    return last.where(F.col("batch") == newest).drop("batch")
