"""Incremental collection as Structured Streaming jobs over arriving files."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadlink.sources.files import read_progress
from leadlink.streaming import state


def file_stream(spark: SparkSession, folder: str, pattern: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(folder)


def first_seen(stream: DataFrame, keys: list[str], event_time: str | None = None, keep_for: str | None = None) -> DataFrame:
    """One row per key as rows arrive.

    By default a key is remembered for ever, as a plain set would. With an event time and a
    retention, memory is bounded and a duplicate later than that is kept again.
    """
    if event_time and keep_for:
        return stream.withWatermark(event_time, keep_for).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def append_run(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append sink: every micro-batch adds files; run once over what is there."""
    return (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def running_counts(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Running totals; each micro-batch writes the totals that changed under its batch number."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.groupBy(*keys).count().writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_counts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Last written total of every key."""
    return spark.read.parquet(path).groupBy(*keys).agg(F.max_by("count", "batch_id").alias("n"))


def resume_job(stream: DataFrame, process, progress: str, progress_schema: str, checkpoint: str) -> StreamingQuery:
    """Process only rows whose (lower name, postal code) is not in the progress table yet.

    `process` maps the rows to do onto progress rows, stamped with the batch number as `seq`. The progress of other runs
    fills the state of a new checkpoint once; from then on the state alone says what is done. Rows are written
    under the run (one per checkpoint) and the batch number, so a batch replayed after a failure overwrites its own output.
    What another run adds to the progress table later is not seen by a checkpoint that has begun.
    """
    run = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    spark = stream.sparkSession
    earlier = read_progress(spark, progress, progress_schema + ", run string, batch int").where(F.col("run") != run)

    def step(batch: DataFrame, batch_id: int) -> None:
        stamped = process(batch).withColumn("seq", F.lit(batch_id).cast("bigint"))
        stamped.write.mode("overwrite").parquet(f"{progress}/run={run}/batch={batch_id}")

    with state.keyed_store(spark):
        return (
            state.unanswered(stream, earlier).writeStream.outputMode("append").foreachBatch(step)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )


def first_ordered_job(stream: DataFrame, keys: list[str], order: str, event_time: str, keep_for: str, path: str, checkpoint: str) -> StreamingQuery:
    """First row of each key by order, with bounded memory; `state.firsts_of` reads the result from what is written."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    with state.keyed_store(stream.sparkSession):
        return (
            state.first_by_order(stream, keys, order, event_time, keep_for).writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
