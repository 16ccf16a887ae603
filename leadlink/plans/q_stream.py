"""Queries: the event table as an arriving stream, run once over everything there."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from leadlink.plans.inputs import table
from leadlink.plans.registry import query
from leadlink.session import fresh_path
from leadlink.streaming import jobs, state

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def _events(spark, sf):
    return jobs.file_stream(spark, sf, "events.parquet", EVENTS)


@query("stream_first_seen", "SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark, sf):
    path = fresh_path(spark, "first-seen")
    firsts = jobs.first_seen(_events(spark, sf), ["user_id", "event_type"])
    jobs.append_run(firsts, path, fresh_path(spark, "ckpt")).awaitTermination()
    return spark.read.parquet(path).select("user_id", "event_type")


def _arrivals(spark, sf):
    """Events in four arrivals in time order, a tenth of the rows twice in theirs and a ninth again, an hour late, in the next;
    then an arrival of new rows from the first quarter, far behind the watermark."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    edge = [low + (high - low) * k / 4 for k in range(4)]
    rows = events.withColumn("q", sum((F.col("ts") >= F.lit(e)).cast("int") for e in edge[1:]))
    for n in range(4):
        own = rows.where(F.col("q") == n)
        recent = rows.where((F.col("q") == n - 1) & (F.col("event_id") % 9 == 0) & (F.col("ts") > F.lit(edge[n] - timedelta(days=1))))
        yield own.unionByName(own.where("event_id % 10 = 0")).unionByName(recent.withColumn("ts", F.expr("ts + interval 1 hour"))).drop("q")
    yield rows.where("q = 0").withColumn("event_id", F.col("event_id") + 1_000_000_000).drop("q")


@query("stream_first_seen_bounded", "SELECT DISTINCT event_id, user_id FROM events")
def stream_first_seen_bounded(spark, sf):
    """Repeated rows go, rows behind the watermark go, and a key is forgotten after two days. The job runs once per arrival,
    over as many files as the arrival has, and goes on from its checkpoint."""
    folder, path, checkpoint = (fresh_path(spark, k) for k in ("arriving", "first-seen-bounded", "ckpt"))
    for part in _arrivals(spark, sf):
        part.write.mode("append").parquet(folder)
        stream = jobs.file_stream(spark, folder, "*.parquet", "event_id bigint, ts timestamp, user_id bigint")
        jobs.append_run(jobs.first_seen(stream, ["event_id"], "ts", "2 days"), path, checkpoint).awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id")


@query("stream_first_ordered", """
  SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL""")
def stream_first_ordered(spark, sf):
    """The first event of each user and type by number, although later numbers arrive first, in two runs of one job."""
    folder, path, checkpoint = (fresh_path(spark, k) for k in ("unordered", "first-ordered", "ckpt"))
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    for odd in (1, 0):
        events.where(F.col("event_id") % 2 == odd).write.mode("append").parquet(folder)
        stream = jobs.file_stream(spark, folder, "*.parquet", "event_id bigint, ts timestamp, user_id bigint, event_type string, value double")
        jobs.first_ordered_job(stream, ["user_id", "event_type"], "event_id", "ts", "3650 days", path, checkpoint).awaitTermination()
    handed_on = spark.read.parquet(path).drop("batch_id")
    return state.firsts_of(handed_on, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id", "value")


@query("stream_counts", "SELECT event_type, CAST(user_id % 7 AS BIGINT) AS city, count(*) AS n FROM events GROUP BY ALL")
def stream_counts(spark, sf):
    path = fresh_path(spark, "counts")
    rows = _events(spark, sf).withColumn("city", F.col("user_id") % 7)
    jobs.running_counts(rows, ["event_type", "city"], path, fresh_path(spark, "ckpt")).awaitTermination()
    return jobs.latest_counts(spark, path, ["event_type", "city"])


@query("stream_resume", """
  SELECT event_id, event_type AS name, CAST(user_id AS VARCHAR) AS cp, CASE WHEN user_id % 3 = 0 THEN 'earlier run' ELSE 'this run' END AS origin
  FROM events WHERE user_id % 3 <> 0
  UNION ALL SELECT event_id, event_type, CAST(user_id AS VARCHAR), 'earlier run' FROM events WHERE user_id % 3 = 0""")
def stream_resume(spark, sf):
    """Keys an earlier run has answered are not processed again."""
    progress = fresh_path(spark, "progress")
    schema = "event_id bigint, name string, cp string, origin string, seq bigint"
    cols = [F.col("event_id"), F.col("event_type").alias("name"), F.col("user_id").cast("string").alias("cp")]
    earlier = table(spark, sf, "events").where("user_id % 3 = 0").select(*cols, F.lit("earlier run").alias("origin"), F.lit(-1).cast("bigint").alias("seq"))
    earlier.write.mode("overwrite").parquet(f"{progress}/run=earlier/batch=-1")
    stream = _events(spark, sf).select(*cols)
    work = lambda todo: todo.withColumn("origin", F.lit("this run"))
    jobs.resume_job(stream, work, progress, schema, fresh_path(spark, "ckpt")).awaitTermination()
    return spark.read.schema(schema).parquet(progress).select("event_id", "name", "cp", "origin")
