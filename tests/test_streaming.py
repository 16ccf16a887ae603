"""Streams whose memory is Spark's keyed state: resuming, and the first row of a key by order."""

from datetime import datetime

from pyspark.sql import functions as F

from leadlink.session import fresh_path
from leadlink.streaming import jobs, state

WORK = "name string, cp string"
PROGRESS = "name string, cp string, answer string, seq bigint"
SEEN = "k string, n bigint, ts timestamp, v string"


def test_resume_from_state(spark):
    """Earlier answers fill the state once; repeats inside a batch are all done, later ones are not; nulls are keys."""
    src, progress, ckpt = (fresh_path(spark, k) for k in ("in", "progress", "c"))
    spark.createDataFrame([("OLD", "1", "earlier", -1)], PROGRESS).write.parquet(f"{progress}/run=earlier/batch=-1")
    steps = [[("old", "1"), ("A", "1"), ("a", "1"), ("b", None)], [("a", "1"), ("a", "2"), ("B", None), (None, None)], [(None, None), ("", None)]]
    done = []
    for rows in steps:
        spark.createDataFrame(rows, WORK).write.mode("append").parquet(src)
        jobs.resume_job(jobs.file_stream(spark, src, "*.parquet", WORK), lambda d: d.withColumn("answer", F.lit("now")), progress, PROGRESS, ckpt).awaitTermination()
        now = spark.read.schema(PROGRESS).parquet(progress).where("answer = 'now'")
        done.append(sorted(((r.name, r.cp) for r in now.collect()), key=repr))
    first = [("A", "1"), ("a", "1"), ("b", None)]
    assert done[0] == sorted(first, key=repr)
    assert done[1] == sorted([*first, ("a", "2"), (None, None)], key=repr)
    assert done[2] == sorted([*first, ("a", "2"), (None, None), ("", None)], key=repr)


def test_resume_reads_the_progress_table_once(spark):
    """A table that another run extends while this job goes on is not read again, and a new checkpoint sees all of it."""
    src, progress, ckpt = (fresh_path(spark, k) for k in ("in", "progress", "c"))
    spark.createDataFrame([("a", "1")], WORK).write.parquet(src)
    run = lambda c: jobs.resume_job(
        jobs.file_stream(spark, src, "*.parquet", WORK), lambda d: d.withColumn("answer", F.lit("now")), progress, PROGRESS, c).awaitTermination()
    run(ckpt)
    spark.createDataFrame([("x", "1", "other", 0)], PROGRESS).write.parquet(f"{progress}/run=other/batch=0")
    spark.createDataFrame([("x", "1"), ("y", "1")], WORK).write.mode("append").parquet(src)
    run(ckpt)
    count = lambda: spark.read.schema(PROGRESS).parquet(progress).where("answer = 'now'").groupBy("name").count().collect()
    assert {r[0]: r[1] for r in count()} == {"a": 1, "x": 1, "y": 1}
    run(fresh_path(spark, "c2"))
    assert {r[0]: r[1] for r in count()} == {"a": 1, "x": 1, "y": 1}


def test_first_by_order_with_expiry(spark):
    """Order decides, not arrival; ties and rows without order or time add nothing; a key goes two days after its last row."""
    day = lambda d: datetime(2026, 1, d)
    src, path, ckpt = (fresh_path(spark, k) for k in ("in", "out", "c"))
    steps = [
        [("a", 5, day(1), "a5"), ("a", 4, day(1), "a4"), (None, 1, day(1), "null"), ("b", None, day(1), "x"), ("c", 1, None, "x")],
        [("a", 3, day(2), "a3"), ("a", 9, day(2), "a9"), ("b", 7, day(2), "b7"), ("b", 7, day(2), "b7")],
        [("z", 1, day(20), "z1")],
        [("a", 2, day(1), "late"), ("a", 8, day(21), "again")],
    ]
    held = []
    for rows in steps:
        spark.createDataFrame(rows, SEEN).repartition(3).write.mode("append").parquet(src)
        q = jobs.first_ordered_job(jobs.file_stream(spark, src, "*.parquet", SEEN), ["k"], "n", "ts", "2 days", path, ckpt)
        q.awaitTermination()
        held.append(sum(o.numRowsTotal for o in q.lastProgress.stateOperators))
    out = spark.read.parquet(path).drop("batch_id")
    first = {r.k: (r.n, r.v) for r in state.firsts_of(out, ["k"], "n").collect()}
    assert first == {"a": (3, "a3"), "b": (7, "b7"), None: (1, "null"), "z": (1, "z1")}
    assert "late" not in {r.v for r in out.collect()} and "again" in {r.v for r in out.collect()}
    assert held[2] < held[1] and held[3] <= held[1]
