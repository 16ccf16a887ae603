"""Keyed state that Spark keeps between micro-batches: which keys are answered, and the first row of each key.

Both processors hold one small value per key. Rows of a key that carries much of a batch are reduced inside each task before
the shuffle where that is possible (`first_by_order`); where every row must pass (`unanswered`) they stream through one
at a time and are never gathered.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_store(spark: SparkSession):
    """The state store that keyed processors need, set while a query starts; the session's own setting comes back after."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def work_key(name: Column, cp: Column) -> list[Column]:
    """The key of a work row: lower-case name and postal code, nulls told apart from blank text."""
    return [F.lower(name).alias("_n"), cp.alias("_cp")]


class Unanswered(StatefulProcessor):
    """Passes the rows of a key on in the first micro-batch that has the key, unless an earlier run answered it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.done = handle.getValueState("done", "done boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.done.update((True,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        # A batch hands all its rows of a key over in one call, so the mark stands for earlier batches only.
        if self.done.exists():
            return
        self.done.update((True,))
        for row in rows:
            yield Row(**{k: v for k, v in row.asDict(recursive=False).items() if k not in ("_n", "_cp")})

    def close(self) -> None:
        pass


def unanswered(stream: DataFrame, progress: DataFrame | None) -> DataFrame:
    """Rows whose (lower name, postal code) neither `progress` nor an earlier micro-batch has.

    `progress` fills the state once, before the first batch; later batches read nothing of it. Rows of one key in
    one batch stay together, as in a loop over a work list. A null name or code is a key of its own.
    """
    keyed = stream.select("*", *work_key(F.col("name"), F.col("cp")))
    known = None
    if progress is not None:
        known = progress.select(*work_key(F.col("name"), F.col("cp"))).distinct().groupBy("_n", "_cp")
    return keyed.groupBy("_n", "_cp").transformWithState(
        statefulProcessor=Unanswered(), outputStructType=stream.schema, outputMode="append", timeMode="None", initialState=known)


class FirstByOrder(StatefulProcessor):
    """Hands a row on whenever it comes before all rows of its key so far; forgets a key some time after its last row."""

    def __init__(self, order: str, order_type: str, keep_ms: int) -> None:
        self.order, self.order_type, self.keep_ms = order, order_type, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.least = handle.getValueState("least", f"least {self.order_type}, until bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self.least.get() if self.least.exists() else None
        floor, until = (held[0], held[1]) if held else (None, None)
        best, last = None, until
        for row in rows:
            end = int(row["_ms"]) + self.keep_ms
            last = end if last is None or end > last else last
            if (floor is None or row[self.order] < floor) and (best is None or row[self.order] < best[self.order]):
                best = row
        if last != until:
            if until is not None:
                self.handle.deleteTimer(until)
            self.handle.registerTimer(last)
        if best is not None:
            floor = best[self.order]
        self.least.update((floor, last))
        if best is not None:
            yield Row(**{k: v for k, v in best.asDict(recursive=False).items() if k not in ("_at", "_ms")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        self.least.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_by_order(stream: DataFrame, keys: list[str], order: str, time: str, keep_for: str) -> DataFrame:
    """The first row of each key by `order`, whatever order rows arrive in; state is bounded by `keep_for`.

    A key's row is handed on when it is met, and again when a row that comes before it arrives later; `firsts_of` keeps the
    least of what was handed on. A row behind the watermark is left out, unless one Arrow batch holds it and a newer row of
    its key. `keep_for` (say "2 days") is both the lateness a row may have and the time, counted from its
    last row, after which a key is forgotten; a row that comes after that opens the key anew. `order` and `time` are not null;
    rows where one is are left out, as they have no place in the order.
    """
    seconds = stream.sparkSession.sql(f"SELECT CAST(CAST(INTERVAL {keep_for} AS INTERVAL DAY TO SECOND) AS INTERVAL SECOND) AS s").first()[0].total_seconds()
    rows = stream.where(F.col(order).isNotNull() & F.col(time).isNotNull()).withColumn("_at", F.col(time).cast("timestamp"))
    rows = _least_per_chunk(rows, keys, order).withColumn("_ms", F.unix_millis("_at")).withWatermark("_at", keep_for)
    processor = FirstByOrder(order, stream.schema[order].dataType.simpleString(), int(seconds * 1000))
    return rows.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=stream.schema, outputMode="update", timeMode="EventTime")


def _least_per_chunk(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key in every Arrow batch, `_at` the latest time there: a key on a third of the rows reaches
    the task that holds its state as one row per batch."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t.take(pc.sort_indices(t, sort_keys=[(order, "ascending")]))
            numbered = t.select([*keys, "_at"]).append_column("_i", pa.array(range(t.num_rows), pa.int64()))
            g = numbered.group_by(keys, use_threads=False).aggregate([("_i", "min"), ("_at", "max")])
            least = t.take(g["_i_min"])
            yield from least.set_column(least.schema.get_field_index("_at"), batch.schema.field("_at"), g["_at_max"]).to_batches()

    return rows.mapInArrow(reduce, rows.schema)


def firsts_of(handed_on: DataFrame, keys: list[str], order: str) -> DataFrame:
    """What `first_by_order` has handed on so far -> one row per key, the least by `order`."""
    cols = [c for c in handed_on.columns if c not in keys]
    g = handed_on.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in cols])
    return g.select(*handed_on.columns)
