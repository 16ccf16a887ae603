"""Small helpers that several operators share."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlink.session import fresh_path


def ship(name: str) -> None:
    """Send the functions of a module along with the tasks, so that executors need no installed copy."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship(__name__)


#: Rows of a batch that a Parquet reader fills at once, and of one that Arrow hands to Python.
TEXT_BATCHES = {"spark.sql.parquet.columnarReaderBatchSize": 512, "spark.sql.execution.arrow.maxRecordsPerBatch": 1024}


#: Parquet's reads of several ranges at once. On local disks each reading thread keeps a buffer outside the heap that is as
#: large as the largest range it has read, all texts of a row group; without them, texts are read in pieces of 8 MB.
RANGES = "parquet.hadoop.vectored.io.enabled"


def text_batches(spark: SparkSession) -> None:
    """Smaller batches in this session for rows with whole texts: at Spark's 4,096 and 10,000 rows each task holds several
    buffers of tens of MB. Smaller settings stay. All rows are read as before, only fewer at a time, and files range by range."""
    for key, rows in TEXT_BATCHES.items():
        if not 0 < int(spark.conf.get(key)) <= rows:
            spark.conf.set(key, rows)
    spark.conf.set(RANGES, "false")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and outlives any executor."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """(uid, row): every row under a number of its own, written, so that rows without an id or with equal ones are told apart."""
    return stored(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct("*").alias("row")), label)


def without(rows: DataFrame, gone: DataFrame, small: int = 1_000_000) -> DataFrame:
    """The rows of `numbered` whose uid is not in `gone` (uid), a written table; up to `small` of them are broadcast,
    which leaves the texts where they are, more are met by a shuffle."""
    side = F.broadcast(gone) if gone.count() <= small else gone.hint("shuffle_hash")
    return rows.join(side, "uid", "left_anti").select("row.*")


def per_worker(key, make):
    """One object per Python worker process, kept from task to task."""
    store = sys.modules.setdefault("leadlink_worker_store", types.ModuleType("leadlink_worker_store")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def crc_mod4(col: Column) -> Column:
    """Remainder of crc32(id as text) by 4; 2 marks a held-out row."""
    return F.crc32(col.cast("string")) % 4
