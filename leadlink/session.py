"""Where a job may write intermediate tables, and how it cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a fresh local one only where none is set."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="leadlink-")
        spark.conf.set("spark.checkpoint.dir", named)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like `cut`, for loops of many rounds: a checkpoint keeps the constraints that the optimizer has inferred, which can
    multiply from round to round; a table that is written and read again has none."""
    path = fresh_path(df.sparkSession, "round")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_side(df: DataFrame) -> DataFrame:
    """A side of a join that is never broadcast: the optimizer judges names, keys and ids by the small files they come from,
    and would send tables that grow with the input through the driver."""
    return df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """Even partitions for rows whose processing costs far more than their size suggests."""
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(shuffles, df.sparkSession.sparkContext.defaultParallelism))


def fill(df: DataFrame) -> DataFrame:
    """Costly rows of a scan with fewer splits than there are cores are dealt over all cores; a larger scan stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
