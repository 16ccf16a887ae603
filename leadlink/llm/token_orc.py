"""Token ids as ORC files: run-length encoded id lists, row indexes, Bloom filters on document ids.

Documents are range-partitioned and sorted by id before they are encoded, so every file holds one ascending id range and
ORC's file, stripe and row-group statistics prune by id; a Bloom filter on the id settles point lookups. Rows carry the
number of their file (`part`) and their token offset inside it (`at`), which makes a document's global offset the sum
of one small per-file total and `at`, without any pass over the ids.

Stripes are read in parallel: Spark's scan splits a file at stripe borders.

Defined cases: a null or empty text is a document of the end id alone; a null id sorts first; rows with equal ids are
ordered by text (null as empty) and each keeps its own ids; an empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlink.llm.bpe import coder
from leadlink.llm.common import ship, table
from leadlink.llm.registry import query
from leadlink.session import fresh_path

ship(__name__)


def _encoder(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                few = batch.slice(k, 1024)
                coded = [x + end for x in coder(path).encode(few.column("text").to_pylist())]
                sizes = np.array([len(x) // 4 for x in coded], np.int64)
                ends = np.cumsum(sizes)
                ids = np.frombuffer(b"".join(coded), np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), pa.array(np.full(len(sizes), part, np.int32)), pa.array(at + ends - sizes), pa.array(sizes), lists],
                    names=["doc_id", "part", "at", "n_tokens", "ids"],
                )
                at += int(ends[-1])

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, stripe_mb: int = 16, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode (id, text) rows into ORC files under `path`, in ascending id order."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    (
        ordered.mapInArrow(_encoder(tokenizer, end_id), f"doc_id {kind}, part int, at long, n_tokens long, ids array<int>")
        .write.option("orc.compress", "ZSTD").option("orc.create.index", "true").option("orc.row.index.stride", "1000")
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
        .option("orc.stripe.size", str(stripe_mb << 20)).orc(path)
    )


def read(spark: SparkSession, path: str, small: int = 500_000) -> DataFrame:
    """All rows with `start`, the number of ids of all documents before."""
    rows = spark.read.orc(path)
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    # One row of 16 bytes per written file; beyond `small` files the join is left to the optimizer.
    offsets = F.broadcast(parts) if len(rows.inputFiles()) <= small else parts
    return rows.join(offsets, "part").withColumn("start", F.col("base") + F.col("at")).drop("base")


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """Rows of a few document ids; statistics and Bloom filters skip the other stripes and row groups."""
    return spark.read.orc(path).where(F.col("doc_id").isin(ids))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        ids, ends = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
        crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows read back."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(_checksums, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


@query("op1_token_orc")
def op1_token_orc(spark, sf_dir):
    path = fresh_path(spark, "token-orc")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return checksums(read(spark, path))
