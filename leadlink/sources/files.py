"""CSV stages, file discovery, progress tables and the key=value run manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as P

from leadlink.operators.keyed import number_within


def read_csv(spark: SparkSession, path: str, columns: list[str], multi_line: bool = True) -> DataFrame:
    """All-string CSV with a header; a byte-order mark is dropped, missing text is "".

    Quoted line breaks are understood by default, at the price of one task per file; turn
    `multi_line` off for very large files without them, which are then split.
    """
    schema = P.StructType([P.StructField(c, P.StringType()) for c in columns])
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", multi_line)
        .option("escape", '"').option("encoding", "UTF-8").csv(path).na.fill("")
    )


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, file, modified of every file below a folder (contents are not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file"), F.col("modificationTime").alias("modified")
    )


def matching(files: DataFrame, keywords: list[str], without: str = "_backup") -> DataFrame:
    """CSV files whose name has any keyword and not the excluded mark, newest first."""
    name = F.lower("file")
    any_kw = F.exists(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(name, k))
    keep = F.endswith(name, F.lit(".csv")) & any_kw & ~F.contains(name, F.lit(without))
    return files.where(keep).orderBy(F.desc("modified"), "path")


def listing_inputs(files: DataFrame) -> DataFrame:
    """Raw listing files only, by name."""
    bad = F.col("file").rlike("_enrichi|_checkpoint|_backup")
    return files.where(F.startswith("file", F.lit("pj_")) & F.endswith("file", F.lit(".csv")) & ~bad).orderBy("file")


def newest(files: DataFrame) -> DataFrame:
    return files.agg(F.max_by("path", F.struct("modified", "path")).alias("path"))


def read_progress(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Progress table; empty with the stage schema when it is absent."""
    ddl = P.StructType.fromDDL(schema)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)


# --- manifest --------------------------------------------------------------------

MANIFEST_KEYS = ["SECTEUR", "BATCH_DIR", "DATE", "PROFILS", "NAF_ATTENDUS", "PJ_ENRICHED_FILE", "LBA_LBB_FILE"]
MANIFEST_REQUIRED = 3


def parse_manifest(lines: DataFrame, by: list[str]) -> DataFrame:
    """Lines (by..., version, value) -> (by..., key, value): split on the first "=", last line wins."""
    kv = F.split("value", "=", 2)
    rows = lines.where(F.contains("value", F.lit("="))).select(
        *by, "version", F.trim(kv[0]).alias("key"), F.trim(kv[1]).alias("value")
    )
    return rows.groupBy(*by, "key").agg(F.max_by("value", "version").alias("value"))


def valid_manifests(entries: DataFrame, by: list[str]) -> DataFrame:
    """Only manifests that name a batch folder."""
    return entries.join(entries.where("key = 'BATCH_DIR'").select(*by).distinct(), by, "left_semi")


def upsert_manifest(entries: DataFrame, updates: DataFrame, by: list[str]) -> DataFrame:
    """New values per key (upper-cased) without losing the other keys."""
    old = entries.withColumn("_v", F.lit(0))
    new = updates.withColumn("key", F.upper("key")).withColumn("_v", F.lit(1))
    return old.unionByName(new).groupBy(*by, "key").agg(F.max_by("value", "_v").alias("value"))


def manifest_entries(runs: DataFrame, by: list[str]) -> DataFrame:
    """Run columns -> entries; optional keys only when they hold something."""
    pairs = [
        F.when(F.lit(i < MANIFEST_REQUIRED) | (F.coalesce(F.col(k.lower()), F.lit("")) != ""),
               F.struct(F.lit(k).alias("key"), F.coalesce(F.col(k.lower()), F.lit("")).alias("value")))
        for i, k in enumerate(MANIFEST_KEYS)
    ]
    kept = F.filter(F.array(*pairs), lambda p: p.isNotNull())
    return runs.select(*by, F.explode(kept).alias("_e")).select(*by, "_e.key", "_e.value")


def resolve_input(runs: DataFrame, files: DataFrame, scope: str) -> DataFrame:
    """Requested path, else the manifest's path if it exists, else the newest match of the scope."""
    known = files.select(F.col("path").alias("manifest_path"), F.lit(True).alias("_exists")).distinct()
    latest = files.groupBy(scope).agg(F.max_by("path", F.struct("modified", "path")).alias("_newest"))
    j = runs.join(known, "manifest_path", "left").join(latest, scope, "left")
    ok = F.when(F.col("_exists"), F.col("manifest_path"))
    how = F.when(F.coalesce("requested_path", F.lit("")) != "", "requested").when(ok.isNotNull(), "manifest").when(
        F.col("_newest").isNotNull(), "newest").otherwise("none")
    path = F.coalesce(F.when(F.col("requested_path") != "", F.col("requested_path")), ok, "_newest")
    return j.select(*[c for c in runs.columns if c != "manifest_path"], path.alias("path"), how.alias("resolved_by"))


def next_batch(folders: DataFrame, by: list[str], name: str = "folder") -> DataFrame:
    """Next batch number per sector, in 38 digits: the highest batch_N plus one, 1 when there is none."""
    n = F.regexp_extract(name, "^batch_([0-9]+)$", 1).try_cast("decimal(38,0)")
    return folders.groupBy(*by).agg((F.coalesce(F.max(n), F.lit(0)) + 1).alias("next_batch"))


def numbered(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Progress marks "[i/n]" inside each group."""
    return number_within(df, by, order).select(*df.columns, F.format_string("[%d/%d]", "i", "n").alias("progress"))
