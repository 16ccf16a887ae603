"""First-row-per-key, mixed-key and best-row operators.

Every "first wins" has an explicit order column. Row-number filters prune inside each
map task before the shuffle (window group limit) and aggregates combine map-side, so a
key holding a third of the rows reaches its reducer as a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlink.functions import text as T
from leadlink.session import cut

PRIORITY_ORDER = {"Haute": 0, "Moyenne": 1, "Basse": 2}


def priority_rank(priority: Column) -> Column:
    out = F.lit(9)
    for name, rank in PRIORITY_ORDER.items():
        out = F.when(priority == name, rank).otherwise(out)
    return out


def first_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def load_signals(df: DataFrame) -> DataFrame:
    """Hiring signals keyed by id: the first live-offer row if any, else the first row."""
    df = df.withColumn("siret", T.normalize_siret(F.col("siret"))).where(F.col("siret") != "")
    not_live = (~F.contains(T.text(F.col("source")), F.lit("LBA"))).cast("int")
    return first_per_key(df, ["siret"], [not_live, "ord"])


def load_listings(df: DataFrame) -> DataFrame:
    """Directory listings keyed by id, first row wins."""
    df = df.withColumn("siret", T.normalize_siret(F.col("siret"))).where(F.col("siret") != "")
    return first_per_key(df, ["siret"], ["ord"])


def load_phone_listings(df: DataFrame) -> DataFrame:
    """Every listing with a phone, with or without an id, and its matching keys."""
    return df.where(T.strip(T.text(F.col("phone"))) != "").select(
        "*",
        T.normalize_cp(F.col("cp")).alias("cp_norm"),
        T.clean_name_link(F.col("name")).alias("name_clean"),
    )


def first_per_name_cp(df: DataFrame, order: list) -> DataFrame:
    return first_per_key(df, [F.lower("name"), "cp"], order)


def first_per_siret_keep_blank(df: DataFrame, order: list) -> DataFrame:
    """First row per id; rows without one are all kept."""
    named = first_per_key(df.where(F.col("siret") != ""), ["siret"], order)
    return named.unionByName(df.where(F.col("siret") == ""))


def first_per_siret_or_name(df: DataFrame, order: list) -> DataFrame:
    """First row per id, or per (name, postal code) where the id is blank."""
    has = T.strip(F.col("siret")) != ""
    key = F.when(has, F.struct(T.strip(F.col("siret")).alias("a"), F.lit("").alias("b"), F.lit(1).alias("kind"))).otherwise(
        F.struct(F.lower("name").alias("a"), F.col("cp").alias("b"), F.lit(2).alias("kind"))
    )
    return first_per_key(df.withColumn("_key", key), ["_key"], order).drop("_key")


def first_per_mixed_key(df: DataFrame, scope: list[str], name: str = "name") -> DataFrame:
    """Ids win first; a row without an id is dropped when an earlier kept row has its name and postal code."""
    named = first_per_key(df.where(F.col("siret") != ""), [*scope, "siret"], ["ord"])
    kept = named.unionByName(df.where(F.col("siret") == ""))
    kept = kept.withColumn("_n", F.lower(name))
    keys = [*scope, "_n", "cp"]
    first = kept.groupBy(*keys).agg(F.min("ord").alias("_first"))
    return (
        kept.join(first, keys)
        .where((F.col("siret") != "") | (F.col("ord") == F.col("_first")))
        .drop("_n", "_first")
        .select(*df.columns)
    )


def count_filled(cols: list[str]) -> Column:
    """Richness of a row: how many of its columns hold something."""
    parts = [F.when(T.strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "", 1).otherwise(0) for c in cols]
    total = F.lit(0)
    for p in parts:
        total = total + p
    return total


def dedup_rank(cols: list[str]) -> list[Column]:
    """Ascending: with a phone first, then priority, then richness."""
    return [
        F.when(T.strip(F.col("phone")) != "", 0).otherwise(1).alias("no_phone"),
        priority_rank(F.col("priority")).alias("prio"),
        (-count_filled(cols)).alias("neg_filled"),
    ]


def merge_groups(df: DataFrame, keys: list[str], rank: list[Column], cols: list[str]) -> DataFrame:
    """One row per key: the best row, its blanks filled from the others in rank order."""
    r = F.struct(*rank, F.col("ord").alias("ord"))
    best = F.min(F.struct(r.alias("r"), *[F.col(c) for c in cols if c not in keys])).alias("_best")
    fills = [
        F.min(F.when(T.strip(F.col(c).cast("string")) != "", F.struct(r.alias("r"), F.col(c).alias("v")))).alias(f"_f_{c}")
        for c in cols
        if c not in keys
    ]
    g = df.groupBy(*keys).agg(best, F.count("*").alias("n_rows"), *fills)
    out = [
        F.col(c) if c in keys else F.coalesce(F.col(f"_f_{c}.v"), F.col(f"_best.{c}")).alias(c) for c in cols
    ]
    return g.select(*out, F.col("_best.r.ord").alias("ord"), "n_rows")


def best_per_siret(leads: DataFrame, cols: list[str]) -> DataFrame:
    """Best row per id with blanks filled from its copies; rows without an id stay."""
    leads = leads.withColumn("siret", T.strip(F.col("siret")))
    merged = merge_groups(leads.where(F.col("siret") != ""), ["siret"], dedup_rank(cols), cols)
    rest = leads.where(F.col("siret") == "").select(*cols, "ord", F.lit(1).cast("bigint").alias("n_rows"))
    return merged.unionByName(rest)


def cap_per_group(df: DataFrame, group: list[str], order: list, limit: int) -> DataFrame:
    """At most `limit` rows per group, in order."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= limit)


def number_within(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds `i` (1, 2, ... in order inside each group) and `n` (size of the group).

    Rows are range-partitioned on (group, order), numbered inside each slice and shifted by
    the sizes of the slices before it, so a group of any size is numbered by many tasks.
    The checkpoint fixes the slices between the two passes.
    """
    slices = cut(df.repartitionByRange(*by, *order).withColumn("_s", F.spark_partition_id()))
    sizes = slices.groupBy(*by, "_s").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*by)
    before = sizes.select(
        *by, "_s", (F.sum("_c").over(w.orderBy("_s")) - F.col("_c")).alias("_before"), F.sum("_c").over(w).alias("n")
    )
    inside = F.row_number().over(Window.partitionBy(*by, "_s").orderBy(*order))
    return slices.withColumn("_i", inside).join(before, [*by, "_s"]).select(
        *df.columns, (F.col("_before") + F.col("_i")).alias("i"), "n"
    )


def duplicates_of(df: DataFrame, kept: DataFrame, keys: list[str], stage: str) -> DataFrame:
    """Audit rows for what a first-per-key stage dropped: which row stayed, which went."""
    first = kept.select(*keys, F.col("ord").alias("kept_ord"))
    return (
        df.join(first, keys)
        .where(F.col("ord") != F.col("kept_ord"))
        .select(F.lit(stage).alias("stage"), "kept_ord", F.col("ord").alias("dropped_ord"), *keys)
    )
