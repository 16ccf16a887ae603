"""Exact deduplication with a split for heavy hitters, in DataFrame functions only.

A Misra-Gries summary (the frequent-items sketch behind `approx_top_k`) names the digests that may be frequent. Their
exact counts and smallest ids, at most `heavy` rows by construction, are broadcast and settle every row of a large
group inside its map task. What is left cannot hold a group above about (4/3) * rows / (8 * heavy), so an ordinary
shuffle by digest is even.

Defined cases: a null text counts as empty, and all empty texts are one group. The smallest non-null id of a group
stays; rows without an id stay only where no row of their group has one. Rows that repeat both id and text are one
document and are marked alike by `mark`; `remove` keeps exactly one row of every group, whatever the ids are. Other
columns are neither read nor needed, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlink.llm.common import numbered, stored, table, without
from leadlink.llm.registry import query


def digest(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the text with every run of ASCII white space as one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)


def _settled(rows: DataFrame, heavy: int) -> DataFrame:
    """The rows (id, sha, more), a written table, with `keep_id` and `group_size` of their group."""
    frequent = rows.agg(F.expr(f"approx_top_k(sha, {heavy}, {8 * heavy})").alias("top")).select(F.explode("top.item").alias("sha"))
    winners = stored(
        rows.join(F.broadcast(frequent), "sha", "left_semi").groupBy("sha")
        .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"),
        "winners",
    )
    hot = rows.join(F.broadcast(winners), "sha")
    same = Window.partitionBy("sha")
    rest = rows.join(F.broadcast(winners.select("sha")), "sha", "left_anti").select(
        "*", F.min("id").over(same).alias("keep_id"), F.count("*").over(same).alias("group_size")
    )
    return hot.unionByName(rest)


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = 1024) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row."""
    rows = stored(docs.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("sha")), "digests")
    return _settled(rows, heavy).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = 1024) -> DataFrame:
    """One row of each group, with all its columns: that with the smallest id, the first in the table among equal or no ids."""
    whole = numbered(docs, "documents")
    row = F.col("row")
    rows = stored(whole.select("uid", row[id_col].alias("id"), digest(row[text_col]).alias("sha")), "digests")
    repeated = stored(_settled(rows, heavy).where("group_size > 1").select("uid", "sha", F.col("id").eqNullSafe(F.col("keep_id")).alias("best")), "repeated")
    stays = repeated.where("best").groupBy("sha").agg(F.min("uid").alias("uid"))
    return without(whole, stored(repeated.select("uid").join(stays.select("uid"), "uid", "left_anti"), "gone"))


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha FROM documents),
g AS (SELECT sha, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY sha)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.sha AS text_sha256
FROM d JOIN g USING (sha)
"""


@query("op8_exact_dedup", SQL)
def op8_exact_dedup(spark, sf_dir):
    return mark(table(spark, sf_dir, "documents"))
