"""Writers. Parquet is the native output; CSV carries display names and a fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlink import refdata

QUOTE = '"'


MARK = "\ufeff"


def write_csv(df: DataFrame, path: str, columns: list[str], display: dict[str, str] | None = None, by: list[str] | None = None,
              mark: bool = True) -> None:
    """Fixed column order as text; extra columns are dropped, missing ones are blank.

    Every file starts with a byte-order mark, unless `mark` is off.
    """
    names = display or {}
    out = []
    for n, c in enumerate(columns):
        col = F.col(c).cast("string") if c in df.columns else F.lit("")
        out.append(F.coalesce(col, F.lit("")).alias(MARK * (mark and n == 0) + names.get(c, c)))
    rows = df.select(*out, *(by or []))
    if by:
        rows = rows.hint("rebalance", *by)
    w = (
        rows.write.mode("overwrite").option("header", True).option("escape", QUOTE).option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )
    (w.partitionBy(*by) if by else w).csv(path)


def write_leads(leads: DataFrame, path: str) -> None:
    write_csv(leads, path, list(refdata.LEAD_DISPLAY), refdata.LEAD_DISPLAY)


def write_stage(rows: DataFrame, path: str, display: dict[str, str], by: list[str] | None = None) -> None:
    """Any stage under its display names (listings, enriched, signals, sectors, registry)."""
    write_csv(rows, path, list(display), display, by)


def write_superset(frames: list[DataFrame], declared: list[str], path: str) -> None:
    """Union of whatever columns the rows have, plus the declared ones, blanks for gaps."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    for c in declared:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(""))
    out.na.fill("").write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """One folder per sector, batch or city.

    Rebalancing gathers small folders into few files and splits a folder that holds much of
    the data over several tasks.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_sectors(df: DataFrame, path: str, by: list[str]) -> None:
    """Per-sector folders and one consolidated copy."""
    write_partitioned(df, f"{path}/sectors", by)
    df.write.mode("overwrite").parquet(f"{path}/consolidated")


def write_if_any(df: DataFrame, path: str, columns: list[str]) -> bool:
    """Projected CSV; nothing is written for an empty frame."""
    if df.isEmpty():
        return False
    write_csv(df, path, columns)
    return True


def append_progress(df: DataFrame, path: str) -> None:
    """Incremental save: rows are only ever added."""
    df.write.mode("append").parquet(path)
