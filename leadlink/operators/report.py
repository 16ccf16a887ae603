"""Coverage, exclusion and synthesis reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlink.functions import text as T
from leadlink.operators.keyed import PRIORITY_ORDER


def blank(name: str):
    return T.strip(F.coalesce(F.col(name).cast("string"), F.lit(""))) == ""


def priority_counts(leads: DataFrame) -> DataFrame:
    """Leads per priority and keys found on both sides, in one pass."""
    return leads.agg(
        *[F.count_if(F.col("priority") == p).alias(p.lower()) for p in PRIORITY_ORDER],
        F.count_if("matched").alias("matches"), F.count("*").alias("total"),
    )


def phone_coverage(df: DataFrame, by: list[str]) -> DataFrame:
    n = F.count("*")
    g = df.groupBy(*by).agg(F.count_if(~blank("phone")).alias("with_phone"), n.alias("total"))
    return g.select(*by, "with_phone", "total", T.percent_text(F.col("with_phone"), F.col("total")).alias("pct"))


def capture_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """How phones were captured, per group and over all groups (`scope` total)."""
    kinds = {"direct": "direct", "click": "via clic", "deep": "deep", "missing": "vide"}
    aggs = [F.count_if(F.col("phone_capture") == v).alias(k) for k, v in kinds.items()]
    per = df.groupBy(*by).agg(*aggs)
    total = per.agg(*[F.sum(k).alias(k) for k in kinds])
    return per.unionByName(total.select(*[F.lit("(total)").alias(b) for b in by], *kinds))


def city_statistics(live: DataFrame, potential: DataFrame, city: str = "search_city") -> DataFrame:
    """Per city: live ids, potential-only ids, ids in both, unique ids.

    Rows are reduced to one per (city, id) first, so no distinct set is held anywhere.
    """
    a = live.select(city, "siret", F.lit(1).alias("l"), F.lit(0).alias("p"))
    b = potential.select(city, "siret", F.lit(0).alias("l"), F.lit(1).alias("p"))
    ids = a.unionByName(b).where(T.text(F.col("siret")) != "").groupBy(city, "siret").agg(F.max("l").alias("l"), F.max("p").alias("p"))
    return ids.groupBy(city).agg(
        F.count_if(F.col("l") == 1).alias("n_live"), F.count_if(F.col("l") == 0).alias("n_potential_only"),
        F.count_if((F.col("l") == 1) & (F.col("p") == 1)).alias("n_both"), F.count("*").alias("n_unique"),
    )


def enrichment_synthesis(rows: DataFrame) -> DataFrame:
    found = F.count_if(F.col("status") == "SIRET trouvé")
    g = rows.agg(
        F.count("*").alias("total"), found.alias("found"),
        F.count_if(F.startswith("status", F.lit("Exclu"))).alias("excluded"),
        F.count_if(F.startswith("status", F.lit("Exclu — erreur"))).alias("errors"),
    )
    return g.select("total", "found", "excluded", "errors", T.percent_text(F.col("found"), F.col("total")).alias("found_pct"))


def most_common(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)


def fill_rate(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Share of non-blank values per column and group: one row per (group, column)."""
    g = df.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(~blank(c)).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in cols])
    return g.select(*by, "n", F.explode(pairs).alias("_p")).select(
        *by, "_p.column_name", "_p.filled", F.col("n").alias("total"),
        T.percent_text(F.col("_p.filled"), F.col("n")).alias("pct"),
    )


def exclusion_counts(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows per excluded value, zero counts included."""
    n = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return dimension.select(key).distinct().join(n, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def deep_pass_input(listings: DataFrame) -> DataFrame:
    """Listings without a phone that have a page of their own."""
    return listings.where((F.col("phone") == "") & (F.col("listing_url") != ""))


def stage_counts(judged: DataFrame, stage: str) -> DataFrame:
    return judged.agg(
        F.lit(stage).alias("stage"), F.count_if(F.col("kept_ord").isNotNull()).alias("removed"),
        F.count_if(F.col("kept_ord").isNull()).alias("remaining"),
    )
