"""Combine sources on the shared id: offer merge, cross-and-score, registry comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlink.functions import text as T
from leadlink.operators.keyed import priority_rank

SIGNAL_FIELDS = ["name", "naf", "address", "city", "cp", "phone", "search_city", "collected_on"]
LEAD_COLUMNS = [
    "name", "siret", "naf", "address", "city", "cp", "phone", "phone_source", "website", "priority", "source",
    "lbb_score", "offers", "collected_on",
]


def merge_signals(live: DataFrame, potential: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """One row per id from live offers and hiring-potential rows.

    The first live row is the base and its blanks come from potential rows in order; offers
    are summed over live rows; the score is the first non-blank potential score. One
    aggregation, combined map-side.
    """
    scope = scope or []
    keys = [*scope, "siret"]
    fields = [f for f in SIGNAL_FIELDS if f not in scope]
    cols = [*keys, "ord", *fields]
    a = live.select(*cols, F.lit("").alias("lbb_score"), F.col("offers").cast("bigint"), F.lit(True).alias("is_live"))
    b = potential.select(*cols, "lbb_score", F.lit(None).cast("bigint").alias("offers"), F.lit(False).alias("is_live"))
    rows = a.unionByName(b).where(T.text(F.col("siret")) != "")
    fields = [*fields, "lbb_score"]
    whole = F.struct("ord", *fields)
    potential_only = ~F.col("is_live")
    aggs = [
        F.min(F.when(F.col("is_live"), whole)).alias("_live"),
        F.min(F.when(potential_only, whole)).alias("_pot"),
        F.sum("offers").alias("offers"),
        F.count_if("is_live").alias("n_live"),
        F.count_if(potential_only).alias("n_potential"),
    ]
    for f in fields:
        filled = potential_only & (T.strip(T.text(F.col(f))) != "")
        aggs.append(F.min(F.when(filled, F.struct("ord", f))).alias(f"_fill_{f}"))
    g = rows.groupBy(*keys).agg(*aggs)
    both = (F.col("n_live") > 0) & (F.col("n_potential") > 0)
    source = F.when(both, "LBA + LBB").when(F.col("n_live") > 0, "LBA").otherwise("LBB")
    out = [
        F.coalesce(T.nz(F.col(f"_live.{f}")), F.col(f"_fill_{f}.{f}"), F.col(f"_live.{f}"), F.col(f"_pot.{f}")).alias(f)
        for f in fields
    ]
    return g.select(
        *keys, *out, source.alias("source"), "offers", both.alias("was_duplicate"),
        F.coalesce(F.col("_live.ord"), F.col("_pot.ord")).alias("ord"), "n_live", "n_potential",
    )


def cross_and_score(listings: DataFrame, signals: DataFrame, run_date: str) -> DataFrame:
    """Full outer join of keyed listings and keyed signals with precedence, priority and labels.

    Filters belong on the inputs: they cannot move through a full outer join.
    """
    p, s = listings.alias("p"), signals.alias("s")
    in_p, in_s = F.col("p.siret").isNotNull(), F.col("s.siret").isNotNull()
    both = in_p & in_s

    def either(name: str) -> Column:
        return F.coalesce(T.nonempty(F.col(f"p.{name}")), F.col(f"s.{name}"), F.lit(""))

    src = T.text(F.col("s.source"))
    live, potential = F.contains(src, F.lit("LBA")), F.contains(src, F.lit("LBB"))
    p_phone, s_phone = T.strip(T.text(F.col("p.phone"))), T.strip(T.text(F.col("s.phone")))
    priority = F.when(in_s, F.when(live, "Haute").otherwise("Moyenne")).otherwise("Basse")
    source = (
        F.when(both & live & potential, "PJ + LBA + LBB")
        .when(both & live, "PJ + LBA")
        .when(both, "PJ + LBB")
        .when(in_s, src)
        .otherwise("Pages Jaunes")
    )
    phone_source = (
        F.when(p_phone != "", "PJ direct").when(s_phone != "", F.when(live, "LBA").otherwise("LBB")).otherwise("")
    )
    return p.join(s, F.col("p.siret") == F.col("s.siret"), "full_outer").select(
        either("name").alias("name"),
        F.coalesce("p.siret", "s.siret").alias("siret"),
        *[either(c).alias(c) for c in ("naf", "address", "city", "cp")],
        F.when(p_phone != "", p_phone).otherwise(s_phone).alias("phone"),
        phone_source.alias("phone_source"),
        T.text(F.col("p.website")).alias("website"),
        priority.alias("priority"),
        source.alias("source"),
        T.text(F.col("s.lbb_score")).alias("lbb_score"),
        F.coalesce(F.col("s.offers").cast("string"), F.lit("")).alias("offers"),
        F.lit(run_date).alias("collected_on"),
        both.alias("matched"),
    )


def order_leads(leads: DataFrame) -> DataFrame:
    """High priority first; the id settles the order inside a priority."""
    return leads.orderBy(priority_rank(F.col("priority")), "siret")


def compare_ids(listings: DataFrame, other: DataFrame, key: str = "listing_id") -> DataFrame:
    """Class of each listing by the id the registry gave and the id a second source gave."""
    j = listings.alias("a").join(other.alias("b"), key, "left")
    a, b = F.col("a.siret"), T.text(F.col("b.siret"))
    cls = (
        F.when((a != "") & (b != "") & (a == b), "Identique")
        .when((a != "") & (b != ""), F.concat(F.lit("Différent (Pappers: "), b, F.lit(")")))
        .when(b != "", "Pappers seul")
        .when(a != "", "SIRENE seul")
        .otherwise("Non trouvé")
    )
    kind = F.when(F.startswith(cls, F.lit("Différent")), "Différent").otherwise(cls)
    return j.select(key, a.alias("siret"), b.alias("other_siret"), cls.alias("comparison"), kind.alias("kind"))


def comparison_summary(compared: DataFrame) -> DataFrame:
    """Counts per class and floored hit rates of both sources."""
    k = F.col("kind")
    n = F.count("*")
    base = compared.agg(
        n.alias("total"),
        F.count_if(k == "Identique").alias("same"),
        F.count_if(k == "Différent").alias("different"),
        F.count_if(k == "Pappers seul").alias("only_other"),
        F.count_if(k == "SIRENE seul").alias("only_registry"),
        F.count_if(k == "Non trouvé").alias("neither"),
    )
    reg = F.col("same") + F.col("different") + F.col("only_registry")
    oth = F.col("same") + F.col("different") + F.col("only_other")
    return base.select(
        "*", T.percent_floor(reg, F.col("total")).alias("registry_pct"),
        T.percent_floor(oth, F.col("total")).alias("other_pct"),
    )


def add_profile_fields(rows: DataFrame, found: DataFrame, key: str, prefer_new: list[str]) -> DataFrame:
    """Overwrite with the looked-up value where there is one, else keep, else blank."""
    j = rows.alias("r").join(found.alias("f"), key, "left")
    kept = [F.col(f"r.{c}") for c in rows.columns if c not in prefer_new]
    new = [T.first_nonempty(F.col(f"f.{c}"), F.col(f"r.{c}")).alias(c) for c in prefer_new]
    return j.select(*kept, *new)
