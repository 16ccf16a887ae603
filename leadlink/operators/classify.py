"""Hierarchical activity codes and keyword lists: match, label, expand, filter, gate."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlink import refdata
from leadlink.functions import text as T


def covers(code: Column) -> Column:
    """A code without a final letter stands for everything below it."""
    return (F.length(code) >= 4) & code.rlike("[0-9]$")


def match_naf(profile_code: Column, company_code: Column) -> Column:
    p, e = T.normalize_naf(profile_code), T.normalize_naf(company_code)
    return (p != "") & (e != "") & ((p == e) | (covers(p) & F.startswith(e, p)))


def coherent(company_code: Column, expected: list[str]) -> Column:
    """True when covered by the list; an unknown code or an empty list passes."""
    e = T.normalize_naf(company_code)
    out = T.text(company_code) == ""
    for code in expected:
        c = _norm(code)
        if not c:
            continue
        hit = F.startswith(e, F.lit(c)) if len(c) >= 4 and c[-1].isdigit() else e == c
        out = out | (hit & (e != ""))
    return out if expected else F.lit(True)


def _norm(code: str) -> str:
    code = code.strip().upper()
    return code[:2] + "." + code[2:] if len(code) >= 4 and "." not in code and code[:2].isdigit() else code


def match_profiles(companies: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every (company, profile code) that match, as an equi-join on code prefixes.

    A prefix condition alone would be a nested loop; here each company emits its few
    prefixes and the join is a hash join however large the profile table is.
    """
    e = T.normalize_naf(F.col("naf"))
    lengths = F.filter(F.sequence(F.lit(1), F.greatest(F.length(e), F.lit(1))), lambda n: (n >= 4) | (n == F.length(e)))
    keyed = companies.withColumn("_e", e).where(F.col("_e") != "").withColumn(
        "_p", F.explode(F.transform(lengths, lambda n: F.col("_e").substr(F.lit(1), n)))
    )
    prof = profiles.withColumn("_p", T.normalize_naf(F.col("profile_code")))
    return keyed.join(prof, "_p").where((F.col("_p") == F.col("_e")) | covers(F.col("_p"))).drop("_p", "_e")


def with_label(df: DataFrame, spark: SparkSession, code: str = "naf", out: str = "naf_label") -> DataFrame:
    """Label of the code, else of its class, else of its division, else blank."""
    lab = refdata.labels(spark)
    c = T.normalize_naf(F.col(code))
    df = df.withColumn("_c", c)
    steps = [("_l0", F.col("_c")), ("_l1", F.substring("_c", 1, 5)), ("_l2", F.substring("_c", 1, 2))]
    for name, key in steps:
        side = F.broadcast(lab.select(F.col("code").alias(f"{name}k"), F.col("label").alias(name)))
        df = df.join(side, key == F.col(f"{name}k"), "left").drop(f"{name}k")
    return df.withColumn(out, F.coalesce("_l0", "_l1", "_l2", F.lit(""))).drop("_c", "_l0", "_l1", "_l2")


def expand_occupations(codes: DataFrame, spark: SparkSession) -> DataFrame:
    """(naf, status, sub-classes, occupations) of requested codes.

    An exact sub-class gives its own occupations; a class code gives those of all
    sub-classes below it; anything else is unresolved. Codes are compared as written.
    """
    occ = refdata.occupations(spark)
    naf = T.strip(F.col("naf"))
    codes = codes.withColumn("naf", naf)
    exact = F.broadcast(occ.select(F.col("naf"), F.col("romes").alias("_exact")))
    prefixes = occ.select(
        F.explode(F.transform(F.sequence(F.lit(4), F.length("naf")), lambda n: F.col("naf").substr(F.lit(1), n))).alias("_p"),
        F.col("naf").alias("_k"), "romes",
    )
    below = prefixes.groupBy("_p").agg(
        F.array_sort(F.collect_set("_k")).alias("_subs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("romes")))).alias("_romes"),
    )
    j = codes.join(exact, "naf", "left").join(F.broadcast(below), (F.col("naf") == F.col("_p")) & covers(F.col("naf")), "left")
    status = F.when(F.col("_exact").isNotNull(), "sub-class").when(F.col("_subs").isNotNull(), "class").otherwise("unresolved")
    empty = F.array().cast("array<string>")
    return j.select(
        *codes.columns,
        status.alias("status"),
        F.when(status == "class", F.col("_subs")).otherwise(empty).alias("covers"),
        F.coalesce(F.array_sort("_exact"), "_romes", empty).alias("occupations"),
    )


def resolve_profiles(requests: DataFrame, spark: SparkSession) -> DataFrame:
    """Requests (request_id, pos, profile) -> codes and labels; unknown names are reported."""
    prof, alias = refdata.profiles(spark), refdata.aliases(spark)
    j = requests.join(
        F.broadcast(alias.select(F.col("alias").alias("profile"), F.col("profile").alias("_new"))), "profile", "left"
    ).withColumn("_name", F.coalesce("_new", "profile"))
    j = j.join(F.broadcast(prof.select(F.col("profile").alias("_name"), "label", "nafs")), "_name", "left")
    g = j.groupBy("request_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce("nafs", F.array().cast("array<string>")))))).alias("codes"),
        F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("pos", "label")))).alias("_labels"),
        F.array_sort(F.collect_set(F.when(F.col("label").isNull(), F.col("profile")))).alias("unknown"),
    )
    return g.select(
        "request_id", "codes",
        F.array_join(F.transform("_labels", lambda x: x["label"]), ", ").alias("label"),
        "unknown",
    )


def sector_of(names: DataFrame, spark: SparkSession) -> DataFrame:
    """(request_id, profile) -> the one sector they share, or null."""
    pre = F.broadcast(refdata.sector_prefixes(spark))
    head = F.split(F.lower("profile"), "_")[0]
    j = names.join(pre, (head == F.col("prefix")) & F.contains(F.col("profile"), F.lit("_")), "left")
    g = j.groupBy("request_id").agg(F.collect_set("sector").alias("_s"))
    return g.select("request_id", F.when(F.size("_s") == 1, F.get("_s", F.lit(0))).alias("sector"))


def profiles_by_sector(spark: SparkSession) -> DataFrame:
    prof = refdata.profiles(spark)
    pre = F.broadcast(refdata.sector_prefixes(spark))
    order = F.array(*[F.lit(s) for s in refdata.SECTOR_DISPLAY_ORDER])
    j = prof.join(pre, F.split("profile", "_")[0] == F.col("prefix"))
    return j.groupBy("sector").agg(
        F.array_sort(F.collect_list(F.struct("profile", F.size("nafs").alias("n_codes")))).alias("profiles")
    ).withColumn("pos", F.array_position(order, F.col("sector")))


def warned_codes(codes: DataFrame, warnings: DataFrame) -> DataFrame:
    """Requested codes that carry a warning."""
    return codes.join(warnings.select("naf"), "naf", "left_semi")


# --- keyword lists ---------------------------------------------------------------


def tag_excluded_category(df: DataFrame, name: str = "name", category: str = "category") -> DataFrame:
    """Adds `excluded`: the first category with a keyword inside "name category", or null."""
    text = F.concat(
        T.strip_accents(F.lower(T.text(F.col(name)))), F.lit(" "), T.strip_accents(F.lower(T.text(F.col(category))))
    )
    by_cat: dict[str, list[str]] = {}
    for _, cat, kw in refdata.category_rows():
        by_cat.setdefault(cat, []).append(kw)
    first = F.coalesce(*[F.when(F.col("_text").rlike("|".join(k)), F.lit(c)) for c, k in by_cat.items()])
    return df.withColumn("_text", text).withColumn("excluded", first).drop("_text")


def tag_excluded_brand(df: DataFrame, name: str = "name") -> DataFrame:
    """Adds `brand`: the chain keyword found in the name, as written in the list, or null."""
    norm = T.strip_accents(F.lower(T.text(F.col(name))))
    return df.withColumn("_norm", norm).withColumn("brand", _brand_in(F.col("_norm"))).drop("_norm")


def _brand_in(norm: Column) -> Column:
    kws = F.array(
        *[F.struct(F.lit(k).alias("kw"), F.lit(_plain(k)).alias("norm")) for k in refdata.brand_keywords()]
    )
    # One literal pattern says whether there is any; which one is only asked of the few names that match.
    some = norm.rlike("|".join(re.escape(_plain(k)) for k in refdata.brand_keywords()))
    hits = F.when(some, F.filter(kws, lambda k: F.contains(norm, k["norm"])))
    word = F.when(norm.rlike("\\b" + refdata.BRAND_WHOLE_WORD + "\\b"), refdata.BRAND_WHOLE_WORD)
    return F.coalesce(F.get(hits, F.lit(0))["kw"], word)


def _plain(keyword: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", keyword) if c < "\x80")


BRAND_SECTORS = ("MBT", "TG")


def brand_rule_applies(sector: Column) -> Column:
    return F.upper(T.text(sector)).isin(*BRAND_SECTORS)


# --- reports and gate ------------------------------------------------------------


def naf_filter(df: DataFrame, expected: list[str]) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and dropped rows with a known code outside the profile."""
    code = T.strip(T.text(F.col("naf")))
    ok = coherent(code, expected)
    return df.where(ok), df.where(~ok).withColumn("naf", code)


def relabel_outside_profile(df: DataFrame, expected: list[str]) -> DataFrame:
    """Rows found but outside the profile change status; they keep their id."""
    code = T.strip(T.text(F.col("naf")))
    out = (F.col("status") == "SIRET trouvé") & ~coherent(code, expected)
    cls = (
        F.when(F.col("status") != "SIRET trouvé", F.lit(None))
        .when(code == "", "unavailable")
        .when(coherent(code, expected), "coherent")
        .otherwise("outside")
    )
    status = F.when(out, F.concat(F.lit("Exclu — NAF hors profil ("), code, F.lit(")"))).otherwise(F.col("status"))
    return df.withColumn("naf_class", cls).withColumn("status", status)


GATE_LIMIT = 0.8


def naf_gate(df: DataFrame, expected: list[str], by: list[str]) -> DataFrame:
    """Share of known codes outside the profile; breached when it exceeds the limit."""
    code = T.strip(T.text(F.col("naf")))
    g = df.groupBy(*by).agg(
        F.count_if(code != "").alias("n"), F.count_if((code != "") & ~coherent(code, expected)).alias("n_bad")
    )
    return g.select(
        *by, "n", "n_bad", T.percent_text(F.col("n_bad"), F.col("n")).alias("pct"),
        F.coalesce(F.col("n_bad") / F.when(F.col("n") > 0, F.col("n")) > GATE_LIMIT, F.lit(False)).alias("breached"),
    )


def top_counts(df: DataFrame, key: str, limit: int = 10) -> DataFrame:
    """The most frequent values, each with how many further values there are."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), key).limit(limit)
    others = counts.agg(F.lit(1).alias("_one"), F.greatest(F.count("*") - limit, F.lit(0)).alias("n_others"))
    return top.withColumn("_one", F.lit(1)).join(F.broadcast(others), "_one").drop("_one")
