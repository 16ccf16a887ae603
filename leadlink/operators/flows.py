"""Whole jobs composed from the operators: DataFrames in, one lazy DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from leadlink.functions import text as T
from leadlink.operators import classify, dedup, keyed, merge, resolve
from leadlink.session import cut, written


def roots(judged: DataFrame) -> DataFrame:
    """(ord, root): the surviving row each row finally went into, by pointer doubling."""
    links = cut(judged.select("ord", F.coalesce("kept_ord", "ord").alias("root")))
    while True:
        up = links.select(F.col("ord").alias("root"), F.col("root").alias("_up"))
        nxt = cut(links.join(up, "root", "left").select("ord", F.coalesce("_up", "root").alias("root"), (F.coalesce("_up", "root") != F.col("root")).alias("moved")))
        links = nxt.select("ord", "root")
        if nxt.where("moved").isEmpty():
            return links


def absorb(judged: DataFrame, rank: list, cols: list[str]) -> DataFrame:
    """Survivors, their blanks filled from the rows that went into them."""
    rows = judged.join(roots(judged), "ord")
    first = F.when(F.col("ord") == F.col("root"), 0).otherwise(1).alias("not_root")
    return keyed.merge_groups(rows, ["root"], [first, *rank], ["root", *cols]).drop("n_rows", "root")


def _counted(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows written once, counted by the job that writes them."""
    seen = Observation()
    kept = written(rows.observe(seen, F.count(F.lit(1)).alias("n")))
    return kept, seen.get["n"]


def dedup_stages(leads: DataFrame, cols: list[str], judge=dedup.survivors) -> tuple[DataFrame, DataFrame]:
    """(leads, report): duplicates by id, then by phone and name, then by department and name, each stage on what the one
    before left; the report has removed and remaining rows per stage and in all. leads: `ord` and the lead columns.
    The counts are observed while a stage is written; no stage is run again to be counted."""
    phone, prio, filled = keyed.dedup_rank(cols)
    rows, start = _counted(leads.select("ord", *cols))
    rows, by_id = _counted(keyed.best_per_siret(rows, cols).select("ord", *cols))
    rows, by_phone = _counted(absorb(cut(judge(dedup.with_phone_block(rows), [phone, prio, filled], dedup.PHONE_THRESHOLD)), [phone, prio, filled], cols))
    rows, by_name = _counted(absorb(cut(judge(dedup.with_department_block(rows), [filled, prio], dedup.NAME_THRESHOLD)), [filled, prio], cols))
    lines = [("siret", start - by_id, by_id), ("phone", by_id - by_phone, by_phone), ("name", by_phone - by_name, by_name), ("total", start - by_name, by_name)]
    return rows, leads.sparkSession.createDataFrame(lines, "stage string, removed long, remaining long")


def qualify_leads(listings: DataFrame, signals: DataFrame, expected: list[str], sector: str, run_date: str,
                  judge=dedup.survivors) -> DataFrame:
    """Filter both sources, cross them, back-fill phones, deduplicate, order.

    The gate (classify.naf_gate) is a report on the inputs; deciding on it is the caller's.
    Excluded listings may still lend a phone: the back-fill reads all listings. `judge` is the deduplication mode.
    """
    donors = keyed.load_phone_listings(listings)
    kept = []
    for side in (keyed.load_listings(listings), keyed.load_signals(signals)):
        if expected:
            side, _ = classify.naf_filter(side, expected)
        if sector.upper() in classify.BRAND_SECTORS:
            side = classify.tag_excluded_brand(side).where(F.col("brand").isNull()).drop("brand")
        kept.append(side)
    leads = merge.cross_and_score(kept[0], kept[1], run_date).drop("matched")
    leads = cut(leads.withColumn("lead_id", F.col("siret")))
    leads = resolve.backfill_phones(leads, donors).drop("outcome").withColumnRenamed("lead_id", "ord")

    cols = merge.LEAD_COLUMNS
    by_phone = judge(dedup.with_phone_block(leads), keyed.dedup_rank(cols), dedup.PHONE_THRESHOLD)
    leads = cut(absorb(cut(by_phone), keyed.dedup_rank(cols), cols))
    _, prio, filled = keyed.dedup_rank(cols)
    by_name = judge(dedup.with_department_block(leads), [filled, prio], dedup.NAME_THRESHOLD)
    return merge.order_leads(absorb(cut(by_name), [filled, prio], cols).select(*cols))


def collect_signals(live: DataFrame, potential: DataFrame) -> DataFrame:
    """Merge offers and potentials inside each searched city, then one row per id over the cities."""
    per_city = merge.merge_signals(live, potential, ["search_city"])
    return keyed.first_per_siret_keep_blank(per_city, ["search_city", "ord"])


def registry_extract(sites: DataFrame, cities: DataFrame, kind: str, priority: int) -> DataFrame:
    """Establishments of the configured cities, consolidated per city and then by id.

    sites: commune, ord and the establishment columns. cities: commune, city_name, owner.
    """
    rows = sites.join(cities, "commune")
    one = keyed.first_per_mixed_key(rows, ["city_name"])
    one = one.select(
        "*", F.lit(kind).alias("kind"), F.lit(priority).alias("priority"), F.lit("").alias("phone")
    )
    return keyed.first_per_siret_keep_blank(one, ["city_name", "ord"])


def sector_rows(listings: DataFrame, candidates: DataFrame, run_date: str) -> DataFrame:
    """Listings of each sector: first per name and postal code, id lookup, first per id or name."""
    one = keyed.first_per_key(listings, ["sector", F.lower("name"), "cp"], ["page_id", "block_pos"])
    found = resolve.first_candidate_ids(one.withColumn("siret", F.lit("")), candidates, ["name", "dept"])
    has = T.strip(F.col("siret")) != ""
    k1 = F.when(has, T.strip(F.col("siret"))).otherwise(F.lower("name"))
    k2 = F.when(has, F.lit("")).otherwise(F.col("cp"))
    out = keyed.first_per_key(found.withColumn("_has", has).withColumn("_a", k1).withColumn("_b", k2), ["sector", "_has", "_a", "_b"], ["page_id", "block_pos"])
    return out.drop("_has", "_a", "_b").withColumn("collected_on", F.date_format(F.lit(run_date).cast("date"), "dd/MM/yyyy"))


def tag_city(df: DataFrame, city, overwrite: bool = True) -> DataFrame:
    """Search city on every row, or only where it is missing."""
    return df.withColumn("search_city", city if overwrite else F.coalesce(T.nonempty(F.col("search_city")), city))


def run_dates(run_date) -> dict:
    """The three date formats of the outputs, from the run date given by the caller."""
    d = run_date.cast("date")
    return {"iso": F.date_format(d, "yyyy-MM-dd"), "compact": F.date_format(d, "yyyyMMdd"), "display": F.date_format(d, "dd/MM/yyyy")}
