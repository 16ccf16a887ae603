"""Queries: whole jobs and staged outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlink.operators import flows
from leadlink.plans import duck as D
from leadlink.plans.inputs import EXPECTED_NAF, RUN_DATE, ctes, table, view
from leadlink.plans.q_core import _merged_sql, signal_rows
from leadlink.plans.q_ingest import PAGE_ARTICLE, _registry_json
from leadlink.plans.q_report import FOLDER
from leadlink.plans.registry import ORACLES, query
from leadlink.session import fresh_path
from leadlink.sinks import files as sink
from leadlink.sources import files, html_listing as H, json_responses as J

@query("qualified_leads")
def qualified_leads(spark, sf):
    return flows.qualify_leads(view(spark, sf, "listing"), signal_rows(spark, sf), EXPECTED_NAF, "MBT", RUN_DATE)


@query("multi_city_collection", ctes("offer", "potential") + "," + _merged_sql("search_city") + """
  SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY siret ORDER BY search_city, ord) = 1""")
def multi_city_collection(spark, sf):
    return flows.collect_signals(view(spark, sf, "offer"), view(spark, sf, "potential"))


_SITES = """s AS (SELECT c_custkey * 10 + n AS ord, 'nation ' || c_nationkey AS city_name, 'owner ' || (c_nationkey % 3) AS owner,
    CASE c_custkey % 3 WHEN 0 THEN 'L''Épi D''Or' WHEN 1 THEN 'Au Bon Pain-Doré' ELSE c_name END AS name, '69001' AS cp,
    CASE WHEN c_custkey % 4 = 3 THEN '' ELSE (c_custkey - c_custkey % 50) || '0' || n END AS siret
    FROM customer, (SELECT unnest([1, 2]) AS n) WHERE (n = 1 OR c_custkey % 2 = 0) AND (c_custkey + n) % 5 <> 0 AND (c_custkey + n) % 6 <> 0)"""


@query("registry_extract", f"""WITH {_SITES},
  named AS (SELECT * FROM s WHERE siret <> '' QUALIFY row_number() OVER (PARTITION BY city_name, siret ORDER BY ord) = 1),
  kept AS (SELECT * FROM named UNION ALL SELECT * FROM s WHERE siret = ''),
  lead AS (SELECT *, min(ord) OVER (PARTITION BY city_name, lower(name), cp) AS f FROM kept),
  one AS (SELECT * FROM lead WHERE siret <> '' OR ord = f)
  SELECT ord, city_name, owner, name, siret, 'Boulangerie' AS kind, 3 AS priority, '' AS phone
  FROM (SELECT *, CASE WHEN siret = '' THEN '#' || ord ELSE siret END AS k FROM one) QUALIFY row_number() OVER (PARTITION BY k ORDER BY city_name, ord) = 1""")
def registry_extract(spark, sf):
    sites = J.registry_sites(J.parse(_registry_json(spark, sf), "body", J.REGISTRY_SCHEMA), ["c_custkey"])
    shared = F.expr(
        "CASE WHEN c_custkey % 4 = 3 THEN '' ELSE (c_custkey - c_custkey % 50) || '0' || (site_pos + 1) END"
    )
    sites = sites.withColumn("ord", F.expr("c_custkey * 10 + site_pos + 1")).withColumn("siret", shared)
    cities = table(spark, sf, "nation").selectExpr(
        "lpad(CAST(n_nationkey * 100 AS STRING), 5, '0') AS commune", "'nation ' || n_nationkey AS city_name", "'owner ' || (n_nationkey % 3) AS owner")
    return flows.registry_extract(sites.select("commune", "ord", "name", "cp", "siret"), cities, "Boulangerie", 3).select(
        "ord", "city_name", "owner", "name", "siret", "kind", "priority", "phone")


_SECTOR = "regexp_extract(url, 'example[.]([a-z]+)', 1)"


@query("sector_workbook", "WITH l AS (" + ORACLES["html_old_layout"] + f"""),
  p AS (SELECT page_id, {_SECTOR} AS sector, {D.strip("regexp_replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '(?s)<[^>]*>', '', 'g')")} AS title FROM pages),
  one AS (SELECT l.*, p.sector FROM l JOIN p USING (page_id) QUALIFY row_number() OVER (PARTITION BY sector, lower(name), cp ORDER BY page_id, block_pos) = 1),
  c AS (SELECT title AS name, min(lpad(CAST(page_id - page_id % 4 AS VARCHAR), 14, '0')) AS siret FROM p GROUP BY title),
  f AS (SELECT one.page_id, one.block_pos, one.sector, one.name, one.cp, one.city, coalesce(c.siret, '') AS siret FROM one LEFT JOIN c USING (name))
  SELECT *, '23/02/2026' AS collected_on FROM f QUALIFY row_number() OVER (PARTITION BY sector,
    CASE WHEN siret <> '' THEN 'i' || siret ELSE 'n' || lower(name) END, CASE WHEN siret <> '' THEN '' ELSE cp END ORDER BY page_id, block_pos) = 1""")
def sector_workbook(spark, sf):
    pages = table(spark, sf, "pages")
    searched = pages.select(
        "*", F.lit("hôtel").alias("keyword"), F.lit("training").alias("training"), F.lit("31").alias("dept"), F.lit("Toulouse").alias("city"))
    sector = pages.select("page_id", F.expr(_SECTOR).alias("sector"))
    rows = H.old_listings(searched, PAGE_ARTICLE).join(sector, "page_id")
    title = F.regexp_replace(F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1), "(?s)<[^>]*>", "")
    cands = pages.select(
        H.T.strip(title).alias("name"), F.lit("31").alias("dept"), F.lit(0).alias("pos"), F.lit("").alias("siege_siret"),
        F.lpad((F.col("page_id") - F.col("page_id") % 4).cast("string"), 14, "0").alias("siret"))
    return flows.sector_rows(rows, cands, RUN_DATE).select("page_id", "block_pos", "sector", "name", "cp", "city", "siret", "collected_on")


@query("staged_backup", ctes("offer") + """
  SELECT search_city, count(*) AS n_raw, count(DISTINCT nullif(siret, '')) AS n_ids FROM offer GROUP BY 1""")
def staged_backup(spark, sf):
    """Raw rows per city kept as they were before consolidation."""
    path = fresh_path(spark, "staging")
    sink.write_partitioned(flows.tag_city(view(spark, sf, "offer"), F.col("search_city"), overwrite=False), path, ["search_city"])
    raw = spark.read.parquet(path)
    per_id = raw.groupBy("search_city", "siret").agg(F.count("*").alias("c"))
    return per_id.groupBy("search_city").agg(F.sum("c").alias("n_raw"), F.count_if(F.col("siret") != "").alias("n_ids"))


@query("batch_output", f"""WITH f AS (SELECT c_mktsegment AS sector, {FOLDER} AS folder FROM customer),
  n AS (SELECT sector, coalesce(max(TRY_CAST(nullif(regexp_extract(folder, '^batch_([0-9]+)$', 1), '') AS DECIMAL(38, 0))), 0) + 1 AS nb FROM f GROUP BY 1)
  SELECT sector, 'batch_' || CAST(nb AS VARCHAR) AS batch, count(*) AS n FROM customer JOIN n ON sector = c_mktsegment GROUP BY ALL""")
def batch_output(spark, sf):
    """Rows written under sector / next batch number."""
    c = table(spark, sf, "customer")
    folders = c.selectExpr("c_mktsegment AS sector", f"{FOLDER} AS folder")
    nxt = files.next_batch(folders, ["sector"])
    rows = c.withColumnRenamed("c_mktsegment", "sector").join(nxt, "sector").withColumn(
        "batch", F.concat(F.lit("batch_"), F.col("next_batch").cast("string")))
    path = fresh_path(spark, "batches")
    sink.write_partitioned(rows.drop("next_batch"), path, ["sector", "batch"])
    return spark.read.parquet(path).groupBy("sector", "batch").agg(F.count("*").alias("n"))


@query("run_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%d/%m/%Y') AS display FROM orders")
def run_dates(spark, sf):
    d = flows.run_dates(F.col("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", *[c.alias(k) for k, c in d.items()])


@query("search_city_tags", ctes("listing") + " SELECT ord, CASE WHEN website <> '' THEN website ELSE 'Lyon' END AS if_missing, 'Lyon' AS overwritten FROM listing")
def search_city_tags(spark, sf):
    rows = view(spark, sf, "listing").select("ord", F.col("website").alias("search_city"))
    a = flows.tag_city(rows, F.lit("Lyon"), overwrite=False).select("ord", F.col("search_city").alias("if_missing"))
    b = flows.tag_city(rows, F.lit("Lyon")).select("ord", F.col("search_city").alias("overwritten"))
    return a.join(b, "ord")
