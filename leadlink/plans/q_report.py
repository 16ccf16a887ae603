"""Queries: city statistics, coverage, fill rates, locations, requests, batches, manifests."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from leadlink import refdata as R
from leadlink.operators import geo, report
from leadlink.operators.keyed import cap_per_group
from leadlink.plans import duck as D
from leadlink.plans.inputs import ctes, table, view
from leadlink.plans.q_classify import OCCUPATIONS, values
from leadlink.plans.registry import query
from leadlink.sources import files
from leadlink.sources.json_responses import REQUEST_SCHEMA, parse, run_requests, work_list


@query("city_statistics", ctes("offer", "potential") + """,
  ids AS (SELECT search_city, siret, max(l) AS l, max(p) AS p FROM (
    SELECT search_city, siret, 1 AS l, 0 AS p FROM offer UNION ALL SELECT search_city, siret, 0, 1 FROM potential) WHERE siret <> '' GROUP BY ALL)
  SELECT search_city, count(*) FILTER (WHERE l = 1) AS n_live, count(*) FILTER (WHERE l = 0) AS n_potential_only,
    count(*) FILTER (WHERE l = 1 AND p = 1) AS n_both, count(*) AS n_unique FROM ids GROUP BY search_city""")
def city_statistics(spark, sf):
    return report.city_statistics(view(spark, sf, "offer"), view(spark, sf, "potential"))


@query("coverage_by_city", ctes("listing") + f"""
  SELECT city, count(*) FILTER (WHERE trim(phone) <> '') AS with_phone, count(*) AS total,
    {D.pct_text("count(*) FILTER (WHERE trim(phone) <> '')", "count(*)")} AS pct FROM listing GROUP BY city""")
def coverage_by_city(spark, sf):
    return report.phone_coverage(view(spark, sf, "listing"), ["city"])


_CAPTURE = "CASE WHEN phone = '' THEN 'vide' WHEN phone LIKE '+%' THEN 'via clic' WHEN phone LIKE '01.%' THEN 'deep' ELSE 'direct' END"


@query("capture_counts", ctes("listing") + f""", k AS (SELECT city, {_CAPTURE} AS c FROM listing),
  g AS (SELECT coalesce(city, '(total)') AS city, c FROM (SELECT city, c FROM k UNION ALL SELECT NULL, c FROM k))
  SELECT city, count(*) FILTER (WHERE c = 'direct') AS direct, count(*) FILTER (WHERE c = 'via clic') AS click,
    count(*) FILTER (WHERE c = 'deep') AS deep, count(*) FILTER (WHERE c = 'vide') AS missing FROM g GROUP BY city""")
def capture_counts(spark, sf):
    return report.capture_counts(view(spark, sf, "listing").withColumn("phone_capture", F.expr(_CAPTURE)), ["city"])


@query("deep_pass_input", ctes("listing") + " SELECT ord, listing_url FROM listing WHERE phone = '' AND listing_url <> ''")
def deep_pass_input(spark, sf):
    return report.deep_pass_input(view(spark, sf, "listing")).select("ord", "listing_url")


@query("owner_counts", "SELECT c_mktsegment AS owner, count(*) AS n FROM customer GROUP BY 1")
def owner_counts(spark, sf):
    return report.most_common(table(spark, sf, "customer").select(F.col("c_mktsegment").alias("owner")), "owner")


_FILL = ["siret", "naf", "phone", "website", "listing_url"]


@query("fill_rate", ctes("listing") + f""", u AS (
  {" UNION ALL ".join(f"SELECT city, '{c}' AS column_name, {c} AS v FROM listing" for c in _FILL)})
  SELECT city, column_name, count(*) FILTER (WHERE trim(v) <> '') AS filled, count(*) AS total,
    {D.pct_text("count(*) FILTER (WHERE trim(v) <> '')", "count(*)")} AS pct FROM u GROUP BY ALL""")
def fill_rate(spark, sf):
    return report.fill_rate(view(spark, sf, "listing"), ["city"], _FILL)


@query("display_samples", ctes("listing") + """
  SELECT category, string_agg(name, ' | ' ORDER BY rn) AS first_names, CAST(max(n) - count(*) AS BIGINT) AS n_others FROM (
    SELECT category, name, row_number() OVER (PARTITION BY category ORDER BY ord) AS rn, count(*) OVER (PARTITION BY category) AS n FROM listing)
  WHERE rn <= 8 GROUP BY category""")
def display_samples(spark, sf):
    rows = view(spark, sf, "listing")
    total = rows.groupBy("category").agg(F.count("*").alias("n"))
    shown = cap_per_group(rows, ["category"], ["ord"], 8).groupBy("category").agg(
        F.array_sort(F.collect_list(F.struct("rn", "name"))).alias("s")
    )
    names = F.array_join(F.transform("s", lambda x: x["name"]), " | ")
    return shown.join(total, "category").select("category", names.alias("first_names"), (F.col("n") - F.size("s")).alias("n_others"))


@query("progress_numbers", ctes("listing") + """
  SELECT ord, '[' || row_number() OVER (PARTITION BY city ORDER BY ord) || '/' || count(*) OVER (PARTITION BY city) || ']' AS progress FROM listing""")
def progress_numbers(spark, sf):
    return files.numbered(view(spark, sf, "listing").select("city", "ord"), ["city"], ["ord"]).select("ord", "progress")


@query("gazetteer_lookup", ctes("listing") + f""", gaz AS {values(["city_key", "lat", "lon"], R.gazetteer_rows())},
  g AS (SELECT n_name AS city, 40.0::DOUBLE + n_nationkey AS lat, 2.0::DOUBLE AS lon FROM nation),
  c AS (SELECT ord, city FROM listing UNION ALL SELECT -1 - c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey)
  SELECT c.ord, c.city, coalesce(g.lat, gaz.lat) AS lat, coalesce(g.lon, gaz.lon) AS lon,
    CASE WHEN g.lat IS NOT NULL THEN 'geocoded' WHEN gaz.lat IS NOT NULL THEN 'local table' ELSE 'unknown city' END AS status
  FROM c LEFT JOIN g USING (city) LEFT JOIN gaz ON gaz.city_key = trim(lower(c.city))""")
def gazetteer_lookup(spark, sf):
    nation = table(spark, sf, "nation")
    geocoded = nation.select(F.col("n_name").alias("city"), (40.0 + F.col("n_nationkey")).alias("lat"), F.lit(2.0).alias("lon"))
    named = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    cities = view(spark, sf, "listing").select("ord", "city").unionByName(
        named.select((-1 - F.col("c_custkey")).alias("ord"), F.col("n_name").alias("city"))
    )
    return geo.locate(cities, geocoded, spark)


_PLACE = (
    "SELECT c_custkey, n_name AS city, 45.0 + n_nationkey * 0.1 + (c_custkey % 50) * 0.002 AS lat, 3.0 + (c_custkey % 7) * 0.01 AS lon "
    "FROM customer JOIN nation ON n_nationkey = c_nationkey"
)
_CENTRE = (
    "SELECT n_name AS city, CASE WHEN n_nationkey % 3 = 0 THEN 45.0 + n_nationkey * 0.1 - 0.006 ELSE 45.0 + n_nationkey * 0.1 END AS clat, "
    "CAST(3.0 AS DOUBLE) AS clon, CASE n_nationkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 5 ELSE 0 END AS radius_km FROM nation"
)


@query("within_radius", f"""WITH p AS ({_PLACE}), c AS ({_CENTRE}),
  j AS (SELECT p.*, clat, clon, radius_km, 2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - clat) / 2), 2)
      + cos(radians(clat)) * cos(radians(lat)) * pow(sin(radians(lon - clon) / 2), 2))) AS km FROM p JOIN c USING (city)),
  n AS (SELECT city, count(*) FILTER (WHERE km <= radius_km) AS hits FROM j GROUP BY city)
  SELECT c_custkey, city, radius_km, round(km, 3) AS km FROM j JOIN n USING (city)
  WHERE km <= radius_km OR (radius_km = 0 AND hits = 0 AND km <= 1)""")
def within_radius(spark, sf):
    nation, customer = table(spark, sf, "nation"), table(spark, sf, "customer")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey", "n_name AS city", "CAST(45.0 + n_nationkey * 0.1 + (c_custkey % 50) * 0.002 AS DOUBLE) AS lat",
        "CAST(3.0 + (c_custkey % 7) * 0.01 AS DOUBLE) AS lon",
    )
    centres = nation.selectExpr(
        "n_name AS city", "CAST(CASE WHEN n_nationkey % 3 = 0 THEN 45.0 + n_nationkey * 0.1 - 0.006 ELSE 45.0 + n_nationkey * 0.1 END AS DOUBLE) AS clat",
        "CAST(3.0 AS DOUBLE) AS clon", "CASE n_nationkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 5 ELSE 0 END AS radius_km",
    )
    return geo.within_radius(rows, centres).select("c_custkey", "city", "radius_km", F.round("km", 3).alias("km"))


_CODES = ["10.71", "47.11D", "86.10Z", "43.32A"]


def _params(spark, sf):
    """One JSON request per customer, in the shapes users write."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    body = F.to_json(F.struct(
        k.cast("string").alias("request_id"),
        F.when(k % 4 == 0, F.col("n_name")).alias("ville"),
        F.when(k % 4 == 1, F.array("n_name", "c_mktsegment")).alias("villes"),
        F.array(*[F.lit(x) for x in _CODES]).alias("codes_naf"),
        F.when(k % 3 == 0, F.lit(0)).alias("rayon_km"),
        F.when(k % 5 == 0, F.lit(200)).alias("nb_max_resultats"),
    ))
    return run_requests(parse(c.select(body.alias("body")), "body", REQUEST_SCHEMA))


@query("request_table", f"""WITH occ AS {OCCUPATIONS}, rome AS (
    SELECT DISTINCT unnest(romes) AS rome FROM occ WHERE naf IN ('47.11D', '86.10Z') OR starts_with(naf, '10.71')),
  req AS (SELECT CAST(c_custkey AS VARCHAR) AS request_id, CASE c_custkey % 4 WHEN 0 THEN [n_name] WHEN 1 THEN [n_name, c_mktsegment] END AS cities,
    CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 30 END AS radius_km, CASE WHEN c_custkey % 5 = 0 THEN 200 ELSE 100 END AS max_results
    FROM customer JOIN nation ON n_nationkey = c_nationkey),
  w AS (SELECT request_id, CAST(radius_km AS INTEGER) AS radius_km, CAST(max_results AS INTEGER) AS max_results, unnest(cities) AS city,
    CAST(unnest(range(0, len(cities))) AS INTEGER) AS city_pos FROM req WHERE cities IS NOT NULL)
  SELECT request_id, radius_km, max_results, city_pos, city, rome FROM w, rome""")
def request_table(spark, sf):
    from leadlink.operators.classify import expand_occupations

    req = _params(spark, sf)
    codes = expand_occupations(R.small_frame(spark, [(c,) for c in _CODES], ["naf"], [pa.string()]), spark)
    occ = req.where("status = 'ok'").select("request_id", "max_results", F.explode("codes_naf").alias("naf")).join(
        F.broadcast(codes), "naf").select("request_id", "max_results", F.explode("occupations").alias("rome")).distinct()
    return work_list(req, occ).select("request_id", "radius_km", "max_results", "city_pos", "city", "rome")


@query("request_status", """
  SELECT CASE WHEN c_custkey % 4 IN (0, 1) THEN 'ok' ELSE 'no city' END AS status, count(*) AS n FROM customer GROUP BY 1""")
def request_status(spark, sf):
    return _params(spark, sf).groupBy("status").agg(F.count("*").alias("n"))


FOLDER = "CASE WHEN c_custkey % 97 = 0 THEN 'batch_30000000' || c_custkey ELSE CASE c_custkey % 5 WHEN 0 THEN 'batch_' || c_custkey WHEN 1 THEN 'batch_' || c_custkey || '_old' WHEN 2 THEN 'Batch_9999999' ELSE c_name END END"


@query("next_batch_number", f"""SELECT c_mktsegment AS sector,
  CAST(coalesce(max(TRY_CAST(nullif(regexp_extract(f, '^batch_([0-9]+)$', 1), '') AS DECIMAL(38, 0))), 0) + 1 AS DECIMAL(38, 0)) AS next_batch
  FROM (SELECT c_mktsegment, {FOLDER} AS f FROM customer) GROUP BY 1""")
def next_batch_number(spark, sf):
    folders = table(spark, sf, "customer").selectExpr("c_mktsegment AS sector", f"{FOLDER} AS folder")
    return files.next_batch(folders, ["sector"])


_LINE = (
    "CASE o_orderkey % 5 WHEN 0 THEN 'BATCH_DIR=/out/b' || o_orderkey WHEN 1 THEN 'DATE = ' || o_orderstatus || '=x' "
    "WHEN 2 THEN 'no separator' WHEN 3 THEN 'SECTEUR=' || o_orderpriority ELSE 'PROFILS=p' || o_orderkey END"
)


@query("manifest_upsert", f"""WITH l AS (SELECT o_custkey AS run, o_orderkey AS version, {_LINE} AS value FROM orders),
  kv AS (SELECT run, version, trim(split_part(value, '=', 1)) AS key, trim(substr(value, strpos(value, '=') + 1)) AS value FROM l WHERE contains(value, '=')),
  e AS (SELECT run, key, arg_max(value, version) AS value FROM kv GROUP BY ALL),
  ok AS (SELECT * FROM e WHERE run IN (SELECT run FROM e WHERE key = 'BATCH_DIR')),
  up AS (SELECT c_custkey AS run, CASE WHEN c_custkey % 2 = 0 THEN 'DATE' ELSE 'LBA_LBB_FILE' END AS key, 'u' || c_custkey AS value FROM customer)
  SELECT coalesce(up.run, ok.run) AS run, coalesce(up.key, ok.key) AS key, coalesce(up.value, ok.value) AS value FROM ok FULL JOIN up ON ok.run = up.run AND ok.key = up.key""")
def manifest_upsert(spark, sf):
    lines = table(spark, sf, "orders").selectExpr("o_custkey AS run", "o_orderkey AS version", f"{_LINE} AS value")
    entries = files.valid_manifests(files.parse_manifest(lines, ["run"]), ["run"])
    updates = table(spark, sf, "customer").selectExpr(
        "c_custkey AS run", "CASE WHEN c_custkey % 2 = 0 THEN 'date' ELSE 'lba_lbb_file' END AS key", "'u' || c_custkey AS value")
    return files.upsert_manifest(entries, updates, ["run"])


@query("manifest_write", """
  SELECT s_suppkey AS run, k.key, k.value FROM supplier, LATERAL (SELECT unnest(['SECTEUR', 'BATCH_DIR', 'DATE', 'PROFILS', 'LBA_LBB_FILE']) AS key,
    unnest(['SB', 'b' || s_suppkey, '', CASE WHEN s_suppkey % 2 = 0 THEN 'p' ELSE '' END, CASE WHEN s_acctbal > 5000 THEN s_name ELSE '' END]) AS value) k
  WHERE key IN ('SECTEUR', 'BATCH_DIR', 'DATE') OR value <> ''""")
def manifest_write(spark, sf):
    runs = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS run", "'SB' AS secteur", "'b' || s_suppkey AS batch_dir", "'' AS date",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'p' ELSE '' END AS profils", "CAST(NULL AS STRING) AS naf_attendus", "'' AS pj_enriched_file",
        "CASE WHEN s_acctbal > 5000 THEN s_name ELSE '' END AS lba_lbb_file")
    return files.manifest_entries(runs, ["run"])


_FILES = "SELECT 'f/' || o_orderkey || '.csv' AS path, o_orderdate AS modified, o_custkey % 40 AS folder FROM orders"
_RUNS = (
    "SELECT c_custkey AS run, c_custkey % 50 AS folder, CASE WHEN c_custkey % 6 = 0 THEN 'r/' || c_custkey ELSE '' END AS requested_path, "
    "CASE c_custkey % 3 WHEN 0 THEN 'f/' || c_custkey || '.csv' WHEN 1 THEN 'gone/' || c_custkey END AS manifest_path FROM customer"
)


@query("input_resolution", f"""WITH f AS ({_FILES}), r AS ({_RUNS}),
  newest AS (SELECT folder, arg_max(path, struct_pack(m := modified, p := path)) AS path FROM f GROUP BY folder)
  SELECT run, folder, requested_path, coalesce(nullif(requested_path, ''), f.path, newest.path) AS path,
    CASE WHEN requested_path <> '' THEN 'requested' WHEN f.path IS NOT NULL THEN 'manifest' WHEN newest.path IS NOT NULL THEN 'newest' ELSE 'none' END AS resolved_by
  FROM r LEFT JOIN (SELECT DISTINCT path FROM f) f ON f.path = r.manifest_path LEFT JOIN newest USING (folder)""")
def input_resolution(spark, sf):
    found = table(spark, sf, "orders").selectExpr("'f/' || o_orderkey || '.csv' AS path", "o_orderdate AS modified", "o_custkey % 40 AS folder")
    runs = table(spark, sf, "customer").selectExpr(
        "c_custkey AS run", "c_custkey % 50 AS folder", "CASE WHEN c_custkey % 6 = 0 THEN 'r/' || c_custkey ELSE '' END AS requested_path",
        "CASE c_custkey % 3 WHEN 0 THEN 'f/' || c_custkey || '.csv' WHEN 1 THEN 'gone/' || c_custkey END AS manifest_path")
    return files.resolve_input(runs, found, "folder")
