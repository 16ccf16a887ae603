"""Queries: crossing sources on the shared id and first-row-per-key consolidation."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlink.operators import keyed, merge, report
from leadlink.plans import duck as D
from leadlink.plans.inputs import RUN_DATE, ctes, view
from leadlink.plans.registry import query


def signal_rows(spark, sf):
    return merge.merge_signals(view(spark, sf, "offer"), view(spark, sf, "potential"))


def crossed(spark, sf):
    listings = keyed.load_listings(view(spark, sf, "listing"))
    signals = keyed.load_signals(signal_rows(spark, sf))
    return merge.cross_and_score(listings, signals, RUN_DATE)


_FILL = ["name", "naf", "address", "city", "cp", "phone", "search_city", "collected_on"]


def _merged_sql(scope: str = "") -> str:
    """CTE bodies live, pot, merged over offer and potential, inside a scope column if given."""
    fill = [c for c in _FILL if c != scope]
    keys = f"{scope}, siret" if scope else "siret"
    live_cols = ", ".join(f"arg_min({c}, ord) AS {c}" for c in fill)
    pot_cols = ", ".join(
        f"arg_min({c}, ord) AS {c}, arg_min({c}, ord) FILTER (WHERE trim({c}) <> '') AS f_{c}" for c in [*fill, "lbb_score"]
    )
    out = ", ".join(
        f"coalesce(CASE WHEN trim(l.{c}) <> '' THEN l.{c} END, p.f_{c}, l.{c}, p.{c}) AS {c}" for c in fill
    )
    return f"""
      live AS (SELECT {keys}, {live_cols}, count(*) AS n, min(ord) AS ord FROM offer WHERE siret <> '' GROUP BY {keys}),
      pot AS (SELECT {keys}, {pot_cols}, count(*) AS n, min(ord) AS ord FROM potential WHERE siret <> '' GROUP BY {keys}),
      merged AS (
        SELECT {keys}, {out}, coalesce(p.f_lbb_score, p.lbb_score, '') AS lbb_score,
          CASE WHEN l.n IS NULL THEN 'LBB' WHEN p.n IS NULL THEN 'LBA' ELSE 'LBA + LBB' END AS source,
          CAST(l.n AS BIGINT) AS offers, l.n IS NOT NULL AND p.n IS NOT NULL AS was_duplicate,
          coalesce(l.ord, p.ord) AS ord, coalesce(l.n, 0) AS n_live, coalesce(p.n, 0) AS n_potential
        FROM live l FULL JOIN pot p USING ({keys}))"""


MERGED = ctes("offer", "potential") + "," + _merged_sql()


@query("merge_sources_by_key", MERGED + " SELECT * FROM merged")
def merge_sources_by_key(spark, sf):
    return signal_rows(spark, sf)


_either = lambda c: f"coalesce(nullif(p.{c}, ''), s.{c}, '') AS {c}"
CROSSED = (
    ctes("offer", "potential", "listing") + "," + _merged_sql() + f""",
  keyed AS (SELECT {D.siret('siret')} AS k, * FROM listing),
  first_listing AS (SELECT * FROM keyed WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY ord) = 1),
  leads AS (
    SELECT coalesce(p.k, s.siret) AS siret, {', '.join(_either(c) for c in ('name', 'naf', 'address', 'city', 'cp'))},
      CASE WHEN trim(coalesce(p.phone, '')) <> '' THEN trim(p.phone) ELSE trim(coalesce(s.phone, '')) END AS phone,
      CASE WHEN trim(coalesce(p.phone, '')) <> '' THEN 'PJ direct'
           WHEN trim(coalesce(s.phone, '')) <> '' THEN CASE WHEN s.source LIKE '%LBA%' THEN 'LBA' ELSE 'LBB' END ELSE '' END AS phone_source,
      coalesce(p.website, '') AS website,
      CASE WHEN s.siret IS NULL THEN 'Basse' WHEN s.source LIKE '%LBA%' THEN 'Haute' ELSE 'Moyenne' END AS priority,
      CASE WHEN s.siret IS NULL THEN 'Pages Jaunes' WHEN p.k IS NULL THEN s.source
           WHEN s.source = 'LBA + LBB' THEN 'PJ + LBA + LBB' WHEN s.source = 'LBA' THEN 'PJ + LBA' ELSE 'PJ + LBB' END AS source,
      coalesce(s.lbb_score, '') AS lbb_score, coalesce(CAST(s.offers AS VARCHAR), '') AS offers, '{RUN_DATE}' AS collected_on,
      p.k IS NOT NULL AND s.siret IS NOT NULL AS matched
    FROM first_listing p FULL JOIN merged s ON p.k = s.siret)"""
)


@query("cross_and_score", CROSSED + " SELECT * EXCLUDE (matched) FROM leads")
def cross_and_score(spark, sf):
    return merge.order_leads(crossed(spark, sf).drop("matched"))


@query("priority_counts", CROSSED + """
  SELECT count(*) FILTER (WHERE priority = 'Haute') AS haute, count(*) FILTER (WHERE priority = 'Moyenne') AS moyenne,
    count(*) FILTER (WHERE priority = 'Basse') AS basse, count(*) FILTER (WHERE matched) AS matches, count(*) AS total FROM leads""")
def priority_counts(spark, sf):
    return report.priority_counts(crossed(spark, sf))


@query("phone_coverage", CROSSED + f"""
  SELECT source, count(*) FILTER (WHERE trim(phone) <> '') AS with_phone, count(*) AS total,
    {D.pct_text("count(*) FILTER (WHERE trim(phone) <> '')", "count(*)")} AS pct FROM leads GROUP BY source""")
def phone_coverage(spark, sf):
    return report.phone_coverage(crossed(spark, sf), ["source"])


_SIG = ["siret", "source", "name", "ord"]
_BOTH = ctes("offer", "potential") + """, rows AS (
    SELECT siret, 'LBB' AS source, name, ord * 2 AS ord FROM potential
    UNION ALL SELECT siret, 'LBA' AS source, name, ord * 2 + 1 AS ord FROM offer)"""


def _mixed_signals(spark, sf):
    p = view(spark, sf, "potential").select("siret", F.lit("LBB").alias("source"), "name", (F.col("ord") * 2).alias("ord"))
    o = view(spark, sf, "offer").select("siret", F.lit("LBA").alias("source"), "name", (F.col("ord") * 2 + 1).alias("ord"))
    return p.unionByName(o)


@query("load_signals_keyed", _BOTH + f""", k AS (SELECT {D.siret('siret')} AS siret, source, name, ord FROM rows)
  SELECT * FROM k WHERE siret <> '' QUALIFY row_number() OVER (
    PARTITION BY siret ORDER BY CASE WHEN source LIKE '%LBA%' THEN 0 ELSE 1 END, ord) = 1""")
def load_signals_keyed(spark, sf):
    return keyed.load_signals(_mixed_signals(spark, sf))


@query("load_listings_keyed", ctes("listing") + f""", k AS (SELECT * REPLACE ({D.siret('siret')} AS siret) FROM listing)
  SELECT siret, ord, name, phone FROM k WHERE siret <> '' QUALIFY row_number() OVER (PARTITION BY siret ORDER BY ord) = 1""")
def load_listings_keyed(spark, sf):
    return keyed.load_listings(view(spark, sf, "listing")).select("siret", "ord", "name", "phone")


_ROW = ["ord", "siret", "name", "cp", "city"]
_first = lambda part, order: f"QUALIFY row_number() OVER (PARTITION BY {part} ORDER BY {order}) = 1"


@query("consolidate_first_per_key", ctes("listing") + """
  SELECT ord, siret, name, cp, city FROM (SELECT *, CASE WHEN siret = '' THEN '#' || ord ELSE siret END AS k FROM listing)
  """ + _first("k", "city_ord, ord"))
def consolidate_first_per_key(spark, sf):
    return keyed.first_per_siret_keep_blank(view(spark, sf, "listing"), ["city_ord", "ord"]).select(*_ROW)


@query("consolidate_name_cp", ctes("listing") + " SELECT ord, siret, name, cp, city FROM listing " + _first("lower(name), cp", "city_ord, ord"))
def consolidate_name_cp(spark, sf):
    return keyed.first_per_name_cp(view(spark, sf, "listing"), ["city_ord", "ord"]).select(*_ROW)


@query("consolidate_two_key", ctes("listing") + """
  SELECT ord, siret, name, cp, city FROM listing """ + _first(
    "CASE WHEN trim(siret) <> '' THEN 'i' || trim(siret) ELSE 'n' || lower(name) END, CASE WHEN trim(siret) <> '' THEN '' ELSE cp END", "ord"))
def consolidate_two_key(spark, sf):
    return keyed.first_per_siret_or_name(view(spark, sf, "listing"), ["ord"]).select(*_ROW)


@query("consolidate_mixed_key", ctes("listing") + f""",
  named AS (SELECT * FROM listing WHERE siret <> '' {_first("city, siret", "ord")}),
  kept AS (SELECT * FROM named UNION ALL SELECT * FROM listing WHERE siret = ''),
  lead AS (SELECT *, min(ord) OVER (PARTITION BY city, lower(name), cp) AS f FROM kept)
  SELECT ord, siret, name, cp, city FROM lead WHERE siret <> '' OR ord = f""")
def consolidate_mixed_key(spark, sf):
    return keyed.first_per_mixed_key(view(spark, sf, "listing"), ["city"]).select(*_ROW)


@query("dedup_audit", ctes("listing") + """
  SELECT 'name+cp' AS stage, f AS kept_ord, ord AS dropped_ord, name, cp FROM (
    SELECT *, first_value(ord) OVER (PARTITION BY lower(name), cp ORDER BY ord) AS f FROM listing) WHERE ord <> f""")
def dedup_audit(spark, sf):
    rows = view(spark, sf, "listing").withColumn("_n", F.lower("name"))
    kept = keyed.first_per_name_cp(rows, ["ord"])
    return keyed.duplicates_of(rows, kept, ["_n", "cp"], "name+cp").join(
        rows.select(F.col("ord").alias("dropped_ord"), "name"), "dropped_ord"
    ).select("stage", "kept_ord", "dropped_ord", "name", "cp")


_COLS = merge.LEAD_COLUMNS
_FILLED = D.filled(_COLS)
_PRIO = "CASE priority WHEN 'Haute' THEN 0 WHEN 'Moyenne' THEN 1 WHEN 'Basse' THEN 2 ELSE 9 END"
_RANK = f"struct_pack(a := CASE WHEN trim(phone) <> '' THEN 0 ELSE 1 END, b := {_PRIO}, c := -{_FILLED}, d := ord)"
KEYED_LEADS = "SELECT * REPLACE (CASE WHEN ord % 5 = 0 THEN '' WHEN ord % 3 = 0 THEN '1' ELSE CAST(ord - ord % 7 AS STRING) END AS siret) FROM lead"


def copied_leads(spark, sf):
    key = F.expr("CASE WHEN ord % 5 = 0 THEN '' WHEN ord % 3 = 0 THEN '1' ELSE CAST(ord - ord % 7 AS STRING) END")
    return view(spark, sf, "lead").withColumn("siret", key)


@query("dedup_best_per_key", ctes("lead") + f""", r AS (SELECT *, {_RANK} AS rk FROM ({KEYED_LEADS}))
  SELECT siret, {', '.join(f"coalesce(arg_min({c}, rk) FILTER (WHERE trim({c}) <> ''), arg_min({c}, rk)) AS {c}" for c in _COLS if c != 'siret')},
    min(rk).d AS ord, count(*) AS n_rows FROM r WHERE siret <> '' GROUP BY siret
  UNION ALL BY NAME SELECT {', '.join(_COLS)}, ord, 1 AS n_rows FROM r WHERE siret = ''""")
def dedup_best_per_key(spark, sf):
    return keyed.best_per_siret(copied_leads(spark, sf), _COLS)


@query("row_richness", ctes("lead") + f" SELECT ord, {_FILLED} AS filled FROM lead")
def row_richness(spark, sf):
    return view(spark, sf, "lead").select("ord", keyed.count_filled(_COLS).alias("filled"))


@query("cap_per_group", ctes("listing") + f""",
  d AS (SELECT * FROM listing {_first("lower(name), cp", "city_ord, ord")})
  SELECT city, ord, name, row_number() OVER (PARTITION BY city ORDER BY ord) AS rn FROM d QUALIFY rn <= 100""")
def cap_per_group(spark, sf):
    one = keyed.first_per_name_cp(view(spark, sf, "listing"), ["city_ord", "ord"])
    return keyed.cap_per_group(one, ["city"], ["ord"], 100).select("city", "ord", "name", F.col("rn").cast("bigint").alias("rn"))
