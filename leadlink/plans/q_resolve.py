"""Queries: best-match resolution, back-fill and resume.

Searches are orders and their candidates are the order's lines, so candidate lists grow
with the data.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leadlink.functions import text as T
from leadlink.operators import merge, report, resolve
from leadlink.operators.keyed import load_phone_listings
from leadlink.plans import duck as D
from leadlink.plans.inputs import ctes, table, view
from leadlink.plans.registry import query

_Q = {
    "query_id": "o_orderkey",
    "name": "CASE WHEN o_orderkey % 17 = 0 THEN 'SARL' WHEN o_orderkey % 2 = 0 THEN 'Sarl ' || p_name ELSE p_name END",
    "cp": "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE lpad(CAST(p_size AS STRING), 5, '0') END",
    "city": "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE p_brand END",
    "failed": "o_orderkey % 23 = 0",
    "siret": "CASE o_orderkey % 5 WHEN 0 THEN CAST(p_partkey AS STRING) WHEN 1 THEN '9' || lpad(CAST(p_partkey AS STRING), 13, '0') ELSE '' END",
}
_C = {
    "query_id": "l_orderkey",
    "retry": "CASE WHEN l_orderkey % 6 = 0 THEN 1 ELSE 0 END",
    "pos": "pos",
    "tie": "l_partkey",
    "n1": "p_name",
    "n2": "CASE WHEN l_partkey % 3 = 0 THEN p_type || ' ' || p_name ELSE '' END",
    "n3": "CASE WHEN l_partkey % 4 = 0 THEN 'EURL ' || replace(p_name, ' ', '  ') ELSE '' END",
    "cand_cp": "CASE WHEN l_partkey % 3 = 1 THEN lpad(CAST(p_size AS STRING), 5, '0') ELSE '00007' END",
    "cand_city": "lower(p_brand) || ' sur mer'",
    "siret": "CAST(l_partkey AS STRING)",
    "naf": "p_type",
}
_FROM_Q = "orders JOIN part ON o_custkey = p_partkey"
# Every line of an order is a candidate; its position is its place among them.
_PLACE = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
_FROM_C = f"(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_PLACE)}) AS pos FROM lineitem) JOIN part ON l_partkey = p_partkey"
_sel = lambda d: ", ".join(f"{e} AS {c}" for c, e in d.items())
SEARCHES = f"q AS (SELECT {_sel(_Q)} FROM {_FROM_Q}), c AS (SELECT {_sel(_C)} FROM {_FROM_C})"


def searches(spark, sf):
    part = table(spark, sf, "part")
    q = table(spark, sf, "orders").join(part, F.col("o_custkey") == F.col("p_partkey"))
    q = q.selectExpr(*[f"{e} AS {c}" for c, e in _Q.items()])
    place = Window.partitionBy("l_orderkey").orderBy(*_PLACE)
    lines = table(spark, sf, "lineitem").select("l_orderkey", *_PLACE).withColumn("pos", F.row_number().over(place))
    c = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).selectExpr(*[f"{e} AS {k}" for k, e in _C.items()])
    c = c.withColumn("names", F.filter(F.array("n1", "n2", "n3"), lambda n: n != ""))
    return q, c


_REG = lambda x: D.clean(x, T.LEGAL_FORMS_REGISTRY, accents=True)
RESOLVED = f"""WITH {SEARCHES},
  qq AS (SELECT *, {_REG('name')} AS qn FROM q),
  cn AS (SELECT c.*, t.i AS npos, t.nm AS cname FROM c, LATERAL (SELECT unnest([0, 1, 2]) AS i, unnest([n1, n2, n3]) AS nm) t WHERE t.nm <> ''),
  j AS (SELECT cn.*, qq.qn, {_REG('cname')} AS cc,
         CASE WHEN qq.cp <> '' AND cn.cand_cp = qq.cp THEN 1 WHEN trim(qq.city) <> '' AND contains(lower(cn.cand_city), lower(trim(qq.city))) THEN 2 ELSE 3 END AS tier
         FROM cn JOIN qq USING (query_id) WHERE cn.retry = 0 OR qq.name <> qq.qn),
  u AS (SELECT DISTINCT qn, cc FROM j), s AS (SELECT qn, cc, {D.ratio('qn', 'cc')} AS sim FROM u),
  best AS (SELECT j.*, s.sim FROM j JOIN s USING (qn, cc)
           QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY retry, tier, sim DESC, pos, npos) = 1),
  resolved AS (
    SELECT qq.query_id, qq.name, qq.cp, qq.city,
      CASE WHEN qq.qn = '' OR qq.failed OR b.sim IS NULL OR b.sim < 80 THEN '' ELSE lpad(b.siret, 14, '0') END AS siret,
      CASE WHEN qq.qn = '' OR qq.failed OR b.sim IS NULL OR b.sim < 80 THEN '' ELSE b.naf END AS naf,
      CASE WHEN qq.qn = '' OR qq.failed OR coalesce(round_even(b.sim, 0), 0) = 0 THEN '' ELSE CAST(CAST(round_even(b.sim, 0) AS INTEGER) AS VARCHAR) END AS score,
      CASE WHEN qq.qn = '' THEN 'Exclu — nom vide' WHEN qq.failed THEN 'Exclu — erreur API' WHEN coalesce(b.sim, 0) <= 0 THEN 'Exclu — SIRET introuvable'
           WHEN b.sim >= 80 THEN 'SIRET trouvé' ELSE 'Exclu — similarité ' || CAST(round_even(b.sim, 0) AS INTEGER) || '% < 80%' END AS status
    FROM qq LEFT JOIN best b USING (query_id))"""


def resolved(spark, sf):
    q, c = searches(spark, sf)
    return resolve.resolve_registry(q.drop("siret"), c).drop("failed")


@query("resolve_best_match", RESOLVED + " SELECT * FROM resolved")
def resolve_best_match(spark, sf):
    return resolved(spark, sf)


@query("enrichment_synthesis", RESOLVED + f"""
  SELECT count(*) AS total, count(*) FILTER (WHERE status = 'SIRET trouvé') AS found, count(*) FILTER (WHERE status LIKE 'Exclu%') AS excluded,
    count(*) FILTER (WHERE status LIKE 'Exclu — erreur%') AS errors,
    {D.pct_text("count(*) FILTER (WHERE status = 'SIRET trouvé')", "count(*)")} AS found_pct FROM resolved""")
def enrichment_synthesis(spark, sf):
    return report.enrichment_synthesis(resolved(spark, sf))


_LIGHT = lambda x: D.clean(x, T.LEGAL_FORMS_PROFILE)


def _best_profile(tag: str, use_cp: bool) -> str:
    """CTEs s_/b_ of one search pass. Names and cities are scored once per distinct pair."""
    cp = "q.cp" if use_cp else "''"
    return f"""
  e{tag} AS (SELECT c.query_id, c.pos, c.siret, c.cand_cp, t.i AS npos, t.nm AS cname, {cp} AS qcp, lq.light AS ql, lq.kw AS qa, lc.light AS cl, lc.kw AS ca,
      upper({D.ascii_fold('q.city')}) AS qc, upper({D.ascii_fold('trim(c.cand_city)')}) AS cc
    FROM c, LATERAL (SELECT unnest([0, 1, 2]) AS i, unnest([n1, n2, n3]) AS nm) t JOIN todo q ON q.query_id = c.query_id
    JOIN nm lq ON lq.nm = q.name JOIN nm lc ON lc.nm = t.nm WHERE t.nm <> ''),
  p{tag} AS (SELECT ql, cl, qa, ca, greatest({D.ratio('ql', 'cl')}, {D.ratio(D.token_sort('ql'), D.token_sort('cl'))}, {D.ratio(D.token_sort('qa'), D.token_sort('ca'))}) AS s
    FROM (SELECT DISTINCT ql, cl, qa, ca FROM e{tag})),
  v{tag} AS (SELECT qc, cc, CASE WHEN qc <> '' AND cc <> '' AND {D.ratio('qc', 'cc')} >= 80 THEN 20 ELSE 0 END AS bonus FROM (SELECT DISTINCT qc, cc FROM e{tag})),
  x{tag} AS (SELECT *, CAST(trunc(0.5 * s + bonus + CASE WHEN qcp <> '' AND qcp = cand_cp THEN 30 ELSE 0 END) AS INTEGER) AS score,
      count(DISTINCT pos) OVER (PARTITION BY query_id) AS nc
    FROM e{tag} JOIN p{tag} USING (ql, cl, qa, ca) JOIN v{tag} USING (qc, cc)),
  b{tag} AS (SELECT *, score >= CASE WHEN nc = 1 AND qcp <> '' AND cand_cp = qcp THEN 50 ELSE 60 END AS found FROM x{tag} WHERE score > 0
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pos, s DESC, npos) = 1)"""


PROFILED = f"""WITH {SEARCHES}, company AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 14, '0') AS siret FROM part),
  qs AS (SELECT *, {D.siret('siret')} AS k FROM q),
  direct AS (SELECT qs.query_id, k FROM qs JOIN company ON k = company.siret),
  todo AS (SELECT * FROM qs WHERE query_id NOT IN (SELECT query_id FROM direct)),
  names AS (SELECT name AS nm FROM q UNION SELECT n1 FROM c UNION SELECT n2 FROM c UNION SELECT n3 FROM c),
  nm AS (SELECT nm, {_LIGHT('nm')} AS light, {D.keywords('nm')} AS kw FROM names),{_best_profile('1', True)},{_best_profile('2', False)},
  second AS (SELECT b2.* FROM b2 JOIN todo USING (query_id) WHERE todo.cp <> ''),
  profiled AS (
  SELECT q.query_id, CASE WHEN d.k IS NOT NULL THEN d.k WHEN a.found THEN lpad(a.siret, 14, '0') WHEN b.found THEN lpad(b.siret, 14, '0') ELSE '' END AS siret,
    CASE WHEN d.k IS NOT NULL THEN 100 WHEN a.found THEN a.score WHEN b.found THEN b.score ELSE 0 END AS score,
    CASE WHEN d.k IS NOT NULL THEN 'SIRET trouvé (direct)' WHEN a.found THEN CASE WHEN a.score >= 80 THEN 'Trouvé par nom' ELSE 'SIRET trouvé (confiance moyenne)' END
      WHEN b.found THEN CASE WHEN b.score >= 80 THEN 'Trouvé par nom (sans CP)' ELSE 'SIRET trouvé (confiance moyenne)' END ELSE 'Non trouvé' END AS status,
    CASE WHEN d.k IS NOT NULL THEN '' WHEN a.found THEN a.cname WHEN b.found THEN b.cname WHEN coalesce(b.score, 0) > coalesce(a.score, 0) THEN b.cname
      ELSE coalesce(a.cname, '') END AS cand_name
  FROM q LEFT JOIN direct d USING (query_id) LEFT JOIN b1 a USING (query_id) LEFT JOIN second b USING (query_id))"""


def profiled(spark, sf):
    q, c = searches(spark, sf)
    companies = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("siret"))
    return resolve.enrich_profiles(q.drop("failed"), companies, c, c)


@query("resolve_multicriteria", PROFILED + " SELECT * FROM profiled")
def resolve_multicriteria(spark, sf):
    return profiled(spark, sf)




def _both(spark, sf):
    listings = resolved(spark, sf).select(F.col("query_id").alias("listing_id"), "siret")
    other = profiled(spark, sf).select(F.col("query_id").alias("listing_id"), "siret")
    return merge.compare_ids(listings, other)


COMPARED = RESOLVED + "," + PROFILED.split("WITH ", 1)[1].split(SEARCHES + ",", 1)[1] + """,
  compared AS (SELECT r.query_id AS listing_id, r.siret, p.siret AS other_siret,
    CASE WHEN r.siret <> '' AND p.siret <> '' THEN CASE WHEN r.siret = p.siret THEN 'Identique' ELSE 'Différent (Pappers: ' || p.siret || ')' END
      WHEN p.siret <> '' THEN 'Pappers seul' WHEN r.siret <> '' THEN 'SIRENE seul' ELSE 'Non trouvé' END AS comparison FROM resolved r JOIN profiled p USING (query_id))"""


@query("compare_registries", COMPARED + " SELECT *, CASE WHEN comparison LIKE 'Diff%' THEN 'Différent' ELSE comparison END AS kind FROM compared")
def compare_registries(spark, sf):
    return _both(spark, sf)


@query("compare_summary", COMPARED + """, n AS (SELECT count(*) AS total, count(*) FILTER (WHERE comparison = 'Identique') AS same,
    count(*) FILTER (WHERE comparison LIKE 'Diff%') AS different, count(*) FILTER (WHERE comparison = 'Pappers seul') AS only_other,
    count(*) FILTER (WHERE comparison = 'SIRENE seul') AS only_registry, count(*) FILTER (WHERE comparison = 'Non trouvé') AS neither FROM compared)
  SELECT *, (same + different + only_registry) * 100 // total AS registry_pct, (same + different + only_other) * 100 // total AS other_pct FROM n""")
def compare_summary(spark, sf):
    return merge.comparison_summary(_both(spark, sf))


@query("first_candidate_ids", f"""WITH {SEARCHES},
  h AS (SELECT query_id, min(CASE WHEN tie % 2 = 0 THEN siret ELSE '9' || siret END) AS s FROM c WHERE pos = 1 GROUP BY query_id)
  SELECT q.query_id, name, CASE WHEN q.siret <> '' THEN q.siret ELSE coalesce(s, '') END AS siret FROM q LEFT JOIN h USING (query_id)""")
def first_candidate_ids(spark, sf):
    q, c = searches(spark, sf)
    cands = c.select(
        "query_id", (F.col("pos") - 1).alias("pos"), F.expr("CASE WHEN tie % 2 = 0 THEN siret END").alias("siege_siret"),
        F.concat(F.lit("9"), "siret").alias("siret"),
    )
    return resolve.first_candidate_ids(q.select("query_id", "name", "siret"), cands, ["query_id"])


@query("coalesce_overwrite", PROFILED + """
  SELECT q.query_id, CASE WHEN p.siret <> '' THEN p.siret WHEN q.siret <> '' THEN q.siret ELSE '' END AS siret, q.name, q.cp FROM q LEFT JOIN profiled p USING (query_id)""")
def coalesce_overwrite(spark, sf):
    q, _ = searches(spark, sf)
    found = profiled(spark, sf).select("query_id", "siret")
    return merge.add_profile_fields(q.select("query_id", "name", "cp", "siret"), found, "query_id", ["siret"])


@query("phone_backfill", ctes("lead", "listing") + f""",
  l AS (SELECT ord AS lead_id, phone, {D.cp('cp')} AS block, {D.token_sort(D.clean('name', T.LEGAL_FORMS_LINK))} AS na FROM lead),
  p AS (SELECT {D.cp('cp')} AS block, {D.token_sort(D.clean('name', T.LEGAL_FORMS_LINK))} AS nb, ord, phone FROM listing WHERE trim(phone) <> ''),
  pool AS (SELECT block, nb, arg_min(phone, ord) AS phone, min(ord) AS ord FROM p WHERE block <> '' GROUP BY ALL),
  need AS (SELECT DISTINCT block, na FROM l WHERE trim(phone) = ''),
  nn AS (SELECT DISTINCT na, nb FROM need JOIN pool USING (block)),
  s AS (SELECT na, nb, {D.ratio('na', 'nb')} AS sim FROM nn WHERE na <> '' AND nb <> ''),
  best AS (SELECT need.block, need.na, pool.phone FROM need JOIN pool USING (block) JOIN s ON s.na = need.na AND s.nb = pool.nb WHERE sim >= 85
           QUALIFY row_number() OVER (PARTITION BY need.block, need.na ORDER BY sim DESC, pool.ord) = 1)
  SELECT lead_id, CASE WHEN trim(l.phone) <> '' THEN l.phone ELSE coalesce(b.phone, l.phone) END AS phone,
    CASE WHEN trim(l.phone) <> '' THEN 'already' WHEN b.phone IS NOT NULL THEN 'added' ELSE 'missing' END AS outcome
  FROM l LEFT JOIN best b ON l.block = b.block AND l.na = b.na AND trim(l.phone) = ''""")
def phone_backfill(spark, sf):
    leads = view(spark, sf, "lead").withColumnRenamed("ord", "lead_id")
    pool = load_phone_listings(view(spark, sf, "listing"))
    return resolve.backfill_phones(leads.select("lead_id", "name", "cp", "phone", "phone_source"), pool).select("lead_id", "phone", "outcome")


@query("resume_todo", ctes("listing") + """,
  prog AS (SELECT ord AS seq, upper(name) AS name, cp, 'S' || ord AS siret FROM listing WHERE listing_url LIKE '/%'),
  last AS (SELECT lower(name) AS n, cp, arg_max(siret, seq) AS siret FROM prog GROUP BY ALL)
  SELECT l.ord, l.name, l.cp, last.siret IS NULL AS todo, last.siret FROM listing l LEFT JOIN last ON last.n = lower(l.name) AND last.cp = l.cp""")
def resume_todo(spark, sf):
    rows = view(spark, sf, "listing").select("ord", "name", "cp")
    progress = view(spark, sf, "listing").where("listing_url LIKE '/%'").select(
        F.col("ord").alias("seq"), F.upper("name").alias("name"), "cp", F.concat(F.lit("S"), F.col("ord").cast("string")).alias("siret")
    )
    todo, done = resolve.todo_and_done(rows, progress)
    return todo.select("*", F.lit(True).alias("todo"), F.lit(None).cast("string").alias("siret")).unionByName(
        done.select("ord", "name", "cp", F.lit(False).alias("todo"), "siret")
    )
