"""Queries: fuzzy deduplication in its three modes."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlink.functions import text as T
from leadlink.operators import dedup, flows, keyed, report
from leadlink.operators.merge import LEAD_COLUMNS
from leadlink.plans import duck as D
from leadlink.plans.inputs import ctes, table, view
from leadlink.plans.q_core import KEYED_LEADS, copied_leads
from leadlink.plans.registry import query

_NAME = D.token_sort(D.clean("name", T.LEGAL_FORMS_LINK))
_FILLED = D.filled(LEAD_COLUMNS)
_PRIO = "CASE priority WHEN 'Haute' THEN 0 WHEN 'Moyenne' THEN 1 WHEN 'Basse' THEN 2 ELSE 9 END"


def _dominance_ctes(tag: str, block: str, rank: str, threshold: int, source: str = "lead") -> str:
    """CTE judged_<tag>: every row against every better row of its block with a similar name."""
    return f"""
  r_{tag} AS (SELECT *, {block} AS block, {_NAME} AS nk, {rank} AS rk FROM {source} l),
  n_{tag} AS (SELECT DISTINCT nk FROM r_{tag}), s_{tag} AS (
    SELECT a.nk AS na, b.nk AS nb, CASE WHEN a.nk = b.nk THEN 100.0 ELSE {D.ratio('a.nk', 'b.nk')} END AS sim FROM n_{tag} a JOIN n_{tag} b
    ON a.nk = b.nk OR (length(a.nk) > 0 AND length(b.nk) > 0 AND 200 * least(length(a.nk), length(b.nk)) >= {threshold} * (length(a.nk) + length(b.nk)))),
  best_{tag} AS (SELECT block, nk, min(rk) AS rk FROM r_{tag} WHERE block <> '' GROUP BY ALL),
  top_{tag} AS (SELECT x.block, x.nk, min(struct_pack(rk := y.rk, sim := s.sim)) AS d FROM best_{tag} x
          JOIN s_{tag} s ON s.na = x.nk AND s.sim >= {threshold} JOIN best_{tag} y ON y.block = x.block AND y.nk = s.nb GROUP BY ALL),
  judged_{tag} AS (SELECT r.*, CASE WHEN d.rk < r.rk THEN d.rk.ord END AS kept_ord, CASE WHEN d.rk < r.rk THEN d.sim END AS sim
          FROM r_{tag} r LEFT JOIN top_{tag} t ON t.block = r.block AND t.nk = r.nk)"""


_PHONE_RANK = f"struct_pack(a := CASE WHEN trim(phone) <> '' THEN 0 ELSE 1 END, b := {_PRIO}, c := -{_FILLED}, ord := ord)"
_NAME_RANK = f"struct_pack(c := -{_FILLED}, ord := ord)"
_PHONE = _dominance_ctes("phone", D.phone_nine("phone"), _PHONE_RANK, dedup.PHONE_THRESHOLD)
_DEPT = _dominance_ctes("dept", f"substr({D.cp('cp')}, 1, 2)", _NAME_RANK, dedup.NAME_THRESHOLD)
PHONE_SQL = ctes("lead") + "," + _PHONE
NAME_SQL = ctes("lead") + "," + _DEPT


def by_phone(spark, sf):
    rows = dedup.with_phone_block(view(spark, sf, "lead"))
    return dedup.dominance(rows, keyed.dedup_rank(LEAD_COLUMNS), dedup.PHONE_THRESHOLD)


def by_name(spark, sf):
    rows = dedup.with_department_block(view(spark, sf, "lead"))
    return dedup.dominance(rows, keyed.dedup_rank(LEAD_COLUMNS)[2:], dedup.NAME_THRESHOLD)


@query("dedup_phone_dominance", PHONE_SQL + " SELECT ord, block, nk AS name_key, kept_ord, sim FROM judged_phone")
def dedup_phone_dominance(spark, sf):
    return by_phone(spark, sf).select("ord", "block", "name_key", "kept_ord", "sim")


@query("dedup_name_dominance", NAME_SQL + " SELECT ord, block, nk AS name_key, kept_ord, sim FROM judged_dept")
def dedup_name_dominance(spark, sf):
    return by_name(spark, sf).select("ord", "block", "name_key", "kept_ord", "sim")


@query("dedup_merge_audit", NAME_SQL + """
  SELECT j.kept_ord, j.ord AS dropped_ord, '"' || k.name || '" (' || k.cp || ') ≈ "' || j.name || '" (' || j.cp || ') → fusionné (' ||
    CAST(CAST(round(j.sim, 1) AS DECIMAL(4, 1)) AS VARCHAR) || '%)' AS detail FROM judged_dept j JOIN lead k ON k.ord = j.kept_ord""")
def dedup_merge_audit(spark, sf):
    return dedup.merge_audit(by_name(spark, sf))


@query("dedup_stage_counts", PHONE_SQL + "," + _DEPT + """
  SELECT 'phone' AS stage, count(kept_ord) AS removed, count(*) - count(kept_ord) AS remaining FROM judged_phone
  UNION ALL SELECT 'name', count(kept_ord), count(*) - count(kept_ord) FROM judged_dept""")
def dedup_stage_counts(spark, sf):
    return report.stage_counts(by_phone(spark, sf), "phone").unionByName(report.stage_counts(by_name(spark, sf), "name"))


def _survivors_sql(tag: str) -> str:
    """One pass in rank order per block: a name stays unless a staying better name is similar."""
    return f"""
  i_{tag} AS (SELECT block, nk, rk, row_number() OVER (PARTITION BY block ORDER BY rk) AS i FROM best_{tag}),
  e_{tag} AS (SELECT y.block, y.i AS worse, list(x.i) AS better FROM i_{tag} x JOIN i_{tag} y ON x.block = y.block AND x.i < y.i
          JOIN s_{tag} s ON s.na = x.nk AND s.nb = y.nk AND s.sim >= {{threshold}} GROUP BY ALL),
  step_{tag} AS (
    SELECT DISTINCT block, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS stay FROM i_{tag}
    UNION ALL SELECT p.block, p.n + 1, CASE WHEN e.worse IS NOT NULL AND list_has_any(e.better, p.stay) THEN p.stay ELSE list_append(p.stay, p.n + 1) END
    FROM step_{tag} p JOIN i_{tag} k ON k.block = p.block AND k.i = p.n + 1 LEFT JOIN e_{tag} e ON e.block = p.block AND e.worse = p.n + 1),
  stay_{tag} AS (SELECT block, unnest(arg_max(stay, n)) AS i FROM step_{tag} GROUP BY block),
  by_{tag} AS (SELECT y.block, y.nk, min(struct_pack(rk := x.rk, sim := s.sim)) AS d FROM i_{tag} y JOIN i_{tag} x ON x.block = y.block AND x.i < y.i
          JOIN stay_{tag} k ON k.block = x.block AND k.i = x.i JOIN s_{tag} s ON s.na = x.nk AND s.nb = y.nk AND s.sim >= {{threshold}} GROUP BY ALL)
  SELECT r.ord, r.block, r.nk AS name_key, coalesce(b.d.rk.ord, CASE WHEN r.rk <> t.rk THEN t.rk.ord END) AS kept_ord,
    coalesce(b.d.sim, CASE WHEN r.rk <> t.rk THEN 100.0 END) AS sim
  FROM r_{tag} r LEFT JOIN best_{tag} t ON t.block = r.block AND t.nk = r.nk LEFT JOIN by_{tag} b ON b.block = r.block AND b.nk = r.nk"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@query("dedup_phone_survivors", _recursive(PHONE_SQL) + "," + _survivors_sql("phone").format(threshold=dedup.PHONE_THRESHOLD))
def dedup_phone_survivors(spark, sf):
    rows = dedup.with_phone_block(view(spark, sf, "lead"))
    return dedup.survivors(rows, keyed.dedup_rank(LEAD_COLUMNS), dedup.PHONE_THRESHOLD).select("ord", "block", "name_key", "kept_ord", "sim")


@query("dedup_name_survivors", _recursive(NAME_SQL) + "," + _survivors_sql("dept").format(threshold=dedup.NAME_THRESHOLD))
def dedup_name_survivors(spark, sf):
    rows = dedup.with_department_block(view(spark, sf, "lead"))
    return dedup.survivors(rows, keyed.dedup_rank(LEAD_COLUMNS)[2:], dedup.NAME_THRESHOLD).select("ord", "block", "name_key", "kept_ord", "sim")


def _stage_ctes(tag: str, block: str, rank: str, threshold: int, source: str, out: str) -> str:
    """CTE `out`: what a survivors stage leaves of `source`, blanks filled from the rows that went into each survivor.
    A row that goes points at one that stays, never at another that goes."""
    fate = _survivors_sql(tag).format(threshold=threshold)
    ctes_of, select = fate.split("\n  SELECT r.ord", 1)
    order = f"struct_pack(a := CASE WHEN f.kept_ord IS NULL THEN 0 ELSE 1 END, r := {rank})"
    fills = ", ".join(f"coalesce(arg_min({c}, w) FILTER (WHERE trim({c}) <> ''), arg_min({c}, w)) AS {c}" for c in LEAD_COLUMNS)
    return f"""{_dominance_ctes(tag, block, rank, threshold, source)},{ctes_of}, fate_{tag} AS MATERIALIZED (SELECT r.ord{select}),
  {out} AS MATERIALIZED (SELECT root AS ord, {fills} FROM (SELECT l.*, coalesce(f.kept_ord, l.ord) AS root, {order} AS w
    FROM {source} l JOIN fate_{tag} f ON f.ord = l.ord) GROUP BY root)"""


_BOTH_RANK = f"struct_pack(c := -{_FILLED}, b := {_PRIO}, ord := l.ord)"
_ID_FILLS = ", ".join(f"coalesce(arg_min({c}, rk) FILTER (WHERE trim({c}) <> ''), arg_min({c}, rk)) AS {c}" for c in LEAD_COLUMNS if c != "siret")
CHAIN_SQL = _recursive(ctes("lead")) + f""",
  every AS (SELECT * REPLACE (trim(siret) AS siret) FROM ({KEYED_LEADS})),
  ided AS MATERIALIZED (SELECT min(rk).ord AS ord, siret, {_ID_FILLS} FROM (SELECT *, {_PHONE_RANK} AS rk FROM every WHERE siret <> '') GROUP BY siret
    UNION ALL BY NAME SELECT ord, {', '.join(LEAD_COLUMNS)} FROM every WHERE siret = ''),
  {_stage_ctes('c1', D.phone_nine('phone'), _PHONE_RANK.replace(':= ord', ':= l.ord'), dedup.PHONE_THRESHOLD, 'ided', 'phoned')},
  {_stage_ctes('c2', f"substr({D.cp('cp')}, 1, 2)", _BOTH_RANK, dedup.NAME_THRESHOLD, 'phoned', 'named')}"""


@query("dedup_chained_leads", CHAIN_SQL + f" SELECT ord, {', '.join(LEAD_COLUMNS)} FROM named")
def dedup_chained_leads(spark, sf):
    """The three stages of the lead job in a row, each on the filled rows the one before left."""
    return flows.dedup_stages(copied_leads(spark, sf), LEAD_COLUMNS)[0].select("ord", *LEAD_COLUMNS)


@query("dedup_chained_counts", CHAIN_SQL + """,
  n AS (SELECT (SELECT count(*) FROM every) AS n0, (SELECT count(*) FROM ided) AS n1, (SELECT count(*) FROM phoned) AS n2, (SELECT count(*) FROM named) AS n3)
  SELECT 'siret' AS stage, n0 - n1 AS removed, n1 AS remaining FROM n UNION ALL SELECT 'phone', n1 - n2, n2 FROM n
  UNION ALL SELECT 'name', n2 - n3, n3 FROM n UNION ALL SELECT 'total', n0 - n3, n3 FROM n""")
def dedup_chained_counts(spark, sf):
    return flows.dedup_stages(copied_leads(spark, sf), LEAD_COLUMNS)[1]


def rich_rows(spark, sf):
    """Parts under longer, more varied names; a third of them in one department."""
    name = F.concat_ws(" ", "p_name", F.regexp_replace("p_brand", "[^A-Za-z0-9]", " "), F.lower("p_type"))
    cp = F.expr("CASE WHEN p_partkey % 3 = 1 THEN '75001' ELSE lpad(CAST(p_size * 1000 AS STRING), 5, '0') END")
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("ord"), name.alias("name"), cp.alias("cp"), F.col("p_size").alias("weight"))
    return dedup.with_department_block(rows)


_RICH = f"""WITH RECURSIVE r AS (SELECT p_partkey AS ord, concat_ws(' ', p_name, regexp_replace(p_brand, '[^A-Za-z0-9]', ' ', 'g'), lower(p_type)) AS name,
    CASE WHEN p_partkey % 3 = 1 THEN '75001' ELSE lpad(CAST(p_size * 1000 AS VARCHAR), 5, '0') END AS cp, p_size AS weight FROM part),
  k AS (SELECT ord, weight, {_NAME} AS nk, substr({D.cp('cp')}, 1, 2) AS block FROM r),
  u0 AS (SELECT block, nk, min(ord) AS ord FROM k WHERE block <> '' GROUP BY ALL),
  u1 AS (SELECT *, list_transform(string_split('abcdefghijklmnopqrstuvwxyz0123456789 ', ''), lambda c: length(nk) - length(replace(nk, c, ''))) AS h FROM u0),
  u AS (SELECT *, list_append(h, length(nk) - CAST(list_sum(h) AS BIGINT)) AS letters FROM u1),
  -- no pair can share more characters in order than it shares at all
  fit AS MATERIALIZED (SELECT a.block, a.nk AS xa, b.nk AS xb FROM u a JOIN u b ON a.block = b.block AND a.nk < b.nk AND length(a.nk) > 0 AND length(b.nk) > 0
    AND 200 * least(length(a.nk), length(b.nk)) >= {dedup.NAME_THRESHOLD} * (length(a.nk) + length(b.nk))
    AND 200 * list_sum(list_transform(range(1, 39), lambda c: least(a.letters[c], b.letters[c]))) >= {dedup.NAME_THRESHOLD} * (length(a.nk) + length(b.nk))),
  scored AS MATERIALIZED (SELECT block, xa, xb, {D.ratio('xa', 'xb')} AS sim FROM fit), near AS (SELECT block, xa, xb FROM scored WHERE sim >= {dedup.NAME_THRESHOLD})"""


@query("dedup_components", _RICH + """,
  e AS (SELECT a.ord AS a, b.ord AS b FROM near n JOIN u a ON a.block = n.block AND a.nk = xa JOIN u b ON b.block = n.block AND b.nk = xb),
  ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  reach AS (SELECT ord AS id, ord AS seen FROM u UNION SELECT reach.id, ways.b FROM reach JOIN ways ON ways.a = reach.seen),
  least_of AS (SELECT id, min(seen) AS component FROM reach GROUP BY id)
  SELECT k.ord, k.block, k.nk AS name_key, coalesce(component, k.ord) AS component FROM k LEFT JOIN u ON u.block = k.block AND u.nk = k.nk LEFT JOIN least_of ON id = u.ord""")
def dedup_components(spark, sf):
    return dedup.similarity_components(rich_rows(spark, sf), dedup.NAME_THRESHOLD).select("ord", "block", "name_key", "component")


# The pair loop itself: in arrival order, a row not yet removed meets all later rows not yet removed; the better score stays.
@query("dedup_sequential", _RICH + """,
  p AS (SELECT *, weight % 3 AS score, row_number() OVER (PARTITION BY block ORDER BY ord) AS i FROM k WHERE block <> ''),
  g AS (SELECT block, xa, xb FROM near UNION ALL SELECT block, xb, xa FROM near UNION ALL SELECT block, nk, nk FROM u),
  later AS (SELECT x.block, x.i AS j, list(y.i ORDER BY y.i) FILTER (WHERE x.score <= y.score) AS loses, list(y.i ORDER BY y.i) FILTER (WHERE x.score > y.score) AS wins
    FROM p x JOIN g ON g.block = x.block AND g.xa = x.nk JOIN p y ON y.block = x.block AND y.nk = g.xb AND y.i > x.i GROUP BY ALL),
  step AS (
    SELECT DISTINCT block, CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(i BIGINT, kept BIGINT)[]) AS gone FROM p
    UNION ALL SELECT s.block, s.n + 1, CASE WHEN l.j IS NULL OR list_contains(list_transform(s.gone, lambda x: x.i), s.n + 1) THEN s.gone ELSE
      s.gone || list_transform(list_filter(coalesce(l.loses, []), lambda y: NOT list_contains(list_transform(s.gone, lambda x: x.i), y)), lambda y: struct_pack(i := y, kept := s.n + 1))
      || list_transform(list_filter(coalesce(l.wins, []), lambda y: NOT list_contains(list_transform(s.gone, lambda x: x.i), y))[1:1], lambda y: struct_pack(i := s.n + 1, kept := y)) END
    FROM step s JOIN p ON p.block = s.block AND p.i = s.n + 1 LEFT JOIN later l ON l.block = s.block AND l.j = s.n + 1),
  fin AS (SELECT block, unnest(arg_max(gone, n)) AS g FROM step GROUP BY block)
  SELECT k.ord, k.block, k.nk AS name_key, keeper.ord AS kept_ord FROM k LEFT JOIN p ON p.ord = k.ord LEFT JOIN fin ON fin.block = p.block AND fin.g.i = p.i
  LEFT JOIN p keeper ON keeper.block = p.block AND keeper.i = fin.g.kept""")
def dedup_sequential(spark, sf):
    return dedup.sequential(rich_rows(spark, sf), F.col("weight") % 3, dedup.NAME_THRESHOLD).select("ord", "block", "name_key", "kept_ord")


@query("dedup_component_merge")
def dedup_component_merge(spark, sf):
    rows = dedup.with_phone_block(view(spark, sf, "lead"))
    grouped = dedup.similarity_components(rows, dedup.PHONE_THRESHOLD)
    cols = ["component", *LEAD_COLUMNS]
    return keyed.merge_groups(grouped, ["component"], keyed.dedup_rank(LEAD_COLUMNS), cols)
