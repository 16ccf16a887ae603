"""Queries: activity codes, profiles, keyword exclusions, gates."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from leadlink import refdata as R
from leadlink.operators import classify as C
from leadlink.operators import report
from leadlink.plans import duck as D
from leadlink.plans.inputs import EXPECTED_NAF, ctes, texts, view
from leadlink.plans.registry import query


def values(names: list[str], rows: list[tuple]) -> str:
    """A fixed table as SQL text."""

    def lit(v):
        if isinstance(v, list):
            return "[" + ", ".join(lit(x) for x in v) + "]"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(names)}))"


LABELS = values(["code", "label"], R.label_rows())
OCCUPATIONS = values(["naf", "romes"], R.occupation_rows())
PROFILES = values(["profile", "label", "nafs"], R.profile_rows())
ALIASES = values(["alias", "profile"], R.alias_rows())
SECTORS = values(["prefix", "sector"], R.sector_prefix_rows())
_CODE = D.naf("naf")
_OK = f"(naf = '' OR {D.covered(_CODE, EXPECTED_NAF)})"
_COVERS = "length({p}) >= 4 AND regexp_matches({p}, '[0-9]$')"


def _label_sql(code: str) -> str:
    return (
        f"coalesce((SELECT label FROM labels WHERE code = {code}), (SELECT label FROM labels WHERE code = substr({code}, 1, 5)), "
        f"(SELECT label FROM labels WHERE code = substr({code}, 1, 2)), '')"
    )


_PROFILE_CODES = [(p, c) for p, _, codes in R.profile_rows() for c in codes]


@query("naf_normalize_match", ctes("company") + f""",
  prof AS {values(["profile", "profile_code"], _PROFILE_CODES)}, c AS (SELECT ord, {_CODE} AS e FROM company)
  SELECT c.ord, c.e AS code, prof.profile, prof.profile_code FROM c JOIN prof ON e <> '' AND
    (profile_code = e OR ({_COVERS.format(p='profile_code')} AND starts_with(e, profile_code)))""")
def naf_normalize_match(spark, sf):
    prof = R.small_frame(spark, _PROFILE_CODES, ["profile", "profile_code"], [pa.string(), pa.string()])
    rows = view(spark, sf, "company").select("ord", "naf", C.T.normalize_naf(F.col("naf")).alias("code"))
    return C.match_profiles(rows, prof).select("ord", "code", "profile", "profile_code")


@query("naf_label_cascade", ctes("company") + f""", labels AS {LABELS}, c AS (SELECT ord, {_CODE} AS e FROM company)
  SELECT ord, {_label_sql('e')} AS naf_label FROM c""")
def naf_label_cascade(spark, sf):
    return C.with_label(view(spark, sf, "company"), spark).select("ord", "naf_label")


_WANTED = "naf, CASE ord % 3 WHEN 0 THEN trim(naf) WHEN 1 THEN substr(naf, 1, 5) ELSE ' ' || substr(naf, 1, 4) END AS asked"


def _asked(spark, sf):
    return view(spark, sf, "company").selectExpr(
        "ord", "CASE ord % 3 WHEN 0 THEN trim(naf) WHEN 1 THEN substr(naf, 1, 5) ELSE ' ' || substr(naf, 1, 4) END AS naf"
    )


_ASKED_SQL = ctes("company") + f""", occ AS {OCCUPATIONS},
  asked AS (SELECT ord, trim(asked) AS naf FROM (SELECT ord, {_WANTED} FROM company)),
  codes AS (SELECT DISTINCT naf FROM asked),
  below AS (SELECT c.naf, list_sort(list(o.naf)) AS subs, list_sort(list_distinct(flatten(list(o.romes)))) AS romes
            FROM codes c JOIN occ o ON {_COVERS.format(p='c.naf')} AND starts_with(o.naf, c.naf) GROUP BY c.naf),
  resolved AS (SELECT c.naf, CASE WHEN o.naf IS NOT NULL THEN 'sub-class' WHEN b.naf IS NOT NULL THEN 'class' ELSE 'unresolved' END AS status,
            CASE WHEN o.naf IS NULL THEN coalesce(b.subs, []) ELSE [] END AS subs, coalesce(list_sort(o.romes), b.romes, []) AS romes
            FROM codes c LEFT JOIN occ o ON o.naf = c.naf LEFT JOIN below b ON b.naf = c.naf)"""


@query("naf_to_rome", _ASKED_SQL + """
  SELECT rome, count(*) AS n_companies FROM (SELECT ord, unnest(romes) AS rome FROM asked JOIN resolved USING (naf)) GROUP BY rome""")
def naf_to_rome(spark, sf):
    r = C.expand_occupations(_asked(spark, sf), spark)
    return r.select(F.explode("occupations").alias("rome")).groupBy("rome").agg(F.count("*").alias("n_companies"))


@query("naf_request_check", _ASKED_SQL + """
  SELECT naf, status, array_to_string(subs, ' ') AS covers, array_to_string(romes, ' ') AS occupations,
    naf IN ('10.71', '56.10A') AS warned FROM resolved""")
def naf_request_check(spark, sf):
    codes = _asked(spark, sf).select(F.trim("naf").alias("naf")).distinct()
    warn = R.small_frame(spark, [("10.71",), ("56.10A",)], ["naf"], [pa.string()])
    warned = C.warned_codes(codes, warn).withColumn("warned", F.lit(True))
    return C.expand_occupations(codes, spark).join(F.broadcast(warned), "naf", "left").select(
        "naf", "status", F.array_join("covers", " ").alias("covers"), F.array_join("occupations", " ").alias("occupations"),
        F.coalesce("warned", F.lit(False)).alias("warned"),
    )


_ALL_NAMES = [p for p, _, _ in R.profile_rows()] + [a for a, _ in R.alias_rows()] + ["unknown_profile", "zz_other"]
_PICK = f"CAST(list_extract([{', '.join(repr(n) for n in _ALL_NAMES)}], CAST((o_custkey * 7 + o_orderkey) % {len(_ALL_NAMES)} + 1 AS INTEGER)) AS VARCHAR)"
_REQ = f"req AS (SELECT CAST(o_custkey AS BIGINT) AS request_id, o_orderkey AS pos, {_PICK} AS profile FROM orders)"


def _requests(spark, sf):
    """Profile requests made by customers: one name per order."""
    from leadlink.plans.inputs import table

    names = F.array(*[F.lit(n) for n in _ALL_NAMES])
    at = ((F.col("o_custkey") * 7 + F.col("o_orderkey")) % len(_ALL_NAMES) + 1).cast("int")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("request_id"), F.col("o_orderkey").alias("pos"), F.element_at(names, at).alias("profile")
    )


_NAMES = f"[{', '.join(repr(n) for n in _ALL_NAMES)}]"


@query("request_codes", f"""WITH prof AS {PROFILES}, al AS {ALIASES},
  r AS (SELECT CAST(c_custkey AS VARCHAR) AS request_id, CASE c_custkey % 3 WHEN 0 THEN [{_NAMES}[c_custkey % {len(_ALL_NAMES)} + 1]]
    WHEN 1 THEN [{_NAMES}[c_custkey % {len(_ALL_NAMES)} + 1], {_NAMES}[c_custkey * 7 % {len(_ALL_NAMES)} + 1]] END AS names FROM customer),
  req AS (SELECT request_id, unnest(range(len(names))) AS pos, unnest(names) AS profile FROM r WHERE names IS NOT NULL),
  j AS (SELECT req.*, p.label, p.nafs FROM req LEFT JOIN al ON al.alias = req.profile LEFT JOIN prof p ON p.profile = coalesce(al.profile, req.profile))
  SELECT request_id, coalesce(array_to_string(list_sort(list_distinct(flatten(list(nafs) FILTER (WHERE nafs IS NOT NULL)))), ' '), '') AS codes,
    coalesce(string_agg(label, ', ' ORDER BY pos) FILTER (WHERE label IS NOT NULL), '') AS label,
    coalesce(string_agg(DISTINCT profile, ' ' ORDER BY profile) FILTER (WHERE label IS NULL), '') AS unknown FROM j GROUP BY request_id
  UNION ALL SELECT request_id, '47.11F 10.71C', '', '' FROM r WHERE names IS NULL""")
def request_codes(spark, sf):
    """Codes of saved run requests that name one profile, several, or codes."""
    from leadlink.plans.inputs import table
    from leadlink.sources import json_responses as J

    k = F.col("c_custkey")
    name = lambda at: F.element_at(F.array(*[F.lit(n) for n in _ALL_NAMES]), (at % len(_ALL_NAMES) + 1).cast("int"))
    body = F.to_json(F.struct(
        k.cast("string").alias("request_id"), F.lit("Lyon").alias("ville"), F.when(k % 3 == 0, name(k)).alias("profil"),
        F.when(k % 3 == 1, F.array(name(k), name(k * 7))).alias("profils"), F.array(F.lit("47.11F"), F.lit("10.71C")).alias("codes_naf"),
    ))
    requests = J.run_requests(J.parse(table(spark, sf, "customer").select(body.alias("body")), "body", J.REQUEST_SCHEMA))
    return J.request_codes(requests, spark).select(
        "request_id", F.array_join("codes", " ").alias("codes"), "label", F.array_join("unknown", " ").alias("unknown"))


@query("profile_resolve", f"""WITH {_REQ}, prof AS {PROFILES}, al AS {ALIASES},
  j AS (SELECT req.*, p.label, p.nafs FROM req LEFT JOIN al ON al.alias = req.profile LEFT JOIN prof p ON p.profile = coalesce(al.profile, req.profile))
  SELECT request_id, coalesce(array_to_string(list_sort(list_distinct(flatten(list(nafs) FILTER (WHERE nafs IS NOT NULL)))), ' '), '') AS codes,
    coalesce(string_agg(label, ', ' ORDER BY pos) FILTER (WHERE label IS NOT NULL), '') AS label,
    coalesce(string_agg(DISTINCT profile, ' ' ORDER BY profile) FILTER (WHERE label IS NULL), '') AS unknown FROM j GROUP BY request_id""")
def profile_resolve(spark, sf):
    r = C.resolve_profiles(_requests(spark, sf), spark)
    return r.select("request_id", F.array_join("codes", " ").alias("codes"), "label", F.array_join("unknown", " ").alias("unknown"))


@query("sector_of_profiles", f"""WITH {_REQ}, sec AS {SECTORS}
  SELECT request_id, CASE WHEN count(DISTINCT sector) = 1 THEN min(sector) END AS sector
  FROM (SELECT * REPLACE (CAST((pos - pos % 2) / 2 AS BIGINT) AS request_id) FROM req) LEFT JOIN sec ON starts_with(lower(profile), prefix || '_') GROUP BY request_id""")
def sector_of_profiles(spark, sf):
    pairs = _requests(spark, sf).withColumn("request_id", F.expr("CAST((pos - pos % 2) / 2 AS BIGINT)"))
    return C.sector_of(pairs, spark)


@query("profiles_by_sector", ctes("company") + f""", prof AS {PROFILES}, sec AS {SECTORS},
  hits AS (SELECT prof.profile, sec.sector, len(nafs) AS n_codes, (SELECT count(*) FROM company c WHERE list_bool_or(list_transform(nafs,
     lambda p: {_CODE} <> '' AND (p = {_CODE} OR (length(p) >= 4 AND regexp_matches(p, '[0-9]$') AND starts_with({_CODE}, p)))))) AS n_companies
     FROM prof JOIN sec ON starts_with(prof.profile, sec.prefix || '_'))
  SELECT sector, profile, CAST(n_codes AS INTEGER) AS n_codes, n_companies FROM hits""")
def profiles_by_sector(spark, sf):
    prof = R.small_frame(spark, _PROFILE_CODES, ["profile", "profile_code"], [pa.string(), pa.string()])
    hit = C.match_profiles(view(spark, sf, "company").select("ord", "naf"), prof).select("ord", "profile").distinct()
    n = hit.groupBy("profile").agg(F.count("*").alias("n_companies"))
    listed = C.profiles_by_sector(spark).select("sector", F.explode("profiles").alias("p")).select("sector", "p.profile", "p.n_codes")
    return listed.join(n, "profile", "left").select("sector", "profile", "n_codes", F.coalesce("n_companies", F.lit(0)).alias("n_companies"))


@query("naf_filter_report", ctes("company") + f""", labels AS {LABELS},
  bad AS (SELECT trim(naf) AS naf FROM company WHERE NOT {_OK}), cnt AS (SELECT naf, count(*) AS n FROM bad GROUP BY naf),
  top AS (SELECT * FROM cnt ORDER BY n DESC, naf LIMIT 10)
  SELECT naf, n, greatest((SELECT count(*) FROM cnt) - 10, 0) AS n_others, {_label_sql(D.naf('top.naf'))} AS naf_label FROM top""")
def naf_filter_report(spark, sf):
    _, dropped = C.naf_filter(view(spark, sf, "company"), EXPECTED_NAF)
    return C.with_label(C.top_counts(dropped, "naf"), spark)


@query("naf_relabel", ctes("company") + f"""
  SELECT ord, CASE WHEN status = 'SIRET trouvé' AND NOT {_OK} THEN 'Exclu — NAF hors profil (' || trim(naf) || ')' ELSE status END AS status,
    CASE WHEN status <> 'SIRET trouvé' THEN NULL WHEN trim(naf) = '' THEN 'unavailable' WHEN {_OK} THEN 'coherent' ELSE 'outside' END AS naf_class FROM company""")
def naf_relabel(spark, sf):
    return C.relabel_outside_profile(view(spark, sf, "company"), EXPECTED_NAF).select("ord", "status", "naf_class")


@query("naf_classes", ctes("company") + f"""
  SELECT CASE WHEN trim(naf) = '' THEN 'unavailable' WHEN {_OK} THEN 'coherent' ELSE 'outside' END AS naf_class, count(*) AS n
  FROM company WHERE status = 'SIRET trouvé' GROUP BY 1""")
def naf_classes(spark, sf):
    r = C.relabel_outside_profile(view(spark, sf, "company"), EXPECTED_NAF)
    return r.where(F.col("naf_class").isNotNull()).groupBy("naf_class").agg(F.count("*").alias("n"))


@query("naf_gate", ctes("company") + f"""
  SELECT source, n, n_bad, {D.pct_text('n_bad', 'n')} AS pct, n_bad / n > 0.8 AS breached FROM (
    SELECT source, count(*) FILTER (WHERE naf <> '') AS n, count(*) FILTER (WHERE naf <> '' AND NOT {_OK}) AS n_bad FROM company GROUP BY source)""")
def naf_gate(spark, sf):
    return C.naf_gate(view(spark, sf, "company"), EXPECTED_NAF, ["source"])


_CAT_TEXT = f"{D.ascii_fold('lower(name)')} || ' ' || {D.ascii_fold('lower(category)')}"


def _category_case(text: str) -> str:
    out: dict[str, list[str]] = {}
    for _, cat, kw in R.category_rows():
        out.setdefault(cat, []).append(f"contains({text}, '{kw.replace(chr(39), chr(39) * 2)}')")
    return "CASE " + " ".join(f"WHEN {' OR '.join(t)} THEN '{c.replace(chr(39), chr(39) * 2)}'" for c, t in out.items()) + " END"


@query("keyword_exclusion", ctes("company") + f""" SELECT ord, {_category_case('t')} AS excluded FROM (SELECT ord, {_CAT_TEXT} AS t FROM company)""")
def keyword_exclusion(spark, sf):
    return C.tag_excluded_category(view(spark, sf, "company")).select("ord", "excluded")


@query("keyword_exclusion_counts", ctes("company") + f""", dim AS (SELECT DISTINCT category AS excluded FROM {values(["pos", "category", "keyword"], R.category_rows())}),
  hit AS (SELECT {_category_case('t')} AS excluded FROM (SELECT {_CAT_TEXT} AS t FROM company))
  SELECT dim.excluded, count(hit.excluded) AS n FROM dim LEFT JOIN hit USING (excluded) GROUP BY 1""")
def keyword_exclusion_counts(spark, sf):
    tagged = C.tag_excluded_category(view(spark, sf, "company"))
    dim = R.categories(spark).select(F.col("category").alias("excluded"))
    return report.exclusion_counts(tagged, dim, "excluded")


def _brand_case(t: str) -> str:
    q = lambda s: s.replace("'", "''")
    parts = [f"WHEN contains({t}, '{q(C._plain(k))}') THEN '{q(k)}'" for k in R.brand_keywords()]
    return "CASE " + " ".join(parts) + f" WHEN regexp_matches({t}, '\\b{R.BRAND_WHOLE_WORD}\\b') THEN '{R.BRAND_WHOLE_WORD}' END"


@query("brand_exclusion", ctes("company") + f"""
  SELECT ord, {_brand_case('t')} AS brand, {_brand_case('t')} IS NOT NULL AND upper(sector) IN ('MBT', 'TG') AS dropped
  FROM (SELECT ord, sector, {D.ascii_fold('lower(name)')} AS t FROM company)""")
def brand_exclusion(spark, sf):
    tagged = C.tag_excluded_brand(view(spark, sf, "company"))
    drop = F.col("brand").isNotNull() & C.brand_rule_applies(F.col("sector"))
    return tagged.select("ord", "brand", drop.alias("dropped"))


@query("brand_exclusion_in_texts", ctes("raw") + f"""
  SELECT brand, count(*) AS n FROM (SELECT {_brand_case('t')} AS brand FROM (SELECT {D.ascii_fold('lower(text)')} AS t FROM raw)) GROUP BY brand""")
def brand_exclusion_in_texts(spark, sf):
    return C.tag_excluded_brand(texts(spark, sf, "documents", "text"), "text").groupBy("brand").agg(F.count("*").alias("n"))


_PICKED = [i for i in range(len(R.catalogue_rows()))]


@query("sector_catalogue_lookup", f"""WITH cat AS {values(["pos", "label", "nafs", "keyword"], R.catalogue_rows())},
  sel AS (SELECT DISTINCT c_nationkey AS user_id, CAST(c_custkey % {len(_PICKED)} AS INTEGER) AS pos FROM customer)
  SELECT user_id, array_to_string(list_sort(list_distinct(flatten(list(nafs)))), ' ') AS codes, string_agg(keyword, ' ' ORDER BY cat.pos) AS keywords
  FROM sel JOIN cat USING (pos) GROUP BY user_id""")
def sector_catalogue_lookup(spark, sf):
    from leadlink.plans.inputs import table

    sel = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("user_id"), (F.col("c_custkey") % len(_PICKED)).cast("int").alias("pos")
    ).distinct()
    return sel.join(F.broadcast(R.catalogue(spark)), "pos").groupBy("user_id").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("nafs")))), " ").alias("codes"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "keyword"))), lambda x: x["keyword"]), " ").alias("keywords"),
    )


@query("code_lists", ctes("company") + f""",
  a AS (SELECT DISTINCT {_CODE} AS code FROM company WHERE source = 'listing' AND naf <> ''),
  b AS (SELECT DISTINCT {_CODE} AS code FROM company WHERE source = 'signal' AND naf <> '')
  SELECT code, a.code IS NOT NULL AS in_listing, b.code IS NOT NULL AS in_signal, contains(code, 'Z') OR contains(code, '71') AS listed
  FROM a FULL JOIN b USING (code)""")
def code_lists(spark, sf):
    c = view(spark, sf, "company").where("naf <> ''").select("source", C.T.normalize_naf(F.col("naf")).alias("code"))
    words = F.array(F.lit("Z"), F.lit("71"))
    return c.groupBy("code").agg(
        F.bool_or(F.col("source") == "listing").alias("in_listing"), F.bool_or(F.col("source") == "signal").alias("in_signal")
    ).withColumn("listed", F.exists(words, lambda k: F.contains(F.col("code"), k))).orderBy("code")
