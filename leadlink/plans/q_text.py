"""Queries: normalisers over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlink.functions import similarity as SIM
from leadlink.functions import text as T
from leadlink.plans import duck as D
from leadlink.plans.inputs import ctes, table, texts, view
from leadlink.plans.registry import query


@query("normalize_ids", ctes("listing") + f"""
  SELECT ord, {D.siret('siret')} AS siret, {D.cp('cp')} AS cp, substr({D.cp('cp')}, 1, 2) AS dept, {D.naf('naf')} AS naf FROM listing""")
def normalize_ids(spark, sf):
    cp = T.normalize_cp(F.col("cp"))
    return view(spark, sf, "listing").select(
        "ord", T.normalize_siret(F.col("siret")).alias("siret"), cp.alias("cp"), T.department(cp).alias("dept"),
        T.normalize_naf(F.col("naf")).alias("naf"),
    )


_LABEL = "regexp_replace('Tél : ' || phone, '^T[ée]l\\s*:\\s*', '')"


@query("normalize_phones", ctes("listing") + f"""
  SELECT ord, {D.phone_signal('phone')} AS signal, {D.phone_valid(D.digits('phone'))} AS listing, {D.phone_nine('phone')} AS nine,
    {_LABEL} AS unlabelled, {D.phone_signal("CASE WHEN trim(website) <> '' THEN website ELSE phone END")} AS first_path FROM listing""")
def normalize_phones(spark, sf):
    p = F.col("phone")
    return view(spark, sf, "listing").select(
        "ord", T.normalize_phone(p).alias("signal"), T.validate_phone(p).alias("listing"), T.phone_nine(p).alias("nine"),
        T.strip_phone_label(F.concat(F.lit("Tél : "), p)).alias("unlabelled"),
        T.extract_phone(F.col("website"), p).alias("first_path"),
    )


@query("normalize_names", ctes("raw") + f"""
  SELECT doc_id, {D.clean('text', T.LEGAL_FORMS_LINK)} AS link, {D.clean('text', T.LEGAL_FORMS_PROFILE)} AS profile,
    {D.keywords('text')} AS keywords FROM raw""")
def normalize_names(spark, sf):
    t = F.col("text")
    return texts(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", T.clean_name_link(t).alias("link"), T.clean_name_profile(t).alias("profile"),
        T.clean_name_keywords(t).alias("keywords"),
    )


@query("normalize_names_registry", f"""
  SELECT conv_id, turn, {D.clean("'Sas ' || text || ' EI sasu'", T.LEGAL_FORMS_REGISTRY, accents=True)} AS cleaned FROM conversations""")
def normalize_names_registry(spark, sf):
    named = F.concat(F.lit("Sas "), F.col("text"), F.lit(" EI sasu"))
    return texts(spark, sf, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", T.clean_name_registry(named).alias("cleaned"))


@query("strip_accents", ctes("raw") + f" SELECT doc_id, {D.ascii_fold('text')} AS plain FROM raw")
def strip_accents(spark, sf):
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", T.strip_accents(F.col("text")).alias("plain"))


@query("title_case", f" SELECT conv_id, turn, {D.title('text')} AS titled FROM conversations")
def title_case(spark, sf):
    return texts(spark, sf, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", T.title_case(F.col("text")).alias("titled"))


_A = "address"
_TAIL = T.ADDRESS_TAIL
_CPC = T.CP_CITY
_CPN = T.CP_CITY_NO_QUOTE


@query("normalize_addresses", ctes("listing") + f""", a AS (
    SELECT ord, city AS searched, CASE WHEN ord % 4 = 0 THEN category ELSE address END AS address,
      CASE WHEN ord % 2 = 0 THEN '75' ELSE '2A004' END AS dept FROM listing)
  SELECT ord,
    CASE WHEN regexp_matches({_A}, '{_TAIL}') THEN trim(rtrim(trim(regexp_extract({_A}, '(?s)^(.*?){_TAIL}', 1)), ',')) ELSE {_A} END AS street,
    regexp_extract({_A}, '{_TAIL}', 1) AS cp, trim(regexp_extract({_A}, '{_TAIL}', 2)) AS city,
    regexp_extract({_A}, '{_CPC.replace("'", "''")}', 1) AS cp2, {D.title(f"trim(regexp_extract({_A}, '{_CPC.replace(chr(39), chr(39)*2)}', 2))")} AS city2,
    CASE WHEN regexp_matches({_A}, '{_CPN}') THEN regexp_extract({_A}, '{_CPN}', 1) WHEN length(dept) = 2 THEN dept || '000' ELSE dept END AS cp3,
    CASE WHEN regexp_matches({_A}, '{_CPN}') THEN {D.title(f"trim(regexp_extract({_A}, '{_CPN}', 2))")} ELSE searched END AS city3 FROM a""")
def normalize_addresses(spark, sf):
    a = view(spark, sf, "listing").selectExpr(
        "ord", "city AS searched", "CASE WHEN ord % 4 = 0 THEN category ELSE address END AS address",
        "CASE WHEN ord % 2 = 0 THEN '75' ELSE '2A004' END AS dept",
    )
    one = T.parse_address(F.col("address"))
    two = T.cp_and_city(F.col("address"))
    three = T.cp_and_city_or(F.col("address"), F.col("dept"), F.col("searched"))
    return a.select(
        "ord", one["street"].alias("street"), one["cp"].alias("cp"), one["city"].alias("city"),
        two["cp"].alias("cp2"), two["city"].alias("city2"), three["cp"].alias("cp3"), three["city"].alias("city3"),
    )


@query("addresses_in_text", ctes("raw") + f"""
  SELECT doc_id, regexp_extract(text, '{_CPC.replace("'", "''")}', 1) AS cp,
    {D.title(D.strip(f"regexp_extract(text, '{_CPC.replace(chr(39), chr(39)*2)}', 2)"))} AS city FROM raw""")
def addresses_in_text(spark, sf):
    d = T.cp_and_city(F.col("text"))
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", d["cp"].alias("cp"), d["city"].alias("city"))


_ENC = "replace(replace(replace(url_encode({x}), '%2F', '/'), '%7E', '~'), '*', '%2A')"


@query("cleaned_text", ctes("listing") + f"""
  SELECT ord, translate(lower(city), ' -', '__') AS city_slug,
    substr(regexp_replace(replace(replace(replace(lower(name), ' ', '-'), '''', ''), '&', 'et'), '[^a-z0-9-]', '', 'g'), 1, 30) AS domain,
    regexp_replace(city, '\\s+[0-9]{{2}}$', '') AS bare_city,
    nullif(regexp_extract(city || CASE WHEN ord % 2 = 0 THEN ' 93' ELSE '' END, '(?:^|[^0-9A-Za-z_])(75|92|93|94|31|59)(?:$|[^0-9A-Za-z_])', 1), '') AS dept,
    'https://d.example.org/search?quoiqui=' || url_encode(category) || '&ou=' || url_encode(city) || '&page=' || (ord % 9) AS url,
    CASE WHEN listing_url LIKE '/%' THEN 'https://d.example.org' || listing_url WHEN listing_url LIKE 'http%' THEN listing_url ELSE '' END AS link,
    CASE WHEN website LIKE 'http%' AND NOT contains(website, 'economy') THEN website END AS external,
    CASE WHEN ord % 3 = 0 THEN split_part(replace(lower('PJ_results_' || city || '_2026.csv'), 'pj_results_', ''), '_', 1) ELSE 'multi' END AS file_city
  FROM listing""")
def cleaned_text(spark, sf):
    path = F.expr("'/data/' || CASE WHEN ord % 3 = 0 THEN 'PJ_results_' ELSE 'other_' END || city || '_2026.csv'")
    return view(spark, sf, "listing").select(
        "ord", T.city_slug(F.col("city")).alias("city_slug"), T.domain_slug(F.col("name")).alias("domain"),
        T.clean_city(F.col("city")).alias("bare_city"),
        T.department_in_city(F.expr("city || CASE WHEN ord % 2 = 0 THEN ' 93' ELSE '' END")).alias("dept"),
        T.search_url("https://d.example.org/search", F.col("category"), F.col("city"), F.col("ord") % 9).alias("url"),
        T.absolute_url("https://d.example.org", F.col("listing_url")).alias("link"),
        T.external_url("economy", F.col("website")).alias("external"),
        T.city_of_file(path, ["lba_lbb_results_", "pj_results_"]).alias("file_city"),
    )


_N = "upper(p_name)"
_PAIRS = f"""n AS (SELECT DISTINCT {_N} AS a FROM part), pairs AS (SELECT x.a AS a, y.a AS b FROM n x JOIN n y ON x.a < y.a)"""


@query("similarity_scores", f"""WITH {_PAIRS}, c AS (SELECT p_partkey, {_N} AS a, upper(p_brand) AS b FROM part),
    u AS (SELECT DISTINCT a, b FROM c), s AS (SELECT a, b, {D.ratio('a', 'b')} AS ratio, {D.ratio(D.token_sort('a'), D.token_sort('b'))} AS token_sort FROM u)
  SELECT p_partkey, ratio, token_sort FROM c JOIN s USING (a, b)""")
def similarity_scores(spark, sf):
    d = table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("a"), F.upper("p_brand").alias("b"))
    return d.select(
        "p_partkey", SIM.ratio(F.col("a"), F.col("b")).alias("ratio"), SIM.token_sort_ratio(F.col("a"), F.col("b")).alias("token_sort")
    )
