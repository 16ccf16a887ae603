"""Queries: saved JSON responses, stored HTML pages, files written and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlink import refdata as R
from leadlink.functions import text as T
from leadlink.operators.merge import LEAD_COLUMNS
from leadlink.plans import duck as D
from leadlink.plans.inputs import ctes, table, texts, view
from leadlink.plans.q_core import crossed, CROSSED
from leadlink.plans.registry import query
from leadlink.session import fresh_path
from leadlink.sinks import files as sink
from leadlink.sources import files, html_listing as H, json_responses as J

# --- JSON ------------------------------------------------------------------------


def _signal_json(spark, sf):
    """One saved search response per order: its job items and its recruiter item."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    num = F.lpad(c.cast("string"), 8, "0")
    address = F.concat(F.lit("3 rue "), "o_orderstatus", F.lit(", 69003 Lyon"))
    job = F.struct(
        F.struct(
            F.when(k % 7 != 0, c.cast("string")).alias("siret"),
            F.when(k % 3 == 0, F.concat(F.lit("Atelier "), c.cast("string"))).alias("name"),
            F.when(k % 3 == 1, F.lit("")).alias("legal_name"), F.when(k % 3 == 1, F.lit("Marque")).alias("brand"),
            F.struct(F.struct(F.when(k % 2 == 0, F.lit("10.71C")).alias("code")).alias("naf")).alias("domain"),
            F.struct(F.when(k % 4 != 0, address).alias("address")).alias("location"),
            F.struct(F.when(k % 5 == 0, F.lit("abc")).alias("phone")).alias("contact"),
        ).alias("workplace"),
        F.struct(F.when(k % 2 == 1, (c + 1).cast("string")).alias("siret"), F.lit("Maison mère").alias("name"), F.lit("1071D").alias("naf")).alias("company"),
        F.struct(F.when(k % 6 == 0, F.lit("Villeurbanne")).alias("city"), F.lit("sans code").alias("fullAddress")).alias("place"),
        F.concat(F.lit("+33 4 "), num).alias("phone"),
    )
    recruiter = F.struct(
        F.struct((c + 1).cast("string").alias("siret"), F.lit("Site").alias("name")).alias("workplace"),
        F.struct(F.when(k % 2 == 0, c.cast("string")).alias("siret"), F.when(k % 3 == 0, F.lit("Employeur")).alias("name"),
                 F.when(k % 4 == 0, F.lit("4.5")).alias("score")).alias("company"),
        F.when(k % 8 == 1, F.lit("haut")).alias("hiring_potential"),
    )
    body = F.to_json(F.struct(F.when(k % 10 != 0, F.array(job)).alias("jobs"), F.when(k % 4 != 1, F.array(recruiter)).alias("recruiters")))
    return texts(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus").select("o_orderkey", body.alias("body"))


@query("json_signal_ingest", f"""WITH j AS (SELECT o_orderkey, 'LBA' AS source,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) WHEN o_orderkey % 2 = 1 THEN CAST(o_custkey + 1 AS VARCHAR) ELSE '' END AS siret,
    CASE o_orderkey % 3 WHEN 0 THEN 'Atelier ' || o_custkey WHEN 1 THEN 'Marque' ELSE 'Maison mère' END AS name,
    CASE WHEN o_orderkey % 2 = 0 THEN '10.71C' ELSE '1071D' END AS naf,
    CASE WHEN o_orderkey % 4 <> 0 THEN '3 rue ' || o_orderstatus ELSE 'sans code' END AS address,
    CASE WHEN o_orderkey % 6 = 0 THEN 'Villeurbanne' WHEN o_orderkey % 4 <> 0 THEN 'Lyon' ELSE '' END AS city,
    CASE WHEN o_orderkey % 4 <> 0 THEN '69003' ELSE '' END AS cp,
    CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '04' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') END AS phone, '' AS lbb_score, CAST(1 AS BIGINT) AS offers
    FROM orders WHERE o_orderkey % 10 <> 0),
  r AS (SELECT o_orderkey, 'LBB' AS source, CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_custkey + 1 END AS VARCHAR) AS siret,
    CASE WHEN o_orderkey % 3 = 0 THEN 'Employeur' ELSE 'Site' END AS name, '' AS naf, '' AS address, '' AS city, '' AS cp, '' AS phone,
    CASE WHEN o_orderkey % 4 = 0 THEN '4.5' WHEN o_orderkey % 8 = 1 THEN 'haut' ELSE '' END AS lbb_score, CAST(NULL AS BIGINT) AS offers
    FROM orders WHERE o_orderkey % 4 <> 1),
  u AS (SELECT * FROM j UNION ALL SELECT * FROM r)
  SELECT o_orderkey, source, lpad(siret, 14, '0') AS siret, name, naf, address, city, cp, phone, lbb_score, offers FROM u WHERE siret <> ''""")
def json_signal_ingest(spark, sf):
    return J.signal_rows(J.parse(_signal_json(spark, sf), "body", J.SIGNALS_SCHEMA), ["o_orderkey"]).drop("item_pos")


def _registry_json(spark, sf):
    """One company per customer: listed establishments, or only a head office."""
    k = F.col("c_custkey")
    commune = F.lpad((F.col("c_nationkey") * 100).cast("string"), 5, "0")

    def site(n: int):
        return F.struct(
            F.concat(k.cast("string"), F.lit(f"0{n}")).alias("siret"),
            F.when(k % 4 != 0, F.lit("10.71C")).alias("activite_principale"),
            F.lit("69001").alias("code_postal"),
            F.when((k + n) % 5 == 0, F.lit("99999")).otherwise(commune).alias("commune"),
            F.col("c_mktsegment").alias("libelle_commune"),
            F.concat(F.lit(f"{n} rue "), "c_name").alias("adresse"),
            F.when((k + n) % 6 == 0, F.lit("F")).otherwise(F.lit("A")).alias("etat_administratif"),
            F.when(k % 3 == 1, F.lit("au bon pain-doré")).alias("nom_commercial"),
            F.when(k % 3 == 0, F.array(F.lit(" l'épi d'or "), F.lit("autre"))).alias("liste_enseignes"),
        )

    company = F.struct(
        k.cast("string").alias("siren"), F.col("c_name").alias("nom_complet"),
        F.when(k % 2 == 0, F.lit("RAISON SOCIALE")).alias("nom_raison_sociale"), site(1).alias("siege"),
        F.when(k % 2 == 0, F.array(site(1), site(2))).alias("matching_etablissements"),
    )
    body = F.to_json(F.struct(F.lit(1).alias("total_pages"), F.array(company).alias("results")))
    return table(spark, sf, "customer").select("c_custkey", commune.alias("commune"), F.lit("10.71D").alias("requested_naf"), body.alias("body"))


@query("registry_ingest", """WITH s AS (SELECT c_custkey, n FROM customer, (SELECT unnest([1, 2]) AS n) WHERE n = 1 OR c_custkey % 2 = 0)
  SELECT c_custkey, CAST(n - 1 AS INTEGER) AS site_pos,
    CASE c_custkey % 3 WHEN 0 THEN 'L''Épi D''Or' WHEN 1 THEN 'Au Bon Pain-Doré' ELSE c_name END AS name,
    n || ' rue ' || c_name AS address, '69001' AS cp, c_mktsegment AS city, c_custkey || '0' || n AS siret, CAST(c_custkey AS VARCHAR) AS siren,
    CASE WHEN c_custkey % 4 <> 0 THEN '10.71C' ELSE '10.71D' END AS naf, 'Boulangerie' AS kind, 3 AS priority, 'owner ' || (c_nationkey % 3) AS owner, '' AS phone
  FROM s JOIN customer USING (c_custkey) WHERE (c_custkey + n) % 5 <> 0 AND (c_custkey + n) % 6 <> 0""")
def registry_ingest(spark, sf):
    owners = table(spark, sf, "nation").select(
        F.lpad((F.col("n_nationkey") * 100).cast("string"), 5, "0").alias("commune"),
        F.concat(F.lit("owner "), (F.col("n_nationkey") % 3).cast("string")).alias("owner"),
    )
    rows = J.registry_sites(J.parse(_registry_json(spark, sf), "body", J.REGISTRY_SCHEMA), ["c_custkey"])
    return rows.join(owners, "commune").select(
        "c_custkey", F.col("site_pos").cast("int").alias("site_pos"), "name", "address", "cp", "city", "siret", "siren", "naf",
        F.lit("Boulangerie").alias("kind"), F.lit(3).alias("priority"), "owner", F.lit("").alias("phone"),
    )


@query("registry_candidates", """
  SELECT c_custkey, 0 AS pos, concat_ws('|', c_name, CASE WHEN c_custkey % 2 = 0 THEN 'RAISON SOCIALE' END, CASE WHEN c_custkey % 3 = 0 THEN ' l''épi d''or ' END) AS names,
    '69001' AS cand_cp, c_mktsegment AS cand_city, c_custkey || '01' AS siret, CASE WHEN c_custkey % 4 <> 0 THEN '10.71C' END AS naf FROM customer""")
def registry_candidates(spark, sf):
    r = J.registry_candidates(J.parse(_registry_json(spark, sf), "body", J.REGISTRY_SCHEMA), ["c_custkey"])
    return r.withColumn("names", F.array_join("names", "|"))


def _profile_json(spark, sf):
    k = F.col("s_suppkey")
    company = F.struct(
        F.when(k % 2 == 0, F.col("s_name")).alias("nom_entreprise"), F.lit("DENO").alias("denomination"), F.lit("").alias("sigle"),
        k.cast("string").alias("siren"), F.concat(k.cast("string"), F.lit("0001")).alias("siret"), F.when(k % 3 == 0, F.lit("47.11F")).alias("code_naf"),
        F.when(k % 4 == 0, F.lit("12")).alias("effectif"), F.lit("10-19").alias("tranche_effectif"), F.lit("2001-01-01").alias("date_creation"),
        F.struct(F.when(k % 5 == 0, k.cast("string")).alias("siret"), F.lit("56.10A").alias("activite_principale"),
                 F.when(k % 2 == 1, F.lit("Enseigne")).alias("enseigne"), F.lit("75001").alias("code_postal"), F.lit("Paris").alias("ville")).alias("siege"),
        F.when(k % 3 == 1, F.array(F.struct(F.when(k % 2 == 0, F.lit("Jean X")).alias("nom_complet"), F.lit("Ana").alias("prenom"), F.lit("B").alias("nom")))).alias("representants"),
        F.when(k % 3 == 2, F.array(F.struct(F.lit("Dir").alias("nom")))).alias("dirigeants"),
        F.when(k % 2 == 0, F.array(F.struct(F.lit("100").alias("chiffre_affaires")), F.struct(F.lit("9").alias("chiffre_affaires")))).alias("comptes"),
    )
    body = F.to_json(F.struct(
        F.when(k % 2 == 0, F.array(company)).alias("resultats"), F.when(k % 2 == 1, F.array(company)).alias("results")))
    return table(spark, sf, "supplier").select("s_suppkey", body.alias("body"))


@query("profile_ingest", """SELECT s_suppkey, 0 AS pos, CASE WHEN s_suppkey % 2 = 0 THEN s_name || '|DENO' ELSE 'DENO|Enseigne' END AS names,
    lpad(CASE WHEN s_suppkey % 5 = 0 THEN CAST(s_suppkey AS VARCHAR) ELSE s_suppkey || '0001' END, 14, '0') AS siret, CAST(s_suppkey AS VARCHAR) AS siren,
    CASE WHEN s_suppkey % 3 = 0 THEN '47.11F' ELSE '56.10A' END AS naf, CASE WHEN s_suppkey % 4 = 0 THEN '12' ELSE '10-19' END AS headcount,
    CASE s_suppkey % 3 WHEN 1 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'Jean X' ELSE 'Ana B' END WHEN 2 THEN 'Dir' ELSE '' END AS director,
    CASE WHEN s_suppkey % 2 = 0 THEN '100' ELSE '' END AS revenue, '2001-01-01' AS created_on, '' AS legal_form, '' AS address, '75001' AS cand_cp, 'Paris' AS cand_city
  FROM supplier""")
def profile_ingest(spark, sf):
    r = J.profile_companies(J.parse(_profile_json(spark, sf), "body", J.PROFILE_SCHEMA), ["s_suppkey"])
    return r.withColumn("names", F.array_join("names", "|"))


# --- HTML ------------------------------------------------------------------------

_LI = "(?is)(<li>.*?</li>)"
_ARTICLE = "(?is)(<article>.*?</article>)"
PAGE_LINKS = H.Layout(
    blocks=[[H.both(H.tag("section"), H.has("class", "listing"))], [H.tag("li")]],
    name=[H.first(H.tag("h3")), H.first(H.tag("a"))],
    link=[H.first(H.both(H.tag("a"), H.has("class", "pro")), take="href"), H.first(H.tag("a"), take="href")],
    phone=[H.first(H.both(H.tag("a"), H.starts("href", "tel:")), take="href"), H.first(H.tag("a"))],
    website=[H.first(H.tag("a"), take="href")],
    category=[H.first(H.both(H.tag("a"), H.has("class", "activite"))), H.first(H.tag("a"))],
    base_url="https://d.example.org",
    own_domain="example.org",
)
PAGE_ARTICLE = H.Layout(
    blocks=[[H.tag("article")]], name=[H.first(H.tag("h1")), H.first(H.tag("p"))], address=[H.first(H.tag("p"))],
    website=[H.first(H.tag("a"), take="href")], own_domain="example.org",
)
_ENT = lambda x: (
    "replace(replace(replace(replace(replace(replace(replace(replace(" + x + ", '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
    "'&#39;', ''''), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')"
)
_TXT = lambda x: D.strip(f"regexp_replace({_ENT(f"regexp_replace({x}, '(?s)<[^>]*>', '', 'g')")}, '\\\\s+', ' ', 'g')")
_FIRST_P = "regexp_extract(block, '(?is)<p[^>]*>(.*?)(?:</p>|<p>|</article>)', 1)"


@query("html_listing_extract", f"""WITH b AS (SELECT page_id, unnest(l) AS block, CAST(unnest(range(0, len(l))) AS INTEGER) AS block_pos
    FROM (SELECT page_id, regexp_extract_all(html, '{_LI}', 1) AS l FROM pages)),
  f AS (SELECT page_id, block_pos, {_TXT("regexp_extract(block, '(?is)<a[^>]*>(.*?)</a>', 1)")} AS name,
    regexp_extract(block, '(?is)<a[^>]*href=\"([^\"]*)\"', 1) AS href FROM b)
  SELECT page_id, block_pos, name, CASE WHEN href LIKE '/%' THEN 'https://d.example.org' || href WHEN href LIKE 'http%' THEN href ELSE '' END AS listing_url,
    CASE WHEN href LIKE 'http%' AND NOT contains(href, 'example.org') THEN href ELSE '' END AS website,
    CASE WHEN length(name) < 200 THEN name ELSE '' END AS category, {D.phone_valid(D.digits('name'))} AS phone FROM f WHERE name <> ''""")
def html_listing_extract(spark, sf):
    return H.listings(texts(spark, sf, "pages", "page_id", "url", "html"), PAGE_LINKS).select(
        "page_id", "block_pos", "name", "listing_url", "website", "category", "phone"
    )


@query("html_old_layout", f"""WITH b AS (SELECT page_id, url, unnest(l) AS block, CAST(unnest(range(0, len(l))) AS INTEGER) AS block_pos
    FROM (SELECT page_id, url, regexp_extract_all(html, '{_ARTICLE}', 1) AS l FROM pages)),
  f AS (SELECT page_id, block_pos, {_TXT("regexp_extract(block, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS h, {_TXT(_FIRST_P)} AS p,
    regexp_extract(block, '(?is)<a[^>]*href=\"([^\"]*)\"', 1) AS href FROM b),
  g AS (SELECT *, CASE WHEN h <> '' THEN h ELSE p END AS name, replace(p, chr(10), ' ') AS full_address FROM f)
  SELECT page_id, block_pos, name, full_address, CASE WHEN contains(href, 'example.org') THEN '' ELSE href END AS website,
    CASE WHEN regexp_matches(full_address, '{T.CP_CITY_NO_QUOTE}') THEN regexp_extract(full_address, '{T.CP_CITY_NO_QUOTE}', 1) ELSE '31000' END AS cp,
    CASE WHEN regexp_matches(full_address, '{T.CP_CITY_NO_QUOTE}') THEN {D.title(D.strip(f"regexp_extract(full_address, '{T.CP_CITY_NO_QUOTE}', 2)"))} ELSE 'Toulouse' END AS city
  FROM g WHERE name <> ''""")
def html_old_layout(spark, sf):
    pages = texts(spark, sf, "pages", "page_id", "url", "html").select(
        "*", F.lit("hôtel").alias("keyword"), F.lit("training").alias("training"), F.lit("31").alias("dept"), F.lit("Toulouse").alias("city"))
    return H.old_listings(pages, PAGE_ARTICLE).select("page_id", "block_pos", "name", "full_address", "website", "cp", "city")


# Listing pages built around the titles of the stored pages: nested tags of the block's own kind, entities, several
# selectors that find something unusable before one that fits. Both engines read the same expression.
_TITLE = "trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[ \\n\\t\\r]+', ' '))"
_TITLE_DUCK = "trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[ \\n\\t\\r]+', ' ', 'g'))"
_NUM = "lpad(CAST(page_id AS STRING), 8, '0')"
_LISTING_HTML = f"""
  '<div id="r"><ul><li class="bi-item"><div class="bi-content"><ul class="tags"><li>nouveau</li></ul><div class="head"><a class="bi-denomination x" href="/pros/' || page_id ||
  '"><h3><b>Chez</b> ' || t || ' &amp; Fils &eacute;</h3></a></div><div class="bi-address"><span>' || page_id || ' rue <i>neuve</i></span> 31000&#32;saint-jean</div>' ||
  CASE page_id % 4 WHEN 0 THEN '<div class="bi-fantomas"><span class="number-contact">T&eacute;l : abc</span><b class="a-phone"><i>01</i>' || {_NUM} || '</b></div>'
    WHEN 1 THEN '<a href="tel:02' || {_NUM} || '">appeler</a>' WHEN 2 THEN '<span class="phone-number">12</span>' ELSE '' END ||
  CASE page_id % 5 WHEN 0 THEN '<a class="site" href="https://d.example.org/x">s</a><a data-pjlb="{{site}}" href="https://s' || page_id || '.example.com">s</a>'
    WHEN 1 THEN '<a href="http://u' || page_id || '.example.com" class="my-url"><b>u</b></a>' WHEN 2 THEN '<div class="my-website"><p><a href="http://w' || page_id || '.example.com">w</a></p></div>'
    ELSE '' END ||
  CASE WHEN page_id % 3 = 0 THEN '<p class="bi-activite"></p>' ELSE '' END || '<p class="rubrique">Boulangerie <span>&#8211; <em>p&acirc;tisserie</em></span></p></div></li>' ||
  CASE page_id % 4 WHEN 2 THEN '<li><button class="x btn_tel"><span>T&eacute;l : 03' || {_NUM} || '</span></button></li>' ELSE '' END ||
  '<li class="bi-item"><div class="bi-content"><a class="bi-denomination"><h3> </h3></a></div></li>' ||
  '<li class="bi-item"><div class="bi-content"><a class="bi-denomination" href="http://o.example.com"><h3>Deux<br>lignes</h3></a><a href="tel:999">x</a></div></li></ul></div>'"""
_OLD_HTML = f"""
  '<section><article class="a bi-bloc"><div class="bi-blocs"></div><div><article>' || t || '</article></div>' ||
  CASE WHEN page_id % 2 = 0 THEN '<h2><a href="x">Maison ' || page_id || '</a></h2><span class="denomination">autre</span>' ELSE '<span class="x-denomination"><b>Nom</b> ' || page_id || '</span><h3><a>autre</a></h3>' END ||
  '<address>' || page_id || ' quai<br>du Port 64100 bayonne</address><p class="adresse">plus loin</p>' ||
  CASE page_id % 3 WHEN 0 THEN '<a class="tel" href="tel:05' || {_NUM} || '"><b>appeler</b></a>' WHEN 1 THEN '<span class="phone">sur <i>demande</i></span><a href="tel:0600000000">x</a>' ELSE '' END ||
  CASE page_id % 4 WHEN 0 THEN '<a class="site" href="https://d.example.org/in">s</a>' ELSE '' END || '<a class="web" href="https://w' || page_id || '.example.com">w</a></article></section>'"""


def _built(spark, sf, html):
    pages = texts(spark, sf, "pages", "page_id", "html").selectExpr("page_id", f"{_TITLE} AS t")
    return pages.selectExpr("page_id", f"{html} AS html")


def _with_domain(layout):
    return H.Layout(**{**layout.__dict__, "base_url": "https://d.example.org", "own_domain": "d.example.org"})


@query("directory_listings", f"""WITH p AS (SELECT page_id, {_ENT(_TITLE_DUCK)} AS t, {_NUM.replace('STRING', 'VARCHAR')} AS num FROM pages)
  SELECT page_id, 0 AS block_pos, trim('Chez ' || t || CASE WHEN t = '' THEN '' ELSE ' ' END || '& Fils é') AS name, 'https://d.example.org/pros/' || page_id AS listing_url,
    page_id || ' rue neuve 31000 saint-jean' AS address,
    CASE page_id % 4 WHEN 0 THEN '01' || num WHEN 1 THEN '02' || num WHEN 2 THEN '03' || num ELSE '' END AS phone,
    CASE page_id % 5 WHEN 0 THEN 'https://s' || page_id || '.example.com' WHEN 1 THEN 'http://u' || page_id || '.example.com' WHEN 2 THEN 'http://w' || page_id || '.example.com' ELSE '' END AS website,
    'Boulangerie – pâtisserie' AS category, '31000' AS cp, 'Saint-Jean' AS city, CASE WHEN page_id % 4 = 3 THEN 'vide' ELSE 'direct' END AS phone_capture FROM p
  UNION ALL SELECT page_id, 2, 'Deux' || chr(10) || 'lignes', 'http://o.example.com', '', CASE WHEN page_id % 4 = 2 THEN '03' || num ELSE '' END, '', '', '', '',
    CASE WHEN page_id % 4 = 2 THEN 'direct' ELSE 'vide' END FROM p""")
def directory_listings(spark, sf):
    """The directory's own selectors over nested listing markup."""
    return H.listings(_built(spark, sf, _LISTING_HTML), _with_domain(H.DIRECTORY))


@query("older_directory_listings", f"""WITH p AS (SELECT page_id, {_NUM.replace('STRING', 'VARCHAR')} AS num FROM pages)
  SELECT page_id, 0 AS block_pos, 'training' AS training, 'hôtel' AS kind, CASE WHEN page_id % 2 = 0 THEN 'Maison ' ELSE 'Nom ' END || page_id AS name,
    page_id || ' quai du Port 64100 bayonne' AS full_address, '31' AS dept, CASE page_id % 3 WHEN 0 THEN '05' || num WHEN 1 THEN 'sur demande' ELSE '' END AS phone,
    CASE WHEN page_id % 4 = 0 THEN '' ELSE 'https://w' || page_id || '.example.com' END AS website, '64100' AS cp, 'Bayonne' AS city FROM p""")
def older_directory_listings(spark, sf):
    """The older layout: the first element in document order decides."""
    pages = _built(spark, sf, _OLD_HTML).select(
        "*", F.lit("hôtel").alias("keyword"), F.lit("training").alias("training"), F.lit("31").alias("dept"), F.lit("Toulouse").alias("city"))
    return H.old_listings(pages, _with_domain(H.OLD_DIRECTORY))


@query("selector_coverage", f"""WITH b AS (SELECT unnest(regexp_extract_all(html, '{_LI}', 1)) AS block FROM pages),
  sel AS (SELECT * FROM (VALUES ('name', 0, '<h3\\b'), ('name', 1, '<a\\b'), ('link', 0, '<a\\b[^>]*class="[^"]*pro'), ('link', 1, '<a\\b[^>]*href="'),
    ('phone', 0, 'href="tel:'), ('phone', 1, '<a\\b'), ('website', 0, '<a\\b[^>]*href="'), ('category', 0, '<a\\b[^>]*class="[^"]*activite'), ('category', 1, '<a\\b')) t(part, pos, re))
  SELECT part, pos, count(*) FILTER (WHERE regexp_matches(block, '(?is)' || re)) AS n_hit, count(*) AS n_blocks FROM sel, b GROUP BY ALL""")
def selector_coverage(spark, sf):
    return H.selector_coverage(texts(spark, sf, "pages", "page_id", "url", "html"), PAGE_LINKS)


@query("registry_work_list", """WITH a AS (SELECT * FROM (VALUES (0, '10.71C'), (1, '10.71D'), (2, '47.24Z')) t(activity_pos, activity)),
  c AS (SELECT s_name AS city, 'owner ' || s_nationkey AS owner, unnest([0, 1]) AS commune_pos, unnest([lpad(CAST(s_suppkey AS VARCHAR), 5, '0'), '7' || s_nationkey]) AS commune FROM supplier)
  SELECT city, owner, commune_pos, commune, activity_pos, activity FROM c, a""")
def registry_work_list(spark, sf):
    """Commune x activity requests of each configured city."""
    cities = table(spark, sf, "supplier").select(
        F.col("s_name").alias("city"), F.concat(F.lit("owner "), "s_nationkey").alias("owner"),
        F.array(F.lpad(F.col("s_suppkey").cast("string"), 5, "0"), F.concat(F.lit("7"), "s_nationkey")).alias("communes"))
    return J.registry_work(cities, R.REGISTRY_ACTIVITIES)


@query("keyword_work_list", """WITH k AS (SELECT c_custkey AS search_id, unnest([0, 1]) AS keyword_pos, unnest([c_mktsegment, 'pharmacie']) AS keyword FROM customer),
  c AS (SELECT c_custkey AS search_id, unnest([0, 1]) AS city_pos, unnest(['Paris', c_name]) AS city, unnest(['75', '31']) AS dept FROM customer)
  SELECT search_id, keyword_pos, keyword, city_pos, city, dept FROM k JOIN c USING (search_id)""")
def keyword_work_list(spark, sf):
    """Keyword x city searches, the department in a city's text first."""
    searches = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("search_id"), F.array("c_mktsegment", F.lit("pharmacie")).alias("keywords"), F.array(F.lit("Paris 75"), "c_name").alias("cities"),
        F.lit("31").alias("dept"))
    return J.keyword_work(searches)


@query("saved_responses", """SELECT o_custkey AS k, o_orderkey AS pos, CASE WHEN o_orderkey % 2 = 0 THEN 'A ' || o_orderkey ELSE '' END AS name FROM orders
  WHERE o_orderkey % 7 <> 0 UNION ALL SELECT NULL, NULL, NULL FROM orders WHERE o_orderkey % 7 = 0""")
def saved_responses(spark, sf):
    """Response files written by a collector and read back, unreadable lines kept as nulls."""
    path = fresh_path(spark, "responses")
    k = F.col("o_orderkey")
    item = F.struct(k.alias("pos"), F.when(k % 2 == 0, F.concat(F.lit("A "), k.cast("string"))).otherwise("").alias("name"))
    line = F.when(k % 7 == 0, F.lit("{not json")).otherwise(F.to_json(F.struct(F.col("o_custkey").alias("k"), F.array(item).alias("items"))))
    table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    back = J.read_responses(spark, path, "k bigint, items array<struct<pos: bigint, name: string>>")
    return back.select("k", F.explode_outer("items").alias("i")).select("k", "i.pos", "i.name")


# --- files -----------------------------------------------------------------------

@query("sinks_roundtrip", ctes("listing") + """
  SELECT ord, siret, name, address, cp, city, phone, website, search_city AS part FROM listing""")
def sinks_roundtrip(spark, sf):
    """Listings to CSV per search city and back, every value text and unchanged."""
    cols = ["ord", "siret", "name", "address", "cp", "city", "phone", "website"]
    path = fresh_path(spark, "roundtrip")
    sink.write_csv(view(spark, sf, "listing").withColumn("part", F.col("search_city")), path, cols, by=["part"])
    back = files.read_csv(spark, path, [*cols, "part"])
    return back.select(F.col("ord").cast("bigint").alias("ord"), *cols[1:], "part")


@query("skip_empty_csv", "SELECT c_mktsegment AS segment, count(*) AS n, true AS written, false AS empty_written FROM customer GROUP BY 1")
def skip_empty_csv(spark, sf):
    """A projected file for rows, none for an empty frame."""
    rows = table(spark, sf, "customer")
    path, nothing = fresh_path(spark, "some"), fresh_path(spark, "none")
    written = sink.write_if_any(rows, path, ["c_custkey", "c_mktsegment"])
    empty = sink.write_if_any(rows.where("c_custkey < 0"), nothing, ["c_custkey"])
    back = files.read_csv(spark, path, ["c_custkey", "c_mktsegment"])
    return back.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n")).withColumns({"written": F.lit(written), "empty_written": F.lit(empty)})


@query("incremental_save", "SELECT o_custkey AS k, count(*) AS n, max(o_orderkey % 3) AS last FROM orders GROUP BY 1")
def incremental_save(spark, sf):
    """Three saves to one progress table; each only adds."""
    path = fresh_path(spark, "saved")
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 3).alias("step"))
    for step in range(3):
        sink.append_progress(rows.where(F.col("step") == step), path)
    return spark.read.parquet(path).groupBy("k").agg(F.count("*").alias("n"), F.max("step").alias("last"))


@query("leads_csv_roundtrip", CROSSED + f" SELECT {', '.join(LEAD_COLUMNS)} FROM leads")
def leads_csv_roundtrip(spark, sf):
    """Leads under their display names, read back and renamed."""
    path = fresh_path(spark, "leads")
    sink.write_leads(crossed(spark, sf), path)
    back = files.read_csv(spark, path, list(R.LEAD_DISPLAY.values()))
    return back.select(*[F.col(f"`{d}`").alias(c) for c, d in R.LEAD_DISPLAY.items()])


_STAGES = {
    "listing": (R.LISTING_DISPLAY, "listing"), "signal": (R.SIGNAL_DISPLAY, "potential"), "enriched": (R.ENRICHED_DISPLAY, "listing"),
    "profiled": (R.PROFILED_DISPLAY, "listing"), "registry": (R.REGISTRY_DISPLAY, "potential"), "sector": (R.SECTOR_DISPLAY, "listing"),
}


@query("stage_csv_roundtrip", ctes("listing", "potential") + """
  SELECT 'listing' AS stage, name, address, cp, phone, collected_on, '' AS lbb_score FROM listing
  UNION ALL SELECT 'signal', name, address, cp, phone, collected_on, lbb_score FROM potential
  UNION ALL SELECT 'enriched', name, address, cp, phone, collected_on, '' FROM listing UNION ALL SELECT 'profiled', name, address, cp, phone, collected_on, '' FROM listing
  UNION ALL SELECT 'registry', name, address, '', phone, '', '' FROM potential UNION ALL SELECT 'sector', name, '', cp, phone, collected_on, '' FROM listing""")
def stage_csv_roundtrip(spark, sf):
    """Stage files under their display names; columns a source lacks come back blank."""
    out = []
    for stage, (display, source) in _STAGES.items():
        path = fresh_path(spark, stage)
        sink.write_stage(view(spark, sf, source), path, display)
        back = files.read_csv(spark, path, list(display.values()))
        names = {c: F.col(f"`{d}`").alias(c) for c, d in display.items()}
        keep = [names.get(c, F.lit("").alias(c)) for c in ("name", "address", "cp", "phone", "collected_on", "lbb_score")]
        out.append(back.select(F.lit(stage).alias("stage"), *keep))
    return reduce(DataFrame.unionByName, out)


@query("superset_roundtrip", """
  SELECT 'customer' AS kind, c_name AS name, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment, '' AS extra, '' AS director FROM customer
  UNION ALL SELECT 'supplier', s_name, CAST(s_suppkey AS VARCHAR), '', 'x', '' FROM supplier""")
def superset_roundtrip(spark, sf):
    """Rows with different columns in one output; gaps and declared columns are blank."""
    a = table(spark, sf, "customer").selectExpr("'customer' AS kind", "c_name AS name", "CAST(c_custkey AS STRING) AS id", "c_mktsegment AS segment")
    b = table(spark, sf, "supplier").selectExpr("'supplier' AS kind", "s_name AS name", "CAST(s_suppkey AS STRING) AS id", "'x' AS extra")
    path = fresh_path(spark, "superset")
    sink.write_superset([a, b], ["director"], path)
    return spark.read.parquet(path)


@query("sector_outputs", ctes("listing") + """
  SELECT city AS sector, count(*) AS n_sector, count(*) AS n_consolidated FROM listing GROUP BY city""")
def sector_outputs(spark, sf):
    """One folder per sector and one consolidated copy."""
    path = fresh_path(spark, "sectors")
    sink.write_sectors(view(spark, sf, "listing").withColumnRenamed("city", "sector"), path, ["sector"])
    whole = spark.read.parquet(f"{path}/consolidated").groupBy("sector").agg(F.count("*").alias("n_consolidated"))
    per = spark.read.parquet(f"{path}/sectors").groupBy("sector").agg(F.count("*").alias("n_sector"))
    return per.join(whole, "sector")


@query("file_discovery")
def file_discovery(spark, sf):
    """Stage files of each kind written from the listings, then found by their names."""
    root = fresh_path(spark, "discovery")
    rows = view(spark, sf, "listing").select("ord", "name", "phone")
    for name in ("pj_lyon.csv", "pj_lyon_enrichi.csv", "LBA_LBB_results.csv", "lba_lbb_results_backup.csv"):
        sink.write_csv(rows, f"{root}/{name}", ["ord", "name", "phone"])
    found = files.list_files(spark, root, "part-*")
    staged = found.select(
        F.regexp_extract("path", "([^/]+\\.csv)/part-", 1).alias("file"), F.regexp_extract("path", "(.*\\.csv)/part-", 1).alias("path"), "modified"
    ).groupBy("file", "path").agg(F.max("modified").alias("modified"))
    signals = files.matching(staged, ["lba", "lbb"])
    newest = files.newest(signals).select(F.element_at(F.split("path", "/"), -1).alias("file"))
    return signals.select(F.lit("signals").alias("kind"), "file").unionByName(
        files.listing_inputs(staged).select(F.lit("listings").alias("kind"), "file")
    ).unionByName(newest.select(F.lit("newest").alias("kind"), "file"))
