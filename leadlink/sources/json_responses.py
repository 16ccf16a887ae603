"""Saved search responses (nested JSON) to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as P

from leadlink.functions import text as T
from leadlink.operators import classify

_ITEM = """struct<
  workplace:struct<siret:string,name:string,legal_name:string,brand:string,
                   domain:struct<naf:struct<code:string>>,location:struct<address:string>,contact:struct<phone:string>>,
  company:struct<siret:string,name:string,naf:string,score:string>,
  place:struct<fullAddress:string,city:string,zipCode:string>,
  apply:struct<phone:string>,contact:struct<phone:string>,phone:string,telephone:string,hiring_potential:string>"""
SIGNALS_SCHEMA = f"jobs array<{_ITEM}>, recruiters array<{_ITEM}>"

_SITE = """struct<siret:string,activite_principale:string,code_postal:string,commune:string,libelle_commune:string,
  adresse:string,etat_administratif:string,nom_commercial:string,liste_enseignes:array<string>>"""
REGISTRY_SCHEMA = f"""total_pages bigint, results array<struct<siren:string,nom_complet:string,nom_raison_sociale:string,
  siege:{_SITE},matching_etablissements:array<{_SITE}>>>"""

_COMPANY = """struct<nom_entreprise:string,denomination:string,nom_complet:string,sigle:string,nom:string,siren:string,
  siret:string,code_naf:string,effectif:string,tranche_effectif:string,date_creation:string,forme_juridique:string,
  siege:struct<siret:string,code_naf:string,activite_principale:string,enseigne:string,adresse_ligne_1:string,
               code_postal:string,ville:string>,
  representants:array<struct<nom_complet:string,prenom:string,nom:string>>,
  dirigeants:array<struct<nom_complet:string,prenom:string,nom:string>>,
  finances:array<struct<chiffre_affaires:string>>,comptes:array<struct<chiffre_affaires:string>>>"""
PROFILE_SCHEMA = f"resultats array<{_COMPANY}>, results array<{_COMPANY}>"


def read_responses(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Saved responses, one JSON document per line; an unreadable line becomes nulls."""
    return spark.read.schema(schema).json(path)


def parse(df: DataFrame, body: str, schema: str) -> DataFrame:
    """Parse a JSON text column and put its fields beside the others."""
    ddl = P.StructType.fromDDL(schema)
    return df.withColumn("_r", F.from_json(F.col(body), ddl)).select(*[c for c in df.columns if c != body], "_r.*")


def _phone(i: str) -> Column:
    return T.extract_phone(*[F.col(f"{i}.{p}") for p in ("apply.phone", "workplace.contact.phone", "contact.phone", "phone", "telephone")])


def _signal_fields(i: str, live: bool) -> list[Column]:
    """Company fields of an item: the workplace leads for offers, the company for potentials."""
    wp, co, pl = f"{i}.workplace", f"{i}.company", f"{i}.place"
    name = [f"{wp}.name", f"{wp}.legal_name", f"{wp}.brand", f"{co}.name"] if live else [f"{co}.name", f"{wp}.name"]
    siret = [f"{wp}.siret", f"{co}.siret"]
    naf = [f"{wp}.domain.naf.code", f"{co}.naf"]
    addr = [f"{wp}.location.address", f"{pl}.fullAddress"]
    if not live:
        siret, naf, addr = siret[::-1], naf[::-1], addr[::-1]
    pick = lambda paths: T.first_nonempty(*[F.col(p) for p in paths])
    parts = T.parse_address(pick(addr))
    score = F.lit("") if live else pick([f"{co}.score", f"{i}.hiring_potential"])
    return [
        pick(name).alias("name"),
        T.normalize_siret(pick(siret)).alias("siret"),
        pick(naf).alias("naf"),
        parts["street"].alias("address"),
        F.coalesce(T.nonempty(F.col(f"{pl}.city")), parts["city"]).alias("city"),
        F.coalesce(T.nonempty(F.col(f"{pl}.zipCode")), parts["cp"]).alias("cp"),
        _phone(i).alias("phone"),
        score.alias("lbb_score"),
        F.lit("LBA" if live else "LBB").alias("source"),
        (F.lit(1) if live else F.lit(None)).cast("bigint").alias("offers"),
    ]


def signal_rows(responses: DataFrame, keep: list[str]) -> DataFrame:
    """Live-offer and hiring-potential rows in one pass; a missing array is an empty one.

    Both arrays are tagged and exploded together, so a response is read and parsed once. The
    outer explode matters: for an inner one the optimizer adds a size filter below it, which
    would parse the JSON text again.
    """

    def tagged(array: str, live: bool) -> Column:
        return F.transform(array, lambda x, n: F.struct(F.lit(live).alias("live"), n.alias("pos"), x.alias("i")))

    jobs, recruiters = tagged("jobs", True), tagged("recruiters", False)
    items = F.when(F.col("jobs").isNull(), recruiters).when(F.col("recruiters").isNull(), jobs).otherwise(F.concat(jobs, recruiters))
    rows = responses.select(*keep, F.explode_outer(items).alias("t")).where(F.col("t.i").isNotNull())
    names = ["name", "siret", "naf", "address", "city", "cp", "phone", "lbb_score", "source", "offers"]
    sides = zip(names, _signal_fields("t.i", True), _signal_fields("t.i", False))
    fields = [F.when(F.col("t.live"), a).otherwise(b).alias(n) for n, a, b in sides]
    return rows.select(*keep, F.col("t.pos").alias("item_pos"), *fields).where(F.col("siret") != "")


def signals(responses: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """The two kinds of rows as separate frames."""
    rows = signal_rows(responses, keep)
    return rows.where("source = 'LBA'"), rows.where("source = 'LBB'")


def _trade_name(site: str, fallback: str) -> Column:
    first = F.get(F.col(f"{site}.liste_enseignes"), F.lit(0))
    has = F.coalesce(F.size(f"{site}.liste_enseignes"), F.lit(0)) > 0
    return F.when(has, T.text(first)).otherwise(T.first_nonempty(F.col(f"{site}.nom_commercial"), F.col(fallback)))


def _site_row(site: str, keep: list[str]) -> list[Column]:
    return [
        *[F.col(k) for k in keep],
        T.title_case(T.strip(_trade_name(site, "r.nom_complet"))).alias("name"),
        *[T.text(F.col(f"{site}.{a}")).alias(b) for a, b in (
            ("adresse", "address"), ("code_postal", "cp"), ("libelle_commune", "city"), ("siret", "siret"))],
        T.text(F.col("r.siren")).alias("siren"),
        F.coalesce(f"{site}.activite_principale", "requested_naf").alias("naf"),
    ]


def registry_sites(responses: DataFrame, keep: list[str]) -> DataFrame:
    """Active establishments of the requested commune, the head office where none is listed.

    responses: commune, requested_naf and the parsed response columns.
    """
    r = responses.select(*keep, "commune", "requested_naf", F.posexplode_outer("results").alias("result_pos", "r")).where(F.col("r").isNotNull())
    listed = F.coalesce(F.size("r.matching_etablissements"), F.lit(0)) > 0
    a = r.where(listed).select(*keep, "commune", "requested_naf", "result_pos", "r", F.posexplode("r.matching_etablissements").alias("site_pos", "e"))
    b = r.where(~listed).withColumn("site_pos", F.lit(0)).withColumn("e", F.col("r.siege"))
    rows = a.unionByName(b)
    live = (F.col("e.etat_administratif") == "A") & (F.col("e.commune") == F.col("commune"))
    return rows.where(live).select(*_site_row("e", [*keep, "commune", "result_pos", "site_pos"]))


def registry_candidates(responses: DataFrame, keep: list[str]) -> DataFrame:
    """Candidates of a name search: position, up to three names, head-office fields."""
    r = responses.select(*keep, F.posexplode_outer("results").alias("pos", "r")).where(F.col("r").isNotNull())
    sign = F.get(F.col("r.siege.liste_enseignes"), F.lit(0))
    return r.select(
        *keep, "pos",
        F.filter(F.array("r.nom_complet", "r.nom_raison_sociale", sign), lambda n: T.text(n) != "").alias("names"),
        F.col("r.siege.code_postal").alias("cand_cp"), F.col("r.siege.libelle_commune").alias("cand_city"),
        F.col("r.siege.siret").alias("siret"), F.col("r.siege.activite_principale").alias("naf"),
    )


def profile_companies(responses: DataFrame, keep: list[str]) -> DataFrame:
    """Companies of a profile search; the array may sit under either of two names."""
    arr = F.when(F.coalesce(F.size("resultats"), F.lit(0)) > 0, F.col("resultats")).otherwise(F.col("results"))
    r = responses.select(*keep, F.posexplode_outer(arr).alias("pos", "c")).where(F.col("c").isNotNull())
    people = F.when(F.coalesce(F.size("c.representants"), F.lit(0)) > 0, F.col("c.representants")).otherwise(F.col("c.dirigeants"))
    years = F.when(F.coalesce(F.size("c.finances"), F.lit(0)) > 0, F.col("c.finances")).otherwise(F.col("c.comptes"))
    boss = F.get(people, F.lit(0))
    full = T.strip(F.concat(T.text(boss["prenom"]), F.lit(" "), T.text(boss["nom"])))
    names = F.array(*[F.col(f"c.{n}") for n in ("nom_entreprise", "denomination", "nom_complet", "sigle", "nom")], F.col("c.siege.enseigne"))
    pick = T.first_nonempty
    return r.select(
        *keep, "pos",
        F.filter(names, lambda n: T.text(n) != "").alias("names"),
        T.normalize_siret(pick(F.col("c.siege.siret"), F.col("c.siret"))).alias("siret"),
        T.strip(T.text(F.col("c.siren"))).alias("siren"),
        pick(F.col("c.siege.code_naf"), F.col("c.code_naf"), F.col("c.siege.activite_principale")).alias("naf"),
        pick(F.col("c.effectif"), F.col("c.tranche_effectif")).alias("headcount"),
        F.when(boss.isNull(), "").otherwise(pick(boss["nom_complet"], full)).alias("director"),
        T.text(F.get(years, F.lit(0))["chiffre_affaires"]).alias("revenue"),
        T.text(F.col("c.date_creation")).alias("created_on"),
        T.text(F.col("c.forme_juridique")).alias("legal_form"),
        T.text(F.col("c.siege.adresse_ligne_1")).alias("address"),
        T.text(F.col("c.siege.code_postal")).alias("cand_cp"),
        T.text(F.col("c.siege.ville")).alias("cand_city"),
    )


REQUEST_SCHEMA = (
    "request_id string, ville string, villes array<string>, profil string, profils array<string>, "
    "codes_naf array<string>, rayon_km int, type_commerce string, nb_max_resultats int, batch_name string"
)


def run_requests(params: DataFrame) -> DataFrame:
    """One row per run request with defaults applied; a request without a city is rejected."""
    cities = F.coalesce("villes", F.when(F.col("ville").isNotNull(), F.array("ville")))
    return params.select(
        "request_id", cities.alias("cities"),
        F.coalesce(F.when(F.col("profil").isNotNull(), F.array("profil")), "profils").alias("profiles"),
        "codes_naf", F.coalesce("rayon_km", F.lit(30)).alias("radius_km"), "type_commerce",
        F.coalesce("nb_max_resultats", F.lit(100)).alias("max_results"), "batch_name",
        F.when(cities.isNull(), "no city").otherwise("ok").alias("status"),
    )


def request_codes(requests: DataFrame, spark: SparkSession) -> DataFrame:
    """(request_id, codes, label, unknown): the activity codes of each accepted request, of its profiles if it names any."""
    ok = requests.where("status = 'ok'")
    named = ok.select("request_id", F.posexplode("profiles").alias("pos", "profile"))
    given = ok.where("profiles IS NULL").select(
        "request_id", F.coalesce("codes_naf", F.array().cast("array<string>")).alias("codes"), F.lit("").alias("label"), F.array().cast("array<string>").alias("unknown")
    )
    return classify.resolve_profiles(named, spark).unionByName(given)


def registry_work(cities: DataFrame, activities: list[str]) -> DataFrame:
    """Every (city, commune, activity) of a registry extract, in order. cities: city, communes, owner."""
    c = cities.select("city", "owner", F.posexplode("communes").alias("commune_pos", "commune"))
    return c.select("*", F.posexplode(F.array(*[F.lit(a) for a in activities])).alias("activity_pos", "activity"))


def keyword_work(searches: DataFrame) -> DataFrame:
    """Every (keyword, city) of a search, keywords first; the department inside a city's text wins over the search's own.

    searches: search_id, keywords, cities, dept.
    """
    k = searches.select("search_id", "cities", "dept", F.posexplode("keywords").alias("keyword_pos", "keyword"))
    rows = k.select("search_id", "keyword_pos", "keyword", "dept", F.posexplode("cities").alias("city_pos", "raw"))
    own = T.department_in_city(F.col("raw"))
    dept = F.when(F.coalesce(own, F.lit("")) != "", own).otherwise(F.col("dept"))
    return rows.select("search_id", "keyword_pos", "keyword", "city_pos", T.clean_city(F.col("raw")).alias("city"), dept.alias("dept"))


def work_list(requests: DataFrame, occupations: DataFrame) -> DataFrame:
    """Every (request, city, occupation) to collect, in order.

    Requests are configuration rows; the join is on request_id, not a cross join of data.
    """
    cities = requests.where("status = 'ok'").select("request_id", "radius_km", F.posexplode("cities").alias("city_pos", "city"))
    return cities.join(occupations, "request_id")
