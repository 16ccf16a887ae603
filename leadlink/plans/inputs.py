"""Stage tables derived from the given tables.

Each column is one expression that Spark and the SQL check both read, so the two sides
start from the same rows. Skew is part of the design: a third of the rows share one id,
postal code or phone, and a third have no id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadlink.session import fill

RUN_DATE = "2026-02-23"
EXPECTED_NAF = ["10.71", "47.11", "86.10Z"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Columns of a table whose rows are costly to process."""
    return fill(table(spark, sf_dir, name).select(*cols))


_PAIR = "CAST((p_partkey - p_partkey % 2) / 2 AS BIGINT)"
_CITY = (
    "CASE p_size % 6 WHEN 0 THEN 'Saint-Denis' WHEN 1 THEN 'Lyon' WHEN 2 THEN 'Évry' WHEN 3 THEN 'Paris 20' "
    "WHEN 4 THEN 'Boulogne-Billancourt' ELSE 'Le Mans' END"
)
_CP = "CASE WHEN p_partkey % 3 = 1 THEN '75001' ELSE CAST(p_size * 1000 + p_size AS STRING) END"
_NUMBER = "CASE WHEN p_partkey % 3 = 2 THEN '40000000' ELSE lpad(CAST(p_size * 7 + p_partkey % 5 AS STRING), 8, '0') END"
_NAME = (
    "CASE p_partkey % 4 WHEN 0 THEN 'Sarl ' WHEN 1 THEN 'EURL ' ELSE '' END || "
    "CASE WHEN p_partkey % 5 = 0 THEN replace(p_name, 'e', 'é') ELSE p_name END"
)
_NAF = (
    "CASE p_size % 9 WHEN 0 THEN '10.71C' WHEN 1 THEN '1071D' WHEN 2 THEN '47.11D' WHEN 3 THEN '4711F' WHEN 4 THEN '86.10Z' "
    "WHEN 5 THEN '56.10A' WHEN 6 THEN '' WHEN 7 THEN '10.99X' ELSE '68.31Z' END"
)

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    # directory listings
    "listing": ("part", {
        "ord": "p_partkey",
        "siret": f"CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 7 = 1 THEN CAST({_PAIR} AS STRING) || '.0' "
                 f"ELSE lpad(CAST({_PAIR} AS STRING), 14, '0') END",
        "name": _NAME,
        "naf": _NAF,
        "address": f"CAST(p_size AS STRING) || ' rue ' || p_type || ', ' || lpad({_CP}, 5, '0') || ' ' || {_CITY}",
        "city": _CITY,
        "cp": _CP,
        "phone": f"CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '+33 1 ' || {_NUMBER} WHEN 2 THEN '01.' || {_NUMBER} "
                 f"ELSE '01' || {_NUMBER} END",
        "website": "CASE WHEN p_partkey % 6 = 0 THEN 'http://www.' || lower(p_type) || '.example.com' ELSE '' END",
        "category": "p_type",
        "search_city": _CITY,
        "city_ord": "CAST(p_size % 6 AS BIGINT)",
        "listing_url": "CASE p_partkey % 3 WHEN 0 THEN '/pros/' || CAST(p_partkey AS STRING) WHEN 1 THEN 'https://d.example.org/' "
                       "|| CAST(p_partkey AS STRING) ELSE '' END",
        "collected_on": f"'{RUN_DATE}'",
    }),
    # live offers: one company holds a third of them
    "offer": ("orders", {
        "ord": "o_orderkey",
        "siret": "CASE WHEN o_orderkey % 11 = 5 THEN '' WHEN o_orderkey % 3 = 0 THEN lpad('77', 14, '0') "
                 "ELSE lpad(CAST(o_custkey AS STRING), 14, '0') END",
        "name": "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'Société ' || CAST(o_custkey AS STRING) END",
        "naf": "CASE o_custkey % 5 WHEN 0 THEN '10.71C' WHEN 1 THEN '4711D' WHEN 2 THEN '' WHEN 3 THEN '56.10A' ELSE '86.10Z' END",
        "address": "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey % 90 AS STRING) || ' quai ' || o_orderpriority ELSE '' END",
        "city": "CASE o_custkey % 3 WHEN 0 THEN 'Lyon' WHEN 1 THEN '' ELSE 'Évry' END",
        "cp": "CASE WHEN o_custkey % 2 = 0 THEN '75001' ELSE '' END",
        "phone": "CASE WHEN o_orderkey % 6 = 1 THEN '01' || lpad(CAST(o_custkey AS STRING), 8, '0') ELSE '' END",
        "search_city": "o_orderstatus",
        "collected_on": f"'{RUN_DATE}'",
        "offers": "CAST(1 AS BIGINT)",
    }),
    # hiring potential: only some of the ids also have offers
    "potential": ("customer", {
        "ord": "c_custkey",
        "siret": "CASE WHEN c_custkey % 13 = 4 THEN '' ELSE lpad(CAST(c_custkey - c_custkey % 3 AS STRING), 14, '0') END",
        "name": "c_name",
        "naf": "CASE c_custkey % 4 WHEN 0 THEN '47.11F' WHEN 1 THEN '' WHEN 2 THEN '68.31Z' ELSE '10.71A' END",
        "address": "CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS STRING) || ' place ' || c_mktsegment ELSE ' ' END",
        "city": "c_mktsegment",
        "cp": "lpad(CAST(c_nationkey * 1000 AS STRING), 5, '0')",
        "phone": "CASE WHEN c_custkey % 3 = 1 THEN '02' || lpad(CAST(c_custkey AS STRING), 8, '0') ELSE '' END",
        "search_city": "CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END",
        "collected_on": f"'{RUN_DATE}'",
        "lbb_score": "CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) END",
    }),
    # leads to deduplicate and back-fill
    "lead": ("part", {
        "ord": "p_partkey",
        "siret": "lpad(CAST(p_partkey AS STRING), 14, '0')",
        "name": _NAME,
        "naf": _NAF,
        "address": "CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE '' END",
        "city": _CITY,
        "cp": _CP,
        "phone": f"CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '+33 1 ' || {_NUMBER} ELSE '01' || {_NUMBER} END",
        "phone_source": "CASE p_partkey % 5 WHEN 0 THEN '' ELSE 'PJ direct' END",
        "website": "CASE WHEN p_partkey % 7 = 0 THEN 'http://x.example.com' ELSE '' END",
        "priority": "CASE p_partkey % 4 WHEN 0 THEN 'Haute' WHEN 1 THEN 'Moyenne' ELSE 'Basse' END",
        "source": "CASE p_partkey % 4 WHEN 0 THEN 'LBA' WHEN 1 THEN 'LBB' ELSE 'Pages Jaunes' END",
        "lbb_score": "CASE WHEN p_partkey % 8 = 1 THEN CAST(p_size AS STRING) ELSE '' END",
        "offers": "CASE WHEN p_partkey % 4 = 0 THEN '1' ELSE '' END",
        "collected_on": f"'{RUN_DATE}'",
    }),
    # companies with codes written with and without the dot
    "company": ("part", {
        "ord": "p_partkey",
        "name": "p_name || ' ' || CASE p_size % 10 WHEN 0 THEN 'LIDL' WHEN 1 THEN 'Saint-Paul' WHEN 2 THEN 'Brico Dépôt' "
                "WHEN 3 THEN 'Le Kebab' WHEN 4 THEN 'Pharmacie' WHEN 5 THEN 'C.H.R.S' WHEN 6 THEN 'Foyer de jeunes' ELSE p_type END",
        "category": "CASE p_size % 7 WHEN 0 THEN 'Parapharmacie' WHEN 1 THEN 'Centre d''hébergement' WHEN 2 THEN 'Planning familial' ELSE p_brand END",
        "naf": _NAF,
        "sector": "CASE p_partkey % 4 WHEN 0 THEN 'mbt' WHEN 1 THEN 'TG' WHEN 2 THEN 'SB' ELSE '' END",
        "status": "CASE WHEN p_partkey % 3 = 0 THEN 'SIRET trouvé' WHEN p_partkey % 3 = 1 THEN 'Exclu — SIRET introuvable' "
                  "ELSE 'Exclu — erreur API' END",
        "source": "CASE WHEN p_partkey % 2 = 0 THEN 'listing' ELSE 'signal' END",
    }),
    # raw texts, whole
    "raw": ("documents", {"doc_id": "doc_id", "text": "text", "lang": "lang", "source": "source"}),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, cols = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} AS {c}" for c, e in cols.items()])


def view_sql(name: str) -> str:
    source, cols = VIEWS[name]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in cols.items())} FROM {source}"


def ctes(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({view_sql(n)})" for n in names)
