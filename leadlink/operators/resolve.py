"""Best-match resolution of listings against candidate lists, and phone back-fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlink.functions import similarity as SIM
from leadlink.functions import text as T
from leadlink.operators.simjoin import similar_between
from leadlink.session import cut, spread

REGISTRY_THRESHOLD = 80
BACKFILL_THRESHOLD = 85
PROFILE_HIGH, PROFILE_LOW, PROFILE_SINGLE = 80, 60, 50
CITY_THRESHOLD = 80


def pool_tier(query_cp: Column, query_city: Column, cand_cp: Column, cand_city: Column) -> Column:
    """1 = same postal code, 2 = city inside the candidate's commune, 3 = the rest."""
    city = F.lower(T.strip(T.text(query_city)))
    by_cp = (T.text(query_cp) != "") & (T.text(cand_cp) == T.text(query_cp))
    by_city = (city != "") & F.contains(F.lower(T.text(cand_city)), city)
    return F.when(by_cp, 1).when(by_city, 2).otherwise(3)


def resolve_registry(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Registry id per listing: best name similarity inside the narrowest candidate pool.

    queries: query_id, name, cp, city, failed. candidates: query_id, retry (0 raw name,
    1 cleaned name), pos, names (array, in order), cand_cp, cand_city, siret, naf. One
    join and one aggregation on query_id; the aggregation combines map-side.
    """
    q = queries.select("query_id", T.clean_name_registry(F.col("name")).alias("_q"), "name", "cp", "city")
    c = candidates.withColumn("names", F.filter("names", lambda n: T.text(n) != ""))
    tier = pool_tier(F.col("cp"), F.col("city"), F.col("cand_cp"), F.col("cand_city"))
    scored = (
        c.join(q, "query_id")
        .where((F.col("retry") == 0) | (F.col("name") != F.col("_q")))
        .select("query_id", "retry", tier.alias("tier"), "pos", "siret", "naf", "_q", F.posexplode_outer("names").alias("npos", "cname"))
        .withColumn("_c", T.clean_name_registry(F.col("cname")))
        .withColumn("_s", F.when(F.col("cname").isNull(), 0.0).otherwise(SIM.ratio(F.col("_q"), F.col("_c"))))
    )
    best = scored.groupBy("query_id").agg(
        F.min(F.struct("retry", "tier", (-F.col("_s")).alias("neg"), "pos", "npos", "siret", "naf")).alias("b")
    )
    s = -F.col("b.neg")
    pct = F.bround(s, 0).cast("int")
    found = s >= REGISTRY_THRESHOLD
    j = queries.join(best, "query_id", "left")
    empty = T.clean_name_registry(F.col("name")) == ""
    nothing = F.col("b").isNull() | (s <= 0)
    status = (
        F.when(empty, "Exclu — nom vide")
        .when(F.col("failed"), "Exclu — erreur API")
        .when(nothing, "Exclu — SIRET introuvable")
        .when(found, "SIRET trouvé")
        .otherwise(F.concat(F.lit("Exclu — similarité "), pct.cast("string"), F.lit(f"% < {REGISTRY_THRESHOLD}%")))
    )
    scored_ok = ~empty & ~F.col("failed") & ~nothing
    hit = scored_ok & found
    return j.select(
        *queries.columns,
        F.when(hit, T.normalize_siret(F.col("b.siret"))).otherwise("").alias("siret"),
        F.when(hit, T.text(F.col("b.naf"))).otherwise("").alias("naf"),
        F.when(scored_ok & (pct != 0), pct.cast("string")).otherwise("").alias("score"),
        status.alias("status"),
    )


def profile_best(queries: DataFrame, candidates: DataFrame, passes: list[bool]) -> DataFrame:
    """Best company profiles per query by name (half), postal code (30) and city (20), one for each pass.

    candidates: query_id, pos, names (array), cand_cp, cand_city, siret. A pass counts postal codes or
    not; one that does not is for queries with a postal code only. Names and cities are scored once for all passes. Result: query_id and, for pass k, a struct p<k> of found, score, status, siret,
    cand_name, cand_score (null if no candidate scores).
    """
    q = queries.select(
        "query_id", T.text(F.col("cp")).alias("_cp"), T.clean_name_profile(F.col("name")).alias("_ql"),
        T.token_sort(T.clean_name_profile(F.col("name"))).alias("_qt"),
        T.token_sort(T.clean_name_keywords(F.col("name"))).alias("_qa"),
        F.upper(T.strip_accents(F.col("city"))).alias("_qc"),
    )
    c = candidates.withColumn("names", F.filter("names", lambda n: T.text(n) != ""))
    e = (
        c.join(q, "query_id")
        .select(
            "query_id", "pos", "siret", T.strip(T.text(F.col("cand_cp"))).alias("_ccp"), "cand_cp", "_cp", "_ql", "_qt", "_qa", "_qc",
            F.upper(T.strip_accents(T.strip(T.text(F.col("cand_city"))))).alias("_cc"),
            F.posexplode_outer("names").alias("npos", "cname"),
        )
        .withColumn("_cl", T.clean_name_profile(F.col("cname")))
        .withColumn("_ct", T.token_sort(F.col("_cl")))
        .withColumn("_ca", T.token_sort(T.clean_name_keywords(F.col("cname"))))
    )
    name = F.greatest(
        SIM.ratio(F.col("_ql"), F.col("_cl")), SIM.ratio(F.col("_qt"), F.col("_ct")), SIM.ratio(F.col("_qa"), F.col("_ca"))
    )
    bonus_cp = F.when((F.col("_cp") != "") & (F.col("_cp") == F.col("_ccp")), 30).otherwise(0)
    bonus_city = F.when(
        (F.col("_qc") != "") & (F.col("_cc") != "") & (SIM.ratio(F.col("_qc"), F.col("_cc")) >= CITY_THRESHOLD), 20
    ).otherwise(0)
    e = e.withColumn("_name", F.when(F.col("cname").isNotNull(), name)).withColumn("_bonus", bonus_city).withColumn("_bonus_cp", bonus_cp)
    best = e.groupBy("query_id").agg(*[_best_scored(use_cp).alias(f"b{k}") for k, use_cp in enumerate(passes)], F.count_if(F.coalesce("npos", F.lit(0)) == 0).alias("n_candidates"))
    return best.select("query_id", *[_profile(F.col(f"b{k}")).alias(f"p{k}") for k in range(len(passes))])


def _best_scored(use_cp: bool) -> Column:
    cp, bonus = (F.col("_cp"), F.col("_bonus_cp") + F.col("_bonus")) if use_cp else (F.lit(""), F.col("_bonus"))
    score = F.when(F.col("cname").isNull(), 0).otherwise((0.5 * F.col("_name") + bonus).cast("int"))
    row = F.struct((-score).alias("neg"), "pos", (-F.col("_name")).alias("nneg"), "npos", "cname", "siret", "cand_cp", cp.alias("_cp"))
    return F.min(row if use_cp else F.when(F.col("_cp") != "", row))


def _profile(b: Column) -> Column:
    score = -b["neg"]
    single = (F.col("n_candidates") == 1) & (b["_cp"] != "") & (T.text(b["cand_cp"]) == b["_cp"])
    ok = score >= F.when(single, PROFILE_SINGLE).otherwise(PROFILE_LOW)
    status = F.when(score >= PROFILE_HIGH, "Trouvé par nom").otherwise("SIRET trouvé (confiance moyenne)")
    return F.when(score > 0, F.struct(
        ok.alias("found"), F.when(ok, score).otherwise(0).alias("score"),
        F.when(ok, status).otherwise("Non trouvé").alias("status"),
        F.when(ok, T.normalize_siret(b["siret"])).otherwise("").alias("siret"),
        T.text(b["cname"]).alias("cand_name"), score.alias("cand_score"),
    ))


def enrich_profiles(queries: DataFrame, companies: DataFrame, with_cp: DataFrame, without_cp: DataFrame) -> DataFrame:
    """Direct id, else name with postal code, else name alone; one result per query.

    queries: query_id, name, cp, city, siret. companies: siret (unique). The two candidate
    frames are the answers of the searches with and without a postal code; one frame given for both is scored once.
    """
    q = queries.withColumn("_siret", T.normalize_siret(F.col("siret"))).drop("siret")
    direct = q.where(F.col("_siret") != "").join(
        companies.select(T.normalize_siret(F.col("siret")).alias("_siret")).distinct(), "_siret", "left_semi"
    ).select("query_id", F.col("_siret").alias("siret"))
    todo = q.join(direct, "query_id", "left_anti")
    if without_cp is with_cp:
        both = profile_best(todo, with_cp, [True, False])
    else:
        second = profile_best(todo.where(T.text(F.col("cp")) != ""), without_cp, [False]).withColumnRenamed("p0", "p1")
        both = profile_best(todo, with_cp, [True]).join(second, "query_id", "full_outer")
    both = both.withColumnsRenamed({"p0": "a", "p1": "b"})
    is_d, is_a, is_b = F.col("d.siret").isNotNull(), F.coalesce("a.found", F.lit(False)), F.coalesce("b.found", F.lit(False))
    status_b = F.replace(F.col("b.status"), F.lit("Trouvé par nom"), F.lit("Trouvé par nom (sans CP)"))
    better_b = F.coalesce("b.cand_score", F.lit(0)) > F.coalesce("a.cand_score", F.lit(0))
    miss_name = F.when(better_b, F.col("b.cand_name")).otherwise(T.text(F.col("a.cand_name")))
    return (
        queries.select("query_id")
        .join(direct.select("query_id", F.struct("siret").alias("d")), "query_id", "left").join(both, "query_id", "left")
        .select(
            "query_id",
            F.when(is_d, F.col("d.siret")).when(is_a, F.col("a.siret")).when(is_b, F.col("b.siret")).otherwise("").alias("siret"),
            F.when(is_d, 100).when(is_a, F.col("a.score")).when(is_b, F.col("b.score")).otherwise(0).alias("score"),
            F.when(is_d, "SIRET trouvé (direct)").when(is_a, F.col("a.status")).when(is_b, status_b)
            .otherwise("Non trouvé").alias("status"),
            F.when(is_d, "").when(is_a, F.col("a.cand_name")).when(is_b, F.col("b.cand_name"))
            .otherwise(miss_name).alias("cand_name"),
        )
    )


def first_candidate_ids(rows: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without an id take that of the first candidate of their key, untested."""
    head = candidates.where(F.col("pos") == 0).groupBy(*keys).agg(
        F.min(F.struct(T.first_nonempty(F.col("siege_siret"), F.col("siret")).alias("s"))).alias("_c")
    )
    return rows.join(head, keys, "left").select(
        *[c for c in rows.columns if c != "siret"],
        T.first_nonempty(F.col("siret"), F.when(F.col("name") != "", F.col("_c.s"))).alias("siret"),
    )


def backfill_phones(leads: DataFrame, listings: DataFrame) -> DataFrame:
    """Leads without a phone take that of the most similar listing of their postal code.

    leads: lead_id, name, cp, phone, phone_source. listings: ord, cp_norm, name_clean, phone.
    The first listing per (postal code, name) stands for its copies, and an equal name needs
    no comparison; an existing phone is never touched.
    """
    key = T.token_sort(T.clean_name_link(F.col("name")))
    lack = leads.where(T.strip(F.col("phone")) == "").select(
        "lead_id", T.normalize_cp(F.col("cp")).alias("block"), key.alias("name_a")
    )
    pool = listings.where(F.col("cp_norm") != "").groupBy(
        F.col("cp_norm").alias("block"), T.token_sort(F.col("name_clean")).alias("name_b")
    ).agg(F.min(F.struct("ord", "phone")).alias("first"))
    pool = cut(spread(pool))
    wanted = cut(spread(lack.where("block <> '' AND name_a <> ''").select("block", "name_a").distinct()))
    same = wanted.join(pool.select("block", F.col("name_b").alias("name_a"), "first"), ["block", "name_a"])
    exact = same.select("block", "name_a", F.col("name_a").alias("name_b"), F.lit(100.0).alias("sim"))
    rest = cut(wanted.join(pool.select("block", F.col("name_b").alias("name_a")), ["block", "name_a"], "left_anti"))
    near = similar_between(
        rest.select("block", F.col("name_a").alias("name")), pool.select("block", F.col("name_b").alias("name")),
        BACKFILL_THRESHOLD, distinct=True,
    )
    pairs = exact.unionByName(near)
    best = pairs.join(pool, ["block", "name_b"]).groupBy("block", "name_a").agg(
        F.min(F.struct((-F.col("sim")).alias("neg"), "first")).alias("m")
    )
    won = lack.join(best, ["block", "name_a"]).select("lead_id", F.col("m.first.phone").alias("_p"))
    had = T.strip(F.col("phone")) != ""
    return leads.join(won, "lead_id", "left").select(
        *[c for c in leads.columns if c not in ("phone", "phone_source")],
        F.when(had, F.col("phone")).otherwise(F.coalesce("_p", F.col("phone"))).alias("phone"),
        F.when(~had & F.col("_p").isNotNull(), "PJ fallback nom+CP").otherwise(F.col("phone_source")).alias("phone_source"),
        F.when(had, "already").when(F.col("_p").isNotNull(), "added").otherwise("missing").alias("outcome"),
    )


def not_done(rows: DataFrame, progress: DataFrame) -> DataFrame:
    """Rows whose key is not in a progress table that may be far larger than the rows.

    The progress keys are first reduced to those among the rows, so a small batch costs a
    scan of the progress table and no shuffle of it.
    """
    keyed = rows.withColumn("_n", F.lower("name")).withColumn("_cp", F.col("cp"))
    here = keyed.select("_n", "_cp").distinct()
    seen = progress.select(F.lower("name").alias("_n"), F.col("cp").alias("_cp")).join(here, ["_n", "_cp"], "left_semi")
    return keyed.join(seen.distinct(), ["_n", "_cp"], "left_anti").select(*rows.columns)


def todo_and_done(rows: DataFrame, progress: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Resume: rows not processed yet, and rows answered by the progress table.

    The key is (lower name, postal code); the latest progress row of a key wins.
    """
    p = progress.groupBy(F.lower("name").alias("_n"), F.col("cp").alias("_cp")).agg(
        F.max(F.struct("seq", *[c for c in progress.columns if c not in ("seq", "name", "cp")])).alias("_last")
    )
    keyed = rows.withColumn("_n", F.lower("name")).withColumn("_cp", F.col("cp"))
    todo = keyed.join(p, ["_n", "_cp"], "left_anti").select(*rows.columns)
    got = [F.col(f"_last.{c}").alias(c) for c in progress.columns if c not in ("seq", "name", "cp")]
    done = keyed.join(p, ["_n", "_cp"]).select(*rows.columns, *got)
    return todo, done
