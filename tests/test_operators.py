"""Relational traps of the keyed, merge, resolve, source and streaming operators."""

import pyarrow as pa
import pyspark.sql.functions as F
import pytest

from leadlink.operators import geo, keyed, merge, resolve
from leadlink.plans.catalog import QUERIES
from leadlink.sinks import files as sink
from leadlink.sources import files, html_listing as H, json_responses as J
from leadlink.streaming import jobs
from leadlink.session import fresh_path

SIGNAL = "siret string, ord bigint, name string, naf string, address string, city string, cp string, phone string, search_city string, collected_on string"


def signal(siret, ord, phone="", name="n"):
    return (siret, ord, name, "", "", "", "", phone, "Lyon", "d")


def test_live_row_wins_when_loading(spark):
    rows = [("1", "LBB", 0), ("1", "LBA", 1), ("1", "LBA", 2), ("2", "LBB", 3), ("2", "LBB", 4), ("", "LBA", 5)]
    got = {r.siret: r.ord for r in keyed.load_signals(spark.createDataFrame(rows, "siret string, source string, ord bigint")).collect()}
    assert got == {"00000000000001": 1, "00000000000002": 3}


def test_merge_signals(spark):
    live = spark.createDataFrame([signal("a", 0), signal("a", 1, "0400000001"), signal("b", 2, "x")], SIGNAL).withColumn("offers", F.lit(1))
    pot = spark.createDataFrame([(*signal("a", 0, "0200000002"), ""), (*signal("a", 1), "7"), (*signal("c", 2), "")], SIGNAL + ", lbb_score string")
    got = {r.siret: (r.source, r.offers, r.phone, r.lbb_score, r.was_duplicate) for r in merge.merge_signals(live, pot).collect()}
    assert got == {"a": ("LBA + LBB", 2, "0200000002", "7", True), "b": ("LBA", 1, "x", "", False), "c": ("LBB", None, "", "", False)}


def test_cross_labels_and_row_count(spark):
    cols = "siret string, name string, naf string, address string, city string, cp string, phone string, website string"
    listings = spark.createDataFrame([("1", "L", "", "", "", "", "", "w"), ("2", "L", "", "", "", "", "0100000000", ""), ("3", "L", "", "", "", "", "", "")], cols)
    cols = "siret string, source string, name string, naf string, address string, city string, cp string, phone string, lbb_score string, offers bigint"
    signals = spark.createDataFrame(
        [("1", "LBB", "S", "", "", "", "", "02", "5", None), ("2", "LBA + LBB", "S", "n", "", "", "", "03", "", 2), ("4", "LBA", "S", "", "", "", "", "04", "", 1)], cols)
    got = {r.siret: (r.name, r.priority, r.source, r.phone_source, r.offers) for r in merge.cross_and_score(listings, signals, "d").collect()}
    assert got == {
        "1": ("L", "Moyenne", "PJ + LBB", "LBB", ""), "2": ("L", "Haute", "PJ + LBA + LBB", "PJ direct", "2"),
        "3": ("L", "Basse", "Pages Jaunes", "", ""), "4": ("S", "Haute", "LBA", "LBA", "1"),
    }


def test_mixed_key(spark):
    rows = [(0, "A", "N", "P"), (1, "", "n", "P"), (2, "B", "N", "P"), (3, "A", "X", "P"), (4, "", "x", "P"), (5, "", "x", "P")]
    df = spark.createDataFrame(rows, "ord bigint, siret string, name string, cp string")
    assert sorted(r.ord for r in keyed.first_per_mixed_key(df, []).collect()) == [0, 2, 4]


def test_blank_ids_are_kept(spark):
    df = spark.createDataFrame([(0, "A"), (1, "A"), (2, ""), (3, "")], "ord bigint, siret string")
    assert sorted(r.ord for r in keyed.first_per_siret_keep_blank(df, ["ord"]).collect()) == [0, 2, 3]


def test_first_wins_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ord"))
    plan = keyed.first_per_key(df, ["k"], ["ord"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_backfill(spark):
    leads = spark.createDataFrame(
        [(1, "Boulangerie Martin", "69003", "", ""), (2, "Autre Chose", "69003", "", ""), (3, "Boulangerie Martin", "69007", "", ""),
         (4, "Boulangerie Martin", "69003", "09", "LBA"), (5, "", "69003", "", "")],
        "lead_id bigint, name string, cp string, phone string, phone_source string")
    pool = keyed.load_phone_listings(spark.createDataFrame(
        [(0, "SARL Martin Boulangerie", "69003", "0411111111"), (1, "Boulangerie Martin", "69003", "0422222222"), (2, "", "69003", "0433333333")],
        "ord bigint, name string, cp string, phone string"))
    got = {r.lead_id: (r.phone, r.phone_source, r.outcome) for r in resolve.backfill_phones(leads, pool).collect()}
    assert got[1] == ("0411111111", "PJ fallback nom+CP", "added") and got[4] == ("09", "LBA", "already")
    assert all(got[i][2] == "missing" for i in (2, 3, 5))


def test_registry_statuses(spark):
    q = spark.createDataFrame(
        [(1, "Le Four", "1", "", False), (2, "SARL", "1", "", False), (3, "X", "1", "", True), (4, "Zzz", "1", "", False), (5, "Le Four", "9", "lyon", False)],
        "query_id bigint, name string, cp string, city string, failed boolean")
    c = spark.createDataFrame(
        [(1, 0, 0, ["Le Four"], "2", "", "11", "n"), (1, 0, 1, ["", "Le Fou"], "1", "", "12", "n"), (4, 0, 0, ["abc"], "1", "", "13", "n"),
         (5, 1, 0, ["LE FOUR"], "3", "Lyon 3", "14", "n"), (5, 0, 0, ["Rien"], "3", "Paris", "15", "n")],
        "query_id bigint, retry int, pos int, names array<string>, cand_cp string, cand_city string, siret string, naf string")
    got = {r.query_id: (r.siret, r.score, r.status) for r in resolve.resolve_registry(q, c).collect()}
    assert got[1] == ("00000000000012", "92", "SIRET trouvé")
    assert got[2][2] == "Exclu — nom vide" and got[3][2] == "Exclu — erreur API" and got[4][2] == "Exclu — SIRET introuvable"
    assert got[5][0] == "" and got[5][2].startswith("Exclu — similarité")


def test_radius_falls_back_to_one_km(spark):
    rows = spark.createDataFrame([("a", 45.0, 3.005), ("a", 45.0, 3.5), ("b", 45.0, 3.0), ("b", 45.0, 3.005)], "city string, lat double, lon double")
    centres = spark.createDataFrame([("a", 45.0, 3.0, 0), ("b", 45.0, 3.0, 0)], "city string, clat double, clon double, radius_km int")
    assert sorted((r.city, r.lon) for r in geo.within_radius(rows, centres).collect()) == [("a", 3.005), ("b", 3.0)]


def test_directory_layout(spark):
    html = """<ul><li class="bi-item"><div class="bi-content"><a class="bi-denomination" href="/pros/1"><h3> Chez &amp; Co </h3></a>
      <div class="bi-address">1 rue X 31000 saint-jean</div><span class="number-contact">Tél : abc</span>
      <a href="tel:0561000000">x</a><a class="site" href="https://chez.example.com">s</a><p class="bi-activite">Boulangerie</p></div></li>
      <li class="bi-item"><div class="bi-content"><a class="bi-denomination"><h3></h3></a></div></li></ul>"""
    layout = H.Layout(**{**H.DIRECTORY.__dict__, "base_url": "https://d.example.org", "own_domain": "d.example.org"})
    got = H.listings(spark.createDataFrame([(1, "u", html), (2, "u", "<p>nothing</p>")], "page_id bigint, url string, html string"), layout).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.name, r.listing_url, r.phone, r.website, r.category, r.cp, r.city) == (
        "Chez & Co", "https://d.example.org/pros/1", "0561000000", "https://chez.example.com", "Boulangerie", "31000", "Saint-Jean")


def test_missing_arrays_are_empty(spark):
    df = spark.createDataFrame([(1, '{"jobs": null}'), (2, "not json"), (3, '{"recruiters":[{"company":{"siret":"5"}}]}')], "k bigint, body string")
    live, pot = J.signals(J.parse(df, "body", J.SIGNALS_SCHEMA), ["k"])
    assert live.count() == 0 and [(r.k, r.siret) for r in pot.collect()] == [(3, "00000000000005")]


def test_csv_keeps_leading_zeros_and_quotes(spark):
    path = fresh_path(spark, "t")
    rows = [("007", 'a "b", c', ""), ("01000", "line\nbreak", "x"), (" 2 ", " ", "x")]
    sink.write_csv(spark.createDataFrame(rows, "cp string, name string, z string"), path, ["cp", "name", "missing"])
    got = sorted((r.cp, r.name, r.missing) for r in files.read_csv(spark, path, ["cp", "name", "missing"]).collect())
    assert got == sorted((a, b, "") for a, b, _ in rows)


def test_byte_order_mark_in_a_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("SIRET,Nom\n007,x\n", encoding="utf-8-sig")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path), ["siret", "name"]).collect()] == [("007", "x")]


def test_not_done(spark):
    rows = spark.createDataFrame([("A", "1"), ("b", "1"), ("A", "2")], "name string, cp string")
    progress = spark.createDataFrame([("a", "1", 0), ("zz", "9", 0)], "name string, cp string, seq int")
    assert sorted(map(tuple, resolve.not_done(rows, progress).collect())) == [("A", "2"), ("b", "1")]


def test_numbering_across_slices(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"))
    got = {(r.g, r.o): r.progress for r in files.numbered(df, ["g"], ["o"]).collect()}
    assert all(got[(i % 2, i)] == f"[{i // 2 + 1}/250]" for i in range(500))


def test_filters_gate_and_merge_in_one_job(spark):
    """Coverage of a whole job on a small fixture: brand and code filters, donors, both dedup stages."""
    from leadlink.operators import flows

    cols = "ord bigint, siret string, name string, naf string, address string, city string, cp string, phone string, website string"
    listings = spark.createDataFrame(
        [(0, "1", "SARL Le Four", "10.71C", "", "Lyon", "69003", "", "w"), (1, "2", "Lidl", "10.71C", "", "", "69003", "0400000009", ""),
         (2, "3", "Garage", "45.20A", "", "", "69003", "0400000003", ""), (3, "", "Four Le", "", "", "", "69003", "0400000001", ""),
         (4, "5", "Le Four", "10.71C", "2 rue", "", "69004", "0400000001", "")], cols)
    signals = spark.createDataFrame(
        [("1", "LBA", 0, "Le Four", "10.71C", "", "", "", "", "", 1), ("6", "LBB", 1, "Patisserie Dupond", "", "", "", "75001", "", "3", None),
         ("7", "LBB", 2, "Patisserie Dupont", "", "9 rue", "", "75002", "", "4", None)],
        "siret string, source string, ord bigint, name string, naf string, address string, city string, cp string, phone string, lbb_score string, offers bigint")
    got = flows.qualify_leads(listings, signals, ["10.71"], "MBT", "2026-02-23").collect()
    rows = {r.siret.lstrip("0"): r for r in got}
    assert list(rows) == ["1", "7"]
    assert rows["1"].phone == "0400000001" and rows["1"].phone_source == "PJ fallback nom+CP"
    assert rows["1"].address == "2 rue" and rows["1"].priority == "Haute" and rows["1"].source == "PJ + LBA"
    assert rows["7"].lbb_score == "4" and rows["7"].address == "9 rue"


def test_stream_resume_skips_answered_keys(spark):
    src, progress = fresh_path(spark, "in"), fresh_path(spark, "progress")
    schema = "name string, cp string, answer string, seq bigint"
    spark.createDataFrame([("A", "1"), ("b", "1")], "name string, cp string").write.parquet(src)
    run = lambda ckpt: jobs.resume_job(
        jobs.file_stream(spark, src, "*.parquet", "name string, cp string"), lambda d: d.withColumn("answer", F.lit("done")), progress, schema, ckpt
    ).awaitTermination()
    ckpt = fresh_path(spark, "c")
    run(ckpt)
    spark.createDataFrame([("a", "1"), ("c", "1")], "name string, cp string").write.mode("append").parquet(src)
    run(ckpt)
    assert sorted(r.name for r in spark.read.schema(schema).parquet(progress).collect()) == ["A", "b", "c"]


def test_every_line_is_a_candidate(spark, sf):
    from leadlink.plans import q_resolve

    _, candidates = q_resolve.searches(spark, sf)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert candidates.count() == lines == candidates.select("query_id", "pos").distinct().count()


def test_batch_numbers_beyond_int(spark):
    folders = spark.createDataFrame([("s", "batch_3000000000"), ("s", "batch_2"), ("t", "batch_99999999999999999999"), ("u", "x")], "sector string, folder string")
    got = {r.sector: int(r.next_batch) for r in files.next_batch(folders, ["sector"]).collect()}
    assert got == {"s": 3000000001, "t": 100000000000000000000, "u": 1}


def found(spark, html, blocks, *picks):
    pages = spark.createDataFrame([(html,)], "html string")
    return [r.name for r in H.blocks(pages, H.Layout(blocks=[[blocks]], name=list(picks))).orderBy("block_pos").collect()]


def test_page_blocks_and_texts(spark):
    """Nested blocks, left-out and stray end tags, hidden and void elements, entities, line breaks."""
    html = """<body><div class="a bi-bloc"><div>one<div>two</div></div> three &eacute;&#8217;<br>four
      <script>var x = "</div><li>no";</script><!-- <li>no --><ul><li>p<li>q</ul><p>r<p>s <b>t</b></div><div id=z>u</div></body>"""
    any_div = H.has("class", "bloc")
    assert found(spark, html, H.tag("body"), H.first(any_div)) == [["one\ntwo\nthree é’\nfour\np\nq\nr\ns t"]]
    assert found(spark, html, H.tag("li"), H.first(H.tag("b"))) == [[None], [None]]
    assert found(spark, html, H.tag("ul"), H.first(H.tag("li"))) == [["p"]]
    assert found(spark, html, any_div, H.first((H.tag("p"), H.tag("b"))), H.first((H.tag("ul"), H.tag("b")))) == [["t", None]]
    assert found(spark, "</p><div><b>open", H.tag("div"), H.first(H.tag("b"))) == [["open"]]
    assert found(spark, "", H.tag("div"), H.first(H.tag("b"))) == [] and found(spark, None, H.tag("div"), H.first(H.tag("b"))) == []
    assert found(spark, "1 < 2 <div>a < b</div>", H.tag("div"), H.first((H.tag("div"), H.tag("i")))) == [[None]]


def test_page_attributes(spark):
    html = """<div><a title="> class='no' href=x" HREF = '/a&amp;b' class='x  y'>k</a><a data-bi-name href=/plain>l</a><a class=url>m</a><br/><i/>n</div>"""
    pick = lambda test, **more: H.first(H.both(H.tag("a"), test), **more)
    got = found(
        spark, html, H.tag("div"), pick(H.word("y"), take="href"), pick(H.has("class", "no")), pick(H.given("data-bi-name"), take="href"),
        pick(H.starts("href", "/pl")), pick(H.word("url"), take="href"), pick(H.word("url"), take="href", or_text=True), pick(H.has("class", "x  y"), take="href", or_text=True),
    )
    assert got == [["/a&b", None, "/plain", "l", "", "m", "/a&b"]]


def test_blocks_that_hold_and_places_around(spark):
    html = """<li class=out><p><span class=in>1</span><li>2</li><div class="bi-bloc x"><section>s</section><b class=btn>far</b></div><h1>h<i class=btn>near</i></h1>"""
    assert found(spark, html, H.Holds(H.tag("li"), H.word("in")), H.first(H.tag("span"))) == [["1"]]
    assert found(spark, html, H.tag("section"), H.beside(H.word("btn"), "next", H.has("class", "bi-bloc"), "parent")) == [["far"]]
    assert found(spark, html, H.word("x"), H.beside(H.word("btn"), "next", H.has("class", "bi-bloc"), "parent")) == [["near"]]
    assert found(spark, "<b class=btn>page</b><p>x</p>", H.tag("p"), H.beside(H.word("btn"), "next", "parent")) == [["page"]]


def test_hostile_pages(spark):
    """Deep nesting, endless attributes, open quotes, comments and scripts without an end, a very long text."""
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert found(spark, f"<main>{deep}</main>", H.tag("main"), H.first(H.tag("div"))) == [["x"]]
    many = "<p " + " ".join(f"a{k}='{k}'" for k in range(20_000)) + " class=c>y</p>"
    assert found(spark, f"<main>{many}</main>", H.tag("main"), H.first(H.word("c"))) == [["y"]]
    for end in ("<!-- open", "<script>open", "<a title='open", "<", "<p"):
        assert found(spark, f"<main><b>z</b>{end}", H.tag("main"), H.first(H.tag("b"))) == [["z"]]
    long = "word " * 200_000
    assert found(spark, f"<main><b>{long}</b></main>", H.tag("main"), H.first(H.tag("b"))) == [[long.strip()]]


def test_first_element_decides_in_the_older_layout(spark):
    html = "<article class='bi-bloc'><h2><a>first</a></h2><i class='denomination'>second</i><span class='tel'></span><a href='tel:0561'>x</a></article>"
    pages = spark.createDataFrame([(1, html, "t", "k", "31", "Toulouse")], "page_id long, html string, training string, keyword string, dept string, city string")
    r = H.old_listings(pages, H.OLD_DIRECTORY).first()
    assert (r.name, r.phone, r.website, r.cp) == ("first", "", "", "31000")


def test_files_start_with_a_byte_order_mark(spark, tmp_path):
    import glob

    sink.write_csv(spark.createDataFrame([("007", "é")], "siret string, name string"), f"{tmp_path}/o", ["siret", "name"])
    raw = [open(p, "rb").read() for p in glob.glob(f"{tmp_path}/o/part-*.csv")]
    assert raw and all(x.startswith(b"\xef\xbb\xbfsiret,name\n") for x in raw)


def test_chained_stages(spark):
    """By id, then by phone and name, then by department and name, each on what the one before left."""
    from leadlink.operators import flows

    cols = ["siret", "name", "phone", "cp", "priority", "website"]
    rows = [
        (1, "11111111111111", "Boulangerie Dupont", "", "31000", "Haute", ""), (2, "11111111111111", "Boulangerie Dupont", "0561000000", "31000", "Basse", ""),
        (3, "22222222222222", "Boulangeries Dupont", "0561000000", "31000", "Basse", "http://w"), (4, "33333333333333", "Boulangerie Duponte", "", "31500", "Basse", ""),
        (5, "", "Autre Nom", "0561000000", "31000", "Basse", ""), (6, "", "Boulangerie Dupont", "", "75001", "Basse", ""),
    ]
    leads = spark.createDataFrame(rows, "ord long, " + ", ".join(f"{c} string" for c in cols))
    out, report = flows.dedup_stages(leads, cols)
    assert [tuple(r) for r in report.collect()] == [("siret", 1, 5), ("phone", 1, 4), ("name", 1, 3), ("total", 3, 3)]
    best = {r.ord: r for r in out.collect()}
    assert set(best) == {3, 5, 6} and best[3].website == "http://w" and best[3].phone == "0561000000"


def test_profiles_of_one_search_are_scored_once(spark):
    """Both passes from one scoring give what two searches with the same answers give."""
    queries = spark.createDataFrame(
        [(1, "Boulangerie Martin", "75001", "Lyon", ""), (2, "Garage du Nord", "", "Lyon", ""), (3, "Le Fournil", "69001", "", ""), (4, "Direct", "1", "", "7"),
         (5, "Twice", "", "Lyon", ""), (5, "Twice Again", "31000", "Lyon", ""), (6, None, None, None, None)],
        "query_id long, name string, cp string, city string, siret string")
    found = spark.createDataFrame(
        [(1, 0, ["Martin"], "75001", "Paris", "11"), (1, 1, ["Boulangerie Martin", "BM"], "69001", "Lyon", "12"), (2, 0, ["Garage Nord"], "", "Lyon", "21"),
         (3, 0, [None, "Fournil Le"], "69001", None, "31"), (5, 0, ["Twice"], "31000", "Lyon", "51"), (5, 1, ["Twice Again"], "", "Lyon", "52"), (6, 0, ["x"], None, None, "61")],
        "query_id long, pos int, names array<string>, cand_cp string, cand_city string, siret string")
    companies = spark.createDataFrame([("7",)], "siret string")
    once = resolve.enrich_profiles(queries, companies, found, found)
    twice = resolve.enrich_profiles(queries, companies, found, found.select("*"))
    assert sorted(once.collect()) == sorted(twice.collect())
    nodes = [d._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") for d in (once, twice)]
    assert 2 * nodes[0] == nodes[1] > 0


def test_page_helpers_run_once_and_on_few_rows(spark):
    page = "<ul>" + "".join(f"<li class='bi-content'><article class='bi-bloc'><div class='bi-denomination'><h3>N&amp;{k}</h3></div></article></li>" for k in range(3)) + "</ul>"
    pages = spark.createDataFrame([(k, page) for k in range(200)], "page_id long, html string")
    rows = H.listings(pages, H.DIRECTORY)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 2
    assert sorted({(r.block_pos, r.name) for r in rows.collect()}) == [(0, "N&0"), (1, "N&1"), (2, "N&2")]
    at_once = []
    values = pa.array([["a"], None, ["b"]] * 100, pa.list_(pa.string()))
    few = type("Few", (), {"__len__": lambda self: len(values), "slice": lambda self, k, n: at_once.append(n) or values.slice(k, n)})()
    assert H._sliced(lambda v: v, few, values.type).equals(values)
    assert max(at_once) <= 64


@pytest.mark.parametrize("name", ["html_old_layout", "sector_workbook"])
def test_pages_with_long_paragraphs(spark, tmp_path, name):
    city = "word and été " * 20_000
    page = lambda h, p: f"<title>{h}</title><article><h1>{h}</h1><p>{p}</p><a href='http://w.example.com'>w</a></article>"
    rows = [(4, "http://a.example.fr/1", page("A", f"1 rue X 31000 {city}")), (9, "http://a.example.fr/2", page("B", "2 rue X 64100 bayonne")), (6, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.name, r.cp, r.city) for r in QUERIES[name](spark, str(tmp_path)).collect()}
    assert got == {4: ("A", "31000", ("Word And Été " * 20_000).strip()), 9: ("B", "64100", "Bayonne")}
