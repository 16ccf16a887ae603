"""Golden rows of the normalisers."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from leadlink.functions import text as T
from leadlink.operators import classify as C

CASES = {
    T.normalize_siret: [
        ("12345678901234.0", "12345678901234"), ("123", "00000000000123"), ("", ""), ("nan", ""), ("None", ""), (None, ""),
        ("12 345", "12 345"), ("123456789012345", "123456789012345"), ("inf", "inf"), ("12D", "12D"), ("1e3", "00000000001000"),
        ("-5", "-0000000000005"), (" 7 ", "00000000000007"), ("1.9", "00000000000001"), ("1e40", "1e40"),
    ],
    T.normalize_cp: [("1000", "01000"), ("F-31 000", "31000"), ("", ""), ("123456", "123456"), (None, "")],
    T.normalize_phone: [
        ("+33 5 00 00 00 01", "0500000001"), ("0033500000001", ""), ("+33 (0)5 00 00 00 01", ""), ("05.00.00.00.01", "0500000001"),
        ("33500000001", ""), ("", ""),
    ],
    T.validate_phone: [("05 00 00 00 01", "0500000001"), ("+33500000001", ""), ("0000000000", "")],
    T.phone_nine: [("+33500000001", "500000001"), ("0500000001", "500000001"), ("500000001", ""), ("3312345678", "")],
    T.strip_accents: [("Hôtel n° ½ œuvre", "Hotel n 12 uvre"), ("ﬁn Ⅳ 𝐀 é ™…", "fin IV A e TM..."), ("abc", "abc")],
    T.title_case: [("saint-denis l'isle ÉTÉ 1er", "Saint-Denis L'Isle Été 1Er"), ("ßa", "Ssa")],
    T.clean_name_link: [("Sarl  Le Café SA-SAS", "LE CAFE -"), ("SASA EI x", "SASA X"), ("sas", "")],
    T.clean_name_registry: [("Sàrl éSA SA b", "SÀRL ÉSA B")],
    T.clean_name_profile: [("Cabinet X SA", "X SA"), ("Sté Y", "Y")],
    T.clean_name_keywords: [("Boulangerie L'Été du Nord-Est SARL", "ete nord est")],
    T.token_sort: [("b  a\tc", "a b c"), ("", "")],
    T.normalize_naf: [("1071c", "10.71C"), ("10.71", "10.71"), ("107", "107"), (" 47.3 ", "47.3")],
    T.domain_slug: [("L'Art & Co é", "lart-et-co-")],
    T.percent_encode: [("a b/é*~", "a%20b/%C3%A9%2A~")],
    T.clean_city: [("Saint-Denis 93", "Saint-Denis")],
    T.department_in_city: [("Saint-Denis 93", "93"), ("Lyon 69", None)],
    T.city_slug: [("Boulogne-Billancourt 2", "boulogne_billancourt_2")],
    T.strip_phone_label: [("Tél : 01", "01"), ("Tel: 01", "01"), ("x Tel: 1", "x Tel: 1")],
}


@pytest.mark.parametrize("fn", list(CASES), ids=lambda f: f.__name__)
def test_normaliser(spark, fn):
    rows = [(i, x) for i, (x, _) in enumerate(CASES[fn])]
    got = spark.createDataFrame(rows, "i int, x string").select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == [w for _, w in CASES[fn]]


def one(spark, cols):
    return tuple(spark.range(1).select(*cols).collect()[0])


def test_addresses(spark):
    for full, want in [("1 rue X, 31000 Toulouse", ("1 rue X", "31000", "Toulouse")), ("no digits", ("no digits", "", "")), ("", ("", "", ""))]:
        d = T.parse_address(F.lit(full))
        assert one(spark, [d["street"], d["cp"], d["city"]]) == want
    d = T.cp_and_city_or(F.lit("nowhere"), F.lit("31"), F.lit("Muret"))
    assert one(spark, [d["cp"], d["city"]]) == ("31000", "Muret")


def test_long_cities_do_not_overflow(spark):
    run = "Saint-Denis l'Isle\u00a0été " * 20_000
    df = spark.range(1).select(F.lit(f"1 rue X 31000 \t{run}2 31000 Lyon").alias("a"))
    two = T.cp_and_city(F.col("a"))
    three = T.cp_and_city_or(F.replace(F.col("a"), F.lit("'"), F.lit("-")), F.lit("75"), F.lit("Muret"))
    got = df.select(two["cp"].alias("cp"), two["city"].alias("city"), three["cp"].alias("cp3"), three["city"].alias("city3")).first()
    titled = ("Saint-Denis L'Isle\u00a0Été " * 20_000).strip()
    assert tuple(got) == ("31000", titled, "31000", titled.replace("'", "-"))


def test_city_patterns_are_those_of_the_sql(spark):
    rng = random.Random(7)
    pieces = ["31000", "7500", "123456", " ", "\t", "\u00a0", "\u3000", "\x1c", "Lyon", "é", "ÿ", "×", "œ", "-", "'", ",", "]", "[", "\\", "_", "\n"]
    rows = [(k, "".join(rng.choices(pieces, k=rng.randint(0, 9)))) for k in range(4_000)]
    df = spark.createDataFrame(rows, "k int, a string")
    for now, sql in ((T.CITY, T.CP_CITY), (T.CITY_NO_QUOTE, T.CP_CITY_NO_QUOTE)):
        pairs = [(F.regexp_extract("a", now, g), F.regexp_extract("a", sql, g)) for g in (0, 1, 2)]
        assert df.where(reduce(lambda x, y: x | y, (a != b for a, b in pairs))).collect() == []
    assert df.where(F.regexp_extract("a", T.CITY, 0) != "").count() > 150


def test_first_invalid_phone_ends_the_search(spark):
    assert one(spark, [T.extract_phone(F.lit("abc"), F.lit("0500000001"))]) == ("",)
    assert one(spark, [T.extract_phone(F.lit(" "), F.lit("0500000001"))]) == ("0500000001",)


NAF = [
    ("10.71", "1071C", True), ("10.71", "10.71C", True), ("86.10Z", "8610Z", True), ("47.11", "4711D", True),
    ("10.71A", "10.71C", False), ("10.71", "4711D", False), ("47.3", "47.30Z", True), ("10.71", "", False),
]


def test_match_naf(spark):
    df = spark.createDataFrame(NAF, "p string, e string, want boolean")
    assert all(r.got == r.want for r in df.select("want", C.match_naf(F.col("p"), F.col("e")).alias("got")).collect())
    for p, e, want in NAF:
        if e:
            assert one(spark, [C.coherent(F.lit(e), [p])]) == (want,)
    assert one(spark, [C.coherent(F.lit(""), ["10.71"]), C.coherent(F.lit("x"), [])]) == (True, True)


def test_labels(spark):
    df = spark.createDataFrame([("10.71C",), ("1071C",), ("10.71",), ("10.99X",), ("01.11Z",)], "naf string")
    got = {r.naf: r.naf_label for r in C.with_label(df, spark).collect()}
    assert got["10.71C"] == got["1071C"] == "Boulangerie et boulangerie-pâtisserie"
    assert got["10.71"] == "Fabrication pain / pâtisserie fraîche" and got["10.99X"] == "Industrie alimentaire" and got["01.11Z"] == ""


def test_unresolved_code_is_reported(spark):
    df = spark.createDataFrame([("43.32A",), ("43.32",), ("43.32B",)], "naf string")
    got = {r.naf: (r.status, r.occupations) for r in C.expand_occupations(df, spark).collect()}
    assert got == {"43.32A": ("unresolved", []), "43.32": ("class", ["F1607"]), "43.32B": ("sub-class", ["F1607"])}


def test_brand_and_category(spark):
    df = spark.createDataFrame([("Saint-Paul", ""), ("Picard Surgelés", ""), ("Le Kebab", ""), ("kebabs", ""), ("x", "C.H.R.S"), ("chrs", "")], "name string, category string")
    got = [(r.brand, r.excluded) for r in C.tag_excluded_category(C.tag_excluded_brand(df)).collect()]
    assert got == [("paul", None), ("picard", None), ("kebab", None), (None, None), (None, None), (None, "Centres d'hébergement")]


def test_gate_is_strict(spark):
    rows = [("a", "47.11D")] * 4 + [("a", "10.71C")] + [("b", "47.11D")] * 5 + [("b", "10.71C"), ("b", "")]
    got = {r.s: (r.n, r.n_bad, r.breached) for r in C.naf_gate(spark.createDataFrame(rows, "s string, naf string"), ["10.71"], ["s"]).collect()}
    assert got == {"a": (5, 4, False), "b": (6, 5, True)}
