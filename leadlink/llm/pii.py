"""Format-preserving pseudonyms for personal data in texts, in DataFrame functions only.

Numbers and dates are found by pattern, validated, and moved by a keyed Feistel permutation inside their own format, so
equal values get equal pseudonyms in every document, different values stay different, and the result validates again:

* card numbers (13 to 19 digits, Luhn): all digits but the last are permuted, the check digit is computed anew;
* account numbers (IBAN, mod 97, as long as the country's are; of unlisted countries or lengths the longest run of groups
  that validates): the digits after the check digits are permuted, country and letters stay;
* phone numbers (+country code, or bracketed or separated groups of 3-3-4): the digits after the country code. Where a
  country has one length the number ends there, elsewhere before a blank that another value follows;
* social security numbers (AAA-GG-SSSS with possible area, group and serial): within the possible ones;
* IPv4 addresses: within all addresses;
* dates (1900 to 2099; Y-M-D, and D/M/Y or D.M.Y or, where only that is a date, M/D/Y): within the days of these years,
  so one day written in two ways stays one day.

Mail addresses are neither numbers nor dates: every letter and digit of theirs becomes a keyed one of its class, chosen by
the whole address in lower case, and the punctuation and top domain stay; equal addresses stay linked.

A Feistel network of eight rounds acts on two parts x < a and y < b of a value by turns x += F(y) mod a, y += F(x) mod b,
with F from SHA-256 of key, kind, round and part. It is invertible for whoever has the key. What doesn't validate is no
personal datum and stays, as does all other text.

Defined cases: a null text stays null, an empty one empty; repeated rows are treated alike; ids are copied, null or
not; extra columns are ignored. Very long texts are one row like any other, with one entry per match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlink.llm.common import table
from leadlink.llm.registry import query

#: A comma never joins two numbers; a point or hyphen after a digit may.
FREE = r"(?<![\w]|\d[.-])"
#: A domain has at most 127 labels; the bound also keeps the matcher from recursing without end.
MAIL = r"(?<![\w.%+-])[\w.%+-]++@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,}"
IP = FREE + r"(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"
CARD = FREE + r"(?:\d{13,19}|(?:\d{4}[ -]){3}\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w|-\d)"
SSN = FREE + r"\d{3}-\d{2}-\d{4}(?!\w|-\d)"
DATE = FREE + r"(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}[/.]\d{1,2}[/.]\d{4})(?!\w|[-/]\d)"
GROUPED = r"(?<!\w)\(\d{3}\) ?\d{3}-\d{4}(?!\w)|" + FREE + r"\d{3}[-.]\d{3}[-.]\d{4}(?!\w|[-.]\d)"

#: Characters of an account number by country (the IBAN registry).
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: Digits after the country code, where a country has one length only.
PHONE_SIZES = {10: "1 7 20 30 44 52 90 91 92", 9: "27 31 33 34 40 41 48 61 212 351 380 420", 8: "45 47 65 852"}


def _iban_of(size: int, countries: str) -> str:
    tail = f"(?: ?[A-Z0-9]{{{size % 4}}})" if size % 4 else ""
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{size // 4 - 1}}}{tail}"


OF_COUNTRY = FREE + "(?:" + "|".join(_iban_of(n, c) for n, c in IBAN_SIZES.items()) + r")(?!\w)"
#: A blank followed by one of these ends a number of unknown length: the next value begins there.
_OCTET, _DAY = r"(?:25[0-5]|2[0-4]\d|[01]?\d?\d)", r"(?:0?[1-9]|[12]\d|3[01])"
_IP = FREE + rf"(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.\d)"
_DATE = FREE + rf"(?:(?:19|20)\d\d-(?:0?[1-9]|1[0-2])-{_DAY}|{_DAY}[/.]{_DAY}[/.](?:19|20)\d\d)(?!\w|[-/]\d)"
#: Groups of four go to cards from the end of their run.
_FOURS = r"(?:\d{4}[ -]){3}\d{4}"
_CARD = FREE + rf"(?:\d{{13,19}}|{_FOURS}(?:[ -]{_FOURS})*+(?![ -]\d{{4}}(?!\d|[-/.]\d))|\d{{4}}[ -]\d{{6}}[ -]\d{{5}})(?!\w|-\d)"
NEXT = "(?:" + "|".join((MAIL, _IP, _DATE, SSN, GROUPED, _CARD, OF_COUNTRY, r"\+\d")) + ")"
IBAN = OF_COUNTRY + "|" + FREE + rf"[A-Z]{{2}}\d{{2}}(?:(?: (?!{NEXT}))?[A-Z0-9]{{4}}){{2,7}}(?:(?: (?!{NEXT}))?[A-Z0-9]{{1,3}})?(?!\w)"
_GROUPS = rf"[ .-]?\(?\d{{1,4}}\)?(?:(?:[ .-](?!{NEXT}))?\d{{2,4}}){{2,4}}(?!\w)"
_DIGIT = r"[ .()-]{0,3}\d"  # written out as often as it counts: Java wants to see how far a look-behind reaches
_SIZED = "|".join(rf"(?:{c.replace(' ', '|')})(?: ?\(0\))?{_DIGIT * n}" for n, c in PHONE_SIZES.items())
_CODES = "|".join(PHONE_SIZES.values()).replace(" ", "|")
PHONE = (
    rf"(?<![\w+])\+(?:{_CODES})(?: ?\(0\))?{_GROUPS}(?<=\+(?:{_SIZED}))|(?<![\w+])\+\d{{1,3}}{_GROUPS}(?<=\+{_DIGIT * 6}{f'(?:{_DIGIT})?' * 9})|" + GROUPED
)
#: Where two kinds begin at one place the first wins.
FOUND = "|".join(f"(?:{p})" for p in (MAIL, IP, DATE, SSN, PHONE, CARD, IBAN))

DAYS = 73049  # 1900-01-01 to 2099-12-31, 319 * 229
ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def _round(key: str, kind: str, number: Column, part: Column) -> Column:
    """A keyed number below 2^48."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), number, part), 256), 1, 12), 16, 10).cast("long")


def feistel(key: str, kind: str, x: Column, y: Column, a: Column, b: Column) -> Column:
    """Struct (x, y): the pair permuted within [0, a) x [0, b)."""
    begin = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s: Column, r: Column) -> Column:
        nx = F.when(r % 2 == 0, (s["x"] + _round(key, kind, r, s["y"])) % s["a"]).otherwise(s["x"])
        ny = F.when(r % 2 == 1, (s["y"] + _round(key, kind, r, s["x"])) % s["b"]).otherwise(s["y"])
        return F.struct(nx.alias("x"), ny.alias("y"), s["a"].alias("a"), s["b"].alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(7)), begin, step)


def permuted_digits(key: str, kind: str, digits: Column) -> Column:
    """A string of up to 36 digits permuted among the strings of its length."""
    n = F.length(digits)
    h = F.floor(n / 2).cast("int")
    left, right = digits.substr(F.lit(1), h).cast("long"), digits.substr(h + 1, n - h).cast("long")
    ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
    s = feistel(key, kind, F.coalesce(left, F.lit(0)), F.coalesce(right, F.lit(0)), ten(h), ten(n - h))
    pad = lambda v, k: F.lpad(v.cast("string"), k, "0")
    return F.concat(F.when(h > 0, pad(s["x"], h)).otherwise(F.lit("")), pad(s["y"], n - h))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _chars(text: Column) -> Column:
    return F.split(text, "")


def _refill(shape: Column, digits: Column) -> Column:
    """The text with its digits replaced in order."""
    done = F.aggregate(
        _chars(shape), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")),
        lambda s, c: F.struct(
            F.concat(s["out"], F.when(c.rlike(r"^\d$"), digits.substr(s["k"], F.lit(1))).otherwise(c)).alias("out"),
            (s["k"] + F.when(c.rlike(r"^\d$"), 1).otherwise(0)).alias("k"),
        ),
    )
    return done["out"]


def luhn_sum(digits: Column) -> Column:
    """Sum over a number whose last digit counts once, the one before twice, and so on."""
    each = F.transform(
        _chars(F.reverse(digits)),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2 % 10) + F.floor(c.cast("int") / 5).cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, d: a + d)


def _card(key: str, m: Column) -> Column:
    d = _digits(m)
    head = permuted_digits(key, "card", d.substr(F.lit(1), F.length(d) - 1))
    check = (10 - luhn_sum(F.concat(head, F.lit("0"))) % 10) % 10
    return F.when(luhn_sum(d) % 10 == 0, _refill(m, F.concat(head, check.cast("string"))))


def _mod97(text: Column) -> Column:
    """Letters count as 10 to 35."""
    return F.aggregate(
        _chars(text), F.lit(0),
        lambda a, c: F.when(c.rlike(r"^\d$"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )


def _iban(key: str, m: Column) -> Column:
    """The longest run of groups that validates; of a country's own length, or of any for the others."""
    parts = F.split(m, " ")
    runs = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), " "))
    tried = F.when(m.rlike(f"^(?:{OF_COUNTRY})$"), F.array(m)).otherwise(runs)

    def valid(t: Column) -> Column:
        plain = F.replace(t, F.lit(" "), F.lit(""))
        rest = plain.substr(F.lit(5), F.length(plain) - 4)
        return (F.length(plain) >= 12) & (F.length(_digits(rest)) >= 4) & (_mod97(F.concat(rest, plain.substr(1, 4))) == 1)

    def changed(t: Column) -> Column:
        plain = F.replace(t, F.lit(" "), F.lit(""))
        country, rest = plain.substr(1, 2), plain.substr(F.lit(5), F.length(plain) - 4)
        new = _refill(rest, permuted_digits(key, "iban", _digits(rest)))
        check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        full = F.concat(country, check, new)
        spaced = F.aggregate(
            _chars(t), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")),
            lambda s, c: F.struct(
                F.concat(s["out"], F.when(c == " ", c).otherwise(full.substr(s["k"], F.lit(1)))).alias("out"),
                (s["k"] + F.when(c == " ", 0).otherwise(1)).alias("k"),
            ),
        )["out"]
        return F.concat(spaced, m.substr(F.length(t) + 1, F.length(m)))

    return F.get(F.transform(F.slice(F.filter(tried, valid), 1, 1), changed), F.lit(0))


def _ip(key: str, m: Column) -> Column:
    o = F.split(m, r"\.")
    at = lambda k: F.get(o, F.lit(k)).cast("int")
    s = feistel(key, "ip", at(0) * 256 + at(1), at(2) * 256 + at(3), F.lit(65536), F.lit(65536))
    out = F.concat_ws(".", *[f(s[p]) for p in "xy" for f in (lambda v: F.floor(v / 256).cast("string"), lambda v: (v % 256).cast("string"))])
    return F.when(F.greatest(at(0), at(1), at(2), at(3)) <= 255, out)


def _ssn(key: str, m: Column) -> Column:
    p = F.split(m, "-")
    area, group, serial = (F.get(p, F.lit(k)).cast("int") for k in range(3))
    s = feistel(key, "ssn", F.when(area > 666, area - 2).otherwise(area - 1), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999))
    new = F.when(s["x"] >= 665, s["x"] + 2).otherwise(s["x"] + 1)
    pad = lambda v, k: F.lpad(v.cast("string"), k, "0")
    out = F.concat_ws("-", pad(new, 3), pad(F.floor(s["y"] / 9999) + 1, 2), pad(s["y"] % 9999 + 1, 4))
    return F.when((area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1), out)


def _phone(key: str, m: Column) -> Column:
    code = F.regexp_extract(m, r"^\+\d{1,3}(?=\D)", 0)
    rest = m.substr(F.length(code) + 1, F.length(m) - F.length(code))
    return F.concat(code, _refill(rest, permuted_digits(key, "phone", _digits(rest))))


def _date(key: str, m: Column) -> Column:
    sep = F.regexp_extract(m, r"\D", 0)
    p = F.split(m, r"\D")
    part = lambda k: F.get(p, F.lit(k))
    date = lambda y, mo, d: F.to_date(F.try_to_timestamp(F.concat_ws("-", y, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd")))
    ymd = sep == "-"
    day_first = date(part(2), part(1), part(0))
    day = F.when(ymd, date(part(0), part(1), part(2))).otherwise(F.coalesce(day_first, date(part(2), part(0), part(1))))
    order = F.datediff(day, F.lit("1900-01-01").cast("date"))
    s = feistel(key, "date", F.floor(order / 229), order % 229, F.lit(319), F.lit(229))
    new = F.date_add(F.lit("1900-01-01").cast("date"), (s["x"] * 229 + s["y"]).cast("int"))
    field = lambda v, like: F.when(F.length(like) == 2, F.lpad(v.cast("string"), 2, "0")).otherwise(v.cast("string"))
    y, mo, d = F.year(new).cast("string"), F.month(new), F.dayofmonth(new)
    first, second = F.when(day_first.isNull(), mo).otherwise(d), F.when(day_first.isNull(), d).otherwise(mo)
    out = F.when(ymd, F.concat_ws("-", y, field(mo, part(1)), field(d, part(2)))).otherwise(F.concat(field(first, part(0)), sep, field(second, part(1)), sep, y))
    return F.when((order >= 0) & (order < DAYS), out)


def _mail(key: str, m: Column) -> Column:
    whole = F.lower(m)
    last = F.length(m) - F.length(F.regexp_extract(m, r"\.[A-Za-z]+$", 0))

    def changed(c: Column, i: Column) -> Column:
        n = _round(key, "mail", i, whole)
        letter = F.substring(F.lit(ALPHABET), (n % 26 + 1).cast("int"), F.lit(1))
        return (
            F.when(i >= last, c).when(c.rlike(r"^\d$"), (n % 10).cast("string")).when(c.rlike(r"^\p{Lu}$"), F.upper(letter))
            .when(c.rlike(r"^[\p{L}_]$"), letter).otherwise(c)
        )

    return F.array_join(F.transform(_chars(m), changed), "")


def pseudonym(key: str, m: Column) -> Column:
    """The pseudonym of one match, null if it doesn't validate."""
    is_ = lambda p: m.rlike(f"^(?:{p})$")
    return (
        F.when(F.contains(m, F.lit("@")), _mail(key, m)).when(is_(IP), _ip(key, m)).when(is_(DATE), _date(key, m))
        .when(is_(SSN), _ssn(key, m)).when(F.startswith(m, F.lit("+")) | is_(PHONE), _phone(key, m)).when(is_(CARD), _card(key, m)).otherwise(_iban(key, m))
    )


def mask(docs: DataFrame, key: str = "leadlink", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_masked): whole texts with pseudonyms, and how many were put in."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Every kind has a digit or an @, most texts have neither.
    some = F.col("text").rlike("[0-9@]")
    rows = rows.withColumn("found", F.when(some, F.regexp_extract_all("text", F.lit(FOUND), F.lit(0))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("new", F.when(F.size("found") > 0, F.transform("found", lambda m: pseudonym(key, m))))
    between = F.split("text", FOUND, -1)
    put = F.zip_with("found", "new", lambda m, n: F.coalesce(n, m))
    text = F.when(F.size("found") > 0, F.array_join(F.zip_with(between, put, lambda b, p: F.concat(b, F.coalesce(p, F.lit("")))), "")).otherwise(F.col("text"))
    count = F.when(F.size("found") > 0, F.size(F.filter("new", lambda n: n.isNotNull()))).otherwise(0)
    return rows.select(F.col("id").alias(id_col), text.alias(text_col), count.alias("n_masked"))


@query("op3_pii")
def op3_pii(spark, sf_dir):
    return mask(table(spark, sf_dir, "documents"))
