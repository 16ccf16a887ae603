"""Listing blocks and fields out of stored HTML pages, as column expressions.

A page is cut into tags and texts by one pattern. A small helper, the only Python on the way in, tells for every tag which
element it lies in and where its own element ends (left-out end tags, stray ones, void elements). Everything else is array
expressions on the page's row: elements with the attributes that selectors need, elements that match each selector, blocks,
and for every block and selector the first match between the block's start and end. Whole pages, tags nested to any depth.

A selector lists alternatives; an alternative is a chain of tests from an outer element to the element itself. Tests read
attributes as written; entities are decoded in what is picked. `take` names an attribute, else the rendered text is picked.
"""

from __future__ import annotations

import html as entities
import sys
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from leadlink.functions import text as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTS = ["name", "link", "address", "phone", "website", "category"]

# --- selectors ---------------------------------------------------------------------

Test = Callable[[Column], Column]
#: Attributes that selectors may test or take.
ATTRIBUTES = ["class", "href", "data-pjlb", "data-bi-name"]


def tag(name: str) -> Test:
    return lambda e: e["tag"] == name


def word(name: str) -> Test:
    """One of the element's classes."""
    return lambda e: F.array_contains(F.split(e["class"], r"\s+"), name)


def has(attribute: str, value: str) -> Test:
    return lambda e: F.contains(e[attribute], F.lit(value))


def starts(attribute: str, value: str) -> Test:
    return lambda e: F.startswith(e[attribute], F.lit(value))


def given(attribute: str) -> Test:
    return lambda e: e[attribute].isNotNull()


def both(*tests: Test) -> Test:
    return lambda e: reduce(lambda a, b: a & b, (t(e) for t in tests))


@dataclass(frozen=True)
class Holds:
    """An element that holds another one."""

    outer: Test
    inner: Test


@dataclass
class Pick:
    """The value of the first element of a block that one of the alternatives matches.

    `around` are further places to look, each only if the ones before have no match: "next" sibling, "parent", or the
    closest element, the block included, that a test matches.
    """

    alternatives: list
    take: str = ""
    or_text: bool = False
    around: list = field(default_factory=list)


def first(*alternatives, take: str = "", or_text: bool = False) -> Pick:
    return Pick(list(alternatives), take, or_text)


def beside(alternative, *around) -> Pick:
    return Pick([alternative], around=list(around))


@dataclass
class Layout:
    """Selectors of one page layout, tried in order for every field; one alone means that the first element decides."""

    blocks: list[list]
    name: list[Pick]
    link: list[Pick] = field(default_factory=list)
    address: list[Pick] = field(default_factory=list)
    phone: list[Pick] = field(default_factory=list)
    website: list[Pick] = field(default_factory=list)
    category: list[Pick] = field(default_factory=list)
    base_url: str = ""
    own_domain: str = ""


# The selectors of the two directory layouts.
BLOC = [both(tag("article"), word("bi-bloc")), both(tag("div"), has("class", "bi-bloc")), both(tag("li"), has("class", "bi-bloc"))]
DIRECTORY = Layout(
    blocks=[[Holds(tag("li"), word("bi-content"))], BLOC, [given("data-bi-name")]],
    name=[first((has("class", "bi-denomination"), tag("h3")))],
    link=[first(both(tag("a"), has("class", "bi-denomination")), take="href"), first(both(tag("a"), has("href", "/pros/")), take="href")],
    address=[first(word("bi-address"))],
    phone=[
        first((word("bi-fantomas"), word("number-contact"))), first(has("class", "number-contact")), first(has("class", "phone-number")),
        first((word("bi-fantomas"), has("class", "phone"))), first((word("bi-fantomas"), has("class", "tel"))),
        first(both(tag("a"), starts("href", "tel:")), take="href"), beside(has("class", "btn_tel"), "next", has("class", "bi-bloc"), "parent"),
    ],
    website=[
        first(both(tag("a"), has("class", "site-internet")), take="href"), first(both(tag("a"), has("class", "bi-website")), take="href"),
        first(both(tag("a"), has("class", "site")), take="href"), first(both(tag("a"), has("class", "web")), take="href"),
        first(both(tag("a"), has("href", "http"), has("class", "url")), take="href"), first(both(tag("a"), has("data-pjlb", "site")), take="href"),
        first(both(tag("a"), has("data-pjlb", "web")), take="href"), first((has("class", "website"), tag("a")), take="href"),
    ],
    category=[first(has("class", c)) for c in ("bi-activite", "activite", "rubrique", "category", "metier")],
)
OLD_DIRECTORY = Layout(
    blocks=[BLOC, [given("data-bi-name")]],
    name=[first(both(tag("a"), word("bi-denomination")), both(tag("span"), word("bi-denomination")), has("class", "denomination"), (tag("h3"), tag("a")), (tag("h2"), tag("a")))],
    address=[first(has("class", "adresse"), tag("address"), has("class", "address"), word("bi-adresse"))],
    phone=[first(has("class", "tel"), has("class", "phone"), both(tag("a"), starts("href", "tel:")), take="href", or_text=True)],
    website=[first(both(tag("a"), has("class", "site")), both(tag("a"), has("class", "web")), both(tag("a"), has("href", "http"), has("class", "url")), take="href")],
)

# --- tags --------------------------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that start a line of their own in rendered text.
LINES = frozenset("address article aside blockquote dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p section table tr ul".split())
#: Elements whose content is neither rendered nor searched.
HIDDEN = ("script", "style", "template")
#: An element whose end tag may be left out ends where one of these begins; not beyond the nearest of BOUNDS.
IMPLIED = {"li": {"li"}, "p": LINES, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
BOUNDS = frozenset(("ul", "ol", "table", "div", "article", "section"))

#: Comments, hidden elements whole, other declarations, tags (quoted values may hold anything), texts. No part can run
#: into recursion: every repetition is of single characters or possessive.
TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b[^>]*+>.*?(?:</\1\s*+>|\z)|<[!?][^>]*+>"
    r"|</?[a-z][^\"'>]*+(?:(?:\"[^\"]*+\"|'[^']*+')[^\"'>]*+)*+>|[^<]++|<"
)
ATTRIBUTE = r"[^\s\"'>/=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+"


#: So many rows at once are Python objects; what is around them stays Arrow.
SLICE = 64


def _sliced(of: Callable, values: pa.Array, kind: pa.DataType) -> pa.Array:
    """`of` applied to every value, few of them as Python objects at a time."""
    few = [pa.array([of(v) for v in values.slice(k, SLICE).to_pylist()], kind) for k in range(0, len(values), SLICE)]
    return pa.concat_arrays(few) if few else pa.array([], kind)


@F.arrow_udf(ArrayType(IntegerType()))
def nesting(pages: pa.Array) -> pa.Array:
    """Of each page's tags ("li", "/li", "li/" if closed at once, "" for text): the number of the tag around it, -1 if it
    opens nothing, followed by where its element ends (exclusive)."""

    def of(names) -> list[int]:
        around, end, open_ = [-1] * len(names), [0] * len(names), []

        def close(k: int, at: int) -> None:
            while len(open_) > k:
                end[open_.pop() - 1] = at

        for at, name in enumerate(names, 1):
            if name[:1] == "/":
                k = next((k for k in range(len(open_) - 1, -1, -1) if names[open_[k] - 1] == name[1:]), None)
                if k is not None:
                    close(k, at)
            elif name:
                bare = name.rstrip("/")
                for k in range(len(open_) - 1, -1, -1):
                    above = names[open_[k] - 1]
                    if above in BOUNDS and bare not in IMPLIED.get(above, ()):
                        break
                    if bare in IMPLIED.get(above, ()):
                        close(k, at)
                        break
                around[at - 1] = open_[-1] if open_ else 0
                end[at - 1] = at + 1
                if name == bare and bare not in VOID:
                    open_.append(at)
        close(0, len(names) + 1)
        return around + end

    return _sliced(of, pages, pa.list_(pa.int32()))


@F.arrow_udf(ArrayType(StringType()))
def decoded(values: pa.Array) -> pa.Array:
    """Entities decoded; a text (marked by a leading T) also has its white space collapsed and empty lines dropped."""

    def of(value: str | None) -> str | None:
        if value is None or value[:1] == "A":
            return value and entities.unescape(value[1:])
        lines = (" ".join(entities.unescape(s).split()) for s in value[1:].split("\n"))
        return "\n".join(s for s in lines if s)

    return _sliced(lambda row: [of(v) for v in row], values, pa.list_(pa.string()))


# Results that the optimizer may not count on are computed once; else a filter on a field would decode all values again,
# in a Python worker of its own for every task.
nesting, decoded = nesting.asNondeterministic(), decoded.asNondeterministic()


def _name(token: Column) -> Column:
    name = F.lower(F.regexp_extract(token, r"^<(/?[a-zA-Z][^\s/>]*)", 1))
    closed = name.isin(*HIDDEN) | (F.endswith(token, F.lit("/>")) & ~F.startswith(name, F.lit("/")))
    return F.when(closed & (name != ""), F.concat(name, F.lit("/"))).otherwise(name)


def _piece(token: Column, name: Column) -> Column:
    """What a token adds to the rendered text; a line break in the source is a blank."""
    lines = [*LINES, "br", *(f"/{n}" for n in LINES), "br/", "hr/"]
    return F.when(name.isin(*lines), "\n").when((name != "") | token.rlike(r"^<[!?]"), "").otherwise(F.translate(token, "\n", " "))


def _element(token: Column, name: Column, at: Column) -> Column:
    def attribute(key: str) -> Column:
        entries = F.filter(F.regexp_extract_all(token, F.lit(ATTRIBUTE), F.lit(0)), lambda x: F.lower(F.regexp_extract(x, r"^[^\s=]++", 0)) == key)
        return F.regexp_extract(F.try_element_at(entries, F.lit(-1)), r"(?s)^[^=]*+=\s*+([\"']?)(.*?)\1$", 2)

    size = F.size("names")
    found = {k: F.when(F.contains(F.lower(token), F.lit(k)), attribute(k)) for k in ATTRIBUTES}
    return F.struct(
        (at + 1).alias("n"), F.get("nest", at).alias("parent"), F.get("nest", at + size).alias("end"), F.rtrim(name, F.lit("/")).alias("tag"),
        *(v.alias(k) for k, v in found.items()),
    )


# --- matches -----------------------------------------------------------------------


def _within(e: Column, outer: Column) -> Column:
    return (outer["n"] < e["n"]) & (e["n"] < outer["end"])


def _matches(alternatives: list) -> Column:
    """Elements of the page that one of the alternatives matches, in document order."""

    def test(alternative, e: Column) -> Column:
        if isinstance(alternative, Holds):
            inner = F.filter("elements", alternative.inner)
            return alternative.outer(e) & F.exists(inner, lambda x: _within(x, e))
        if isinstance(alternative, tuple):
            outer, last = alternative
            return last(e) & F.exists("elements", lambda a: _within(e, a) & outer(a))
        return alternative(e)

    return F.filter("elements", lambda e: F.coalesce(reduce(lambda a, b: a | b, (F.coalesce(test(x, e), F.lit(False)) for x in alternatives)), F.lit(False)))


def _value(pick: Pick, found: Column, block: Column) -> Column:
    """What a selector finds for a block, marked A (attribute) or T (text); null without an element."""
    inside = lambda scope: F.get(F.filter(found, lambda e: _within(e, scope)), F.lit(0))

    def scope(where) -> Column:
        if where == "next":
            return F.get(F.filter("elements", lambda e: (e["parent"] == block["parent"]) & (e["n"] >= block["end"])), F.lit(0))
        if where == "parent":
            page = F.struct(F.lit(0).alias("n"), (F.size("names") + 1).alias("end"))
            own = F.get(F.filter("elements", lambda e: e["n"] == block["parent"]), F.lit(0))
            return F.when(block["parent"] == 0, page).otherwise(F.struct(own["n"].alias("n"), own["end"].alias("end")))
        return F.try_element_at(F.filter("elements", lambda e: (e["n"] <= block["n"]) & (block["n"] < e["end"]) & where(e)), F.lit(-1))

    # With places to look around it, the block itself is not looked into.
    e = F.coalesce(*[inside(scope(w)) for w in pick.around]) if pick.around else inside(block)

    def read(x: Column) -> Column:
        text = F.concat(F.lit("T"), F.array_join(F.slice("pieces", x["n"] + 1, F.greatest(x["end"] - x["n"] - 1, F.lit(0))), ""))
        if not pick.take:
            return text
        attribute = F.concat(F.lit("A"), F.coalesce(x[pick.take], F.lit("")))
        return F.when(attribute == "A", text).otherwise(attribute) if pick.or_text else attribute

    return F.get(F.transform(F.array(e), lambda x: F.when(x.isNotNull(), read(x))), F.lit(0))


def blocks(pages: DataFrame, layout: Layout) -> DataFrame:
    """One row per block of the first block selector that finds any on the page: the columns of pages except html, block_pos,
    and per field an array with what each selector found."""
    others = [c for c in pages.columns if c != "html"]
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in others]).alias("page")
    cut = pages.select(row, F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(TOKEN), F.lit(0)).alias("tokens"))
    cut = cut.withColumn("names", F.transform("tokens", _name)).withColumn("nest", nesting("names"))
    every = F.transform("tokens", lambda t, k: _element(t, F.get("names", k), k))
    cut = cut.select(
        "page", "names", F.filter(every, lambda e: e["parent"] >= 0).alias("elements"),
        F.transform("tokens", lambda t, k: _piece(t, F.get("names", k))).alias("pieces"),
    )
    picks = [(f"m{k}", p) for k, p in enumerate(p for part in PARTS for p in getattr(layout, part))]
    cut = cut.select("*", *[_matches(p.alternatives).alias(c) for c, p in picks], *[_matches(b).alias(f"b{k}") for k, b in enumerate(layout.blocks)])
    some = [F.when(F.size(f"b{k}") > 0, F.col(f"b{k}")) for k in range(len(layout.blocks))]
    values = F.transform(F.coalesce(*some), lambda b: F.array(*[_value(p, F.col(c), b) for c, p in picks]))
    out = cut.select("page", F.posexplode(values).alias("block_pos", "found")).withColumn("found", decoded("found"))
    at, fields = 1, []
    for part in PARTS:
        n = len(getattr(layout, part))
        fields.append(F.slice("found", at, n).alias(part))
        at += n
    return out.select(*[F.col("page")[c].alias(c) for c in others], "block_pos", *fields)


def cascade(part: str, layout: Layout, clean) -> Column:
    """First selector whose cleaned value is usable (non-null and non-empty)."""
    tries = [T.nonempty(clean(F.get(F.col(part), F.lit(k)))) for k in range(len(getattr(layout, part)))]
    return F.coalesce(*tries, F.lit("")) if tries else F.lit("")


def short_text(text: Column) -> Column:
    return F.when((F.length(text) > 0) & (F.length(text) < 200), text)


def _phone(raw: Column) -> Column:
    return T.validate_phone(T.strip_phone_label(F.replace(raw, F.lit("tel:"), F.lit(""))))


def listings(pages: DataFrame, layout: Layout) -> DataFrame:
    """One row per listing block with a name; the first valid phone wins, not the first found."""
    out = blocks(pages.select("page_id", "html"), layout).select(
        "page_id", "block_pos",
        cascade("name", layout, T.strip).alias("name"),
        T.absolute_url(layout.base_url, cascade("link", layout, lambda c: c)).alias("listing_url"),
        cascade("address", layout, T.strip).alias("address"),
        cascade("phone", layout, _phone).alias("phone"),
        cascade("website", layout, lambda c: T.external_url(layout.own_domain, c)).alias("website"),
        cascade("category", layout, short_text).alias("category"),
    ).where(F.col("name") != "")
    parts = T.cp_and_city(F.col("address"))
    return out.select(
        "*", parts["cp"].alias("cp"), parts["city"].alias("city"),
        F.when(F.col("phone") != "", "direct").otherwise("vide").alias("phone_capture"),
    )


def old_listings(pages: DataFrame, layout: Layout) -> DataFrame:
    """The older layout: address on one line, phone and site taken from the first element, whatever it holds.

    pages also carries keyword, training, dept and city: what was searched.
    """
    site = cascade("website", layout, lambda c: c)
    out = blocks(pages.select("page_id", "training", "keyword", "dept", F.col("city").alias("_city"), "html"), layout).select(
        "page_id", "block_pos", "training", F.col("keyword").alias("kind"),
        cascade("name", layout, T.strip).alias("name"),
        F.replace(cascade("address", layout, T.strip), F.lit("\n"), F.lit(" ")).alias("full_address"), "dept", "_city",
        cascade("phone", layout, lambda c: T.strip(F.replace(c, F.lit("tel:"), F.lit("")))).alias("phone"),
        F.when(F.contains(site, F.lit(layout.own_domain)) & F.lit(layout.own_domain != ""), "").otherwise(site).alias("website"),
    ).where(F.col("name") != "")
    parts = T.cp_and_city_or(F.col("full_address"), F.col("dept"), F.col("_city"))
    return out.select("*", parts["cp"].alias("cp"), parts["city"].alias("city")).drop("_city")


def selector_coverage(pages: DataFrame, layout: Layout) -> DataFrame:
    """For every candidate selector, on how many blocks it finds something."""
    b = blocks(pages.select("page_id", "html"), layout)
    hits = b.select(F.explode(F.array(*[
        F.struct(F.lit(p).alias("part"), F.lit(k).alias("pos"), F.get(F.col(p), F.lit(k)).isNotNull().alias("hit"))
        for p in PARTS for k in range(len(getattr(layout, p)))
    ])).alias("h")).select("h.*")
    return hits.groupBy("part", "pos").agg(F.count_if("hit").alias("n_hit"), F.count("*").alias("n_blocks"))
