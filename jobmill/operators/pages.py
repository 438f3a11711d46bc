"""Postings from stored web pages: listing cards and detail descriptions.

A small helper lists a page's tags and texts by position. A tag spans the positions inside it,
so selectors, n-th matches and fields are comparisons of spans: native expressions over the
page's own lists. Pages never meet: there is no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmill.functions.batches import MOST_BYTES, byte_sizes, runs
from jobmill.functions.html import visible_text
from jobmill.functions.postings import absolute_url, numbered_url
from jobmill.functions.salary import first_amount, parse_salary
from jobmill.functions.text import bind

# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SIMPLE = re.compile(r"([.#]?)((?:\\.|[\w\-])+)|\[([\w\-]+)(?:=([^\]]*))?\]")


@dataclass(frozen=True)
class Field:
    """Text of the ``nth`` match; ``attr`` reads an attribute, ``last`` the last text piece."""

    selector: str
    nth: int = 0
    attr: str | None = None
    last: bool = False


@dataclass(frozen=True)
class Anchor:
    """The enclosing ``inside`` element of the first ``tag`` whose text holds ``words``."""

    tag: str
    words: str
    inside: str


@dataclass(frozen=True)
class Profile:
    """Where one site keeps its fields."""

    site: str
    card: str
    fields: dict[str, Field]
    chips: str | None = None
    next_page: str | None = None
    details: tuple[str | Anchor, ...] = ()
    base_url: str = ""
    home_icon: str = "span.i_home"
    office_icon: str = "span.i_home_office"


# Markup of the two listing sites.
COMPUTRABAJO = Profile(
    site="computrabajo",
    card="div.box_offer",
    fields={
        "title": Field("h2 a.js-o-link"),
        "href": Field("h2 a.js-o-link", attr="href"),
        "company": Field("div.fs16 p.mt5", last=True),
        "raw_location": Field("div.fs16 p.mt5", nth=1),
        "date_posted": Field("p.fc_aux"),
    },
    chips="div.fs12.mt15 span.dIB",
    next_page="span.b_primary.buildLink[data-path]",
    details=("#js_oferta ~ p.mbB", "p.mbB"),
    base_url="https://mx.computrabajo.com",
)
OCC = Profile(
    site="occ",
    card="div[data-offers-grid-offer-item-container]",
    fields={
        "title": Field("h2.text-grey-900.text-lg"),
        "number": Field("", attr="data-id"),
        "company": Field(r"div.col-span-10 div.h-\[21px\]"),
        "raw_location": Field("div.no-alter-loc-text p"),
        "date_posted": Field("span.mr-2.text-sm.font-light"),
        "salary_text": Field("span.mr-2.text-grey-900.font-base.font-light"),
    },
    details=(
        "#Descripcion",
        "div[itemprop=description]",
        Anchor("p", "Descripción:", "div"),
        "div.break-words",
    ),
)


class TagReader(HTMLParser):
    """Start tags and texts of a page by position; a tag spans the positions from its own to ``post``.

    An end tag closes everything up to its nearest open start tag. Texts are trimmed; empty
    ones and those of scripts and styles are left out.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.texts, self.open, self.at = [], [], [], 0
        self.feed(html)
        self.close()
        self.end_all(0)

    def end_all(self, depth: int) -> None:
        while len(self.open) > depth:
            self.open.pop()["post"] = self.at - 1

    def handle_starttag(self, tag, attrs):
        parent = self.open[-1]["pre"] if self.open else -1
        row = {"pre": self.at, "post": self.at, "parent": parent, "tag": tag, "attrs": {k: v or "" for k, v in attrs}}
        self.tags.append(row)
        self.at += 1
        if tag not in VOID:
            self.open.append(row)

    def handle_endtag(self, tag):
        depth = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i]["tag"] == tag), None)
        if depth is not None:
            self.end_all(depth)

    def handle_data(self, data):
        if data.strip() and not any(t["tag"] in ("script", "style") for t in self.open):
            self.texts.append({"pos": self.at, "text": data.strip()})
            self.at += 1


MAP = pa.map_(pa.string(), pa.string())
TAG = pa.struct([("pre", pa.int32()), ("post", pa.int32()), ("parent", pa.int32()), ("tag", pa.string()), ("attrs", MAP)])
PAGE = pa.struct([("tags", pa.list_(TAG)), ("texts", pa.list_(pa.struct([("pos", pa.int32()), ("text", pa.string())])))])
PAGE_SQL = (
    "struct<tags:array<struct<pre:int,post:int,parent:int,tag:string,attrs:map<string,string>>>,"
    "texts:array<struct<pos:int,text:string>>>"
)


def read_page(html: Column) -> Column:
    """``tags`` and ``texts`` of a page; none for a null page. A worker lists ``MOST_BYTES`` of pages at a time."""

    @F.arrow_udf(PAGE_SQL)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            for start, n in runs(byte_sizes(pages), MOST_BYTES):
                out = []
                for source in pages.slice(start, n):
                    page = TagReader(source.as_py() or "")
                    rows = [{**t, "attrs": list(t["attrs"].items())} for t in page.tags]
                    out.append({"tags": rows, "texts": page.texts})
                yield pa.array(out, PAGE)

    return read(html)


def fits(tag: Column, simple: str) -> Column:
    """Tag, ``.class``, ``#id`` and ``[attribute=value]`` tests; a backslash quotes a bracket."""
    out = F.lit(True)
    for mark, name, attr, value in SIMPLE.findall(simple):
        name = name.replace("\\", "")
        if attr:
            own = tag["attrs"][attr]
            out = out & (own == value if value else own.isNotNull())
        elif mark == ".":
            classes = F.split(F.coalesce(tag["attrs"]["class"], F.lit("")), r"\s+")
            out = out & F.array_contains(classes, name)
        elif mark == "#":
            out = out & F.coalesce(tag["attrs"]["id"] == name, F.lit(False))
        else:
            out = out & (tag["tag"] == name)
    return F.coalesce(out, F.lit(False))


def inside(outer: Column, at: Column) -> Column:
    """Whether a position lies inside a tag."""
    return (outer["pre"] < at) & (at <= outer["post"])


def matches(tags: Column, selector: str) -> Column:
    """The tags that a selector finds, in page order; steps are descendants, ``~`` a later sibling.

    Every step filters the tags by the matches of the step before, which are made once.
    """
    steps = selector.split()
    found, later = F.filter(tags, lambda t: fits(t, steps[0])), False
    for simple in steps[1:]:
        if simple == "~":
            later = True
        else:
            found, later = bind(found, next_step(tags, simple, later)), False
    return found


def next_step(tags: Column, simple: str, later: bool) -> Callable[[Column], Column]:
    """Of the matches of a step those of the next: later siblings or descendants."""

    def near(a: Column, t: Column) -> Column:
        return (a["parent"] == t["parent"]) & (a["pre"] < t["pre"]) if later else inside(a, t["pre"])

    return lambda before: F.filter(tags, lambda t: fits(t, simple) & F.exists(before, lambda a: near(a, t)))


def pieces(texts: Column, tag: Column) -> Column:
    """The texts below a tag."""
    return F.transform(F.filter(texts, lambda x: inside(tag, x["pos"])), lambda x: x["text"])


def within(found: Column, tag: Column) -> Column:
    return F.filter(found, lambda t: inside(tag, t["pre"]))


def field_value(tag: Column, texts: Column, want: Field) -> Column:
    if want.attr:
        return tag["attrs"][want.attr]
    own = pieces(texts, tag)
    return bind(own, last_of) if want.last else F.array_join(own, "")


TEXT_FIELDS = ("title", "href", "number", "company", "raw_location", "date_posted", "salary_text")


def page_cards(pages: DataFrame, key: str, profile: Profile, html: str = "html") -> DataFrame:
    """One row per card with its raw fields; a page without cards has no rows.

    All selectors are matched page by page inside the row, so nothing is shuffled; the
    matches of a card are those inside its span.
    """
    tags, texts = F.col("_page.tags"), F.col("_page.texts")
    found = {name: matches(tags, want.selector) for name, want in profile.fields.items() if want.selector}
    if profile.chips:
        found |= {
            "chips": matches(tags, profile.chips),
            "home": matches(tags, profile.home_icon),
            "office": matches(tags, profile.office_icon),
        }
    more = F.size(matches(tags, profile.next_page)) > 0 if profile.next_page else F.lit(True)
    rows = pages.select(F.col(key), read_page(F.col(html)).alias("_page")).select(
        F.col(key), texts.alias("_texts"), more.alias("has_next"), matches(tags, profile.card).alias("_cards"),
        *[c.alias(f"_{name}") for name, c in found.items()],
    )

    def value(card: Column, name: str) -> Column:
        want = profile.fields.get(name)
        if want is None:
            return F.lit(None).cast("string")
        if not want.selector:
            return field_value(card, F.col("_texts"), want)
        tag = F.get(within(F.col(f"_{name}"), card), F.lit(want.nth))
        return bind(tag, lambda t: F.when(t.isNotNull(), field_value(t, F.col("_texts"), want)))

    def chip(tag: Column) -> Column:
        return F.struct(
            F.array_join(pieces(F.col("_texts"), tag), "").alias("text"),
            (F.size(within(F.col("_home"), tag)) > 0).alias("home"),
            (F.size(within(F.col("_office"), tag)) > 0).alias("office"),
        )

    def card_row(card: Column, at: Column) -> Column:
        none = F.array().cast("array<struct<text:string,home:boolean,office:boolean>>")
        chips = F.transform(within(F.col("_chips"), card), chip) if profile.chips else none
        return F.struct(at.alias("card_no"), *[value(card, n).alias(n) for n in TEXT_FIELDS], chips.alias("chips"))

    return rows.select(key, F.inline(F.transform("_cards", card_row)), "has_next")


def last_of(values: Column) -> Column:
    return F.get(values, F.size(values) - 1)


def listing_rows(
    cards: DataFrame, profile: Profile, remote: bool = False, country: str = "MX", currency: str = "MXN"
) -> DataFrame:
    """Cards as listing rows: full links, salary, modality.

    A chip with a dollar sign is a salary, otherwise its icon tells the modality; later
    chips override earlier ones.
    """
    chips = F.col("chips")
    pay_chip = last_of(F.filter(chips, lambda c: F.contains(c["text"], F.lit("$"))))["text"]
    pay_text = F.when(F.contains(F.col("salary_text"), F.lit("$")), F.col("salary_text"))
    icon = last_of(F.filter(chips, lambda c: ~F.contains(c["text"], F.lit("$")) & (c["home"] | c["office"])))
    pay = parse_salary(F.coalesce(pay_chip, pay_text))
    usual = F.lit("Remoto" if remote else None).cast("string")
    link = F.coalesce(absolute_url(F.lit(profile.base_url), F.col("href")), numbered_url(F.col("number")))
    key = cards.columns[0]
    return cards.select(
        key,
        "card_no",
        F.lit(profile.site).alias("site"),
        link.alias("job_url"),
        "title",
        "company",
        "raw_location",
        F.lit(None).cast("string").alias("description"),
        "date_posted",
        pay["salary_min"].alias("salary_min"),
        pay["salary_max"].alias("salary_max"),
        F.lit(currency).alias("currency"),
        F.when(icon["home"], "Remoto").when(icon["office"], "Híbrido").otherwise(usual).alias("job_type"),
        F.lit(country).alias("country_code"),
        "has_next",
    )


def detail_text(tags: Column, texts: Column, chain: tuple[str | Anchor, ...]) -> Column:
    """The texts of the first step of the chain that finds something, line by line.

    An anchor is found where its words are; its text is that of the nearest tag around it,
    null if there is none.
    """
    out = F.lit(None).cast("string")
    for step in reversed(chain):
        selector = step.tag if isinstance(step, Anchor) else step
        found = matches(tags, selector)
        if isinstance(step, Anchor):
            found = F.filter(found, holds(texts, step.words))
        out = bind(F.get(found, F.lit(0)), step_text(tags, texts, step, out))
    return out


def holds(texts: Column, words: str) -> Callable[[Column], Column]:
    return lambda t: F.contains(F.array_join(pieces(texts, t), ""), F.lit(words))


def step_text(tags: Column, texts: Column, step: str | Anchor, rest: Column) -> Callable[[Column], Column]:
    """The text of a step's tag, or what the rest of the chain finds where there is no tag."""

    def lines(t: Column) -> Column:
        return F.when(t.isNotNull(), F.array_join(pieces(texts, t), "\n"))

    def own(t: Column) -> Column:
        if isinstance(step, Anchor):
            return bind(last_of(F.filter(tags, lambda a: (a["tag"] == step.inside) & inside(a, t["pre"]))), lines)
        return lines(t)

    return lambda t: F.when(t.isNotNull(), own(t)).otherwise(rest)


def page_details(pages: DataFrame, key: str, profile: Profile, html: str = "html") -> DataFrame:
    """``key, description, salary_raw`` of detail pages; nulls when nothing is found."""
    priced = pages.select(
        key, read_page(F.col(html)).alias("_page"), first_amount(visible_text(F.col(html))).alias("salary_raw")
    )
    description = detail_text(F.col("_page.tags"), F.col("_page.texts"), profile.details)
    return priced.select(key, description.alias("description"), "salary_raw")
