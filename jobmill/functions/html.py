"""Visible text and simple fields of raw HTML as native expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmill.functions.text import bind, strip

EDGE = "\x01"
# A character that Unicode reserves for use inside programs: the "<" of an opener that nothing closes.
OPEN = "\ufdd0"
LINK = r"""(?i)<a\b[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def decode_entities(text: Column) -> Column:
    """Named and numeric character references, each decoded once.

    The closing semicolon may be missing when no letter or digit follows the name.
    """
    named = F.create_map(*[F.lit(x) for name, code in {**name2codepoint, "apos": 39}.items() for x in (name, chr(code))])
    pieces = F.split(text, "&")

    def decode(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^[A-Za-z][A-Za-z0-9]*", 0)
        digits = F.regexp_extract(piece, r"^#0*([0-9]{1,7})(?![0-9])", 1)
        hexes = F.regexp_extract(piece, r"^#[xX]0*([0-9A-Fa-f]{1,6})(?![0-9A-Fa-f])", 1)
        number = F.when(digits != "", F.hex(digits.try_cast("long"))).when(hexes != "", hexes)
        valid = F.conv(number, 16, 10).try_cast("long").between(1, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(number, 8, "0")), "UTF-32")
        rest = F.regexp_replace(piece, r"^#?[A-Za-z0-9]*;?", "")
        known = F.when(name == "amp", F.lit("&")).when(name != "", F.element_at(named, name))
        return (
            F.when(known.isNotNull(), F.concat(known, rest))
            .when(F.coalesce(valid, F.lit(False)), F.concat(char, rest))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    head = F.get(pieces, F.lit(0))
    tail = F.transform(F.slice(pieces, 2, F.size(pieces)), decode)
    decoded = F.concat(head, F.array_join(tail, ""))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def without_blocks(html: Column) -> Column:
    """Comments, scripts and styles replaced by an edge; an opener that nothing closes stays.

    Openers behind the last closer of their kind can't match, but each would be tried up to
    the end of the page. They are hidden during the match, which keeps it linear.
    """

    def hide_comments(page: Column) -> Column:
        tail = F.substring_index(page, "-->", -1)
        head = F.left(page, F.length(page) - F.length(tail))
        return F.when(F.contains(page, F.lit("<!--")), F.concat(head, F.replace(tail, F.lit("<!--"), F.lit(OPEN + "!--")))).otherwise(page)

    def hide(tag: str):
        def step(page: Column) -> Column:
            tail = F.regexp_replace(page, rf"(?is)\A.*</{tag}\s*>", "")
            head = F.left(page, F.length(page) - F.length(tail))
            hidden = F.regexp_replace(tail, rf"(?i)<({tag}\b)", OPEN + "$1")
            return F.when(page.rlike(rf"(?i)<{tag}\b"), F.concat(head, hidden)).otherwise(page)

        return step

    page = bind(bind(bind(html, hide_comments), hide("script")), hide("style"))
    bare = F.regexp_replace(page, F.lit(r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"), F.lit(EDGE))
    return F.translate(bare, OPEN, "<")


def without_tags(page: Column) -> Column:
    """Tags replaced by an edge; behind the last ``>`` there is none."""

    def use(text: Column) -> Column:
        tail = F.substring_index(text, ">", -1)
        head = F.left(text, F.length(text) - F.length(tail))
        return F.concat(F.regexp_replace(head, F.lit(r"(?s)</?[A-Za-z!?][^>]*>"), F.lit(EDGE)), tail)

    return bind(page, use)


def visible_text(html: Column) -> Column:
    """Texts between tags, trimmed and joined by one blank; scripts and comments excluded."""
    text = bind(without_tags(without_blocks(html)), decode_entities)
    joined = F.regexp_replace(text, F.lit(rf"(?U)(?<!\s)\s*+{EDGE}[\s{EDGE}]*"), F.lit(" "))
    return strip(joined)


def inner_text(html: Column, tag: str) -> Column:
    """Visible text of the first element with the tag; empty when it is not closed, null when the page has none."""
    closed = F.regexp_extract(html, rf"(?is)\A.*</{tag}\s*>", 0)
    body = F.regexp_extract(closed, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    has = html.rlike(rf"(?i)<{tag}\b")
    return F.when(has, visible_text(body))


def link_targets(html: Column) -> Column:
    """``href`` values of all anchors, in page order: in double, single or no quotes."""
    found = F.regexp_extract_all(html, F.lit(LINK), F.lit(1))
    return F.transform(found, lambda v: F.when(v.rlike("^[\"']"), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v))
