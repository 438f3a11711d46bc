"""Text cleaning as native expressions.

Every pattern scans its input once: patterns that start with a repeated class are
anchored to the first character of the run, so a very long token stays linear.
Patterns begin with a plain character class where they can, which lets the matcher
skip most positions after one comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
AMOUNT = r"[\p{Nd},.]"
MIN_WORDS = 15

# Every character that counts as whitespace when a text is trimmed.
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def drop(text: Column, pattern: str, put: str = "") -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(put))


def strip(text: Column) -> Column:
    """Trim every kind of whitespace, not only blanks."""
    return F.btrim(text, F.lit(BLANKS))


def has_length(text: Column, least: int) -> Column:
    """Whether the stripped text has ``least`` (two or more) characters, read no further than those."""
    return F.rlike(text, F.lit(rf"(?s)\A[{BLANKS}]*+[^{BLANKS}].{{{least - 2},}}?[^{BLANKS}]"))


def unescape(text: Column) -> Column:
    """Literal ``\\n``, ``\\t``, ``\\r`` and backslash-escaped punctuation."""
    text = F.replace(text, F.lit("\\n"), F.lit("\n"))
    text = F.replace(text, F.lit("\\t"), F.lit(" "))
    text = F.replace(text, F.lit("\\r"), F.lit(""))
    return drop(text, r"\\([.\-*\[\]()\\])", "$1")


def drop_urls(text: Column) -> Column:
    # One class first, as a choice of two words costs more at every character.
    return drop(text, r"(?U)[hw](?:(?<=h)ttps?://\S+|(?<=w)ww\.\S+)", " ")


def drop_emails(text: Column) -> Column:
    """A whole non-blank run goes when it holds an at-sign followed by a dot."""
    return drop(text, r"(?U)(?<!\S)\S[^\s@]*+@\S+\.\S+", " ")


def drop_phones(text: Column) -> Column:
    """Ten or more digits standing alone, or ``(dd) dddd-dddd``."""
    alone = rf"(?<=\p{{Nd}})(?<!{WORD}\p{{Nd}})\p{{Nd}}{{9,}}+(?!{WORD})"
    area = r"(?<=\()\p{Nd}{2,3}\)(?U:\s*)\p{Nd}{3,4}(?U:[\-\s])\p{Nd}{4}"
    return drop(text, rf"[\p{{Nd}}(](?:{alone}|{area})", " ")


def drop_emphasis(text: Column) -> Column:
    """Bold, then italic markers; the words inside stay."""
    return drop(drop(text, r"(?d)\*\*(.+?)\*\*", "$1"), r"(?d)\*(.+?)\*", "$1")


def drop_bullets(text: Column) -> Column:
    # A run of blanks without a bullet is taken whole and put back, so no line of it starts anew.
    return drop(text, r"(?mUd)^(?:\s*+[*\-•·]\s*+|(\s++))", "$1")


def drop_hashtags(text: Column) -> Column:
    return drop(text, rf"#{WORD}+", " ")


def drop_markdown(text: Column) -> Column:
    return drop_hashtags(drop_bullets(drop_emphasis(text)))


def drop_money(text: Column) -> Column:
    """Dollar amounts, and amounts followed by a currency word."""
    dollars = rf"(?<=\$){AMOUNT}+"
    named = rf"(?<={AMOUNT})(?<!{AMOUNT}{{2}}){AMOUNT}*+(?U:\s*+)(?iuU:MXN|USD|pesos?|dólares?)"
    return drop(text, rf"[$\p{{Nd}},.](?:{dollars}|{named})", " ")


def collapse_blanks(text: Column) -> Column:
    return drop(text, r"[ \t]{2,}", " ")


def collapse_newlines(text: Column) -> Column:
    return drop(text, r"\n{3,}", "\n\n")


# The cleaning steps in order, each with the marks it needs; a text that holds none of
# the marks is left alone without running the pattern.
STEPS: tuple[tuple[Callable[[Column], Column], tuple[str, ...]], ...] = (
    (unescape, ("\\",)),
    (drop_urls, ("http", "www.")),
    (drop_emails, ("@",)),
    (drop_phones, ()),
    (drop_emphasis, ("*",)),
    (drop_bullets, ("*", "-", "•", "·")),
    (drop_hashtags, ("#",)),
    (drop_money, ()),
    (collapse_blanks, ("  ", "\t")),
    (collapse_newlines, ("\n\n\n",)),
)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` reads it.

    The value stays a single node of the expression tree, so a filter that Catalyst
    pushes below a projection copies a chain of such steps once and not exponentially.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def guarded(text: Column, step: Callable[[Column], Column], marks: tuple[str, ...]) -> Column:
    """Run the step only on texts that hold one of the marks."""

    def use(value: Column) -> Column:
        needed = F.contains(value, F.lit(marks[0]))
        for mark in marks[1:]:
            needed = needed | F.contains(value, F.lit(mark))
        return F.when(needed, step(value)).otherwise(value)

    return bind(text, use)


def clean_description(text: Column) -> Column:
    """Embedding-ready text; null and blank input give an empty string."""
    for step, marks in STEPS:
        text = guarded(text, step, marks) if marks else step(text)
    return F.coalesce(strip(text), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; null gives 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\S++")), F.lit(0)).cast("int")


def is_unusable(words: Column, least: int = MIN_WORDS) -> Column:
    return F.coalesce(words, F.lit(0)) < least


def has_few_words(text: Column, least: int = MIN_WORDS) -> Column:
    """``is_unusable`` of the text's ``word_count``, read no further than the word that decides."""
    enough = rf"(?U)\A\s*+(?:\S++\s++){{{least - 1}}}\S"
    return ~F.coalesce(F.rlike(text, F.lit(enough)), F.lit(False))
