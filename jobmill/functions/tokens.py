"""Token rules as array expressions: no explode, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmill.functions.text import bind
from jobmill.lookups import stop_words

MIN_TOKENS = 5


def tokenize(text: Column) -> Column:
    """Lower-cased words; punctuation splits, hyphens and underscores stay."""
    words = F.split(F.lower(text), r"(?U)[^\p{L}\p{N}_\-]+")
    return F.coalesce(F.filter(words, lambda w: w != ""), F.array().cast("array<string>"))


def without_stop_words(
    tokens: Column, language: Column, words: dict[str, list[str]] | None = None
) -> Column:
    """Drop the stop words of the row's language; an unknown one drops both lists.

    ``isin`` over constants is one hash lookup per token.
    """
    lists = words or {lang: stop_words(lang) for lang in ("es", "en", "otro")}

    def by_language(all_tokens: Column) -> Column:
        def kept(lang: str) -> Column:
            return F.filter(all_tokens, lambda w: ~w.isin(*lists[lang]))

        return F.when(language == "es", kept("es")).when(language == "en", kept("en")).otherwise(kept("otro"))

    return bind(tokens, by_language)


def without_short_or_numeric(tokens: Column) -> Column:
    """The pattern is tried only on words that don't begin with a letter from a to z."""

    def kept(word: Column) -> Column:
        letter = (word >= "a") & (word < "{")
        return (F.length(word) > 2) & (letter | ~word.rlike(r"^\p{Nd}+$"))

    return F.filter(tokens, kept)


def lemma_language(language: Column) -> Column:
    return F.when(language == "en", "en").otherwise("es")


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` neighbouring tokens, each joined by blanks."""

    def runs(size: int) -> Column:
        starts = F.when(F.size(tokens) >= size, F.sequence(F.lit(1), F.size(tokens) - (size - 1)))
        found = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(size)), " "))
        return F.coalesce(found, F.array().cast("array<string>"))

    return tokens if (low, high) == (1, 1) else F.concat(*[runs(size) for size in range(low, high + 1)])
