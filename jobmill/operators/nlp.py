"""Stop-word removal and lemmas over whole corpora."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmill.functions.batches import MOST_TOKENS, list_sizes, runs
from jobmill.functions.text import has_few_words, strip, word_count
from jobmill.functions.tokens import (
    MIN_TOKENS,
    joined,
    lemma_language,
    tokenize,
    without_short_or_numeric,
    without_stop_words,
)
from jobmill.session import shared_dir, small_batches

#: Rows of the largest lemma table that every worker holds, some 100 MB.
MOST_LEMMAS = 500_000


def content_tokens(text: Column, language: Column) -> Column:
    """Tokens that are no stop word, longer than two characters and not all digits."""
    return without_short_or_numeric(without_stop_words(tokenize(text), language))


def lemma_table(lemmas: DataFrame) -> DataFrame:
    """One lemma per language and token (the smallest wins)."""
    return lemmas.groupBy("lang", "token").agg(F.min("lemma").alias("lemma"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = shared_dir(df.sparkSession, purpose)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lemmatize(df: DataFrame, tokens: str, language: str, lemmas: DataFrame, most: int = MOST_LEMMAS) -> DataFrame:
    """Replace every token by its lemma; unknown tokens stay; order is kept.

    A lemma table of at most ``most`` rows is given to the workers, and arrays are rewritten in
    place: nothing is exploded or shuffled, and rows need no id. A larger table is joined.
    A worker rewrites ``MOST_TOKENS`` at a time, whatever the batch. Marked as not deterministic,
    the function runs once even where a later filter reads its result.
    """
    table = stored(lemma_table(lemmas).where("token <> lemma"), "lemma-table")
    if table.count() > most:
        return lemmatize_by_join(df, tokens, language, table)
    words: dict[str, dict[str, str]] = {"es": {}, "en": {}}
    for row in table.collect():
        words.setdefault(row["lang"], {})[row["token"]] = row["lemma"]
    held = df.sparkSession.sparkContext.broadcast(words)

    def rewrite(lists: pa.Array, languages: pa.Array) -> pa.Array:
        sizes = list_sizes(lists)
        coded = lists.flatten().dictionary_encode()
        seen, new = coded.dictionary.to_pylist(), []
        # Only words that have a lemma are made anew; a language's place of any other is its own.
        place = np.tile(np.arange(len(seen)), 2)
        for first, lang in ((0, "es"), (len(seen), "en")):
            own = held.value[lang]
            changed = [i for i, w in enumerate(seen) if w in own]
            place[first + np.array(changed, dtype=np.intp)] = len(seen) + len(new) + np.arange(len(changed))
            new += [own[seen[i]] for i in changed]
        english = np.repeat(np.asarray(pc.equal(languages, "en").fill_null(False)), sizes)
        at = place[np.asarray(coded.indices) + english * len(seen)]
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        words = pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array(new, pa.string())])
        return pa.ListArray.from_arrays(ends, words.take(pa.array(at)))

    @F.arrow_udf("array<string>")
    def rewritten(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lists, languages in batches:
            for start, n in runs(list_sizes(lists), MOST_TOKENS):
                yield rewrite(lists.slice(start, n), languages.slice(start, n))

    once = rewritten.asNondeterministic()
    return df.withColumn(tokens, once(F.col(tokens), lemma_language(F.col(language))))


def lemmatize_by_join(df: DataFrame, tokens: str, language: str, table: DataFrame) -> DataFrame:
    """The same with a lemma table of any size: tokens are joined and put together by row number."""
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    keyed = table.select(F.concat_ws(" ", "lang", "token").alias("_key"), F.col("lemma").alias("_lemma"))
    # The outer form keeps Catalyst from adding a filter that would tokenise twice.
    words = rows.select(
        "_row", lemma_language(F.col(language)).alias("_lang"), F.posexplode_outer(tokens).alias("_pos", "_token")
    ).where("_token IS NOT NULL")
    words = words.select("_row", "_pos", "_token", F.concat_ws(" ", "_lang", "_token").alias("_key"))
    looked_up = words.join(keyed, "_key", "left").select("_row", "_pos", F.coalesce("_lemma", "_token").alias("_word"))
    rebuilt = looked_up.groupBy("_row").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_pos", "_word"))), lambda w: w["_word"]
        ).alias("_words")
    )
    return (
        rows.join(rebuilt, "_row", "left")
        .withColumn(tokens, F.coalesce("_words", F.array().cast("array<string>")))
        .drop("_words", "_row")
    )


def token_rows(
    corpus: DataFrame,
    title: str = "title",
    text: str = "descripcion_limpia",
    language: str = "idioma_det",
    unusable: str = "es_vacio",
) -> DataFrame:
    """The corpus with ``_all``, the content tokens of title and usable text in one array, and
    ``_n``, how many of them are the title's. A map-only step."""
    lang = F.col(language)
    none = F.array().cast("array<string>")
    out = corpus.withColumns(
        {
            "_title": content_tokens(F.col(title), lang),
            "_text": F.when(~F.col(unusable), content_tokens(F.col(text), lang)).otherwise(none),
        }
    )
    return out.withColumns({"_n": F.size("_title"), "_all": F.concat("_title", "_text")}).drop("_title", "_text")


def nlp_columns(rows: DataFrame, unusable: str = "es_vacio") -> DataFrame:
    """The five token columns in place of ``_all`` and ``_n``."""
    out = rows.withColumns(
        {
            "titulo_nlp": joined(F.slice("_all", F.lit(1), F.col("_n"))),
            "descripcion_nlp": joined(F.slice("_all", F.col("_n") + 1, F.size("_all"))),
        }
    )
    out = out.withColumns(
        {
            "texto_nlp": strip(F.concat_ws(" ", "titulo_nlp", "descripcion_nlp")),
            "n_palabras_nlp": word_count(F.col("descripcion_nlp")),
        }
    )
    return out.withColumn(
        "es_vacio_nlp", F.col(unusable) | has_few_words(F.col("descripcion_nlp"), MIN_TOKENS)
    ).drop("_n", "_all")


def add_nlp_columns(corpus: DataFrame, lemmas: DataFrame | None = None, language: str = "idioma_det") -> DataFrame:
    """Cleaned corpus plus its five token columns.

    Titles are processed on every row, descriptions only on usable ones. Title and
    description tokens share one array so that a lemma table is looked up once.
    """
    out = token_rows(corpus, language=language)
    if lemmas is not None:
        out = lemmatize(out, "_all", language, lemmas)
    return nlp_columns(out)
