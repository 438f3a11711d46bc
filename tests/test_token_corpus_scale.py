"""The token corpus: bounded batches for the lemmas, texts read no further and no more often than needed, same results."""

import numpy as np
from pyspark.sql import functions as F

from jobmill.functions import text as X
from jobmill.functions import tokens as N
from jobmill.operators import language, nlp
from jobmill.plans import corpus, registry
from jobmill.plans import inputs as I

ODD = [
    None, "", " ", " uno dos", "a-b c_d, e.f!g", "\n- x\n  * y\n\n   z", "İstanbul ΣΑΣ ½ ²", "١٢٣ 123 a1 1a ab١",
    "x\x00y \U0001d400\U0001d7d8 𝟘𝟙𝟚", "__ -- - _ ...", " ".join("w" * 3 for _ in range(15)), " ".join(["w"] * 14) + " ",
    "ver https://x y www.z hwww.q shttp://r http://", "·x\n·", "  \n\t•  v", "x\u0085y z w", "{abc `ab ~ab éab zzz",
]


def odd(spark):
    return spark.createDataFrame(list(enumerate(ODD)), "id long, t string")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lemmas_are_put_in_place_before_the_session_reads_the_rows(spark, folder):
    """the workers' batches are those of ``stored`` and not those of whoever reads the result."""
    assert "EvalPython" not in physical(registry.QUERIES["nlp_title"](spark, folder))


def test_single_pass_counts_read_the_stored_lemma_rows(spark, folder, monkeypatch):
    """the tokens aren't stored once more for one pass over them."""
    stored, purposes = nlp.stored, []

    def noted(df, purpose):
        purposes.append(purpose)
        return stored(df, purpose)

    monkeypatch.setattr(nlp, "stored", noted)
    monkeypatch.setattr(I, "stored", noted)
    registry.QUERIES["term_frequencies"](spark, folder)
    assert "lemma-rows" in purposes and "token-rows" not in purposes
    # each token is split off once for the lemma table, not for either side of its join.
    assert "words" in purposes


def test_few_words_are_told_without_counting(spark):
    """whether a text is usable needs its first words only."""
    for least in (1, 5, 15):
        rows = odd(spark).select(X.has_few_words(F.col("t"), least), X.is_unusable(X.word_count(F.col("t")), least))
        assert all(a == b for a, b in rows.collect())
    jobs = spark.createDataFrame(
        [("x", "y", 1.0, None, "t")], "description string, raw_location string, salary_min double, salary_max double, title string"
    )
    assert "regexp_extract_all" not in physical(corpus.add_clean_columns(jobs).select("es_vacio"))


def test_tokens_are_those_of_two_patterns(spark):
    """F14, F15, F16: one split instead of a replacement and a split, and fewer tries of the digits' pattern."""
    bare = F.regexp_replace(F.lower("t"), F.lit(r"(?U)[^\p{L}\p{N}_\s\-]+"), F.lit(" "))
    words = F.coalesce(F.filter(F.split(bare, r"(?U)\s+"), lambda w: w != ""), F.array().cast("array<string>"))
    kept = F.filter(words, lambda w: (F.length(w) > 2) & ~w.rlike(r"^\p{Nd}+$"))
    tokens = N.tokenize(F.col("t"))
    for found, wanted in odd(spark).select(tokens, words).union(
        odd(spark).select(N.without_short_or_numeric(tokens), kept)
    ).collect():
        assert found == wanted
    assert "regexp_replace" not in physical(odd(spark).select(tokens))


def test_patterns_match_as_before(spark):
    before = {X.drop_urls: r"(?U)https?://\S+|www\.\S+", X.drop_bullets: r"(?mUd)^\s*+[*\-•·]\s*+|(^\s++)"}
    for step, pattern in before.items():
        put = "$1" if step is X.drop_bullets else " "
        rows = odd(spark).select(step(F.col("t")), F.regexp_replace("t", F.lit(pattern), F.lit(put)))
        assert all(a == b for a, b in rows.collect())


def test_trigrams_of_blocks_are_those_of_the_text(monkeypatch):
    """a long text's trigrams are made a block at a time."""
    numbers = language.letter_numbers()
    for text in ("", "a", "ab, cd éf " * 7, "\U0001d400x", "no" * 20):
        whole = language.gram_numbers(text, numbers)
        for size in (1, 2, 7, 64):
            monkeypatch.setattr(language, "BLOCK_CHARS", size)
            assert np.array_equal(language.gram_numbers(text, numbers), whole)
        monkeypatch.undo()


def test_scores_are_summed_as_language_by_language():
    draw = np.random.default_rng(5)
    weights = np.log(draw.random((4, language.BASE**3)))
    for n in (1, 7, 200, 9_000):
        grams = draw.integers(0, language.BASE**3, n)
        assert language.likeliest(grams, weights) == int(np.argmax([own.take(grams).sum() for own in weights]))


def test_lemmas_by_language_in_place(spark):
    rows = spark.createDataFrame(
        [(["as", "b", "as"], "en"), (["as", "b"], "es"), ([], "en"), (["as"], None), (["cs", "b"], "otro")], "t array<string>, l string"
    )
    table = spark.createDataFrame(
        [("en", "as", "a"), ("es", "b", "x y"), ("es", "cs", "c")], "lang string, token string, lemma string"
    )
    got = [r.t for r in nlp.lemmatize(rows, "t", "l", table).collect()]
    assert got == [["a", "b", "a"], ["as", "x y"], [], ["as"], ["c", "x y"]]
    by_join = [r.t for r in nlp.lemmatize(rows, "t", "l", table, most=0).collect()]
    assert sorted(map(str, by_join)) == sorted(map(str, got))


def test_length_of_stripped_text_is_told_without_stripping(spark):
    texts = [None, "", "a", " a", "ab", "a b", "a   ", " \u3000a\x1f b\xa0\n", "\U0001d400" * 3, "a" + " " * 30 + "\n", "a\n\nb" * 9]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for least in (2, 3, 4, 20):
        got = rows.select(X.has_length(F.col("t"), least), F.length(X.strip(F.col("t"))) >= least).collect()
        assert all(a == b for a, b in got)
