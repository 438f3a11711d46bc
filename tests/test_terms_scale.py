"""Term statistics and lemmas a bounded part of a batch at a time: the same results, each text handled once."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from jobmill.functions import batches
from jobmill.functions.tokens import ngrams
from jobmill.operators import features, language, nlp

LISTS = [["a", "b", "a", "b", "c"], [], None, ["a", "b c"], ["", "b"], ["b", None, "a"], ["a", "b", "c", "a", "b"]]


def frame(spark, lists):
    return spark.createDataFrame(list(enumerate(lists)), "id long, tokens array<string>")


def test_runs_are_bounded_and_whole():
    sizes = np.array([3, 3, 0, 9, 1, 1])
    assert list(batches.runs(sizes, 6)) == [(0, 3), (3, 1), (4, 2)]
    assert list(batches.runs(sizes[:0], 6)) == []


def test_grams_are_those_of_the_expression(spark):
    df = frame(spark, LISTS)
    for low, high in ((1, 1), (1, 3), (2, 3)):
        found, row = batches.grams(pa.array(LISTS, pa.list_(pa.string())), low, high)
        wanted = df.select("id", F.explode(ngrams(F.col("tokens"), low, high)).alias("g")).where("g IS NOT NULL")
        assert sorted(zip(row.tolist(), found.to_pylist(), strict=True)) == sorted(map(tuple, wanted.collect()))


def test_frequent_terms_are_the_top_of_all_counts(spark):
    draw = np.random.default_rng(3)
    plain = [[f"w{min(int(x), 40)}" for x in draw.geometric(0.15, draw.integers(0, 30))] for _ in range(60)]
    for lists, k in ((plain, 5), (plain, 60), (plain, 100_000), (LISTS, 4)):
        df = frame(spark, lists)
        wanted = features.top_terms(features.term_counts(df, "tokens", 1, 3), k).collect()
        assert features.frequent_terms(df, "tokens", 3, k) == wanted
    counts = features.term_counts(frame(spark, plain), "tokens", 2, 2, ["w1", "w2"])
    assert {r.term for r in counts.collect()} <= {"w1 w1", "w1 w2", "w2 w1", "w2 w2"}


def test_a_filter_on_lemmas_does_not_rewrite_twice(spark):
    rows = spark.createDataFrame([(["cats", "dog"] * 3, "en")], "t array<string>, l string").select(
        F.array_repeat("t", 1).alias("x"), "t", "l"
    )
    table = spark.createDataFrame([("en", "cats", "cat")], "lang string, token string, lemma string")
    done = nlp.lemmatize(rows, "t", "l", table).where(F.array_contains("t", "cat")).select("t")
    assert done.first().t == ["cat", "dog"] * 3
    assert done._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_profile_reads_capitals_and_odd_characters(spark):
    texts = [("Abİc Kk", "en"), ("\U0001d400x, y\x00z", "en"), (None, "es"), ("ẞ", "de"), ("no", None)]
    rows = spark.createDataFrame(texts, "t string, l string")
    got = {r.gram: (r.n_en, r.n_de, r.n_es) for r in language.profile(rows, "t", "l").collect()}
    words = {"en": ["abi", "c", "kk", "x", "y", "z"], "de": ["ß"]}
    wanted = {}
    for i, code in enumerate(("en", "de")):
        for word in words[code]:
            padded = f" {word} "
            for at in range(len(word)):
                wanted.setdefault(padded[at : at + 3], [0, 0, 0])[i] += 1
    assert got == {gram: tuple(n) for gram, n in wanted.items()}


def test_an_open_model_still_scores_by_its_own_weights(spark):
    words = {"xx": "alpha beta gamma delta epsilon", "yy": "uno dos tres cuatro cinco"}
    rows = [(f"{words[code]} {words[code].split()[i % 5]} {i}", code) for code in words for i in range(60)]
    df = spark.createDataFrame(rows, "t string, l string")
    model = language.train_open(df, "t", "l")
    found = df.select("l", model.language(F.col("t")).alias("got")).collect()
    assert model.weights.shape == (language.BASE**3, 2) and sum(r.l == r.got for r in found) > 100
