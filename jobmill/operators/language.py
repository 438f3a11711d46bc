"""Language of a text by character trigrams, learned from labelled texts.

Naive Bayes with add-one smoothing and equal priors. Texts are reduced to the letters of
``LETTERS`` and blanks, so a profile has at most ``(len(LETTERS) + 1) ** 3`` rows (about
200,000) whatever the corpus size: only that bounded profile reaches the driver and the
workers. Learning counts the trigrams of a task's texts in one array per language and sums
these few rows over the tasks. Detection is map-only: the joins and groupings that a relational
form needs would move every text, so an Arrow batch of texts is scored against the weight table
instead.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmill.functions.batches import MOST_BYTES, byte_sizes, runs
from jobmill.functions.text import has_length
from jobmill.session import small_batches

LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß"
BASE = len(LETTERS) + 1
#: The one capital that lower-cases to a letter and a mark.
DOTTED = "\u0130"
LANGUAGES = ("de", "en", "es", "fr")
REPORTED = ("es", "en")
OTHER = "otro"
#: Deviations below its language's own texts from which a text is of no known language.
FAR = 3.0
MIN_CHARS = 20
#: Characters whose trigrams are made at a time.
BLOCK_CHARS = 16_384


def profile(labelled: DataFrame, text: str, label: str, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """``gram, n_<language>...``: how often each trigram occurs per language.

    A task adds up its texts' trigrams in one array per language and sends the counts above 0,
    at most ``BASE ** 3`` rows; only these meet in the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, totals = letter_numbers(), {}
        for batch in batches:
            for start, n in runs(byte_sizes(batch.column("text")), MOST_BYTES):
                part = batch.slice(start, n)
                for code in part.column("label").unique().to_pylist():
                    texts = part.column("text").filter(pc.equal(part.column("label"), code)).cast(pa.binary())
                    # A line break ends a word, as the end of a text does.
                    joined = b"\n".join(texts.to_pylist()).decode("utf-8", "replace")
                    grams = gram_numbers(joined.replace(DOTTED, DOTTED.lower()), numbers)
                    own = totals.setdefault(code, np.zeros(BASE**3, dtype=np.int64))
                    own += np.bincount(grams, minlength=BASE**3)
        seen = np.flatnonzero(np.sum(list(totals.values()), axis=0)) if totals else np.zeros(0, dtype=np.int64)
        none = np.zeros(BASE**3, dtype=np.int64)
        found = [pa.array([gram_text(int(g)) for g in seen], pa.string())]
        found += [pa.array(totals.get(code, none)[seen]) for code in languages]
        yield pa.RecordBatch.from_arrays(found, names=["gram", *names])

    names = [f"n_{code}" for code in languages]
    texts = labelled.where(F.col(label).isin(*languages) & F.col(text).isNotNull())
    counted = texts.select(F.col(label).alias("label"), F.col(text).alias("text")).mapInArrow(
        count, ", ".join(["gram string", *[f"`{name}` long" for name in names]])
    )
    return counted.groupBy("gram").agg(*[F.sum(f"`{name}`").alias(name) for name in names])


@lru_cache(maxsize=1)
def letter_numbers() -> np.ndarray:
    """Position of every character in ``LETTERS``, counted from 1 and blind to case; 0 otherwise.

    A worker makes the table once.
    """
    place = {letter: i for i, letter in enumerate(LETTERS, 1)}
    return np.array([place.get(chr(code).lower(), 0) for code in range(0x10000)], dtype=np.int32)


def gram_numbers(text: str, numbers: np.ndarray) -> np.ndarray:
    """Trigrams of all words as numbers in base ``BASE``; every other character ends a word."""
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    # A block's arrays stay in a core's own cache; each block reads two characters of the next.
    blocks = []
    for start in range(0, len(codes) - 2, BLOCK_CHARS):
        place = numbers.take(codes[start : start + BLOCK_CHARS + 2], mode="clip")
        grams = place[:-2] * BASE
        grams += place[1:-1]
        grams *= BASE
        grams += place[2:]
        # Made indexes here once, not by every table that they are looked up in.
        blocks.append(grams[place[1:-1] > 0].astype(np.intp))
    return np.concatenate(blocks) if len(blocks) > 1 else blocks[0] if blocks else np.zeros(0, dtype=np.intp)


def gram_text(number: int) -> str:
    """The trigram of a number."""
    letters = f" {LETTERS}"
    return letters[number // BASE**2] + letters[number // BASE % BASE] + letters[number % BASE]


def likeliest(grams: np.ndarray, weights: np.ndarray) -> int:
    """The language of the highest score; ``weights`` has a row per language."""
    return int(np.argmax(weights.take(grams, axis=1, mode="clip").sum(axis=1)))


def best_score(grams: np.ndarray, weights: np.ndarray) -> tuple[int, int, float, float]:
    """The likeliest language, the number of trigrams, and mean and variance of their scores in it.

    A trigram that no language has scores as the rarest does.
    """
    best = likeliest(grams, weights)
    scores = weights[best].take(grams)
    scores = np.where(scores == 0, weights[best].min(), scores)
    return best, len(grams), float(scores.mean()), float(scores.var())


@dataclass(frozen=True)
class LanguageModel:
    """``weights[gram number, language]``: smoothed log probability; 0 for unknown trigrams.

    ``limits``, where there are any, have for each language how its own texts score: the mean
    of a text's mean score, its spread from text to text, and that from trigram to trigram.
    """

    languages: tuple[str, ...]
    weights: np.ndarray
    limits: np.ndarray | None = None

    def language(self, text: Column) -> Column:
        """The most likely language; null for a text without a trigram. Ties go by code.

        With limits, a text that scores far below its language's own texts is of no known
        language, and null as well. A short text may score lower than a long one.
        """
        languages, limits = self.languages, self.limits
        if not languages:
            return F.lit(None).cast("string")
        weights = np.ascontiguousarray(self.weights.T)

        # Texts are taken from the batch one by one, so a worker holds a single one beside it.
        @F.arrow_udf("string")
        def best(texts: pa.Array) -> pa.Array:
            numbers = letter_numbers()
            found: list[str | None] = []
            for text in texts:
                value = text.as_py()
                grams = gram_numbers(value, numbers) if value else ()
                if not len(grams):
                    found.append(None)
                    continue
                if limits is None:
                    found.append(languages[likeliest(grams, weights)])
                    continue
                best, n, mean, _ = best_score(grams, weights)
                middle, between, within = limits[best]
                far = mean < middle - FAR * np.sqrt(between**2 + within**2 / n)
                found.append(None if far else languages[best])
            return pa.array(found, pa.string())

        return best(text)


def fit(profiles: DataFrame, languages: Sequence[str] = LANGUAGES) -> LanguageModel:
    """Weights of a profile. The alphabet bounds the profile, so it may be collected."""
    languages = tuple(sorted(languages))
    rows = profiles.toPandas()
    numbers = letter_numbers()
    counts = rows[[f"n_{code}" for code in languages]].to_numpy(float)
    place = [int(np.dot([numbers[ord(c)] for c in gram], (BASE * BASE, BASE, 1))) for gram in rows["gram"]]
    weights = np.zeros((BASE**3, len(languages)))
    weights[place] = np.log((counts + 1.0) / (counts.sum(axis=0) + len(rows)))
    return LanguageModel(languages, weights)


def train(labelled: DataFrame, text: str, label: str, languages: Sequence[str] = LANGUAGES) -> LanguageModel:
    with small_batches(labelled.sparkSession):
        return fit(profile(labelled, text, label, languages), languages)


def train_open(labelled: DataFrame, text: str, label: str) -> LanguageModel:
    """A model of whatever labels the table has, with limits from texts it was not trained on.

    A fifth of the texts, chosen by hash, is held out: how each language's own texts score
    there sets the limits. One small row per held-out text is grouped by label; the labels,
    their limits and the profile are all that reaches the driver. Rows without a label or
    text take no part.
    """
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    languages = tuple(sorted(r[0] for r in rows.select(label).distinct().collect()))
    if not languages:
        return LanguageModel((), np.zeros((0, 0)))
    part = F.pmod(F.xxhash64(F.col(text), F.lit("held out")), F.lit(5))
    model = train(rows.where(part > 0), text, label, languages)
    weights = np.ascontiguousarray(model.weights.T)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = letter_numbers()
        kinds = {"label": pa.string(), "n": pa.int64(), "mean": pa.float64(), "variance": pa.float64()}
        for batch in batches:
            out = []
            for value, label in zip(batch.column("text"), batch.column("label"), strict=True):
                grams, own = gram_numbers(value.as_py(), numbers), label.as_py()
                if len(grams):
                    best, n, mean, variance = best_score(grams, weights)
                    if languages[best] == own:
                        out.append({"label": own, "n": n, "mean": mean, "variance": variance})
            yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))

    held = rows.where(part == 0).select(F.col(text).alias("text"), F.col(label).alias("label"))
    measured = held.mapInArrow(measure, "label string, n long, mean double, variance double")
    # Of the spread of the means, what comes from few trigrams is counted by length.
    found = measured.groupBy("label").agg(
        F.avg("mean").alias("middle"),
        F.coalesce(F.var_pop("mean"), F.lit(0.0)).alias("all"),
        F.avg(F.col("variance") / F.col("n")).alias("short"),
        F.avg("variance").alias("within"),
    )
    limits = np.full((len(languages), 3), -np.inf)
    limits[:, 1:] = 0
    for r in found.collect():
        between = max(r["all"] - r["short"], 0.0)
        limits[languages.index(r["label"])] = r["middle"], between**0.5, r["within"] ** 0.5
    return LanguageModel(languages, model.weights, limits)


def reported(language: Column) -> Column:
    """``es`` and ``en`` are told apart; anything else, unknown included, is ``otro``."""
    return F.when(language.isin(*REPORTED), language).otherwise(F.lit(OTHER))


def detect(
    texts: DataFrame, text: str, usable: Column, model: LanguageModel, into: str = "idioma_det"
) -> DataFrame:
    """Add ``into`` to every row; unusable and too short texts are ``otro`` and not scored."""
    masked = F.when(usable & has_length(F.col(text), MIN_CHARS), F.col(text))
    return texts.withColumn(into, model.language(masked)).withColumn(into, reported(F.col(into)))
