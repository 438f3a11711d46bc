"""Quality classifier from overlapping heuristic labellers, without any given label."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmill.llm.common import drop, store
from jobmill.llm.encoder import give_back
from jobmill.llm.hashing import mix64, word_hashes

#: Documents the linear scorer is fitted on, at most.
SAMPLE = 8000
DIMENSIONS = 1 << 16
#: Low, since a clean document lost costs more than a poor one kept.
KEEP_AT = 0.25
#: Texts of fewer words get no vote from labellers of repetition and sentence marks.
FEWEST_WORDS = 8
EM_ROUNDS = 200
BAD, GOOD, NONE = 0, 1, 2
MEASURES = ("symbols", "capitals", "repeats", "variety", "pairs", "stops", "marks", "prose")
# A labeller votes bad beyond the first border and good beyond the second; between, it has no
# vote. Seven of them know only one fault, so they never vote good.
BORDERS = {
    "symbols": (0.03, None),
    "capitals": (0.4, None),
    "repeats": (0.2, None),
    "variety": (0.2, None),
    "pairs": (0.5, None),
    "stops": (0.02, None),
    "marks": (0.25, None),
    "prose": (0.9, 0.95),
}
HIGH_IS_GOOD = ("variety", "pairs", "stops", "prose")
# Bytes of ASCII marks that running text has little of.
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"


def measured(texts: pd.Series) -> tuple[np.ndarray, list[np.ndarray]]:
    """The measures of every text, one column each, and its distinct words' hashes."""
    words = word_hashes(texts)
    out = np.zeros((len(words), len(MEASURES) + 1))
    distinct = []
    for i, (text, w) in enumerate(zip(texts, words, strict=True)):
        own = np.unique(w)
        distinct.append(own)
        n = len(w)
        out[i, -1] = n
        if not n:
            continue
        counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        upper, letters = counts[65:91].sum(), counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()
        pairs = len(np.unique(mix64(w[:-1]) ^ w[1:])) / (n - 1) if n > 1 else 1.0
        repeats = float((w[1:] == w[:-1]).sum()) / n
        out[i, :-1] = (
            counts[list(SYMBOLS)].sum() / counts.sum(),
            upper / max(1, letters),
            repeats,
            len(own) / n,
            pairs,
            (counts[46] + counts[44]) / n,
            (counts[33] + counts[63]) / n,
            (letters + counts[9:14].sum() + counts[32]) / counts.sum(),
        )
    return out, distinct


def votes(measures: np.ndarray) -> np.ndarray:
    """Each labeller's vote on each text: 0 bad, 1 good, 2 none."""
    out = np.full((len(measures), len(MEASURES)), NONE)
    for j, name in enumerate(MEASURES):
        bad, good = BORDERS[name]
        x = measures[:, j]
        low = name in HIGH_IS_GOOD
        out[(x < bad) if low else (x > bad), j] = BAD
        if good is not None:
            out[(x > good) if low else (x < good), j] = GOOD
        if name in ("repeats", "variety", "pairs", "stops"):
            out[measures[:, -1] < FEWEST_WORDS, j] = NONE
    out[measures[:, -1] == 0] = NONE
    return out


def features(measures: np.ndarray, distinct: list[np.ndarray]) -> list[np.ndarray]:
    """Hashed features of every text: its distinct words and, for each measure, its step."""
    steps = np.minimum(15, (measures[:, :-1] * 16).astype(np.int64))
    fine = np.minimum(15, (measures[:, :-1] * 160).astype(np.int64))
    names = np.arange(len(MEASURES)) * 32
    out = []
    for i, own in enumerate(distinct):
        fixed = np.concatenate([names + steps[i], names + 16 + fine[i]])
        hashed = (own % np.uint64(DIMENSIONS - 1024)).astype(np.int64) + 1024
        out.append(np.concatenate([fixed, np.unique(hashed)]).astype(np.int32))
    return out


#: Share of the words' features in a score; those of the measures count one each.
def values(found: np.ndarray) -> np.ndarray:
    fixed = 2 * len(MEASURES)
    out = np.ones(len(found))
    out[fixed:] = 1 / max(1, len(found) - fixed)
    return out


def estimate(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Posterior of good for every pattern of votes, by expectation-maximisation.

    Each labeller has for each class its own probabilities of bad, good and no vote; votes
    are independent given the class. It begins at the share of good votes. Work and memory
    depend on the number of patterns, at most 3 to the number of labellers.
    """
    if not len(counts):
        return np.zeros(0)
    one = np.eye(3)[patterns]
    cast = (patterns != NONE).sum(1)
    good = ((patterns == GOOD).sum(1) + 1) / (cast + (patterns == BAD).sum(1) + 2)
    for _ in range(EM_ROUNDS):
        weight = np.stack([(1 - good) * counts, good * counts])
        prior = (weight.sum(1) + 1) / (counts.sum() + 2)
        chance = np.einsum("cp,pjv->cjv", weight, one) + 0.1
        chance /= chance.sum(2, keepdims=True)
        log = np.log(prior)[:, None] + np.einsum("pjv,cjv->cp", one, np.log(chance))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - good).max() < 1e-6:
            break
        good = new
    return good


def fit(found: list[np.ndarray], labels: np.ndarray, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Logistic regression with soft labels on hashed features: weights and bias."""
    weights, bias = np.zeros(DIMENSIONS), 0.0
    if not found:
        return weights, bias
    # A few hundred documents at a time: the driver holds their numbers, not those of all.
    parts = []
    for i in range(0, len(found), 512):
        some = found[i : i + 512]
        at = np.repeat(np.arange(len(some)), [len(x) for x in some])
        parts.append((slice(i, i + len(some)), np.concatenate(some), np.concatenate([values(x) for x in some]), at.astype(np.int16)))
    found_n = len(found)
    squares, bias_square = np.full(DIMENSIONS, 1e-3), 1e-3
    for _ in range(rounds):
        step, error = 1e-6 * weights, np.zeros(found_n)
        for rows, index, value, at in parts:
            z = np.bincount(at, weights[index] * value, rows.stop - rows.start) + bias
            error[rows] = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[rows]) / found_n
            step += np.bincount(index, error[rows][at] * value, DIMENSIONS)
        squares += step**2
        bias_square += error.sum() ** 2
        weights -= 0.5 * step / np.sqrt(squares)
        bias -= 0.5 * error.sum() / np.sqrt(bias_square)
    return weights, bias


def scorer(docs: DataFrame) -> Column:
    """A column with the score of ``text`` in 0 to 1, learned from all documents of ``docs``.

    The votes of all documents are counted by pattern of votes; the accuracies are estimated
    from these counts. The linear scorer is fitted on at most ``SAMPLE`` documents, the
    distinct texts of smallest hashes among those chosen by hash, with the posteriors of their votes as labels.
    """
    total = docs.count()
    every = max(1, -(-total // SAMPLE))
    sampled = docs.select("text", F.xxhash64("text").alias("hash"))

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                found, distinct = measured(part["text"])
                code = votes(found) @ 3 ** np.arange(len(MEASURES))
                first = ~part["hash"].duplicated().to_numpy() & ~part["hash"].isin(seen).to_numpy()
                chosen = (part["hash"].to_numpy() % every == 0) & first
                seen.update(part["hash"].to_numpy()[chosen].tolist())
                own = features(found[chosen], [d for d, c in zip(distinct, chosen, strict=True) if c])
                kept = iter(own)
                yield pd.DataFrame(
                    {"code": code, "hash": part["hash"].to_numpy(), "found": [next(kept) if c else None for c in chosen]}
                )
        give_back()

    voted = store(sampled.mapInPandas(vote, "code int, hash long, found array<int>"), "votes")
    counted = voted.groupBy("code").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("code")
    patterns = counted["code"].to_numpy()[:, None] // 3 ** np.arange(len(MEASURES)) % 3
    posterior = dict(zip(counted["code"], estimate(patterns, counted["n"].to_numpy(float)), strict=True))
    chosen = voted.where("found IS NOT NULL").dropDuplicates(["hash"]).orderBy("hash").limit(SAMPLE)
    rows = chosen.toPandas()
    drop(voted)
    weights, bias = fit([np.asarray(x) for x in rows["found"]], rows["code"].map(posterior).to_numpy(float))
    del rows
    give_back()
    model = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, b = model.value
        for texts in batches:
            out = np.empty(len(texts))
            for at in range(0, len(texts), 256):
                found, distinct = measured(texts.iloc[at : at + 256])
                for i, x in enumerate(features(found, distinct)):
                    out[at + i] = (w[x] * values(x)).sum() + b
            del texts
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -30, 30))))
        give_back()

    return run(F.col("text"))


def score(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, score, kept``.

    A document is kept at a score of ``KEEP_AT`` or more. Null and empty texts have no votes,
    and the score of a text with no words. Equal texts have equal scores. An empty table
    gives no rows; other columns take no part.
    """
    scored = docs.select("doc_id", scorer(docs).alias("score"))
    return scored.withColumn("kept", F.col("score") >= KEEP_AT)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; nothing is shuffled."""
    return docs.where(scorer(docs) >= KEEP_AT)
