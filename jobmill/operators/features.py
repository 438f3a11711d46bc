"""Term statistics and topic or cluster models on the token texts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmill.functions.batches import MOST_TOKENS, grams, list_sizes, runs
from jobmill.operators.nlp import stored

SEED = 42


def counted(lists: pa.Array, low: int, high: int, parts: pa.Array | None = None) -> pa.RecordBatch:
    """``term, n, n_docs`` of the token lists: occurrences of each n-gram and lists that hold it.

    With ``parts``, only n-grams of size ``high`` whose two runs of one token less are among them.
    """
    found, row = grams(lists, low, high) if parts is None else grams_of(lists, high, parts)
    coded = found.dictionary_encode()
    terms, at = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
    pairs = np.sort(row * len(terms) + at)
    once = pairs[np.diff(pairs, prepend=-1) > 0]
    n = np.bincount(at, minlength=len(terms))
    n_docs = np.bincount(once % max(len(terms), 1), minlength=len(terms))
    return pa.RecordBatch.from_arrays(
        [terms.cast(pa.string()), pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())], names=["term", "n", "n_docs"]
    )


def grams_of(lists: pa.Array, size: int, parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The n-grams of a size whose first and last ``size - 1`` tokens are both among ``parts``, and their lists."""
    found, row = grams(lists, size, size)
    if not len(found):
        return found, row
    shorter, at = grams(lists, size - 1, size - 1)
    known = np.asarray(pc.is_in(shorter, value_set=parts))
    # A list's runs of one token less are one more than its n-grams: each n-gram has one and the next.
    follows = np.flatnonzero(at[:-1] == at[1:])
    both = np.flatnonzero(known[follows] & known[follows + 1])
    return found.take(pa.array(both)), row[both]


def term_counts(df: DataFrame, tokens: str, low: int = 1, high: int = 1, parts: list[str] | None = None) -> DataFrame:
    """Occurrences and document count of each n-gram, with one shuffle.

    A worker counts the n-grams of whole texts, ``MOST_TOKENS`` tokens at a time; the counts
    are summed per term, first in the task, so no (text, term) pair is moved. For ``parts``
    see ``counted``.
    """
    among = None if parts is None else pa.array(parts, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            for start, n in runs(list_sizes(lists), MOST_TOKENS):
                yield counted(lists.slice(start, n), low, high, among)

    rows = df.select(tokens).mapInArrow(count, "term string, n long, n_docs long")
    return rows.groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def top_terms(counts: DataFrame, k: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), "term").limit(k)


def frequent_terms(df: DataFrame, tokens: str, high: int, k: int) -> list:
    """The ``k`` most frequent n-grams of 1 to ``high`` tokens, as ``top_terms`` of all ``term_counts`` has them.

    An n-gram is not more frequent than its parts. So once ``k`` shorter ones are known, only
    n-grams whose parts are as frequent as the last of these are counted: any other is less
    frequent than ``k`` terms. Where very many parts are equally frequent, or tokens are null, empty
    or hold a blank, all are counted. At most ``4 * k`` terms a size reach the driver.
    """
    place = lambda r: (-r["n"], r["term"])
    rows = df.select(F.transform(tokens, lambda t: F.coalesce(t, F.lit(""))).alias("tokens"))
    single = stored(term_counts(rows, "tokens"), "terms")
    if high > 1 and not single.where((F.col("term") == "") | F.contains("term", F.lit(" "))).isEmpty():
        return top_terms(term_counts(df, tokens, 1, high), k).collect()
    kept, found = [], top_terms(single, 4 * k + 1).collect()
    for size in range(1, high + 1):
        kept = sorted([*kept, *found], key=place)[:k]
        if size == high:
            break
        least = kept[-1]["n"] if len(kept) == k else 0
        parts = [r["term"] for r in found if r["n"] >= least]
        all_known = least > 0 and len(parts) <= 4 * k
        counts = term_counts(rows, "tokens", size + 1, size + 1, parts if all_known else None)
        found = top_terms(counts, 4 * k + 1).collect()
    return kept


def weights(lists: pa.Array, kept: pa.Array, idf: np.ndarray, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the lists and of their terms among ``kept``, and the weights: ``tf * idf``, scaled to length 1 per list."""
    found, row = grams(lists, 1, high)
    at = pc.index_in(found.cast(pa.string()), value_set=kept)
    known = np.asarray(at.is_valid())
    pairs, tf = np.unique(row[known] * len(kept) + np.asarray(at.drop_null()), return_counts=True)
    row, term = pairs // len(kept), pairs % len(kept)
    weight = tf * idf[term]
    length = np.sqrt(np.bincount(row, weight**2, minlength=len(lists)))
    return row, term, weight / length[row]


def vocabulary_terms(df: DataFrame, tokens: str, high: int, vocabulary: int) -> tuple[list, pa.Array, np.ndarray]:
    """The ``vocabulary`` most frequent n-grams, their terms, and their ``idf``.

    ``idf = ln((1 + documents) / (1 + documents with the term)) + 1``. Only these bounded rows reach the driver.
    """
    kept = frequent_terms(df, tokens, high, vocabulary)
    documents = df.count() if kept else 0
    idf = [math.log((documents + 1.0) / (r["n_docs"] + 1.0)) + 1.0 for r in kept]
    return kept, pa.array([r["term"] for r in kept], pa.string()), np.array(idf)


def tfidf_top(df: DataFrame, tokens: str, high: int = 3, vocabulary: int = 5000) -> DataFrame:
    """Terms of the ``vocabulary`` most frequent n-grams by total L2-normalised tf-idf: ``term, n, n_docs, tfidf``.

    A task adds up the weights of its texts and sends one total per term, so no (text, term)
    pair is shuffled. Only the vocabulary, which is bounded, and its totals reach the driver.
    """
    kept, terms, idf = vocabulary_terms(df, tokens, high, vocabulary)
    if not kept:
        return df.sparkSession.createDataFrame([], "term string, n long, n_docs long, tfidf double")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms))
        for batch in batches:
            lists = batch.column(0)
            for start, n in runs(list_sizes(lists), MOST_TOKENS):
                _, term, weight = weights(lists.slice(start, n), terms, idf, high)
                total += np.bincount(term, weight, minlength=len(terms))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(terms))), pa.array(total)], names=["at", "total"])

    added = df.select(tokens).mapInArrow(add, "at long, total double").groupBy("at").agg(F.sum("total").alias("total"))
    totals = {r["at"]: r["total"] for r in added.collect()}
    found = [(r["term"], r["n"], r["n_docs"], round(totals[i], 6)) for i, r in enumerate(kept)]
    return df.sparkSession.createDataFrame(found, "term string, n long, n_docs long, tfidf double")


def tfidf_matrix(df: DataFrame, row_id: str, tokens: str, high: int = 3, vocabulary: int = 5000) -> DataFrame:
    """``row_id, term, weight``: every text's weights over the vocabulary, one row per text and term.

    Texts without a term of the vocabulary have no rows. A worker weighs ``MOST_TOKENS`` tokens at a time.
    """
    kept, terms, idf = vocabulary_terms(df, tokens, high, vocabulary)
    schema = df.select(row_id).schema.add("term", "string").add("weight", "double")
    if not kept:
        return df.sparkSession.createDataFrame([], schema)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.columns
            for start, n in runs(list_sizes(lists), MOST_TOKENS):
                row, term, weight = weights(lists.slice(start, n), terms, idf, high)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row + start)), terms.take(pa.array(term)), pa.array(weight)],
                    names=[row_id, "term", "weight"],
                )

    rows = df.select(row_id, tokens).mapInArrow(weigh, schema)
    return rows.withColumn("weight", F.round("weight", 6))


def lda_topics(df: DataFrame, tokens: str, topics: int = 10, vocabulary: int = 3000, words: int = 10, rounds: int = 10) -> DataFrame:
    """Heaviest words of each topic: ``topic, rank, term, weight``.

    Vectors are stored, so rounds read numbers and don't count tokens again.
    """
    counter = CountVectorizer(inputCol=tokens, outputCol="features", vocabSize=vocabulary).fit(df)
    vectors = stored(counter.transform(df).select("features"), "topic-vectors")
    model = LDA(k=topics, maxIter=rounds, seed=SEED, featuresCol="features").fit(vectors)
    terms = F.array(*[F.lit(t) for t in counter.vocabulary])
    pairs = F.arrays_zip("termIndices", "termWeights")
    return model.describeTopics(words).select("topic", F.posexplode(pairs)).select(
        "topic",
        (F.col("pos") + 1).alias("rank"),
        F.get(terms, F.col("col.termIndices")).alias("term"),
        F.col("col.termWeights").alias("weight"),
    )


def cosine_clusters(vectors: DataFrame, row_id: str, vector: str, k: int = 10, rounds: int = 20) -> DataFrame:
    """Cluster number of every vector by cosine K-means."""
    rows = vectors.select(row_id, array_to_vector(F.col(vector)).alias("features"))
    model = KMeans(k=k, seed=SEED, maxIter=rounds, distanceMeasure="cosine", featuresCol="features").fit(rows)
    return model.transform(rows).select(row_id, F.col("prediction").alias("cluster"))
