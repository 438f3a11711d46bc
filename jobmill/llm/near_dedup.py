"""Near duplicates by one-permutation MinHash, banded buckets and star-shaped candidate edges."""

from __future__ import annotations

import operator
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmill.llm.common import attach, drop, numbered, store
from jobmill.llm.encoder import give_back
from jobmill.llm.hashing import mix64, word_hashes

SHINGLE = 5
#: Links have ``100 * shared >= percent * union``: of the query, and of the pipeline's stage.
PERCENT, STAGE_PERCENT = 85, 80
#: Bands and bins of each for a threshold. 48 bands of 8: a pair at 0.85 shares no band with
#: probability 2e-7, a pair at 0.5 shares one with probability 0.17, a pair at 0.3 with 0.003.
#: 66 bands of 7: a pair at 0.8 shares none with probability 2e-7, a pair at 0.5 one with 0.40.
BANDS = {85: (48, 8), 80: (66, 7)}
STAR_ROUNDS = 4
PROBES = 64
#: Ids of documents in shared buckets, at most, that are broadcast to find their texts; some 16 MB.
#: More are joined.
MOST_WANTED = 500_000
#: Longs of a set's parity bits.
PARITY_LONGS = 16


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of one text's word hashes."""
    if len(words) == 0:
        return words
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, np.uint64(width))
    for i in range(width):
        mixed = mix64(mixed ^ words[i : i + n])
    return np.unique(mixed)


@lru_cache(maxsize=2)
def probes(n: int) -> np.ndarray:
    """For every one of ``n`` bins the bins it tries, in order, when it is empty."""
    rng = np.random.default_rng(20)
    return rng.integers(0, n, (PROBES, n))


def signature(hashes: np.ndarray, n: int) -> np.ndarray:
    """One-permutation MinHash: the hash's upper half chooses the bin, the smallest hash of a bin stays.

    An empty bin copies the first filled bin of its own list of random bins, the same list
    for every text (optimal densification); if the whole list is empty, the next filled bin.
    """
    bins = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    filled, first = np.unique(bins.astype(np.int64), return_index=True)
    out = np.zeros(n, np.uint64)
    full = np.zeros(n, bool)
    out[filled] = hashes[first]
    full[filled] = True
    empty = np.flatnonzero(~full)
    table = probes(n)
    for t in range(PROBES):
        if not len(empty):
            return out
        tried = table[t, empty]
        hit = full[tried]
        out[empty[hit]] = out[tried[hit]]
        empty = empty[~hit]
    if len(empty):
        after = filled[np.searchsorted(filled, empty) % len(filled)]
        out[empty] = out[after]
    return out


def band_keys(sign: np.ndarray, width: int) -> np.ndarray:
    rows = sign.reshape(-1, width)
    key = np.arange(len(rows), dtype=np.uint64)
    for i in range(width):
        key = mix64(key ^ rows[:, i])
    return key.view(np.int64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """One bit for each of 1,024 parts of the hashes: whether the part holds an odd number of them.

    Every hash that only one of two sets has changes one bit, so the bits in which two sets
    differ are never more than the hashes in which they differ.
    """
    parts = PARITY_LONGS * 64
    odd = np.bincount((hashes % np.uint64(parts)).astype(np.int64), minlength=parts) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def may_link(size: Column, bits: str, other_size: Column, other_bits: str, percent: int) -> Column:
    """Whether two sets can be similar enough: a link is ``(100 - percent) * sizes >= (100 + percent)
    * differing``, and the differing bits are a lower bound of the differing hashes."""
    differ = reduce(
        operator.add, (F.bit_count(F.col(bits)[i].bitwiseXOR(F.col(other_bits)[i])) for i in range(PARITY_LONGS))
    )
    return (100 + percent) * differ <= (100 - percent) * (size + other_size)


def sketch_batches(percent: int):
    """A function that sketches texts with the bands of a threshold."""
    bands, width = BANDS[percent]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                rows = []
                for words in word_hashes(part["text"]):
                    found = shingle_set(words)
                    if len(found):
                        a, b = mix64(found).sum(dtype=np.uint64), mix64(~found).sum(dtype=np.uint64)
                        keys = band_keys(signature(found, bands * width), width)
                        rows.append((len(found), a.view(np.int64), b.view(np.int64), keys))
                    else:
                        rows.append((0, 0, 0, None))
                n, a, b, keys = zip(*rows, strict=True)
                yield pd.DataFrame({"doc_id": part["doc_id"].array, "n_shingles": n, "set_a": a, "set_b": b, "bands": keys})
        give_back()

    return run


def set_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.iloc[at : at + 256]
            sets = [shingle_set(words) for words in word_hashes(part["text"])]
            bits = [parity(x) for x in sets]
            sets = [x.view(np.int64) for x in sets]
            yield pd.DataFrame({"doc_id": part["doc_id"].array, "shingles": sets, "bits": bits})
    give_back()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole shingle sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_right"))
    shared = F.size(F.array_intersect("_left", "_right"))
    union = F.size("_left") + F.size("_right") - shared
    both = pairs.join(left, "a").join(right, "b")
    # Sets of too different sizes need no look.
    small, large = F.least(F.size("_left"), F.size("_right")), F.greatest(F.size("_left"), F.size("_right"))
    return both.where((100 * small >= percent * large) & (100 * shared >= percent * union)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``doc_id, label`` of every linked document: the smallest id it reaches.

    Labels spread to neighbours and then jump to the label's own label, so the rounds grow
    with the logarithm of a chain. Only ids move; every round is a stored table.
    """
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = store(edges.distinct(), "edges")
    labels = store(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = labels.select(F.col("a").alias("b"), F.col("label").alias("_near"))
        best = edges.join(near, "b").groupBy("a").agg(F.min("_near").alias("_best"))
        spread = labels.join(best, "a").select("a", "label", F.least("label", "_best").alias("_next"))
        jump = labels.select(F.col("a").alias("_next"), F.col("label").alias("_jump"))
        moved = store(
            spread.join(jump, "_next").select(
                "a", F.least("_next", "_jump").alias("label"), (F.least("_next", "_jump") < F.col("label")).alias("moved")
            ),
            "labels",
        )
        drop(labels)
        labels = moved.select("a", "label")
        if moved.where("moved").isEmpty():
            drop(edges)
            return labels.withColumnRenamed("a", "doc_id")


def own_parts(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """``doc_id, own, shared, bits``: how many shingles of a document no other of ``docs`` has, the
    rest, and the parity bits of all."""
    some = sets.join(docs, "doc_id", "left_semi")
    counted = some.select("doc_id", F.explode("shingles").alias("_s")).groupBy("_s").agg(
        F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("doc_id")
    )
    own = counted.where("_n = 1").groupBy("doc_id").agg(F.count(F.lit(1)).alias("own"))
    sizes = some.select("doc_id", F.size("shingles").alias("_size"), "bits")
    number = F.coalesce("own", F.lit(0))
    return sizes.join(own, "doc_id", "left").select(
        "doc_id", number.alias("own"), (F.col("_size") - number).alias("shared"), "bits"
    )


def linked(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join all documents of a component, as a table ``a, b``.

    ``members`` has the rows ``bucket, doc_id`` of buckets with two documents or more. First a
    star joins each bucket's smallest id to its other documents. A bucket that then holds
    several components chooses in each round one document of each, by a hash of round and
    bucket, and a star joins it to the documents of the other components. What is in one
    component needs no more pairs. After the star rounds, the pairs across components that no
    star has held are made, so that no link between components is lost.

    Many changed copies of one text may meet in a bucket without a link. Shingles that a
    document shares with no other still unsettled one lie outside every intersection: a link
    needs ``own_a + own_b <= rest / percent * min(shared_a, shared_b)`` with ``rest = 100 -
    percent``. So two documents that are both *heavy*, ``own > rest / (2 * percent) * shared``,
    cannot be linked, and only pairs with a light document are looked at. The join makes those of them alone that the parity bits leave open.
    """
    spark = members.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    tried = spark.createDataFrame([], "a long, b long")
    label = members.select("doc_id", F.col("doc_id").alias("label")).distinct()
    rest = 100 - percent
    stored_: list[DataFrame] = []

    def ends(stars: DataFrame) -> DataFrame:
        return stars.select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b"))

    for turn in range(STAR_ROUNDS + 1):
        if turn == 0:
            first = members.groupBy("bucket").agg(F.min("doc_id").alias("centre"))
            pairs = ends(members.join(first, "bucket").where("doc_id <> centre"))
        else:
            known = members.join(label, "doc_id")
            span = known.groupBy("bucket").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"))
            known = known.join(span.where("_lo < _hi").select("bucket"), "bucket", "left_semi")
            if turn == 1:
                parts = store(own_parts(known.select("doc_id").distinct(), sets), "parts")
                stored_.append(parts)
            known = known.join(parts, "doc_id").where(percent * F.col("own") <= rest * F.col("shared"))
            known = known.withColumn("light", 2 * percent * F.col("own") <= rest * F.col("shared"))
            known = store(known, f"unsettled{turn}")
            stored_.append(known)
            facts = [F.col(c).alias("_" + c) for c in ("label", "light", "own", "shared", "bits")]
            centres = known.select("bucket", *facts, F.col("doc_id").alias("centre"))
            if turn < STAR_ROUNDS:
                order = F.struct(~F.col("_light"), F.xxhash64(F.lit(turn), "bucket", "centre"))
                chosen = centres.groupBy("bucket", "_label").agg(
                    F.min_by(F.struct("centre", "_light", "_own", "_shared", "_bits"), order).alias("_c")
                )
                centres = chosen.select("bucket", "_label", "_c.*")
            fit = percent * (F.col("own") + F.col("_own")) <= rest * F.least("shared", "_shared")
            size, other = F.col("own") + F.col("shared"), F.col("_own") + F.col("_shared")
            fit = fit & (F.col("label") != F.col("_label")) & may_link(size, "bits", other, "_bits", percent)
            stars = known.join(centres.where("_light"), "bucket").unionByName(
                known.where("light").join(centres.where("NOT _light"), "bucket")
            )
            pairs = ends(stars.where(fit))
        pairs = store(pairs.distinct().join(tried, ["a", "b"], "left_anti"), f"pairs{turn}")
        if turn and pairs.isEmpty():
            continue
        found = store(confirmed(pairs, sets, percent), f"links{turn}")
        tried = tried.unionByName(pairs)
        if not found.isEmpty():
            links = links.unionByName(found)
            label = members.select("doc_id").distinct().join(components(links), "doc_id", "left").select(
                "doc_id", F.coalesce("label", "doc_id").alias("label")
            )
    drop(*stored_)
    return links


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when their sets of five-word shingles share ``percent`` % of the union;
    ``component_id`` is the smallest id reachable over links, and that document is kept.
    Null and empty texts have no shingles and stand alone. Rows without an id, or with an
    id that repeats, are treated like others; of rows that share an id all get its fate.
    Documents with equal sets become one class first, so copies make no pairs. An empty
    table gives no rows; other columns take no part.

    The texts are read twice: for the sketches, and for the full sets of those documents
    that share a bucket. Sets are compared by 64-bit hashes of their shingles.
    """
    named = docs.select("doc_id", "text")
    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
    sketches = store(named.mapInPandas(sketch_batches(percent), schema), "sketches")
    total = sketches.count()
    key = ["n_shingles", "set_a", "set_b"]
    classes = store(
        sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*key)
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
        "classes",
    )
    chosen = sketches.join(classes.withColumnRenamed("rep", "doc_id"), [*key, "doc_id"], "left_semi")
    banded = chosen.select("doc_id", F.explode(F.array_distinct("bands")).alias("bucket")).distinct()
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    sizes = store(sizes, "buckets")
    members = store(banded.join(sizes.select("bucket"), "bucket", "left_semi"), "members")
    wanted = store(members.select("doc_id").distinct(), "wanted")
    if wanted.count() <= MOST_WANTED:
        wanted = F.broadcast(wanted)  # the texts stay where they are
    schema = "doc_id long, shingles array<long>, bits array<long>"
    sets = store(named.join(wanted, "doc_id", "left_semi").mapInPandas(set_batches, schema), "sets")
    if sets.count() > sets.select("doc_id").distinct().count():
        sets = store(sets.distinct(), "sets")  # rows that repeat an id and its text
    links = linked(members, sets, percent)
    label = components(links)
    final = classes.join(label.withColumnRenamed("doc_id", "rep"), "rep", "left").select(
        *key, "copies", F.coalesce("label", "rep").alias("component_id")
    )
    final = store(final, "final")
    drop(members, sizes, sets, wanted, classes)
    none = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    alone = sketches.where(none).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    rows = attach(sketches.where(~none), final, key, "copies", total).select("doc_id", "n_shingles", "component_id")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return rows.unionByName(alone).withColumn("kept", kept)


def keep_one(docs: DataFrame, percent: int = STAGE_PERCENT) -> DataFrame:
    """The documents that stay, with all their columns: one row of every group of linked texts.

    The rows are stored with a number, which stands for the id while groups are made. Of a
    group the row with the smallest id stays, one without an id only where no row has one.
    Rows without shingles stand alone and stay. Only numbers and ids meet the documents.
    """
    stored, number = numbered(docs)
    groups = near_groups(stored.select(F.col(number).alias("doc_id"), "text"), percent).select(
        F.col("doc_id").alias("_row"), "component_id"
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), F.col("doc_id"), F.col("_row")))
    kept = groups.join(stored.select(F.col(number).alias("_row"), "doc_id"), "_row").groupBy("component_id").agg(first.alias("_first"))
    return stored.join(kept.select(F.col("_first._row").alias(number)), number, "left_semi").select(*docs.columns)
