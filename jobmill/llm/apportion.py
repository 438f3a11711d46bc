"""Highest-quotient apportionment and the mixing of sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobmill.llm.common import attach, free_name, n_words, store

BLOCK_WORDS = 64
WEIGHTS = (3, 1, 2)
SEED = "mix-1"
#: A shard holds at least so many documents, and there are about so many shards at most.
SHARD_DOCS, MAX_SHARDS = 512, 4096


def sainte_lague(votes: DataFrame, group: Sequence[str], key: str, vote: str, seats: str) -> DataFrame:
    """``votes`` with ``quota``: the seats of each row when every group deals its ``seats``
    (the same on all its rows) to the highest quotients ``vote / (2 k + 1)``.

    With S rows and N seats a row's quota lies within ``q (1 -+ S / 2N) -+ 1/2`` of its share
    ``q``, so only these quotients, fewer than ``4 S`` a group, are made and ranked; the
    seats below are certain. Equal quotients go to the smaller key. Groups without votes
    or seats get none.
    """
    of = W.partitionBy(*group)
    share = F.try_divide(F.col(vote) * F.col(seats), F.col("_votes"))
    slack = F.try_divide(F.col("_rows"), 2 * F.col(seats))
    ranged = votes.withColumns(
        {"_votes": F.sum(vote).over(of).cast("double"), "_rows": F.count(F.lit(1)).over(of)}
    ).withColumns(
        {
            "_low": F.greatest(F.lit(0), F.floor(share * (1 - slack) - 0.5) - 1).cast("long"),
            "_high": (F.ceil(share * (1 + slack) + 0.5) + 1).cast("long"),
        }
    )
    open_seats = F.col(seats) - F.sum("_low").over(of)
    real = (F.col("_votes") > 0) & (F.col(seats) > 0)
    quotients = (
        ranged.where(real)
        .withColumn("_open", open_seats)
        .select(*group, key, vote, "_open", F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_k"))
        .withColumn("_quotient", F.col(vote) / (2 * F.col("_k") + 1))
    )
    ranks = F.row_number().over(of.orderBy(F.desc("_quotient"), key, "_k"))
    won = (
        quotients.withColumn("_rank", ranks)
        .where(F.col("_rank") <= F.col("_open"))
        .groupBy(*group, key)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    out = ranged.join(won, [*group, key], "left")
    quota = F.when(real, F.col("_low") + F.coalesce("_won", F.lit(0))).otherwise(F.lit(0))
    return out.withColumn("quota", quota.cast("long")).drop("_votes", "_rows", "_low", "_high", "_won")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``sizes`` (``source, source_size``, a row per source) with ``src`` (place of the source
    by code point, null last), ``weight``, ``target`` and ``total``.

    All sources share 150 % of all words by weight; a target stops at twice its source's
    words and the excess is shared again. Sources sorted by ``2 size / weight`` reach their
    stop in that order, so the stopped ones are a prefix, found with integers only.
    One row per source of the mixture is all that meets here.
    """
    everything = W.partitionBy(F.lit(0))
    ranked = sizes.withColumn("src", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())))
    dealt = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("src") - 1, len(weights)) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": dealt.cast("long"), "total": F.sum("source_size").over(everything)})
    order = everything.orderBy(F.col("source_size") / F.col("weight"), "src")
    upto = order.rowsBetween(W.unboundedPreceding, -1)
    cap = 2 * F.col("source_size")
    steps = ranked.withColumns(
        {
            "_caps": F.coalesce(F.sum(cap).over(upto), F.lit(0)),
            "_weights": F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)),
        }
    ).withColumn(
        "_stops",
        2 * cap * F.col("_weights") <= F.col("weight") * (3 * F.col("total") - 2 * F.col("_caps")),
    )
    shared = steps.withColumns(
        {
            "_spent": F.sum(F.when(F.col("_stops"), cap).otherwise(0)).over(everything),
            "_open": F.sum(F.when(F.col("_stops"), 0).otherwise(F.col("weight"))).over(everything),
        }
    )
    words = (F.col("weight") * (3 * F.col("total") - 2 * F.col("_spent"))).cast("double")
    share = F.try_divide(words, 2 * F.col("_open"))
    target = F.when(F.col("_stops"), cap.cast("double")).otherwise(share)
    return shared.select("source", "source_size", "n_docs", "src", "weight", target.alias("target"), "total")


def hash_number(*parts: Column) -> Column:
    """A number below 2^32 of the parts, the same in every engine that has md5."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("long")


def overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    block: int = BLOCK_WORDS,
    seed: str = SEED,
    keep: Sequence[str] = ("doc_id", "source"),
) -> DataFrame:
    """One row per document with ``size, source_size, target, taken`` and the columns ``keep``.

    The mixture has 1.5 times all words, in blocks of ``block`` words. Highest quotients of
    the targets give every source a number of blocks, and highest quotients of the shards'
    sizes give every shard its part. In a shard the documents lie in seeded order on a ring;
    its blocks are as many whole turns as fit and one run that begins at a seeded block. So a
    document is taken at most twice, in part at the two ends of a run.

    Null and empty texts have size 0 and are taken 0 times; null is a source of its own;
    repeated rows are separate documents. Only id, source and size are shuffled. A shard is
    one task's work: 512 documents, or 1/4096 of all, so no source meets in one task.
    """
    narrow = store(docs.select(*keep, n_words(F.col("text")).alias("size")), "sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = source_targets(sizes, weights)
    seats = F.floor((3 * F.col("total") + block) / (2 * block)).cast("long")
    dealt = sainte_lague(targets.withColumns({"_all": F.lit(0), "_seats": seats}), ["_all"], "src", "target", "_seats")
    sources = store(dealt.withColumnRenamed("quota", "source_quota").drop("_all", "_seats"), "sources")
    n = narrow.count()
    per_shard = max(SHARD_DOCS, -(-n // MAX_SHARDS))
    shards = F.ceil(F.col("n_docs") / per_shard)
    rows = attach(narrow, sources.drop("total", "weight"), ["source"], "n_docs", n).withColumn(
        "shard", F.pmod(hash_number(F.lit(seed), F.col("doc_id")), shards).cast("int")
    )
    by_shard = rows.groupBy("src", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota")
    )
    quotas = sainte_lague(by_shard, ["src"], "shard", "shard_size", "source_quota").select(
        "src", "shard", "shard_size", "quota"
    )
    placed = rows.drop("source_quota").join(quotas, ["src", "shard"])
    order = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    ring = W.partitionBy("src", "shard").orderBy("_order", "size")
    end = F.sum("size").over(ring.rowsBetween(W.unboundedPreceding, 0))
    z = F.col("shard_size")
    words = F.least(F.col("quota") * block, 2 * z)
    turn = F.greatest(z, F.lit(1))
    blocks = F.ceil(turn / block)
    first = F.pmod(hash_number(F.lit(seed), F.lit("start"), F.col("src"), F.col("shard")), blocks) * block
    run = placed.withColumn("_order", order).withColumns(
        {
            "_end": end,
            "_turns": F.floor(words / turn),
            "_rest": F.pmod(words, turn),
            "_first": first,
        }
    )
    start, stop = F.col("_end") - F.col("size"), F.col("_end")
    part = overlap(start, stop, F.col("_first"), F.col("_first") + F.col("_rest")) + overlap(
        start, stop, F.lit(0), F.col("_first") + F.col("_rest") - z
    )
    taken = F.when(z > 0, F.col("_turns") * F.col("size") + part).otherwise(F.lit(0))
    return run.select(*keep, "size", "source_size", "target", taken.cast("long").alias("taken"), "src", "shard")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mixture, with all their columns: each row as often as the words
    taken make up its size, rounded, so at most twice.

    Only id, source, size and number of copies meet the documents. Rows that share these
    three share the copies: each gets the rounded mean.
    """
    rows = mix(docs)
    part = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(F.lit(0))
    copies = rows.groupBy(*[F.col(c).alias("_mix_" + c) for c in ("doc_id", "source", "size")]).agg(
        F.round(F.avg(part)).cast("int").alias("_copies")
    ).where("_copies > 0")
    on = (
        docs["doc_id"].eqNullSafe(copies["_mix_doc_id"])
        & docs["source"].eqNullSafe(copies["_mix_source"])
        & (n_words(docs["text"]) == copies["_mix_size"])
    )
    chosen = docs.join(copies, on)
    copy = free_name(docs, "_copy")
    again = F.explode(F.sequence(F.lit(1), copies["_copies"])).alias(copy)
    return chosen.select(*[docs[c] for c in docs.columns], again).select(*docs.columns)
