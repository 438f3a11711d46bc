"""Sharding by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobmill.llm.apportion import hash_number
from jobmill.llm.common import store

SLOTS = 4096
SHARDS = 40
OVERHEAD = 16


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """A stored table ``doc_id, size, text_crc32, virtual_slot`` of all documents.

    A null text has no bytes and the check sum of none, 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    crc = F.crc32(F.encode(text, "UTF-8"))
    rows = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), crc.alias("text_crc32"))
    slot = F.pmod(hash_number(F.col("doc_id"), F.col("text_crc32")), F.lit(slots)).cast("int")
    return store(rows.withColumn("virtual_slot", slot), "sized")


def slot_loads(rows: DataFrame) -> DataFrame:
    """Bytes and rows of every slot that has rows (at most ``SLOTS`` rows)."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def first_map(spark: SparkSession, loads: DataFrame, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Version 1: slots dealt round the shards; with each slot's bytes and rows."""
    dealt = spark.range(slots).select(
        F.lit(1).alias("version"),
        F.col("id").cast("int").alias("virtual_slot"),
        F.pmod("id", F.lit(shards)).cast("int").alias("shard"),
    )
    return dealt.join(loads, "virtual_slot", "left").na.fill(0, ["bytes", "n_rows"])


def rebalance(slot_map: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of the map: shards of near equal bytes, most slots where they were.

    A shard keeps its largest slots up to the mean load and gives up the rest. The slots
    given up, largest first, go one by one to the shard with the fewest bytes (the lowest
    number on ties). The map has a fixed number of rows, whatever the data: they meet as one
    array, and nothing else does.
    """
    own = W.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(W.unboundedPreceding, 0)
    mean = F.sum("bytes").over(W.partitionBy("version")) / shards
    marked = slot_map.withColumns({"_upto": F.sum("bytes").over(own), "_mean": mean}).withColumn(
        "_stays", F.col("_upto") <= F.col("_mean")
    )
    item = F.struct((-F.col("bytes")).alias("minus"), "virtual_slot")
    state = marked.agg(
        F.array(
            *[F.coalesce(F.sum(F.when(F.col("_stays") & (F.col("shard") == i), F.col("bytes"))), F.lit(0)) for i in range(shards)]
        ).alias("_loads"),
        F.sort_array(F.collect_list(F.when(~F.col("_stays"), item))).alias("_pool"),
    )

    def deal(acc: Column, slot: Column) -> Column:
        loads = acc["loads"]
        to = F.array_position(loads, F.array_min(loads)) - 1
        more = F.transform(loads, lambda x, i: F.when(i == to, x - slot["minus"]).otherwise(x))
        placed = F.struct(slot["virtual_slot"].alias("virtual_slot"), to.cast("int").alias("to"))
        return F.struct(more.alias("loads"), F.concat(acc["placed"], F.array(placed)).alias("placed"))

    none = F.expr("cast(array() AS array<struct<virtual_slot: int, to: int>>)")
    dealt = state.select(
        F.explode(
            F.aggregate("_pool", F.struct(F.col("_loads").alias("loads"), none.alias("placed")), deal)["placed"]
        ).alias("_moved")
    ).select("_moved.*")
    return marked.join(dealt, "virtual_slot", "left").select(
        (F.col("version") + 1).alias("version"),
        "virtual_slot",
        F.coalesce("to", "shard").alias("shard"),
        "bytes",
        "n_rows",
    )


def grow(slot_map: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version with one shard more, which alone takes slots: from each shard its
    smallest ones, as far as they hold its part of the load."""
    own = W.partitionBy("shard")
    upto = F.sum("bytes").over(own.orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(W.unboundedPreceding, 0))
    leaves = upto > F.sum("bytes").over(own) * shards / (shards + 1)
    return slot_map.withColumns({"version": F.col("version") + 1, "_leaves": leaves}).withColumn(
        "shard", F.when(F.col("_leaves"), F.lit(shards)).otherwise(F.col("shard"))
    ).drop("_leaves")


def balanced_map(rows: DataFrame, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Both versions of the map, stored: ``version, virtual_slot, shard, bytes, n_rows``."""
    first = first_map(rows.sparkSession, slot_loads(rows), slots, shards)
    first = store(first, "slot-map")
    return store(first.unionByName(rebalance(first, shards)), "slot-maps")


def shard(docs: DataFrame, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and its
    ``virtual_slot``; law ``bytes``: shards have near equal sizes.

    Id and check sum choose one of ``slots`` virtual slots, so rows that repeat an id do not
    all meet. ``slot`` is the row's place in its shard: rows are ranked inside their virtual
    slot only, and the slots' row counts (a fixed number of them, broadcast) give where each
    begins. Null ids and texts are ordinary values; equal rows get places in any order. An
    empty table gives no rows.
    """
    rows = sized(docs, slots)
    newest = balanced_map(rows, slots, shards).where("version = 2")
    begins = F.sum("n_rows").over(W.partitionBy("shard").orderBy("virtual_slot")) - F.col("n_rows")
    known = F.broadcast(newest.select("virtual_slot", "shard", begins.alias("_begins")))
    inside = F.row_number().over(W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return rows.withColumn("_inside", inside - 1).join(known, "virtual_slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_begins") + F.col("_inside")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
