"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobmill.llm.common import BLANKS, attach, drop, numbered, places, store

BLOCK_CHARS = 4096
#: Blocks sorted in one task; a task of blocks of 4,096 characters then sorts some 80 MB.
PER_PLACE = 20_000


def normalised(text: Column) -> Column:
    """Every run of blanks as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def sort_names(df: DataFrame, key: Column, hashed: Column, spread: Column, purpose: str) -> DataFrame:
    """A stored copy of ``df`` with ``name``: an integer that is equal exactly where ``key`` is.

    Keys are sorted inside their place, and rank and place make the name. The rows of a hot
    key are sorted in several places; one row of each then meets the others by the key
    itself, and at most ``2 / HOT_SHARE`` such names are replaced by the smallest.
    """
    placed, n = places(df.withColumn("_key", key), hashed, spread, PER_PLACE)
    by_key = W.partitionBy("_place").orderBy("_key")
    before = F.lag("_key").over(by_key)
    ranked = placed.withColumns({"_rank": F.dense_rank().over(by_key), "_before": before})
    named = ranked.withColumns(
        {
            "name": F.col("_rank").cast("long") * n + F.col("_place"),
            "_rep": F.when(F.col("_hot") & ~F.col("_key").eqNullSafe(F.col("_before")), F.col("_key")),
        }
    )
    kept = [c for c in df.columns if c not in ("_block",)]
    stored = store(named.select(*kept, "name", "_rep", "_hot"), purpose)
    reps = stored.where(F.col("_rep").isNotNull())
    one = reps.groupBy("_rep").agg(F.min("name").alias("_one"), F.collect_set("name").alias("_names"))
    replace = one.select(F.explode("_names").alias("name"), "_one").where("name <> _one")
    out = stored.join(F.broadcast(replace), "name", "left")
    return out.withColumn("name", F.coalesce("_one", "name")).drop("_one", "_rep", "_hot")


def identities(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK_CHARS, row: str | None = None
) -> DataFrame:
    """A stored table ``row, doc_id, text_sha256, level, name``: texts are equal after
    normalisation exactly where ``(level, name)`` is. Rows are numbered unless ``row`` names
    a column that numbers them.

    Each text is cut into blocks of ``block`` characters, which get integer names; then the
    names of adjacent pairs get a name, again and again, until one is left. A text without
    characters has one empty block. There are as many rounds as halvings of the longest
    text's blocks; a text leaves the rounds as soon as it has one name.
    """
    whole = normalised(F.col(text))
    cut = docs.select(
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        F.col(doc_id).alias("doc_id"),
        whole.alias("_text"),
    ).select(
        "row",
        "doc_id",
        F.sha2("_text", 256).alias("_sha"),
        F.regexp_extract_all("_text", F.lit("(?s).{1,%d}" % block), F.lit(0)).alias("_blocks"),
    )
    blocks = cut.select(
        "row",
        "doc_id",
        "_sha",
        F.greatest(F.size("_blocks"), F.lit(1)).alias("left"),
        F.posexplode_outer("_blocks").alias("_pos", "_block"),
    ).select(
        "row",
        F.coalesce("_pos", F.lit(0)).alias("pos"),
        "left",
        F.when(F.coalesce("_pos", F.lit(0)) == 0, F.struct("doc_id", "_sha")).alias("who"),
        F.coalesce("_block", F.lit("")).alias("_block"),
    )
    level = 0
    now = sort_names(blocks, F.col("_block"), F.xxhash64("_block"), F.col("row"), "blocks")
    who = now.where("pos = 0").select(
        "row", F.col("who.doc_id").alias("doc_id"), F.col("who._sha").alias("text_sha256")
    )
    done = now.where("left = 1").select("row", F.lit(0).alias("level"), "name")
    stored = []
    now = now.where("left > 1").select("row", "pos", "left", "name")
    while not now.isEmpty():
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = (
            now.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max("left").alias("_left"),
                F.max(F.when(even, F.col("name"))).alias("_a"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("_b"),
            )
            .select("row", "pos", F.ceil(F.col("_left") / 2).cast("int").alias("left"), "_a", "_b")
        )
        pairs = store(pairs, f"pairs{level}")
        named = sort_names(pairs, F.struct("_a", "_b"), F.xxhash64("_a", "_b"), F.col("row"), f"names{level}")
        stored.append(pairs)
        done = done.unionByName(named.where("left = 1").select("row", F.lit(level).alias("level"), "name"))
        now = named.where("left > 1").select("row", "pos", "left", "name")
    out = store(done.join(who, "row").select("row", "doc_id", "text_sha256", "level", "name"), "identities")
    drop(*stored)
    return out


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the smallest id stays. Rows that repeat an id and its text
    are separate rows, of which one stays; rows without an id stay only where no row of the
    group has one (``keep_id`` is then null). Null and empty texts are equal. Other columns
    take no part. An empty table gives no rows.
    """
    return grouped_rows(docs, text, doc_id, block).drop("row")


def grouped_rows(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK_CHARS, row: str | None = None
) -> DataFrame:
    """The rows of ``exact_groups`` with their number, ``row``."""
    named = identities(docs, text, doc_id, block, row)
    total = named.count()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), F.col("doc_id"), F.col("row").alias("_row")))
    groups = store(
        named.groupBy("level", "name").agg(first.alias("_first"), F.count(F.lit(1)).alias("group_size")), "groups"
    )
    rows = attach(named, groups, ["level", "name"], "group_size", total)
    return rows.select(
        "row",
        "doc_id",
        F.col("_first.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("_first._row")).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that stay, with all their columns: exactly the rows that ``exact_groups`` keeps.

    The rows are stored with a number, and only numbers meet the documents.
    """
    stored, number = numbered(docs)
    kept = grouped_rows(stored, text, doc_id, row=number).where("kept").select(F.col("row").alias(number))
    return stored.join(kept, number, "left_semi").select(*docs.columns)
