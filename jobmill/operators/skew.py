"""Equi joins whose left side may hold a huge group of one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TASK_ROWS = 1_000_000
MAX_HOT = 100_000
SALT = "_salt"
HASH = "_hash"
PLACES = "_places"


def hot_keys(df: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """``_hash, _places`` of the keys with more rows than one task should take.

    A key needs as many places as its rows make tasks. Keys are known by a 64-bit hash, so
    a row of the list takes 12 bytes however long the keys are; keys of equal hash are spread
    together. The list is broadcast: it holds the ``MAX_HOT`` largest groups, and a group
    beyond these has at most ``rows / MAX_HOT`` rows. Only the key column is read, and
    counts are combined before the shuffle.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias(HASH)).agg(F.count(F.lit(1)).alias("_n"))
    most = counts.where(F.col("_n") > task_rows).orderBy(F.desc("_n"), HASH).limit(MAX_HOT)
    return most.select(HASH, F.ceil(F.col("_n") / task_rows).cast("int").alias(PLACES))


def left_join_hot(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: Column,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Left join to a side with one row per key; hot keys of the left are spread.

    ``spread`` is a value that differs between rows of one key (a row id). Rows of a
    hot key go to as many places as ``hot_keys`` gives it, and only the right rows of
    hot keys are copied there. Copies are at most the left rows over ``task_rows``, plus
    one per hot key.
    """
    hot = F.broadcast(hot_keys(left, key, task_rows))

    def place(places: Column) -> Column:
        return F.pmod(F.xxhash64(spread), places).cast("int")

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn(HASH, F.xxhash64(key)).join(hot, HASH, "left").drop(HASH)

    # Rows without a key match nothing, but they would all hash to one task: spread them too.
    salt = F.when(F.col(key).isNull(), place(F.lit(1 << 20))).when(
        F.col(PLACES).isNotNull(), place(F.col(PLACES))).otherwise(F.lit(0))
    salted = marked(left).withColumn(SALT, salt).drop(PLACES)
    copies = F.sequence(F.lit(0), F.coalesce(F.col(PLACES), F.lit(1)) - 1)
    copied = marked(right).withColumn(SALT, F.explode(copies)).drop(PLACES)
    return salted.join(copied, [key, SALT], "left").drop(SALT)
