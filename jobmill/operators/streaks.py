"""Runs of consecutive failures per key, with a trip at every n-th failure.

A key may own a large share of all rows, so no window holds a whole key. Rows are cut
into ranges of about equal counts by key, time and id, whatever the times are; windows run
inside a range, and one summary row per key and range carries the open run over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobmill.operators.nlp import stored
from jobmill.operators.skew import TASK_ROWS

CHUNK = "_chunk"
THRESHOLD = 3


def ranged(rows: DataFrame, order: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """``rows`` with ``_chunk``, rising with ``order``; a chunk has about ``task_rows`` rows.

    Stored once, because bounds are sampled: all later steps must read the same ones.
    """
    parts = -(-max(rows.count(), 1) // task_rows)
    return stored(rows.repartitionByRange(parts, *order).withColumn(CHUNK, F.spark_partition_id()), "ranges")


def failure_trips(
    outcomes: DataFrame,
    key: str,
    time: str,
    row_id: str,
    outcome: str,
    threshold: int = THRESHOLD,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Rows where a run of failures reaches a multiple of ``threshold``.

    ``outcome`` holds ``fail``, ``empty`` or anything else for success. Empty rows
    neither count nor end a run, and no more do rows without an outcome. Rows without
    a time come first, rows without a key are one key. ``row_id`` differs within equal times.
    Returns ``key, row_id, time, run_length``.
    """
    rows = outcomes.where(F.col(outcome) != "empty").select(
        key, time, row_id, (F.col(outcome) == "fail").cast("int").alias("_fail")
    )
    rows = ranged(rows, [key, time, row_id], task_rows)
    inside = W.partitionBy(key, CHUNK).orderBy(time, row_id).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_fails", F.sum("_fail").over(inside))
    # Failures counted so far when the last success of the chunk happened; null before it.
    rows = rows.withColumn("_reset", F.max(F.when(F.col("_fail") == 0, F.col("_fails"))).over(inside))

    # At most one row per key and one per range: a key's list is as long as its rows make tasks.
    chunks = rows.groupBy(key, CHUNK).agg(F.max("_fails").alias("_n"), F.max("_reset").alias("_last"))
    upto = W.partitionBy(key).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(key).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    chunks = chunks.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
    chunks = chunks.withColumn("_open", F.col("_before") - F.coalesce(
        F.max(F.col("_before") + F.col("_last")).over(before), F.lit(0)))

    named = chunks.select(F.col(key).alias("_key"), F.col(CHUNK).alias("_at"), "_open")
    joined = rows.join(named, F.col(key).eqNullSafe(F.col("_key")) & (F.col(CHUNK) == F.col("_at")))
    length = F.when(F.col("_reset").isNull(), F.col("_fails") + F.col("_open")).otherwise(
        F.col("_fails") - F.col("_reset")
    )
    return joined.select(key, row_id, time, "_fail", length.alias("run_length")).where(
        (F.col("_fail") == 1) & (F.col("run_length") % threshold == 0)
    ).drop("_fail")
