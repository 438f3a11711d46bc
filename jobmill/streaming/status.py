"""Status of visited postings as a stateful stream: pending until the first visit, then new or orphaned.

Drops may repeat and come out of order. The state of a link is the place of its earliest
visit so far (numbers and a flag, no text), and it is forgotten once the watermark is ``delay``
past that visit; so the state is bounded by ``delay``, not by the links ever seen. Links are
kept by hash in ``BUCKETS`` states, so a batch calls the function once per bucket and not per link.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from jobmill import schema as S
from jobmill.operators.enrich import apply_updates

BATCH = "batch_id"
VISIT = "job_url string, visited_at timestamp, no_text boolean, tie long, description string, salary_raw string"
CHANGE = f"{VISIT}, status string"
CHANGED = [field.split()[0] for field in CHANGE.split(", ")]
#: A bucket's links as JSON: ``link: [visited_us, no_text, tie, ms of the watermark that forgets it]``.
STATE = "links string"
PLACE = ["visited_at", "no_text", "tie"]
BUCKET = "bucket"
BUCKETS = 4_096


def visits(results: DataFrame) -> DataFrame:
    """Results in the form of ``VISIT``; those without a link or a time of visit are left out."""
    return results.where(F.col("job_url").isNotNull() & F.col("visited_at").isNotNull()).select(
        "job_url",
        F.col("visited_at").cast("timestamp").alias("visited_at"),
        F.col("description").isNull().alias("no_text"),
        F.xxhash64("description", "salary_raw").alias("tie"),
        "description",
        "salary_raw",
    )


def earliest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The earliest visit per link of every Arrow batch, so a hot link sends one row per batch."""
    for frame in frames:
        yield frame.sort_values(PLACE).drop_duplicates("job_url")


def changes(results: DataFrame, delay: str, buckets: int = BUCKETS) -> DataFrame:
    """A row whenever a visit earlier than all known ones of its link turns up, with the status it leads to.

    Of visits at one time one with a description goes first, then the smallest hash. ``buckets``
    stays the same for the life of a checkpoint.
    """
    late_ms = int(pd.Timedelta(delay) / pd.Timedelta("1ms"))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        links = json.loads(state.get[0]) if state.exists else {}
        watermark = state.getCurrentWatermarkMs()
        best, seen = None, set()
        for frame in () if state.hasTimedOut else frames:
            head = frame if best is None else pd.concat([best, frame])
            best = head.sort_values(PLACE).drop_duplicates("job_url")
        if best is not None:
            us = best["visited_at"].astype("datetime64[us]").astype("int64")
            earlier = []
            for link, *place in zip(best["job_url"], us.tolist(), best["no_text"].tolist(), best["tie"].tolist(), strict=True):
                known = links.get(link)
                earlier.append(known is None or place < known[:3])
                first = place if earlier[-1] else known[:3]
                links[link] = [*first, max(first[0] // 1000, watermark) + late_ms]
                seen.add(link)
            best = best[earlier]
            if len(best):
                yield best.assign(status=best["no_text"].map({True: S.ORPHANED, False: S.NEW}))[CHANGED]
        links = {link: known for link, known in links.items() if link in seen or known[3] >= watermark}
        if not links:
            state.remove()
            return
        state.update((json.dumps(links),))
        state.setTimeoutTimestamp(max(min(known[3] for known in links.values()), watermark))

    small = visits(results).mapInPandas(earliest, VISIT).withWatermark("visited_at", delay)
    placed = small.withColumn(BUCKET, F.pmod(F.xxhash64("job_url"), F.lit(buckets)))
    return placed.groupBy(BUCKET).applyInPandasWithState(
        step, CHANGE, STATE, "update", GroupStateTimeout.EventTimeTimeout
    )


def start(results: DataFrame, path: str, checkpoint: str, delay: str) -> StreamingQuery:
    """Log the changes, each batch in its own folder; a repeated batch overwrites itself."""

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        changes(results, delay)
        .writeStream.foreachBatch(append)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def settled(spark: SparkSession, path: str) -> DataFrame:
    """The earliest logged visit per link."""
    log = spark.read.schema(f"{CHANGE}, {BATCH} long").parquet(path)
    first = F.min_by(F.struct("description", "salary_raw"), F.struct(*PLACE)).alias("_first")
    return log.groupBy("job_url").agg(first).select("job_url", "_first.*")


def current_table(jobs: DataFrame, path: str, now: Column) -> DataFrame:
    """The postings table after all logged changes."""
    return apply_updates(jobs, settled(jobs.sparkSession, path), now)
