"""Streaming enrichment results: a small log that is merged when the table is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobmill.operators.enrich import apply_updates
from jobmill.operators.load import first_positions, rows_at, with_tie

BATCH = "batch_id"
LOG = f"job_url string, description string, salary_raw string, visited_at timestamp_ntz, {BATCH} long"


def start_log(updates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each batch of results as its own folder; a repeated batch overwrites itself."""

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        updates.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_results(spark: SparkSession, path: str) -> DataFrame:
    """The first result per link that ended its pending state: later visits find nothing to do.

    Only links and positions (batch, time, then a hash of the result; no time comes first)
    are grouped; texts meet them by null-safe equality, and equal results count once.
    """
    log = with_tie(spark.read.schema(LOG).parquet(path).where(F.col("job_url").isNotNull()))
    order = [BATCH, "visited_at"]
    kept = rows_at(log, first_positions(log, "job_url", order), "job_url", order)
    return kept.select("job_url", "description", "salary_raw")


def current_table(jobs: DataFrame, path: str, now: Column) -> DataFrame:
    """The postings table with all logged results applied."""
    return apply_updates(jobs, latest_results(jobs.sparkSession, path), now)
