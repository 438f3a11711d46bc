"""Streaming insert-if-new into a Parquet table that grows by one folder per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from jobmill.operators.load import new_rows

BATCH = "batch_id"
BUCKET = "bucket"
BUCKETS = 256


def read_table(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Stored rows, or those of the batches before ``before``; empty when none exist."""
    fields = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    try:
        stored = spark.read.schema(fields).parquet(path)
    except AnalysisException:
        stored = spark.createDataFrame([], fields)
    return stored if before is None else stored.where(F.col(BATCH) < before)


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_keys(rows: DataFrame, path: str, batch_id: int, key: str, buckets: int = BUCKETS) -> None:
    """Add the keys of ``rows`` to the store, by batch and bucket; a repeated batch overwrites itself."""
    keys = rows.select(key).withColumn(BUCKET, bucket_of(key, buckets))
    # Keys are distinct, so each bucket is a fair share: one file for each.
    keys.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/{BATCH}={batch_id}")


def stored_keys(
    spark: SparkSession, path: str, batch: DataFrame, key: str, before: int | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Stored keys of the buckets that ``batch`` touches, of batches before ``before``.

    At most ``buckets`` numbers reach the driver; they become a partition filter, so folders
    of other buckets are not read.
    """
    fields = T.StructType([
        batch.schema[key], T.StructField(BATCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())
    ])
    try:
        stored = spark.read.schema(fields).parquet(path)
    except AnalysisException:
        stored = spark.createDataFrame([], fields)
    touched = [r[0] for r in batch.where(F.col(key).isNotNull()).select(bucket_of(key, buckets)).distinct().collect()]
    stored = stored.where(F.col(BUCKET).isin(touched))
    return stored if before is None else stored.where(F.col(BATCH) < before)


def compact_keys(spark: SparkSession, path: str, upto: int, target: str, key: str) -> None:
    """Write the keys of the batches up to ``upto`` as one batch of that number below ``target``; later ones as they are.

    The old store stays for whoever still reads it; the next run of the stream takes ``target``.
    """
    stored = spark.read.parquet(path)
    merged = F.when(F.col(BATCH) <= upto, F.lit(upto)).otherwise(F.col(BATCH)).cast("long")
    (
        stored.select(key, merged.alias(BATCH), BUCKET).repartition(BATCH, BUCKET)
        .write.partitionBy(BATCH, BUCKET).parquet(target)
    )


def start_insert(
    postings: DataFrame,
    path: str,
    checkpoint: str,
    order: Sequence[str],
    seed: DataFrame | None = None,
    key: str = "job_url",
    keys: str | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Insert rows with unseen keys.

    A batch writes only its own folders and compares only with earlier ones, so a batch
    that is repeated after a failure overwrites itself with the same rows. ``seed`` is
    the table as it was before the stream; its keys go to the store as batch -1. Keys are
    stored by bucket below ``keys`` (by default beside the table), and a batch reads only its
    buckets. Rows are written before their keys, and keys are read back from the rows.
    """
    schema = postings.schema
    store = keys or f"{path}-keys"

    def insert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = stored_keys(spark, store, batch, key, batch_id, buckets).select(key)
        folder = f"{path}/{BATCH}={batch_id}"
        new_rows(known, batch, order, key).write.mode("overwrite").parquet(folder)
        write_keys(spark.read.schema(schema).parquet(folder), store, batch_id, key, buckets)

    if seed is not None:
        write_keys(seed.where(F.col(key).isNotNull()).select(key).distinct(), store, -1, key, buckets)

    return (
        postings.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_first_within(
    rows: DataFrame, path: str, checkpoint: str, time: str, delay: str, key: str = "job_url"
) -> StreamingQuery:
    """Append the first row of every key; a key is remembered until the watermark is ``delay`` past it.

    Rows older than the watermark are left out, so the state is bounded by ``delay`` and not
    by the keys ever seen.
    """
    return (
        first_within(rows, time, delay, key)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def first_within(postings: DataFrame, time: str, delay: str, key: str = "job_url") -> DataFrame:
    """Bounded-state form: a key repeated within ``delay`` is dropped, older keys are forgotten."""
    return postings.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
