"""Streaming export: every arriving file is handed over exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from jobmill.sources.lake import PARTITION, export_rows, with_partition


def read_drops(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files below ``path`` as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def start_export(postings: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append exportable rows to day folders until the backlog is empty.

    Spark tracks files, not a latest time, so late postings are exported as well. The
    file sink commits whole batches; a restart repeats none.
    """
    rows = with_partition(export_rows(postings))
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(PARTITION)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
