"""Date-partitioned export with a checkpoint and a read-back check."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmill import schema as S
from jobmill.functions.postings import full_salary
from jobmill.sources.csv_files import CSV, flags_as_words

PARTITION = "ingestion_date"
UNKNOWN = "unknown"
RUN = "export_run"
SUMMARY = "records long, columns long, partitions long, files long, verified boolean, checkpoint timestamp_ntz"
MANIFEST = f"{PARTITION} string, file string, records long, newest timestamp_ntz"
COMMITS = "_commits"


class ExportMismatch(RuntimeError):
    """The files of a run do not hold what was to be exported; the run is not committed."""


def export_rows(jobs: DataFrame, after: Column | datetime | None = None) -> DataFrame:
    """Rows to hand over; ``after`` keeps only those scraped strictly later."""
    chosen = jobs.where(F.col("status").isin(*S.EXPORT_STATUSES))
    if after is not None:
        chosen = chosen.where(F.col("date_scraped") > (after if isinstance(after, Column) else F.lit(after)))
    return chosen.select(
        *[c for c in S.EXPORT_COLUMNS if c in jobs.columns],
        full_salary(F.col("salary_min"), F.col("salary_max")).alias("has_salary"),
    )


def with_partition(rows: DataFrame) -> DataFrame:
    day = F.date_format("date_scraped", "yyyy-MM-dd")
    return rows.withColumn(PARTITION, F.coalesce(day, F.lit(UNKNOWN)))


def partition_counts(rows: DataFrame) -> DataFrame:
    return with_partition(rows).groupBy(PARTITION).agg(F.count(F.lit(1)).alias("n"))


def write_partitions(
    rows: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", run: str | None = None
) -> None:
    """One folder per day and, with ``run``, one folder per run inside it.

    Rows are rebalanced by day: small days share a task and a day that holds much of
    the data is split over several tasks and files.
    """
    spread = with_partition(rows).hint("rebalance", F.col(PARTITION))
    folders = [PARTITION]
    if run is not None:
        spread = spread.withColumn(RUN, F.lit(run))
        folders.append(RUN)
    writer = flags_as_words(spread) if fmt == "csv" else spread
    options = CSV if fmt == "csv" else {}
    writer.write.mode(mode).partitionBy(*folders).format(fmt).options(**options).save(path)


def read_partitions(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", run: str | None = None
) -> DataFrame:
    """Written rows. ``schema`` is that of the exported rows; the folder columns stay
    text so that the day ``unknown`` survives. ``run`` reads the folders of one run."""
    fields = [
        T.StructField(f.name, T.StringType() if fmt == "csv" and isinstance(f.dataType, T.BooleanType) else f.dataType)
        for f in schema.fields
    ]
    fields += [T.StructField(PARTITION, T.StringType())]
    options = {**CSV, "multiLine": True} if fmt == "csv" else {}
    if run is None:
        return spark.read.schema(T.StructType(fields)).format(fmt).options(**options).load(path)
    fields += [T.StructField(RUN, T.StringType())]
    stored = spark.read.schema(T.StructType(fields)).format(fmt).options(**options).load(path)
    return stored.where(F.col(RUN) == run)


def verify(source: DataFrame, written: DataFrame) -> DataFrame:
    """Row counts per partition on both sides; equal ones carry ``verified``."""
    expected = partition_counts(source).withColumnRenamed("n", "expected")
    found = written.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("written"))
    both = expected.join(found, PARTITION, "full_outer")
    return both.select(
        PARTITION,
        F.coalesce("expected", F.lit(0)).alias("expected"),
        F.coalesce("written", F.lit(0)).alias("written"),
        (F.col("expected").eqNullSafe(F.col("written"))).alias("verified"),
    )


def export_summary(written: DataFrame, columns: int) -> DataFrame:
    """One row read back from the written files."""
    return written.agg(
        F.count(F.lit(1)).alias("records"),
        F.lit(columns).cast("long").alias("columns"),
        F.countDistinct(PARTITION).alias("partitions"),
        F.max("date_scraped").alias("checkpoint"),
    )


def read_checkpoint(spark: SparkSession, path: str) -> datetime | None:
    """Latest exported time; a missing, empty or unreadable checkpoint means a full export."""
    try:
        row = spark.read.parquet(path).agg(F.max("date_scraped").alias("t")).first()
    except Exception:  # noqa: BLE001 - any failure falls back to the full export
        return None
    return row["t"] if row else None


def write_checkpoint(spark: SparkSession, path: str, when: datetime) -> None:
    spark.createDataFrame([(when,)], "date_scraped timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(path)


def manifest(written: DataFrame) -> DataFrame:
    """Records and newest time of every file, read back from the files of a run."""
    return written.groupBy(PARTITION, F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("records"), F.max("date_scraped").alias("newest")
    )


def commits(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows of all committed runs; none before the first commit."""
    schema = f"{MANIFEST}, {RUN} string"
    try:
        return spark.read.schema(schema).parquet(f"{path}/{COMMITS}")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_committed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Rows of committed runs only: what a failed or unfinished run left behind is not seen."""
    fields = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    rows = read_partitions(spark, path, fields, fmt)
    return rows.join(commits(spark, path).select(RUN).distinct(), RUN, "left_semi").select(*schema.names, PARTITION)


def commit(found: DataFrame, path: str, run: str) -> None:
    """Phase two: the run's manifest enters the list of commits as one folder, which is what makes the run count.

    The folder is written aside and renamed, so that it is there in full or not at all.
    """
    spark = found.sparkSession
    aside, final = f"{path}/_pending/{RUN}={run}", f"{path}/{COMMITS}/{RUN}={run}"
    found.write.mode("overwrite").parquet(aside)
    files = spark._jvm.org.apache.hadoop.fs.Path(final).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}"))
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(aside), spark._jvm.org.apache.hadoop.fs.Path(final)):
        raise ExportMismatch(f"run {run} is committed already")


def recover(spark: SparkSession, path: str, checkpoint: str) -> datetime | None:
    """The checkpoint, moved first if a committed run ended before it could move it."""
    known = read_checkpoint(spark, checkpoint)
    newest = commits(spark, path).agg(F.max("newest").alias("t")).first()["t"]
    if known is not None and newest is not None and newest > known:
        write_checkpoint(spark, checkpoint, newest)
        return newest
    return known


def run_export(
    jobs: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", run: str | None = None, dry_run: bool = False
) -> DataFrame:
    """Export what came after the checkpoint, in two phases; the checkpoint moves last.

    First the files are written below the run, and a manifest is read back from them: records
    and newest time by file. Its counts must equal those of the rows to export on every day;
    if not, ``ExportMismatch`` is raised, and neither commit nor checkpoint changes. Then the
    manifest is committed, and the checkpoint moves to its newest time. A run that ends
    between the two is finished by the next. A dry run writes nothing and returns a preview
    of three rows.
    """
    spark = jobs.sparkSession
    if dry_run:
        rows = export_rows(jobs, read_checkpoint(spark, checkpoint))
        return rows.orderBy(F.desc("date_scraped"), "id").limit(3)
    rows = export_rows(jobs, recover(spark, path, checkpoint))
    run = run or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    write_partitions(rows, path, fmt, run=run)
    nothing = spark.createDataFrame([(0, len(rows.columns), 0, 0, True, None)], SUMMARY)
    try:
        written = read_partitions(spark, path, rows.schema, fmt, run)
    except AnalysisException:  # nothing was ever written
        if rows.isEmpty():
            return nothing
        raise
    aside = f"{path}/_manifests/{RUN}={run}"
    manifest(written).write.parquet(aside)
    found = spark.read.schema(MANIFEST).parquet(aside)
    days = found.groupBy(PARTITION).agg(F.sum("records").alias("written"))
    expected = partition_counts(rows)
    wrong = expected.join(days, PARTITION, "full_outer").where("NOT n <=> written").limit(5).collect()
    if wrong:
        raise ExportMismatch("; ".join(f"{r[PARTITION]}: {r['n']} rows, {r['written']} written" for r in wrong))
    total = found.agg(
        F.coalesce(F.sum("records"), F.lit(0)), F.countDistinct(PARTITION), F.count(F.lit(1)), F.max("newest")
    ).first()
    if not total[0]:
        return nothing
    commit(found, path, run)
    if total[3] is not None:
        write_checkpoint(spark, checkpoint, total[3])
    return spark.createDataFrame([(total[0], len(rows.columns), total[1], total[2], True, total[3])], SUMMARY)
