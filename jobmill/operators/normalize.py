"""Raw batches of the sources to the one postings schema: map-only projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmill import schema as S
from jobmill.functions.location import detect_state
from jobmill.functions.postings import default, detect_job_type, map_job_type, nan_to_null
from jobmill.functions.salary import salary_from_text


def align(df: DataFrame, to: T.StructType = S.LISTING) -> DataFrame:
    """Exactly the columns of ``to``, in order: missing ones null, others dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in to.fields
        ]
    )


def _as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def normalize_search_batch(
    df: DataFrame, career: Column | str, niche: Column | str, worker: Column | str = "default_worker"
) -> DataFrame:
    """Rows of the search source; rows without a link are left out.

    Input columns: ``job_url site title company location min_amount max_amount currency
    description date_posted``; further columns pass through.
    """
    used = "job_url site title company location min_amount max_amount currency description date_posted"
    rest = [c for c in df.columns if c not in used.split()]
    location = default(F.col("location"), S.DEFAULT_LOCATION)
    rows = df.where(F.coalesce(F.col("job_url"), F.lit("")) != "").select(
        *rest,
        default(F.col("site"), "unknown").alias("site"),
        "job_url",
        F.upper(default(F.col("title"), "")).alias("title"),
        default(F.col("company"), S.DEFAULT_COMPANY).alias("company"),
        location.alias("raw_location"),
        F.lit(S.DEFAULT_COUNTRY).alias("country"),
        F.lit(None).cast("string").alias("country_code"),
        detect_state(location).alias("state"),
        _as_column(career).alias("career"),
        _as_column(worker).alias("scraped_by"),
        _as_column(niche).alias("industry_niche"),
        F.lit(False).alias("is_premium"),
        detect_job_type(F.col("title"), location).alias("job_type"),
        nan_to_null(F.col("min_amount")).alias("_low"),
        nan_to_null(F.col("max_amount")).alias("_high"),
        default(F.col("currency"), S.DEFAULT_CURRENCY).alias("currency"),
        "description",
        "date_posted",
        F.lit(S.NEW).alias("status"),
    )
    unpriced = F.col("_low").isNull() & F.col("_high").isNull()
    rows = rows.withColumn("_text", F.when(unpriced, salary_from_text(F.col("description"))))
    return rows.withColumns(
        {
            "salary_min": F.coalesce("_low", "_text.salary_min"),
            "salary_max": F.when(unpriced, F.col("_text.salary_max")).otherwise(F.col("_high")),
        }
    ).drop("_low", "_high", "_text")


def normalize_listing_batch(
    df: DataFrame, career: Column | str, niche: Column | str, worker: Column | str = "unknown"
) -> DataFrame:
    """Rows of the listing sources; descriptions are still to be fetched."""
    code = F.col("country_code") if "country_code" in df.columns else F.lit("MX")
    rest = [c for c in df.columns if c not in S.LISTING.names]
    location = default(F.col("raw_location"), S.DEFAULT_LOCATION)
    return df.select(
        *rest,
        "site",
        "job_url",
        F.upper(default(F.col("title"), "")).alias("title"),
        default(F.col("company"), S.DEFAULT_COMPANY).alias("company"),
        location.alias("raw_location"),
        F.lit(S.DEFAULT_COUNTRY).alias("country"),
        code.alias("country_code"),
        detect_state(location).alias("state"),
        _as_column(career).alias("career"),
        _as_column(worker).alias("scraped_by"),
        _as_column(niche).alias("industry_niche"),
        F.lit(False).alias("is_premium"),
        map_job_type(F.col("job_type")).alias("job_type"),
        nan_to_null(F.col("salary_min")).alias("salary_min"),
        nan_to_null(F.col("salary_max")).alias("salary_max"),
        default(F.col("currency"), S.DEFAULT_CURRENCY).alias("currency"),
        F.lit(None).cast("string").alias("description"),
        "date_posted",
        F.lit(S.PENDING).alias("status"),
    )
