"""Second phase: which postings to visit, and what the visits change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobmill import schema as S
from jobmill.functions.salary import parse_salary
from jobmill.operators.skew import left_join_hot

SITES = ("computrabajo", "occ")
DAILY_LIMIT = 100
BATCH_SIZE = 20


def pending(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("site").isin(*SITES) & (F.col("status") == S.PENDING))


def queue(jobs: DataFrame, daily_limit: int = DAILY_LIMIT) -> DataFrame:
    """At most ``daily_limit`` pending postings, site by site, then by id."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SITES]), F.col("site"))
    return pending(jobs).withColumn("site_order", rank).orderBy("site_order", "id").limit(daily_limit)


def batches(jobs: DataFrame, daily_limit: int = DAILY_LIMIT, size: int = BATCH_SIZE) -> DataFrame:
    """The queue cut into batches inside each site (the queue is bounded by its limit)."""
    site = W.partitionBy("site")
    position = F.row_number().over(site.orderBy("id")) - 1
    return queue(jobs, daily_limit).withColumns(
        {
            "batch_no": F.floor(position / size) + 1,
            "batch_count": F.ceil(F.count(F.lit(1)).over(site) / size),
        }
    )


def one_per_link(results: DataFrame) -> DataFrame:
    """``job_url, description, salary_raw``: of several results of a link one with a
    description, else any with a salary; ties go to the greatest texts. Null links are left out."""
    best = F.max(F.struct("description", "salary_raw")).alias("_best")
    return results.where(F.col("job_url").isNotNull()).groupBy("job_url").agg(best).select("job_url", "_best.*")


def merge_details(listing: DataFrame, details: DataFrame, row_id: str) -> DataFrame:
    """Description and missing salary of listing rows from detail pages.

    Salary is filled only when no row of the link has one; both ends come together.
    """
    known = listing.groupBy("job_url").agg(F.max("salary_min").alias("_known"))
    found = one_per_link(details).join(known, "job_url", "left").select(
        "job_url",
        F.col("description").alias("_text"),
        F.when(F.col("_known").isNull() & (F.col("salary_raw") != ""), parse_salary(F.col("salary_raw"))).alias("_pay"),
    )
    joined = left_join_hot(listing, found, "job_url", F.col(row_id))
    return joined.withColumns(
        {
            "description": F.col("_text"),
            "salary_min": F.when(F.col("_pay").isNull(), F.col("salary_min")).otherwise(F.col("_pay.salary_min")),
            "salary_max": F.when(F.col("_pay").isNull(), F.col("salary_max")).otherwise(F.col("_pay.salary_max")),
        }
    ).drop("_text", "_pay")


def apply_updates(jobs: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """Visited pending rows become NEW (text found) or ORPHANED (nothing found).

    Only pending rows take part in the join; the rest of the table is passed on
    without a shuffle.
    ``updates`` has ``job_url, description, salary_raw``; a link with several results counts once.
    """
    found = one_per_link(updates).select(
        "job_url",
        F.lit(True).alias("_visited"),
        F.col("description").alias("_text"),
        F.when(F.col("salary_raw") != "", parse_salary(F.col("salary_raw"))).alias("_pay"),
    )
    waits = F.coalesce(F.col("site").isin(*SITES) & (F.col("status") == S.PENDING), F.lit(False))
    joined = left_join_hot(jobs.where(waits), found, "job_url", F.col("id"))
    visited = F.coalesce("_visited", F.lit(False))
    enriched = visited & F.col("_text").isNotNull()
    fill = enriched & F.col("salary_min").isNull() & F.col("_pay.salary_min").isNotNull()
    changed = joined.select(
        *[c for c in jobs.columns if c not in ("description", "salary_min", "salary_max", "status", "last_updated")],
        F.when(enriched, F.col("_text")).otherwise(F.col("description")).alias("description"),
        F.when(fill, F.col("_pay.salary_min")).otherwise(F.col("salary_min")).alias("salary_min"),
        F.when(fill, F.col("_pay.salary_max")).otherwise(F.col("salary_max")).alias("salary_max"),
        F.when(enriched, S.NEW).when(visited, S.ORPHANED).otherwise(F.col("status")).alias("status"),
        F.when(visited, now).otherwise(F.col("last_updated")).alias("last_updated"),
    )
    return jobs.where(~waits).unionByName(changed)


def run_totals(jobs: DataFrame, updates: DataFrame) -> DataFrame:
    """Enriched, orphaned and still pending rows of a run of ``apply_updates``, from one pass over each side.

    Pending rows are counted per link before they meet the results, so no link is hot and no text moves.
    """
    waiting = pending(jobs).groupBy("job_url").agg(F.count(F.lit(1)).alias("_n"))
    visited = updates.where(F.col("job_url").isNotNull()).groupBy("job_url").agg(
        F.max(F.col("description").isNotNull()).alias("_text")
    )

    def rows(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("_n"))), F.lit(0))

    return waiting.join(visited, "job_url", "left").agg(
        rows(F.col("_text")).alias("enriched"),
        rows(~F.col("_text")).alias("orphaned"),
        rows(F.col("_text").isNull()).alias("remaining"),
    )
