"""Follow-up scores, ordered reports, samples, result caps and pagination stops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobmill import schema as S
from jobmill.functions.location import detect_state
from jobmill.functions.report import card_place, card_text, card_title, local_time, salary_label
from jobmill.operators.skew import left_join_hot


def days_between(start: Column, today: Column) -> Column:
    """Whole days, truncated towards zero, from a moment to midnight of ``today``."""
    seconds = F.unix_timestamp(today.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))
    return (seconds / 86400).cast("int")


def steps(value: Column, table: Sequence[tuple[int, int]]) -> Column:
    rule = F.lit(0)
    for least, points in reversed(table):
        rule = F.when(value >= least, points).otherwise(rule)
    return rule


def followup_scores(jobs: DataFrame, today: Column) -> DataFrame:
    active = jobs.where(F.col("status").isin(*S.FOLLOWUP_STATUSES)).select(
        "id",
        "company",
        "title",
        "status",
        days_between(F.coalesce("last_updated", "applied_date"), today).alias("days_since_update"),
        days_between(F.col("applied_date"), today).alias("_applied"),
    )
    # Points per age in days.
    score = (
        F.when(F.col("status").isin("APPLIED", "SCREENING"), 5).otherwise(0)
        + steps(F.col("days_since_update"), ((14, 5), (7, 3), (3, 1)))
        + steps(F.col("_applied"), ((21, 3), (14, 2), (7, 1)))
    )
    return active.withColumn("followup_score", score).drop("_applied").orderBy(F.desc("followup_score"), "id")


def new_postings(jobs: DataFrame, n: int = 20) -> DataFrame:
    wanted = "id title company raw_location site salary_min salary_max job_url date_scraped".split()
    return jobs.where(F.col("status") == S.NEW).select(*wanted).orderBy("id").limit(n)


def _with_state(jobs: DataFrame) -> DataFrame:
    return jobs if "state" in jobs.columns else jobs.withColumn("state", detect_state(F.col("raw_location")))


def open_postings(jobs: DataFrame) -> DataFrame:
    """The spreadsheet report: new and applied postings, latest local time first."""
    return (
        _with_state(jobs.where(F.col("status").isin(*S.REPORT_STATUSES)))
        .select(*S.REPORT_COLUMNS, local_time(F.col("date_scraped")).alias("local_date_scraped"))
        .orderBy(F.desc("local_date_scraped"), "id")
    )


def report_cards(jobs: DataFrame) -> DataFrame:
    """The printed report: one card per new posting, latest local time first."""
    return (
        _with_state(jobs.where(F.col("status") == S.NEW))
        .select(
            "id",
            card_title(F.col("job_type"), F.col("title"), F.col("site")).alias("title_line"),
            card_place(F.col("company"), F.col("state"), F.col("raw_location")).alias("place_line"),
            salary_label(F.col("salary_min"), F.col("salary_max")).alias("salary_line"),
            card_text(F.col("description")).alias("description_text"),
            F.col("job_url").alias("link"),
            local_time(F.col("date_scraped")).alias("local_date_scraped"),
        )
        .orderBy(F.desc("local_date_scraped"), "id")
    )


def sample_exact(df: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """Exactly ``n`` rows (all if fewer), the same ones on any partitioning."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.orderBy(draw, key).limit(n)


def before_after(nlp: DataFrame, n: int = 3, seed: int = 42, language: str = "es", chars: int = 120) -> DataFrame:
    usable = nlp.where(~F.col("es_vacio_nlp") & (F.col("idioma_det") == language))
    picked = sample_exact(usable.select("id", "career", "city", "descripcion_limpia", "descripcion_nlp"), n, seed)
    return picked.select(
        "id",
        "career",
        "city",
        F.left("descripcion_limpia", F.lit(chars)).alias("before_text"),
        F.left("descripcion_nlp", F.lit(chars)).alias("after_text"),
    )


def cap_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    Spark turns the rank filter into a group limit before the shuffle, so each task
    sends at most ``n`` rows of a group however large the group is.
    """
    position = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return df.withColumn("position", position).where(F.col("position") <= n)


def cap_total(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def until_pagination_stops(
    pages: DataFrame, group: str, page: str, empty: str, has_next: str | None, row_id: str
) -> DataFrame:
    """Pages before the first empty one and up to the first one without a next link."""
    last = F.min(F.when(~F.col(has_next), F.col(page))) if has_next else F.lit(None).cast("long")
    stops = pages.groupBy(group).agg(
        F.min(F.when(F.col(empty), F.col(page))).alias("_empty"), last.alias("_last")
    )
    joined = left_join_hot(pages, stops, group, F.col(row_id))
    before_empty = F.col("_empty").isNull() | (F.col(page) < F.col("_empty"))
    upto_last = F.col("_last").isNull() | (F.col(page) <= F.col("_last"))
    return joined.where(before_empty & upto_last).drop("_empty", "_last")
