"""Data-quality counts and corpus summaries: one aggregate pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmill import schema as S


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; 0 for an empty whole."""
    return F.coalesce(F.round(100.0 * part / F.nullif(whole, F.lit(0)), 6), F.lit(0.0))


def summary(jobs: DataFrame) -> DataFrame:
    total, paid = F.count(F.lit(1)), F.count("salary_min")
    return jobs.agg(
        total.alias("total"),
        F.count_if(F.col("title").isNull() | F.col("job_url").isNull()).alias("missing_title_or_url"),
        paid.alias("with_salary"),
        percent(paid, total).alias("salary_pct"),
    )


def duplicate_links(jobs: DataFrame) -> DataFrame:
    """Links stored more than once, with their row count (null links are one group)."""
    return jobs.groupBy("job_url").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def constraint_violations(jobs: DataFrame) -> DataFrame:
    """Over-long and missing values per column, one row per checked column."""
    checks: list[tuple[str, str, Column]] = []
    for name, cap in S.LENGTH_CAPS.items():
        if name in jobs.columns:
            checks.append((name, "too_long", F.length(name) > cap))
    for name in S.REQUIRED:
        if name in jobs.columns:
            checks.append((name, "missing", F.col(name).isNull()))
    counted = jobs.agg(*[F.count_if(test).alias(f"{kind}__{name}") for name, kind, test in checks])
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("check_name"),
            F.col(f"{kind}__{name}").alias("violations"),
        )
        for name, kind, _ in checks
    ]
    return counted.select(F.inline(F.array(*rows)))


def top_regions(corpus: DataFrame, n: int = 10) -> DataFrame:
    return (
        corpus.groupBy("region").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "region").limit(n)
    )


def corpus_summary(corpus: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    usable, empty = F.count_if(~F.col("es_vacio")), F.count_if("es_vacio")
    paid = F.count_if("tiene_salario")
    return corpus.agg(
        total.alias("total"),
        usable.alias("usable"),
        percent(usable, total).alias("usable_pct"),
        empty.alias("empty"),
        percent(empty, total).alias("empty_pct"),
        paid.alias("with_salary"),
        percent(paid, total).alias("with_salary_pct"),
    )


def median_by(df: DataFrame, group: str, number: str, unusable: str, n: int = 10, exact: bool = True) -> DataFrame:
    """Median of the usable rows per group, highest first.

    The exact form keeps one counter per distinct value, not the rows. Unusable rows
    are masked rather than filtered so that the text they come from is cleaned once.
    """
    value = F.when(~F.col(unusable), F.col(number))
    middle = F.median(value) if exact else F.percentile_approx(value, 0.5, F.lit(10000)).cast("double")
    return (
        df.groupBy(group)
        .agg(middle.alias("median_words"))
        .where(F.col("median_words").isNotNull())
        .orderBy(F.desc("median_words"), group)
        .limit(n)
    )


def language_shares(df: DataFrame, language: str, unusable: str) -> DataFrame:
    """Rows and percent per language over the usable rows, from one aggregate row."""
    codes = ("es", "en", "otro")
    usable = ~F.col(unusable)
    counts = df.agg(
        F.count_if(usable).alias("_all"),
        *[F.count_if(usable & (F.col(language) == code)).alias(code) for code in codes],
    )
    rows = [
        F.struct(
            F.lit(code).alias("idioma"),
            F.col(code).alias("n"),
            percent(F.col(code), F.col("_all")).alias("pct"),
        )
        for code in codes
    ]
    return counts.select(F.inline(F.array(*rows))).where("n > 0")


def nlp_summary(df: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    usable = F.count_if(~F.col("es_vacio_nlp"))
    return df.agg(
        total.alias("total"),
        usable.alias("usable_nlp"),
        percent(usable, total).alias("usable_nlp_pct"),
        F.count_if("es_vacio_nlp").alias("empty_nlp"),
        F.count_if(~F.col("es_vacio") & F.col("es_vacio_nlp")).alias("newly_empty"),
    )
