"""Search pages to visit: one row per keyword, country and page number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmill.functions.postings import country_currency, country_subdomain

MAX_PAGES = 5


def search_config(assignments: DataFrame, worker: str, fallback: str = "default") -> DataFrame:
    """``search_term, location, industry_niche`` of one worker; an unknown one takes ``fallback``.

    ``assignments`` adds the column ``worker``.
    """
    known = assignments.agg(F.count_if(F.col("worker") == worker)).scalar() > 0
    chosen = F.when(known, F.lit(worker)).otherwise(F.lit(fallback))
    return assignments.where(F.col("worker") == chosen).select("search_term", "location", "industry_niche")


def distinct_terms(config: DataFrame, term: str = "search_term") -> DataFrame:
    return config.select(F.col(term).alias("search_term")).where("search_term IS NOT NULL").distinct()


def search_url(site: str, keyword: Column, country: Column, page: Column, remote: bool = False) -> Column:
    """Fixed link templates of the two listing sites."""
    slug = F.replace(keyword, F.lit(" "), F.lit("-"))
    if site == "computrabajo":
        tail = "-modalidad-teletrabajo?p=" if remote else "?p="
        head = F.concat(F.lit("https://"), country_subdomain(country), F.lit(".computrabajo.com/trabajo-de-"))
    elif site == "occ":
        tail = "/en-mexico-y-teletrabajo/?page=" if remote else "/?page="
        head = F.lit("https://www.occ.com.mx/empleos/de-")
    else:
        raise ValueError(f"unknown site {site!r}")
    return F.concat(head, slug, F.lit(tail), page.cast("string"))


def search_pages(
    terms: DataFrame,
    site: str = "computrabajo",
    countries: Sequence[str] = ("MX",),
    pages: int = MAX_PAGES,
    remote: bool = False,
) -> DataFrame:
    """Every page of every term: the small lists are exploded inside the row."""
    rows = terms.select("search_term", F.explode(F.array(*[F.lit(c) for c in countries])).alias("country_code"))
    rows = rows.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(pages))))
    return rows.withColumns(
        {
            "currency": country_currency(F.col("country_code")),
            "url": search_url(site, F.col("search_term"), F.col("country_code"), F.col("page"), remote),
        }
    )


def enabled_sources(rows: DataFrame, flags: DataFrame, source: str = "site") -> DataFrame:
    """Rows of the sources whose flag is on (``flags``: ``source, enabled``)."""
    on = flags.where("enabled").select(F.col("source").alias(source)).distinct()
    return rows.join(on, source, "left_semi")
