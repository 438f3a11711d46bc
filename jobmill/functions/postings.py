"""Column rules of one posting: defaults, flags, modality, links, lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmill import lookups
from jobmill.functions.location import constant_map


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def default(value: Column, fallback: str) -> Column:
    """Null becomes the fallback; an empty text stays."""
    return F.coalesce(value, F.lit(fallback))


def lower_text(value: Column) -> Column:
    return F.lower(F.coalesce(value, F.lit("")))


def to_number(text: Column) -> Column:
    """Numeric coercion: whatever does not parse is null, and so is NaN."""
    return nan_to_null(text.try_cast("double"))


def strict_bool(text: Column, otherwise: bool) -> Column:
    """Only the exact words ``True`` and ``False`` count."""
    return F.when(text == "True", True).when(text == "False", False).otherwise(otherwise)


def detect_job_type(title: Column, location: Column) -> Column:
    text = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(location, F.lit(""))))
    return (
        F.when(text.rlike("|".join(lookups.REMOTE_WORDS)), "remoto")
        .when(text.rlike("|".join(lookups.HYBRID_WORDS)), "hibrido")
        .otherwise("presencial")
    )


def map_job_type(label: Column) -> Column:
    """Site label to modality; a label outside the table passes through."""
    return F.coalesce(F.element_at(constant_map(lookups.JOB_TYPES), label), label)


def any_salary(low: Column, high: Column) -> Column:
    return low.isNotNull() | high.isNotNull()


def full_salary(low: Column, high: Column) -> Column:
    return low.isNotNull() & high.isNotNull()


def title_with_text(title: Column, text: Column, unusable: Column) -> Column:
    joined = F.concat(F.coalesce(title, F.lit("")), F.lit(". "), text)
    return F.when(unusable, title).otherwise(joined)


def country_search_name(code: Column) -> Column:
    return default(F.element_at(constant_map(lookups.COUNTRY_NAMES), code), "mexico")


def country_display(code: Column) -> Column:
    return F.when(code == "MX", "México").otherwise(code)


def country_subdomain(code: Column) -> Column:
    table = constant_map({k: v[0] for k, v in lookups.COUNTRY_SITES.items()})
    return default(F.element_at(table, code), "mx")


def country_currency(code: Column) -> Column:
    table = constant_map({k: v[1] for k, v in lookups.COUNTRY_SITES.items()})
    return default(F.element_at(table, code), "MXN")


def absolute_url(base: Column, href: Column) -> Column:
    return F.when(F.startswith(href, F.lit("/")), F.concat(base, href)).otherwise(href)


def numbered_url(number: Column, base: str = "https://www.occ.com.mx/empleo/oferta/") -> Column:
    """Posting link of a site that only shows a number; no number, no link."""
    return F.when(F.coalesce(number, F.lit("")) != "", F.concat(F.lit(base), number, F.lit("/")))


def is_source_day(day: Column, enabled: Column | bool = True, weekday: int = 0) -> Column:
    """True on the one weekday a source runs (0 is Monday) while it is enabled."""
    return (F.weekday(day) == weekday) & (enabled if isinstance(enabled, Column) else F.lit(enabled))


def with_status(status: Column, wanted: Sequence[str]) -> Column:
    return status.isin(*wanted)


def is_recent(when: Column, now: Column, hours: int = 72) -> Column:
    return when >= now - F.make_dt_interval(hours=F.lit(hours))
