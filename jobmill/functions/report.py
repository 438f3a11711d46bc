"""Report texts: local time, printable characters, salary label, card lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPORT_ZONE = "America/Mexico_City"
CARD_CHARS = 400


def local_time(utc: Column, zone: str = REPORT_ZONE) -> Column:
    """Wall-clock time in the report zone of a zone-less UTC time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))


def printable(text: Column) -> Column:
    """Plain quotes and dashes; anything outside Latin-1 becomes a question mark."""
    plain = F.translate(F.coalesce(text, F.lit("")), "“”’–", "\"\"'-")
    return F.regexp_replace(plain, F.lit(r"[^\x00-\xff]"), F.lit("?"))


def filled(text: Column, fallback: str) -> Column:
    """Fallback for null and for empty text."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(fallback)).otherwise(printable(text))


def salary_label(low: Column, high: Column) -> Column:
    def money(value: Column) -> Column:
        return F.concat(F.lit("$"), F.format_number(value, 0))

    return (
        F.when(low.isNull(), "Salario no mostrado")
        .when(high.isNull(), money(low))
        .otherwise(F.concat(money(low), F.lit(" - "), money(high)))
    )


def capitalised(text: Column) -> Column:
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def card_title(job_type: Column, title: Column, site: Column) -> Column:
    tag = F.when(F.coalesce(job_type, F.lit("")) == "", "").otherwise(
        F.concat(F.lit("["), F.upper(job_type), F.lit("] "))
    )
    return F.concat(tag, printable(title), F.lit(" ("), capitalised(site), F.lit(")"))


def card_place(company: Column, state: Column, location: Column) -> Column:
    return F.concat(
        filled(company, "Empresa confidencial"),
        F.lit(" | "),
        filled(state, "México"),
        F.lit(" ("),
        printable(location),
        F.lit(")"),
    )


def card_text(description: Column) -> Column:
    """The card shows the first 400 characters, always followed by dots."""
    return F.concat(F.left(filled(description, "Sin descripcion disponible"), F.lit(CARD_CHARS)), F.lit("..."))
