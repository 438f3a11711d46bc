"""Salary amounts in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three amount patterns.
THOUSANDS = r"(?U)\$\s?([0-9]{1,3}(?:,[0-9]{3})+)"
ANY_AMOUNT = r"(?U)([0-9,]+\.?[0-9]*)"
FIRST_AMOUNT = r"(?U)\$\s*+[0-9,]+\.?[0-9]*(?:\s*+[-–]\s*+\$?\s*+[0-9,]+\.?[0-9]*)?"


def amounts(text: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.transform(found, lambda m: F.replace(m, F.lit(","), F.lit("")).try_cast("double"))


def _range(low: Column, high: Column) -> Column:
    return F.struct(low.alias("salary_min"), high.alias("salary_max"))


def salary_from_text(text: Column) -> Column:
    """Lowest and highest dollar amount that carries a thousands comma."""
    values = amounts(text, THOUSANDS)
    return _range(F.array_min(values), F.array_max(values))


def parse_salary(text: Column) -> Column:
    """First two amounts in reading order; a single one is both ends."""
    values = amounts(text, ANY_AMOUNT)
    first = F.get(values, F.lit(0))
    return _range(first, F.when(F.size(values) > 1, F.get(values, F.lit(1))).otherwise(first))


def first_amount(text: Column) -> Column:
    """First amount or amount range as written, null when there is none."""
    return F.nullif(F.regexp_extract(text, FIRST_AMOUNT, 0), F.lit(""))
