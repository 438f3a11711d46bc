"""State and region rules on the raw location text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmill import lookups
from jobmill.functions.text import strip

NO_DATA = "Sin dato"
PLACE = r"(?Ud)^(.+?),\s*([A-Z]{2,3}),\s*([A-Z]{2})\z"


def constant_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def detect_state(location: Column) -> Column:
    """First configured word the lower-cased location holds; null otherwise."""
    text = F.lower(F.coalesce(location, F.lit("")))
    rule = F.lit(None).cast("string")
    for word, state in reversed(lookups.STATE_WORDS):
        rule = F.when(F.contains(text, F.lit(word)), F.lit(state)).otherwise(rule)
    return rule


def parse_location(location: Column) -> Column:
    """Struct ``city, state_code, region`` of ``City, STATE, COUNTRY`` and remote texts."""
    raw = strip(location)
    part = [strip(F.regexp_extract(raw, PLACE, i)) for i in (1, 2, 3)]
    city, code, country = part
    known = F.element_at(constant_map(lookups.REGIONS), code)
    key_city = F.lower(city).rlike("|".join(lookups.BAJIO_CITIES))
    region = (
        F.when(country != "MX", F.lit("Internacional"))
        .when((known == lookups.BAJIO) & key_city, F.concat(F.lit(f"{lookups.BAJIO} — "), city))
        .otherwise(F.coalesce(known, code))
    )
    null = F.lit(None).cast("string")

    def place(c: Column, s: Column, r: Column) -> Column:
        return F.struct(c.alias("city"), s.alias("state_code"), r.alias("region"))

    return (
        F.when(raw.isNull() | (raw == ""), place(null, null, F.lit(NO_DATA)))
        .when(
            raw.rlike(r"(?iuU)\b(?:desde casa|remoto|remote)\b"),
            place(F.lit("Remoto"), null, F.lit("Remoto")),
        )
        .when(code != "", place(city, code, region))
        .otherwise(place(raw, null, F.lit(NO_DATA)))
    )
