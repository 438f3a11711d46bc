"""Declared schemas, defaults and status values of the postings table."""

from __future__ import annotations

from pyspark.sql import types as T

NEW = "NEW"
PENDING = "PENDING_ENRICHMENT"
ORPHANED = "ORPHANED"
NOTIFIED = "NOTIFIED"
APPLIED = "APPLIED"

REPORT_STATUSES = (NEW, APPLIED)
EXPORT_STATUSES = (NEW, PENDING)
FOLLOWUP_STATUSES = (APPLIED, "SCREENING", "INTERVIEW")

DEFAULT_COUNTRY = "México"
DEFAULT_COMPANY = "Empresa confidencial"
DEFAULT_LOCATION = "Ubicación desconocida"
DEFAULT_CURRENCY = "MXN"

# The stored table and the longest text each column admits.
POSTINGS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("site", T.StringType()),
        T.StructField("job_url", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("company", T.StringType(), False),
        T.StructField("raw_location", T.StringType(), False),
        T.StructField("country", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("career", T.StringType()),
        T.StructField("scraped_by", T.StringType()),
        T.StructField("industry_niche", T.StringType()),
        T.StructField("is_premium", T.BooleanType()),
        T.StructField("job_type", T.StringType()),
        T.StructField("salary_min", T.DoubleType()),
        T.StructField("salary_max", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("salary_source", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("cleaned_description", T.StringType()),
        T.StructField("keywords_json", T.StringType()),
        T.StructField("date_posted", T.StringType()),
        T.StructField("date_scraped", T.TimestampType()),
        T.StructField("last_updated", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)
LENGTH_CAPS = {
    "site": 50,
    "country": 50,
    "country_code": 5,
    "state": 50,
    "career": 100,
    "scraped_by": 50,
    "industry_niche": 50,
    "job_type": 20,
    "currency": 10,
    "salary_source": 20,
    "status": 20,
}
REQUIRED = tuple(f.name for f in POSTINGS.fields if not f.nullable and f.name != "id")

# The columns every listing source hands over, in this order.
LISTING = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("job_url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("raw_location", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("date_posted", T.StringType()),
        T.StructField("salary_min", T.DoubleType()),
        T.StructField("salary_max", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("job_type", T.StringType()),
        T.StructField("country_code", T.StringType()),
    ]
)

# Output order of the cleaned corpus.
CORPUS_COLUMNS = (
    "id site job_url title company career industry_niche job_type is_premium salary_min salary_max "
    "currency tiene_salario raw_location city state_code region date_posted date_scraped idioma_det "
    "es_vacio n_palabras descripcion_raw descripcion_limpia titulo_desc status"
).split()
NLP_COLUMNS = "descripcion_nlp titulo_nlp texto_nlp n_palabras_nlp es_vacio_nlp".split()

# Columns of the lake export.
EXPORT_COLUMNS = (
    "id site job_url title company raw_location country country_code state career scraped_by "
    "industry_niche job_type salary_min salary_max currency description date_posted date_scraped status"
).split()
REPORT_COLUMNS = (
    "id title company raw_location state job_type salary_min salary_max site job_url date_posted"
).split()
