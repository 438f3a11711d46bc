"""Input tables and the postings view over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# One SQL text for both engines. ``{documents}`` and ``{events}`` name the inputs.
POSTINGS_SQL = """
SELECT
  d.doc_id AS id,
  CASE d.doc_id % 4 WHEN 0 THEN 'indeed' WHEN 1 THEN 'linkedin' WHEN 2 THEN 'computrabajo' ELSE 'occ' END AS site,
  CASE WHEN d.doc_id % 50 = 49 THEN NULL
       ELSE concat('https://jobs.example/', cast(d.doc_id - d.doc_id % 10 + (d.doc_id % 10) % 9 AS string)) END AS job_url,
  CASE WHEN d.doc_id % 41 = 40 THEN NULL ELSE substr(d.text, 1, 40) END AS title,
  CASE WHEN d.doc_id % 11 = 10 THEN NULL ELSE concat('Empresa ', cast(d.doc_id % 37 AS string)) END AS company,
  CASE d.doc_id % 10 WHEN 0 THEN 'Irapuato, GUA, MX' WHEN 1 THEN 'León, GUA, MX' WHEN 2 THEN 'Zapopan, JAL, MX'
       WHEN 3 THEN 'Desde casa' WHEN 4 THEN 'New York, NY, US' WHEN 5 THEN 'Guadalajara' WHEN 6 THEN 'Qro, México'
       WHEN 7 THEN 'Xalapa, XXX, MX' WHEN 8 THEN '  ' ELSE NULL END AS raw_location,
  'México' AS country,
  CASE WHEN d.doc_id % 4 >= 2 THEN 'MX' END AS country_code,
  CASE d.lang WHEN 'en' THEN 'Data Engineer' WHEN 'es' THEN 'Data Analyst' WHEN 'fr' THEN 'Cloud Engineer'
       ELSE 'React Developer' END AS career,
  concat('worker', cast(d.doc_id % 5 AS string)) AS scraped_by,
  CASE WHEN d.lang IN ('en', 'es') THEN 'Ingeniería de Datos' ELSE 'Infraestructura Cloud' END AS industry_niche,
  CASE d.doc_id % 5 WHEN 0 THEN 'Remoto' WHEN 1 THEN 'Híbrido' WHEN 2 THEN 'Presencial' WHEN 3 THEN 'fulltime'
       ELSE NULL END AS job_type,
  CASE WHEN d.doc_id % 3 = 0 THEN cast(8000 + (d.doc_id * 37) % 40000 AS double) END AS salary_min,
  CASE WHEN d.doc_id % 6 = 0 THEN cast(9000 + (d.doc_id * 37) % 40000 AS double) END AS salary_max,
  concat(CASE d.doc_id % 6
      WHEN 0 THEN '**Requisitos** ver https://x.mx/a?b=1 o www.y.mx '
      WHEN 1 THEN 'Sueldo $12,000 a $13,500 MXN, tel 5512345678 '
      WHEN 2 THEN 'Correo ana@empresa.com #empleo *urgente* '
      WHEN 3 THEN concat('Ofrecemos ', chr(92), '- bono ', chr(92), '* vales $ 9,500', chr(92), 'n ')
      ELSE '' END, d.text) AS description,
  {dates}
  cast(NULL AS string) AS date_posted,
  CASE WHEN d.doc_id % 4 >= 2 THEN 'MXN' END AS currency,
  CASE d.doc_id % 7 WHEN 0 THEN 'NEW' WHEN 1 THEN 'PENDING_ENRICHMENT' WHEN 2 THEN 'APPLIED' WHEN 3 THEN 'SCREENING'
       WHEN 4 THEN 'INTERVIEW' WHEN 5 THEN 'NOTIFIED' ELSE 'ORPHANED' END AS status,
  d.lang, d.text
FROM documents d {join}
"""
DATES_SQL = """
  e.ts AS date_scraped,
  CASE WHEN d.doc_id % 5 <> 4 THEN e.ts + INTERVAL 3 DAY END AS last_updated,
  CASE WHEN d.doc_id % 7 IN (2, 3, 4) THEN e.ts + INTERVAL 1 DAY END AS applied_date,
"""
JOIN_SQL = "LEFT JOIN events e ON e.event_id = d.doc_id"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread an input that is a single split, so at most ``maxPartitionBytes`` long.

    One split would keep one core busy with all text work. An input of two splits or more
    is returned as it is, whatever the number of cores, so no larger table is moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() == 1 else df


KEYS = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(df, KEYS[name]) if name in KEYS else df


def postings_sql(dates: bool = True) -> str:
    return POSTINGS_SQL.format(dates=DATES_SQL if dates else "", join=JOIN_SQL if dates else "")


def postings(spark: SparkSession, folder: str, dates: bool = True) -> DataFrame:
    """The postings table; ``dates=False`` leaves out the join that only adds times."""
    text = postings_sql(dates).replace("documents d", "{documents} d").replace("events e", "{events} e")
    inputs = {"documents": table(spark, folder, "documents")}
    if dates:
        inputs["events"] = table(spark, folder, "events")
    return spark.sql(text, **inputs)


def read_postings(spark: SparkSession, path: str | None = None, **jdbc: str) -> DataFrame:
    """The stored table from Parquet, or over JDBC split by the numeric key.

    ``jdbc`` takes Spark's own options (``url``, ``dbtable``, ``lowerBound``, ...).
    """
    if path:
        return spark.read.parquet(path)
    options = {"partitionColumn": "id", "numPartitions": "64", **jdbc}
    return spark.read.format("jdbc").options(**options).load()
