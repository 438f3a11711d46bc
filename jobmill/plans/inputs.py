"""Frames the registered queries start from, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmill.functions.tokens import lemma_language
from jobmill.operators import language
from jobmill.operators.nlp import lemmatize, nlp_columns, stored, token_rows
from jobmill.operators.normalize import normalize_listing_batch, normalize_search_batch
from jobmill.plans.corpus import add_clean_columns
from jobmill.sources.tables import postings, table

TODAY = "2024-01-31 00:00:00"
CHECKPOINT = "2024-01-01 12:00:00"
SEARCH_SITES = ("indeed", "linkedin")
LISTING_SITES = ("computrabajo", "occ")
# The configured order of the search terms, which is not the alphabetical one.
TERMS = ("React Developer", "Data Engineer", "Cloud Engineer", "Data Analyst")
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# Cards of the two listing sites; a page's number decides what its card holds.
COMPUTRABAJO_CARDS_SQL = """concat('<main>',
  CASE WHEN doc_id % 5 = 0 THEN '<div class="box_offer"><h2>sin enlace</h2></div>' ELSE '' END,
  '<div class="js box_offer"><h2 class="fs18"><a class="js-o-link fc_base" href="/oferta/', cast(doc_id AS string), '">Puesto <b>', cast(doc_id AS string),
  '</b></a></h2><div class="fs16"><p class="mt5"><span>4,5</span><a>Empresa ', cast(doc_id % 37 AS string),
  '</a></p><p class="mt5">León, Gto.</p></div><p class="fc_aux">Hace ', cast(doc_id % 9 AS string), ' días</p><div class="fs12 mt15">',
  CASE WHEN doc_id % 2 = 0 THEN '<span class="dIB">$12,000 - $15,000</span>' ELSE '' END,
  CASE WHEN doc_id % 4 = 0 THEN '<span class="dIB">$20,000.50</span>' ELSE '' END,
  CASE WHEN doc_id % 3 = 0 THEN '<span class="dIB"><span class="icon i_home"></span>Remoto</span>' ELSE '' END,
  CASE WHEN doc_id % 6 = 0 THEN '<span class="dIB"><span class="i_home_office"></span>Mixto</span>' ELSE '' END,
  '</div></div>', CASE WHEN doc_id % 7 <> 0 THEN '<span class="b_primary buildLink" data-path="p2"></span>' ELSE '' END, '</main>')"""
OCC_CARDS_SQL = """concat('<div data-offers-grid-offer-item-container data-id="', CASE WHEN doc_id % 5 = 0 THEN '' ELSE cast(doc_id AS string) END,
  '"><h2 class="text-lg text-grey-900">Puesto ', cast(doc_id AS string), '</h2>',
  CASE doc_id % 3 WHEN 0 THEN '<span class="mr-2 text-grey-900 font-base font-light">$5,000</span>'
    WHEN 1 THEN '<span class="mr-2 text-grey-900 font-base font-light">Sueldo oculto</span>' ELSE '' END,
  '<div class="col-span-10"><div class="h-[21px]"><a>Empresa</a> ', cast(doc_id % 37 AS string), '</div></div>',
  CASE WHEN doc_id % 4 <> 0 THEN '<div class="no-alter-loc-text"><p>CDMX</p></div>' ELSE '' END,
  '<span class="mr-2 text-sm font-light">Ayer</span></div>')"""


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def time_text(column: str) -> Column:
    return F.date_format(column, TIME_FORMAT).alias(column)


def label_language() -> Column:
    """The labelled language under its reported name."""
    return F.when(F.col("lang").isin("es", "en"), F.col("lang")).otherwise("otro")


def labelled_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned postings with the labelled language in place of a detected one."""
    jobs = postings(spark, folder, dates=False)
    return add_clean_columns(jobs).withColumn("idioma_det", label_language())


def detected_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned postings with the detected language, learned from the labelled documents."""
    model = language.train(table(spark, folder, "documents"), "text", "lang")
    cleaned = add_clean_columns(postings(spark, folder, dates=False))
    return language.detect(cleaned, "descripcion_limpia", ~F.col("es_vacio"), model)


def lemma_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The token corpus in full: cleaned, detected, tokenised, with lemmas, as ``token_rows`` has it.

    Tokens are stored once, with the named columns; the lemma table and the result are both
    made from the stored tokens, so no text is cleaned or scored twice.
    """
    rows = token_rows(detected_corpus(spark, folder))
    kept = stored(rows.select("id", "idioma_det", "es_vacio", "_n", "_all", *columns), "tokens")
    return lemmatize(kept, "_all", "idioma_det", plural_lemmas(kept, "_all"))


def nlp_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """``lemma_rows`` with their token columns. The rows are stored, so that the workers which put
    the lemmas in place get small batches, whatever the session that reads the result has set."""
    return nlp_columns(stored(lemma_rows(spark, folder, *columns), "lemma-rows"))


def search_batch(jobs: DataFrame) -> DataFrame:
    raw = jobs.select(
        "id",
        "job_url",
        "site",
        "title",
        "company",
        F.col("raw_location").alias("location"),
        F.col("salary_min").alias("min_amount"),
        F.col("salary_max").alias("max_amount"),
        "currency",
        "description",
        "date_posted",
        F.col("career").alias("_term"),
        F.col("industry_niche").alias("_niche"),
        F.col("scraped_by").alias("_worker"),
    )
    rows = normalize_search_batch(raw, F.col("_term"), F.col("_niche"), F.col("_worker"))
    return rows.drop("_term", "_niche", "_worker")


def listing_batch(jobs: DataFrame) -> DataFrame:
    raw = jobs.select(
        "id",
        "site",
        "job_url",
        "title",
        "company",
        "raw_location",
        "date_posted",
        "salary_min",
        "salary_max",
        "currency",
        "job_type",
        "country_code",
        F.col("career").alias("_term"),
        F.col("industry_niche").alias("_niche"),
        F.col("scraped_by").alias("_worker"),
    )
    rows = normalize_listing_batch(raw, F.col("_term"), F.col("_niche"), F.col("_worker"))
    return rows.drop("_term", "_niche", "_worker")


def stored_links(jobs: DataFrame) -> DataFrame:
    """Links that were stored before: those of postings past their first stages."""
    past = jobs.where(~F.col("status").isin("NEW", "PENDING_ENRICHMENT") & F.col("job_url").isNotNull())
    return past.select("job_url").distinct()


def visit_results(jobs: DataFrame) -> DataFrame:
    """One detail-page result per link: that of its highest id."""
    rows = jobs.where(F.col("job_url").isNotNull()).select(
        "job_url",
        "id",
        F.expr("CASE WHEN id % 3 <> 0 THEN concat('Detalle ', cast(id AS string)) END").alias("description"),
        F.expr(
            "CASE id % 4 WHEN 0 THEN '$12,000 - $15,000' WHEN 1 THEN 'A convenir' WHEN 2 THEN '$20,000.50' END"
        ).alias("salary_raw"),
    )
    return rows.groupBy("job_url").agg(
        F.max_by("description", "id").alias("description"), F.max_by("salary_raw", "id").alias("salary_raw")
    )


def plural_lemmas(rows: DataFrame, tokens: str) -> DataFrame:
    """A lemma table learned from stored rows with tokens, stored: a word with a final s
    goes back to the same word without it when both occur in texts of that language."""
    words = rows.select(
        lemma_language(F.col("idioma_det")).alias("lang"), F.explode_outer(tokens).alias("token")
    ).where("token IS NOT NULL").distinct()
    # Stored, as both sides of the join read it; the tokens are split into words once.
    words = stored(words, "words")
    plural = words.where(F.endswith("token", F.lit("s"))).withColumn(
        "lemma", F.expr("substr(token, 1, length(token) - 1)")
    )
    found = plural.join(words.withColumnRenamed("token", "lemma"), ["lang", "lemma"], "left_semi")
    return stored(found.select("lang", "token", "lemma"), "lemmas")
