"""The two corpus stages: cleaned text, then token text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmill import schema as S
from jobmill.functions.location import parse_location
from jobmill.functions.postings import any_salary, title_with_text
from jobmill.functions.text import clean_description, has_few_words, word_count
from jobmill.operators.language import LanguageModel, detect
from jobmill.operators.nlp import add_nlp_columns


def add_clean_columns(jobs: DataFrame) -> DataFrame:
    """Location parts, salary flag and cleaned text: a map-only chain."""
    return (
        jobs.withColumn("_place", parse_location(F.col("raw_location")))
        .withColumns(
            {
                "city": F.col("_place.city"),
                "state_code": F.col("_place.state_code"),
                "region": F.col("_place.region"),
                "tiene_salario": any_salary(F.col("salary_min"), F.col("salary_max")),
                "descripcion_raw": F.col("description"),
                "descripcion_limpia": clean_description(F.col("description")),
            }
        )
        .drop("_place")
        .withColumn("n_palabras", word_count(F.col("descripcion_limpia")))
        .withColumn("es_vacio", has_few_words(F.col("descripcion_limpia")))
        .withColumn(
            "titulo_desc",
            title_with_text(F.col("title"), F.col("descripcion_limpia"), F.col("es_vacio")),
        )
    )


def cleaned_corpus(jobs: DataFrame, model: LanguageModel) -> DataFrame:
    """The 26-column corpus: map-only, so texts never move between tasks."""
    cleaned = add_clean_columns(jobs)
    if "is_premium" not in cleaned.columns:
        cleaned = cleaned.withColumn("is_premium", F.lit(False))
    found = detect(cleaned, "descripcion_limpia", ~F.col("es_vacio"), model)
    return found.select(*[c for c in S.CORPUS_COLUMNS if c in found.columns])


def nlp_corpus(corpus: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """The cleaned corpus plus its five token columns."""
    return add_nlp_columns(corpus, lemmas)
