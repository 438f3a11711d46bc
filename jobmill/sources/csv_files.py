"""CSV in and out: every column is text on the way in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmill.functions.postings import strict_bool, to_number

# Words the reference's CSV reader takes for a missing value.
NA_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "",
)
CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}
BOM = "\ufeff"
ROWS_PER_FILE = 50_000


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_WORDS), text)


def read_text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as strings; quoted values may span lines; NA words are null.

    A file with multi-line values is read by one task; ``write_csv`` bounds the rows of a file.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).options(multiLine=True, **CSV).csv(path)
    return raw.select(*[na_to_null(F.col(c)).alias(c) for c in columns])


def restore_types(df: DataFrame) -> DataFrame:
    """Numbers and flags of a corpus that was read as text."""
    numbers = [c for c in ("salary_min", "salary_max", "n_palabras") if c in df.columns]
    # What each flag becomes when its text is neither True nor False.
    flags = {"is_premium": False, "tiene_salario": False, "es_vacio": True}
    return df.withColumns(
        {
            **{c: to_number(F.col(c)) for c in numbers},
            **{c: strict_bool(F.col(c), d) for c, d in flags.items() if c in df.columns},
        }
    )


def flags_as_words(df: DataFrame) -> DataFrame:
    """Booleans written as ``True`` and ``False``, the words ``restore_types`` reads."""
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.when(F.col(c), "True").when(~F.col(c), "False") for c in flags})


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", rows_per_file: int = ROWS_PER_FILE) -> None:
    """CSV files of at most ``rows_per_file`` rows: a file with multi-line values is read by one task."""
    written = flags_as_words(df).write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    written.options(lineSep="\n", **CSV).csv(path)


def write_report_csv(df: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None) -> None:
    """Spreadsheet files, each with a byte-order mark and a header.

    Tasks write their own part, in order for an ordered report. ``files`` merges the
    parts of a report that is known to be small.
    """
    first, *rest = df.columns
    marked = flags_as_words(df).withColumnRenamed(first, BOM + first)
    if files is not None:
        marked = marked.coalesce(files)
    marked.write.mode(mode).options(**CSV).csv(path)


def all_marked(spark: SparkSession, path: str) -> Column:
    """Whether every file below ``path`` begins with a byte-order mark; files are opened one per task at most."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    return files.agg(F.bool_and(F.hex(F.substring("content", 1, 3)) == "EFBBBF")).scalar()
