"""Parts the operators share: stored tables, word rules, places for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmill.session import shared_dir, small_batches

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: A key is hot above this share of the rows, so fewer than ``1 / HOT_SHARE`` keys are.
HOT_SHARE = 1 / 2048
#: No key with more rows than this is cold, however many rows there are.
MOST_COLD = 1 << 18
#: Places of the keys that are not hot, at least.
FEWEST_PLACES = 2048


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hot_limit(total: int) -> float:
    """Rows beyond which a key is hot: a share of all rows, and never more than ``MOST_COLD``.

    So at most ``max(1 / HOT_SHARE, total / MOST_COLD)`` keys are hot: some 100,000 of 2.5e10 rows.
    """
    return min(total * HOT_SHARE, MOST_COLD)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def store(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the folder all executors share and read again: its lineage is cut."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    with small_batches(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, compression: str = "snappy") -> tuple[DataFrame, str]:
    """A stored copy of ``df`` with a number that every row keeps whenever it is read, and that column's name."""
    name = free_name(df, "_row")
    return store(df.withColumn(name, F.monotonically_increasing_id()), "numbered", compression), name


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of the keys."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[k])
    return out


def attach(rows: DataFrame, facts: DataFrame, keys: Sequence[str], weight: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row per key and, in ``weight``,
    how many rows that key has.

    Facts of hot keys, of which there are few (see ``hot_limit``), are broadcast, so the rows of
    a hot key stay where they are; all other keys are shuffled. Rows without facts are left
    out. ``rows`` is read twice: pass a stored table.
    """
    keys = list(keys)
    limit = max(1.0, hot_limit(total))
    renamed = facts.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    names = [f"_k_{k}" for k in keys]
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    hot = F.broadcast(renamed.where(F.col(weight) > limit))
    warm = rows.join(hot, on, "inner").drop(*names)
    cold = rows.join(hot.select(*names), on, "left_anti").join(
        renamed.where(F.col(weight) <= limit), on, "inner"
    )
    return warm.unionByName(cold.drop(*names))


def places(df: DataFrame, hashed: Column, spread: Column, per_place: int) -> tuple[DataFrame, int]:
    """``df`` with ``_place``, a number of which no value holds many more than ``per_place`` rows
    or ``hot_limit`` rows, and the number of places; ``_hot`` marks rows of hot keys.

    Rows of one cold key share a place. A hot key (found by counting its hash) has as many
    places of its own as its count asks for. Few keys are hot, and that list
    alone reaches the driver.
    """
    spark = df.sparkSession
    counts = df.select(hashed.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    counts = store(counts, "counts")
    rows = counts.agg(F.sum("_n")).first()[0] or 0
    limit = max(2.0, hot_limit(rows))
    found = counts.where(F.col("_n") > limit).orderBy("_h").collect()
    drop(counts)
    cold = max(FEWEST_PLACES, -(-rows // per_place))
    listed, first = [], cold
    for h, n in found:
        fan = int(-(-n // limit))
        listed.append((h, first, fan))
        first += fan
    hot = spark.createDataFrame(listed, "_h long, _first long, _fan long")
    placed = (
        df.withColumn("_h", hashed)
        .join(F.broadcast(hot), "_h", "left")
        .withColumns(
            {
                "_place": F.when(
                    F.col("_fan").isNotNull(), F.col("_first") + F.pmod(F.xxhash64(spread), F.col("_fan"))
                ).otherwise(F.pmod("_h", F.lit(cold))),
                "_hot": F.col("_fan").isNotNull(),
            }
        )
        .drop("_first", "_fan")
    )
    return placed, first
