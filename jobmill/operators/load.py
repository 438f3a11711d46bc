"""Insert-if-new, status updates and per-source load counts.

Parquet has no in-place update: every operator maps an old snapshot to a new one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmill import schema as S


TIE = "_tie"


def with_tie(df: DataFrame) -> DataFrame:
    """``df`` with a hash of the whole row, which orders rows of equal position."""
    return df.withColumn(TIE, F.xxhash64(*[F.col(c) for c in df.columns]))


def first_positions(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Key, order columns and ``TIE`` of the first row of every key; nulls come first.

    ``df`` comes from ``with_tie``. Only these columns are grouped and they combine before the
    shuffle, so a key with very many copies sends one row per task.
    """
    order = [*order, TIE]
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    return first.select(F.col(key), *[F.col(f"_first.{c}").alias(c) for c in order])


def rows_at(df: DataFrame, positions: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The one row of ``df`` at each position, matched null-safe.

    Key, order and hash meet, so copies of one key spread over all tasks. Only rows that are
    equal in every column are still more than one; of these the last step keeps one.
    """
    named = positions.withColumnsRenamed({c: f"_at_{c}" for c in positions.columns})
    same = F.lit(True)
    for c in positions.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
    return df.join(named, same, "left_semi").dropDuplicates([key]).drop(TIE)


def dedup_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row of every key by ``order``, ties by the row's hash; rows without a key are left out."""
    tied = with_tie(df)
    return rows_at(tied, first_positions(tied, key, order), key, order)


def rejects(df: DataFrame, required: Sequence[str] = S.REQUIRED) -> Column:
    """True for rows that miss a required value."""
    missing = F.lit(False)
    for name in required:
        if name in df.columns:
            missing = missing | F.col(name).isNull()
    return missing


def new_rows(stored: DataFrame, batch: DataFrame, order: Sequence[str], key: str = "job_url") -> DataFrame:
    """Rows of the batch that enter the table: first per key, key not stored yet."""
    accepted = with_tie(batch.where(~rejects(batch)))
    # Stored keys are taken out of the narrow positions, so whole rows move little.
    wanted = first_positions(accepted, key, order).join(stored.select(key), key, "left_anti")
    return rows_at(accepted, wanted, key, order)


def insert_new(stored: DataFrame, batch: DataFrame, order: Sequence[str], key: str = "job_url") -> DataFrame:
    """The new snapshot: every stored row unchanged plus the new rows."""
    return stored.unionByName(new_rows(stored, batch, order, key), allowMissingColumns=True)


def load_counts(
    stored: DataFrame,
    batch: DataFrame,
    order: Sequence[str],
    source: str | None = None,
    key: str = "job_url",
) -> DataFrame:
    """Rows inserted, skipped and rejected, in total or for every source."""
    by = [source] if source else []
    narrow = batch.select(
        F.col(key), *by, *[c for c in order if c not in by], rejects(batch).alias("_rejected")
    )
    seen = narrow.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("_rejected").alias("rejected")
    )
    winners = (
        narrow.where(~F.col("_rejected"))
        .groupBy(key)
        .agg(F.min(F.struct(*order, *[c for c in by if c not in order])).alias("_first"))
        .join(stored.select(key), key, "left_anti")
    )
    entered = winners.groupBy(*[F.col(f"_first.{c}").alias(c) for c in by]).agg(
        F.count(F.lit(1)).alias("inserted")
    )
    # Without a source both sides are a single row.
    both = seen.join(entered, by, "left") if by else seen.withColumn("inserted", entered.scalar())
    inserted = F.coalesce("inserted", F.lit(0))
    return both.select(
        *by,
        inserted.alias("inserted"),
        (F.col("n_rows") - F.col("rejected") - inserted).alias("skipped"),
        "rejected",
    )


def cascade(batches: Sequence[tuple[str, DataFrame]], position: str = "load_order") -> DataFrame:
    """Sources of one run appended; ``position`` ranks them in the given order."""
    out = None
    for rank, (source, df) in enumerate(batches):
        tagged = df.withColumns({"load_source": F.lit(source), position: F.lit(rank)})
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no batches")
    return out


def term_rank(term: Column, terms: Sequence[str]) -> Column:
    """Place of a search term in the configured order of ``terms``; any other term comes after all of them."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(t) for t in terms]), term), F.lit(0))
    return F.when(place > 0, place).otherwise(F.lit(len(terms) + 1))


def mark_notified(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("status", F.when(F.col("status") == S.NEW, S.NOTIFIED).otherwise(F.col("status")))


def mark_applied(jobs: DataFrame, ids: DataFrame, applied_at: Column) -> DataFrame:
    """Set status and application time of every id in ``ids``; unknown ids do nothing."""
    chosen = ids.select("id").distinct().withColumn("_hit", F.lit(True))
    hit = F.coalesce("_hit", F.lit(False))
    return (
        jobs.join(chosen, "id", "left")
        .withColumns(
            {
                "status": F.when(hit, S.APPLIED).otherwise(F.col("status")),
                "applied_date": F.when(hit, applied_at).otherwise(F.col("applied_date")),
            }
        )
        .drop("_hit")
    )
