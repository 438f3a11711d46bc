"""Exact top-k search with a vector-approximation file."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobmill.llm.common import drop, store

BITS = 6
TOP = 5
QUERY_EVERY = 50
#: Rows and queries that meet in one task at a time: 8,192 x 2,048 vectors.
ROW_BLOCK, QUERY_BLOCK = 8192, 2048
#: Queries whose bounds are held at once inside a task.
AT_ONCE = 128


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, dim, vector``: every component x as floor(256 x), x as double.

    Rows without an id, and vectors that are null or hold a null, NaN or infinite
    component, take no part. Components beyond 64-bit integers end at their limits.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fit).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.size("embedding").alias("dim"),
        F.transform(x, lambda v: F.floor(v * 256)).alias("vector"),
    )


def approximation_file(vectors: DataFrame, bits: int = BITS) -> tuple[DataFrame, int, int]:
    """The stored file of cells and vectors, the lowest cell's border and a cell's width.

    A cell number has ``bits`` bits; borders come from the least and greatest component of
    all vectors.
    """
    numbers = store(integer_vectors(vectors), "vectors")
    low, high = numbers.agg(F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    low, high = low or 0, high or 0
    width = (high - low) // (1 << bits) + 1
    def cell(v: Column) -> Column:
        at = F.floor((v.cast("double") - float(low)) / float(width))
        return F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), at)).cast("short")

    file = store(numbers.withColumn("cells", F.transform("vector", cell)), "approximations")
    drop(numbers)
    return file, low, width


def nothing() -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([], dtype="int64") for c in ("query_row", "query_id", "vec_id", "score")})


def exact_scores(vectors: np.ndarray, query: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, list[int]]:
    """The ``n`` best scores of vectors whose products may pass 64 bits, and their places.

    A best score that has no 64-bit form raises an error.
    """
    own = query.astype(object)
    score = [int((v.astype(object) * own).sum()) for v in vectors]
    best = sorted(range(len(score)), key=lambda i: (-score[i], ids[i]))[:n]
    if any(not -(1 << 63) <= score[i] < 1 << 63 for i in best):
        raise OverflowError("a score has no 64-bit form: the components are too large")
    return np.array([score[i] for i in best], np.int64), best


def nearest(rows: pd.DataFrame, queries: pd.DataFrame, low: int, width: int, top: int) -> pd.DataFrame:
    """The best ``top`` rows of this block for each query of this block.

    The cells give every score within ``width * |q| / 2`` of that of the cells' centres.
    Vectors are read in the order of their upper bounds until the next bound is below the
    score at place ``top``.
    """
    ids = rows["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    vectors = np.stack(rows["vector"].to_numpy()[order]).astype(np.int64)
    cells = np.stack(rows["cells"].to_numpy()[order])
    centres = low + cells * float(width) + (width - 1) / 2
    # A cell number is rounded where components pass 2^53, by less than this.
    half = (width - 1) / 2 + (abs(low) + 64.0 * width) * 2.0**-50
    wide = vectors.shape[1] * int(max(abs(int(vectors.min())), int(vectors.max()))) ** 2 >= 1 << 62
    wanted = np.stack(queries["vector"].to_numpy()).astype(np.int64)
    own = queries["vec_id"].to_numpy()
    out = []
    for at in range(0, len(queries), AT_ONCE):
        part = wanted[at : at + AT_ONCE].astype(np.float64)
        near = part @ centres.T
        # Rounding of the product is far below this share of its largest possible size.
        slack = half * np.abs(part).sum(1) + 1e-9 * (np.abs(part).sum(1) * np.abs(centres).max(initial=0)) + 1e-6
        for i in range(len(part)):
            bound = near[i] + slack[i]
            bound[ids == own[at + i]] = -np.inf
            n = min(top, int(np.isfinite(bound).sum()))
            if not n:
                continue
            # No row below the lower bound of the n-th best can be among the best.
            floor = np.partition(bound, len(bound) - n)[len(bound) - n] - 2 * slack[i]
            able = np.flatnonzero(bound >= floor)
            able = able[np.argsort(-bound[able], kind="stable")]
            if wide:
                score, best = exact_scores(vectors[able], wanted[at + i], ids[able], n)
                out.append((queries["row"].iloc[at + i], own[at + i], ids[able[best]], score))
                continue
            score = np.empty(0, np.int64)
            read, step = 0, 4 * n
            while read < len(able) and (read < n or bound[able[read]] >= np.partition(score, read - n)[read - n]):
                score = np.append(score, vectors[able[read : read + step]] @ wanted[at + i])
                read, step = len(score), step * 2
            best = np.lexsort((ids[able[:read]], -score))[:n]
            out.append((queries["row"].iloc[at + i], own[at + i], ids[able[best]], score[best]))
    if not out:
        return nothing()
    sizes = [len(x[2]) for x in out]
    return pd.DataFrame(
        {
            "query_row": np.repeat([x[0] for x in out], sizes),
            "query_id": np.repeat([x[1] for x in out], sizes),
            "vec_id": np.concatenate([x[2] for x in out]),
            "score": np.concatenate([x[3] for x in out]),
        }
    )


def top_k(vectors: DataFrame, every: int = QUERY_EVERY, top: int = TOP, bits: int = BITS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is divisible by ``every`` the
    ``top`` highest integer inner products over all other rows, ties to the smaller id.

    Vectors of another length than the query's are no candidates; rows with the query's id
    count as its own; a row that repeats a query's id is a query of its own. Rows and queries
    are dealt into blocks of bounded size by row number, so equal vectors spread, and every
    pair of blocks is one task's work. Fewer than ``top`` candidates give fewer rows.
    """
    file, low, width = approximation_file(vectors, bits)
    n_rows, n_queries = file.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0)).first()
    row_blocks, query_blocks = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))

    def place(blocks: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")

    def all_of(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    key = ["dim", "row_block", "query_block"]
    rows = file.withColumn("row_block", place(row_blocks)).withColumn("query_block", all_of(query_blocks))
    queries = (
        file.where(F.col("vec_id") % every == 0)
        .drop("cells")
        .withColumn("query_block", place(query_blocks))
        .withColumn("row_block", all_of(row_blocks))
    )

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) and len(right):
            return nearest(left, right, low, width, top)
        return nothing()

    found = rows.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(
        block, "query_row long, query_id long, vec_id long, score long"
    )
    place_of = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place_of).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
