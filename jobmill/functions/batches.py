"""Work on Arrow batches of whole rows a bounded part at a time, so a worker's memory doesn't follow the batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tokens that a worker handles at a time.
MOST_TOKENS = 200_000
#: Bytes of texts or pages that a worker handles at a time.
MOST_BYTES = 1_000_000


def runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Start and length of runs of rows whose sizes add up to ``most`` at most; a larger row is a run of its own."""
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + most, side="right")), start + 1)
        yield start, stop - start
        start = stop


def list_sizes(lists: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)


def byte_sizes(texts: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)


def grams(lists: pa.Array, low: int, high: int) -> tuple[pa.Array, np.ndarray]:
    """All runs of ``low`` to ``high`` neighbouring tokens, joined by blanks, and the place of each one's list.

    As ``tokens.ngrams`` makes them: null tokens leave no blank, and single tokens alone stay as they are.
    """
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), list_sizes(lists))
    if (low, high) == (1, 1):
        known = np.asarray(flat.is_valid())
        return flat.drop_null(), row[known]
    found, rows = [], []
    for size in range(low, high + 1):
        n = len(flat) - size + 1
        if n <= 0:
            break
        inside = np.flatnonzero(row[:n] == row[size - 1 :])
        joined = pc.fill_null(flat, "")
        if size > 1:
            joined = pc.binary_join_element_wise(
                *[flat.slice(i, n) for i in range(size)], " ", null_handling="skip"
            )
        found.append(joined.take(pa.array(inside)))
        rows.append(row[inside])
    if not found:
        return pa.array([], pa.string()), np.zeros(0, dtype=np.int64)
    return pa.concat_arrays(found), np.concatenate(rows)
