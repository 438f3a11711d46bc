"""Packing of documents into sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobmill.llm.common import store
from jobmill.llm.encoder import TOKENIZER, task_encoder

END_ID = 1
CAPACITY = 4096
#: Pieces that one island packs; so many bins that the last, half-filled one costs little.
CELL_ITEMS = 8192
ISLANDS, MIGRATIONS = 3, 2
POPULATION, GENERATIONS = 4, 6
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER) -> DataFrame:
    """A stored table of pieces: ``doc_id, row, piece, start, length, ids_crc32``.

    A document's ids end with id 1; only documents longer than ``capacity`` are cut.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with task_encoder(name) as coder:
            for batch in batches:
                out = []
                for doc, row, text in zip(batch["doc_id"], batch["row"], batch["text"], strict=True):
                    ids = np.append(coder.text(text), np.array([END_ID], "<u4")).astype("<u4")
                    for i, start in enumerate(range(0, len(ids), capacity)):
                        own = ids[start : start + capacity]
                        out.append((None if pd.isna(doc) else doc, row, i, start, len(own), zlib.crc32(own.tobytes())))
                frame = pd.DataFrame(out, columns=[c.split(" ")[0] for c in PIECES.split(", ")])
                yield frame.astype({"doc_id": "Int64"})

    rows = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).alias("text")
    )
    return store(rows.mapInPandas(cut, PIECES), "pieces")


def best_fit(lengths: np.ndarray, items: list[int], bins: list[list[int]], capacity: int) -> None:
    """Put each item, in the given order, into the fullest bin with room for it, or a new one."""
    room = sorted((capacity - int(lengths[b].sum()), i) for i, b in enumerate(bins))
    for x in items:
        size = int(lengths[x])
        at = bisect.bisect_left(room, (size, -1))
        if at < len(room):
            left, i = room.pop(at)
            bins[i].append(x)
        else:
            left, i = capacity, len(bins)
            bins.append([x])
        bisect.insort(room, (left - size, i))


def worth(lengths: np.ndarray, bins: list[list[int]], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones: greater is better."""
    fill = np.array([lengths[b].sum() for b in bins]) / capacity
    return -len(bins), float((fill**2).sum())


def crossover(rng, lengths: np.ndarray, one: list[list[int]], other: list[list[int]], capacity: int) -> list[list[int]]:
    """A child of ``one``: well-filled bins of ``other`` come in whole, bins of ``one`` that hold
    any of their items go, and their other items are placed by best fit."""
    fill = np.array([lengths[b].sum() for b in other])
    good = np.flatnonzero(fill >= np.median(fill))
    chosen = rng.permutation(good)[: max(1, len(good) // 2)]
    coming = [list(other[i]) for i in chosen]
    inside = set(chain.from_iterable(coming))
    child, displaced = coming, []
    for b in one:
        if inside.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [x for x in b if x not in inside]
    # The emptiest bins are dissolved as well, which is the mutation.
    child.sort(key=lambda b: -lengths[b].sum())
    for _ in range(int(rng.integers(1, 4))):
        if child:
            displaced += child.pop()
    displaced.sort(key=lambda x: -lengths[x])
    best_fit(lengths, displaced, child, capacity)
    return child


def evolve(lengths: np.ndarray, start: list[list[list[int]]], seed: int, capacity: int = CAPACITY) -> list[list[int]]:
    """The best grouping after some generations from ``start`` and seeded best-fit groupings.

    It ends early at the lower bound, where no grouping can be better.
    """
    rng = np.random.default_rng(seed)
    least = -(-int(lengths.sum()) // capacity)
    order = np.argsort(-lengths, kind="stable")
    people = [(worth(lengths, b, capacity), b) for b in start]
    while len(people) < POPULATION:
        noise = 1 if not people else rng.uniform(0.9, 1.1, len(lengths))
        bins: list[list[int]] = []
        best_fit(lengths, [int(i) for i in np.argsort(-lengths * noise, kind="stable")] if people else order.tolist(), bins, capacity)
        people.append((worth(lengths, bins, capacity), bins))
        if people[-1][0][0] == -least:
            break
    for _ in range(GENERATIONS):
        people.sort(key=lambda p: p[0], reverse=True)
        if people[0][0][0] == -least or len(people) < 2:
            break
        i, j = rng.choice(len(people), 2, replace=False)
        child = crossover(rng, lengths, people[min(i, j)][1], people[max(i, j)][1], capacity)
        people[-1] = max(people[-1], (worth(lengths, child, capacity), child), key=lambda p: p[0])
    return max(people, key=lambda p: p[0])[1]


STATE = "cell int, island int, row long, piece int, length long, bin int, bins int, least int, worth double"


def islands(state: DataFrame, capacity: int, turn: int) -> DataFrame:
    """One round: every island of a cell evolves the groupings it holds, and gives its elite."""

    def run(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(["origin", "row", "piece"], kind="stable")
        origins = held["origin"].unique()
        mine = held[held["origin"] == origins[0]].reset_index(drop=True)
        lengths = mine["length"].to_numpy()
        start = []
        if turn:
            for o in origins:
                bins: dict[int, list[int]] = {}
                for i, b in enumerate(held.loc[held["origin"] == o, "bin"]):
                    bins.setdefault(b, []).append(i)
                start.append(list(bins.values()))
        best = evolve(lengths, start, hash((int(key[0]), int(key[1]), turn)) & 0xFFFFFFFF, capacity)
        where = np.empty(len(lengths), np.int32)
        for i, b in enumerate(best):
            where[b] = i
        return mine.assign(
            bin=where, bins=len(best), least=-(-int(lengths.sum()) // capacity), worth=worth(lengths, best, capacity)[1]
        )[[c.split(" ")[0] for c in STATE.split(", ")]]

    return state.groupBy("cell", "island").applyInPandas(run, STATE)


def pack(docs: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Pieces are dealt to cells of some 8,192 by a hash. Each cell has three islands, every one
    a task: it evolves groupings of the cell's pieces and gives its elite, which moves to the
    next island before the next round; a cell that has reached the lower bound, the sum of
    lengths over the capacity, is done. Null texts are empty and have one piece, the end
    id; rows that repeat an id are separate documents; an empty table gives no rows.
    """
    cut = pieces(docs, capacity, name)
    cells = max(1, -(-cut.count() // CELL_ITEMS))
    items = cut.select(
        F.pmod(F.xxhash64("row", "piece"), F.lit(cells)).cast("int").alias("cell"), "row", "piece", "length"
    )
    each = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    first = items.select("*", each).withColumns({"origin": F.lit(0), "bin": F.lit(0)})
    state = store(islands(first, capacity, 0), "islands")
    done = None
    for turn in range(1, MIGRATIONS + 1):
        best = state.groupBy("cell").agg(
            F.max_by("island", F.struct(-F.col("bins"), "worth", -F.col("island"))).alias("island"),
            F.min("bins").alias("_bins"),
            F.first("least").alias("_least"),
        )
        ready = state.join(best.where("_bins = _least").select("cell", "island"), ["cell", "island"], "left_semi")
        done = ready if done is None else done.unionByName(ready)
        open_cells = state.join(best.where("_bins > _least").select("cell"), "cell", "left_semi")
        if open_cells.isEmpty():
            break
        own = open_cells.withColumn("origin", F.lit(0))
        guests = open_cells.withColumns({"island": (F.col("island") + 1) % ISLANDS, "origin": F.lit(1)})
        state = store(islands(own.unionByName(guests), capacity, turn), f"islands{turn}")
    else:
        best = state.groupBy("cell").agg(
            F.max_by("island", F.struct(-F.col("bins"), "worth", -F.col("island"))).alias("island")
        )
        done = done.unionByName(state.join(best, ["cell", "island"], "left_semi"))
    placed = done.select(
        "row", "piece", (F.col("cell").cast("long") * (1 << 24) + F.col("bin")).alias("sequence_id")
    )
    inside = W.partitionBy("sequence_id").orderBy("row", "piece").rowsBetween(W.unboundedPreceding, 0)
    return cut.join(placed, ["row", "piece"]).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        "sequence_id",
        (F.sum("length").over(inside) - F.col("length")).cast("long").alias("offset"),
    )
