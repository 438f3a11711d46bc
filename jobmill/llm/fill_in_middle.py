"""Fill-in-the-middle form of whole texts; cuts are found by summaries of content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmill.llm.hashing import mix64

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (b"<P>", b"<S>", b"<M>")
#: Per cent of texts that change their form, and of those, per cent with the suffix first.
CHANGED, SUFFIX_FIRST = 90, 20
#: A chunk ends where a hash of its last 32 bytes has its low 10 bits clear, within these sizes.
WINDOW, MASK, SHORTEST, LONGEST = 32, (1 << 10) - 1, 256, 8192
#: Bytes hashed at once; bytes of chunks that a task remembers; bytes of texts in one batch out.
AT_ONCE, REMEMBERED_BYTES, BATCH_BYTES = 1 << 20, 32 << 20, 4 << 20
OVERHEAD = 300
CONTINUATION = bytes(range(0x80, 0xC0))
GEAR = mix64(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"


class Summary(NamedTuple):
    """What a stretch of bytes adds to a document; two neighbours' summaries combine into one."""

    chars: int
    marked: bool
    head: bytes
    tail: bytes

    def __add__(self, other: Summary) -> Summary:  # type: ignore[override]
        seam = self.tail + other.head
        marked = self.marked or other.marked or any(m in seam for m in MARKS)
        return Summary(self.chars + other.chars, marked, (self.head + other.head)[:2], (self.tail + other.tail)[-2:])


NOTHING = Summary(0, False, b"", b"")


def summary(data: bytes) -> Summary:
    marked = b"<" in data and any(m in data for m in MARKS)
    return Summary(len(data.translate(None, CONTINUATION)), marked, data[:2], data[-2:])


def ends(data: bytes) -> list[int]:
    """Where the chunks of some bytes end. A chunk never parts a character.

    The hash of a place is that of the 32 bytes before it alone, so after an edit the ends
    are soon the same again. Doubling the window five times makes all hashes of a piece.
    """
    found: list[int] = []
    begin = 0
    for at in range(0, len(data), AT_ONCE):
        first = max(0, at - WINDOW)
        raw = np.frombuffer(data, np.uint8, min(len(data), at + AT_ONCE) - first, first)
        hashes = GEAR[raw]
        width = 1
        while width < WINDOW:
            older = hashes[:-width] << np.uint32(width)
            hashes = hashes.copy()
            hashes[width:] += older
            width *= 2
        for i in (np.flatnonzero((hashes & np.uint32(MASK)) == 0) + first + 1).tolist():
            if i <= at:
                continue
            begin = forced(data, begin, i, found)
            if i - begin >= SHORTEST and i < len(data) and data[i] & 0xC0 != 0x80:
                found.append(i)
                begin = i
    forced(data, begin, len(data), found)
    if data and (not found or found[-1] < len(data)):
        found.append(len(data))
    return found


def forced(data: bytes, begin: int, until: int, found: list[int]) -> int:
    """Ends at the longest size while none is found before ``until``."""
    while until - begin > LONGEST:
        end = begin + LONGEST
        while data[end] & 0xC0 == 0x80:
            end -= 1
        found.append(end)
        begin = end
    return begin


class Chunks:
    """Summaries of chunks seen before, found by hash and verified by content.

    At half of the budget the chunks so far become the old generation, of which only those
    seen again are kept.
    """

    def __init__(self, budget: int = REMEMBERED_BYTES) -> None:
        self.new: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.limit, self.held, self.hits = budget // 2, 0, 0

    def of(self, chunk: bytes) -> Summary:
        known = self.new.get(chunk)
        if known is not None:
            self.hits += 1
            return known
        known = self.old.get(chunk)
        if known is None:
            known = summary(chunk)
        else:
            self.hits += 1
        self.held += len(chunk) + OVERHEAD
        if self.held > self.limit:
            self.old, self.new, self.held = self.new, {}, len(chunk) + OVERHEAD
        self.new[chunk] = known
        return known


class Cut(NamedTuple):
    n: int
    marked: bool
    bounds: list[int]
    counts: np.ndarray

    def place(self, data: bytes, char: int) -> int:
        """Byte at which character ``char`` begins: its chunk by the running counts, then inside it."""
        i = int(np.searchsorted(self.counts, char, "right")) - 1
        if i >= len(self.bounds) - 1:
            return len(data)
        begin = self.bounds[i]
        chunk = np.frombuffer(data, np.uint8, self.bounds[i + 1] - begin, begin)
        return begin + int(np.flatnonzero((chunk & 0xC0) != 0x80)[char - int(self.counts[i])])


def cut(data: bytes, chunks: Chunks) -> Cut:
    bounds = [0, *ends(data)]
    all_of, counts = NOTHING, [0]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        all_of = all_of + chunks.of(data[a:b])
        counts.append(all_of.chars)
    return Cut(all_of.chars, all_of.marked, bounds, np.array(counts))


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 that follow from seed and id; a missing id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    Map-only. A null text is empty; empty texts and texts with a mark stay plain, and have no
    prefix and middle. Rows that repeat an id get the same draws, rows without an id those of
    an empty one. Only ``doc_id`` and ``text`` are read, so other columns may have any names;
    an empty table gives no rows. Of a long text, one piece of hashes is held at a time.
    """

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks()
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())]
        )

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        try:
            out: list[tuple] = []
            held = 0
            for given in batches:
                for doc, text, *drawn in zip(*given.columns, strict=True):
                    data = text.as_buffer().to_pybytes() if text.is_valid else b""
                    h1, h2, h3, h4 = (h.as_py() for h in drawn)
                    found = cut(data, chunks)
                    n = found.n
                    if not n or found.marked or h3 % 100 >= changed:
                        out.append((doc.as_py(), n, "plain", None, None, data))
                    else:
                        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                        i, j = found.place(data, a), found.place(data, b)
                        parts = data[:i], data[i:j], data[j:]
                        form = "spm" if h4 % 100 < suffix_first else "psm"
                        out.append((doc.as_py(), n, form, a, b - a, joined(form, *parts)))
                    held += len(data)
                    if held >= BATCH_BYTES:
                        yield batch(out)
                        out, held = [], 0
            if out:
                yield batch(out)
        finally:
            chunks.new, chunks.old = {}, {}

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), *draws(F.col("doc_id").cast("long"), seed))
    return rows.mapInArrow(change, OUT).withColumn("output", F.col("output").cast("string"))


def joined(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    p, s, m = MARKS
    return p + prefix + s + suffix + m + middle if form == "psm" else s + suffix + p + prefix + m + middle


def restored(output: Column, form: Column) -> Column:
    """The exact text, from output and form alone: a changed text holds no mark of its own."""

    def parts(first: str, second: str) -> list[Column]:
        """What lies behind the first, second and last mark."""
        body = F.substring(output, F.lit(len(first) + 1), F.length(output))
        at, last = F.instr(body, second), F.instr(body, MIDDLE)
        return [
            F.substring(body, F.lit(1), at - 1),
            F.substring(body, at + len(second), last - at - len(second)),
            F.substring(body, last + len(MIDDLE), F.length(body)),
        ]

    p_first, s_first = parts(PREFIX, SUFFIX), parts(SUFFIX, PREFIX)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(p_first[0], p_first[2], p_first[1]))
        .otherwise(F.concat(s_first[1], s_first[2], s_first[0]))
    )


def digests(docs: DataFrame) -> DataFrame:
    """Checksums of the outputs and of the texts rebuilt from them."""
    out = fill_in_middle(docs)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
