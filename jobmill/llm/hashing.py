"""Hashes of all words of a batch of texts at once, with numpy, for use inside tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes hashed at once; a longer text is hashed in parts.
CHUNK = 1 << 20
#: Bytes from which a word is long.
LONG_WORD = 256
BLANKS = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2^64."""
    out = np.full(n, np.uint64(base))
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_UP, _DOWN = powers(BASE, 1), powers(pow(BASE, -1, 1 << 64), 1)


def tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each; those of a chunk are kept."""
    global _UP, _DOWN
    if n > CHUNK + 1:
        return powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)
    if min(len(_UP), len(_DOWN)) < n:
        _UP, _DOWN = powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)
    return _UP, _DOWN


def pieces(data: bytes) -> Iterator[bytes]:
    """Long data in stretches of about a chunk, cut at blanks; a longer word stays whole."""
    at = 0
    while len(data) - at > CHUNK:
        cut = max(data.rfind(blank, at, at + CHUNK) for blank in BLANKS)
        if cut <= at:
            ends = [e for e in (data.find(blank, at + CHUNK) for blank in BLANKS) if e >= 0]
            cut = min(ends, default=len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def joined_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word (A-Z lower-cased, blanks between) of some bytes.

    A word's hash is a polynomial of its bytes modulo 2^64, taken from running sums, and
    scrambled; its length goes in as well. Such polynomials of some words of thousands of bytes
    are equal by construction, so long words get a cryptographic hash.
    """
    raw = LOWER[np.frombuffer(data, np.uint8)]
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~BLANK[raw]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = tables(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
        value = (sums[end] - sums[start]) * down[start]
        out = mix64(mix64(value) + (end - start).astype(np.uint64))
    for i in np.flatnonzero(end - start >= LONG_WORD):
        digest = hashlib.blake2b(raw[start[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out, start


def word_hashes(texts: Iterable[str | None]) -> list[np.ndarray]:
    """For every text the hashes of its words in order; none for null and empty texts."""
    out: list[np.ndarray] = []
    waiting: list[bytes] = []
    held = 0

    def flush() -> None:
        if not waiting:
            return
        lengths = np.array([len(b) + 1 for b in waiting])
        hashes, start = joined_hashes(b"\n".join(waiting))
        cuts = np.searchsorted(start, np.cumsum(lengths)[:-1])
        out.extend(np.split(hashes, cuts))
        waiting.clear()

    for text in texts:
        data = text.encode() if isinstance(text, str) else b""
        if held + len(data) > CHUNK:
            flush()
            held = 0
        if len(data) > CHUNK:
            out.append(np.concatenate([joined_hashes(part)[0] for part in pieces(data)]))
            continue
        waiting.append(data)
        held += len(data) + 1
    flush()
    return out
