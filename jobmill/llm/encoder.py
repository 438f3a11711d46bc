"""Token ids of whole texts inside tasks, with a bounded memory of word ids."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import lru_cache

import numpy as np
import pyarrow as pa

TOKENIZER = "word_bpe_49k.json"
#: Bytes of words and ids that a worker remembers during a task, overheads included.
REMEMBERED_BYTES = 40 << 20
# Bytes of the two objects and the dictionary place of a word, beside its text and its ids.
OVERHEAD = 180
# How ASCII text parts: runs of letters, single digits, runs of other signs.
PARTS = re.compile("[a-z]+|[0-9]|[^a-z0-9]+")
ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
# Letters that no step before the merges changes or parts, once they are lower case.
PLAIN = re.compile("[a-zß-öø-ÿ]+")
# Byte-level vocabularies write a byte that is no printable Latin-1 character as the next free
# character from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


@lru_cache(maxsize=2)
def tokenizer(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


class WordIds(dict):
    """Ids of runs without blanks, as little-endian bytes; a run is encoded when it is first asked.

    The vocabulary's merges alone are asked for pieces of plain letters and of ASCII; other runs
    go through all steps of the tokenizer. At half of the budget, the runs remembered so far
    become the old generation, of which only those asked again are kept.
    """

    def __init__(self, name: str, budget: int = REMEMBERED_BYTES) -> None:
        super().__init__()
        self.coder = tokenizer(name)
        self.merges = self.coder.model.tokenize
        self.limit, self.held, self.old = budget // 2, 0, {}

    def piece(self, text: str) -> bytes:
        return b"".join([x.id.to_bytes(4, "little") for x in self.merges(text)])

    def encode(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isascii():
            if text.isalpha():
                return self.piece(text.lower())
            if text.isprintable() and b"'" not in word and b"<|" not in word:
                return b"".join([self.piece(p) for p in PARTS.findall(text.lower())])
        else:
            lower = text.lower()
            if PLAIN.fullmatch(lower):
                return self.piece(lower.encode().decode("latin-1").translate(BYTE_CHARS))
        return np.array(self.coder.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.ended(word) or self.encode(word)
        self.held += len(word) + len(ids) + OVERHEAD
        if self.held > self.limit:
            self.old = dict(self)
            self.clear()
            self.held = len(word) + len(ids) + OVERHEAD
        self[word] = ids
        return ids

    def ended(self, word: bytes) -> bytes | None:
        """Ids of a run that ends in one full stop or comma behind an ASCII letter or digit:
        the sign is a piece of its own, so the run before it may be remembered already."""
        if word[-1] in b".," and len(word) > 1 and word[-2] in ALNUM:
            return self[word[:-1]] + self[word[-1:]]
        return None

    def text(self, text: str) -> np.ndarray:
        """Token ids of a whole text, as the tokenizer gives them.

        Its pieces never cross ASCII blanks, so every distinct run of other characters is
        encoded once. ASCII capitals are lowered, as the tokenizer does itself, unless the text
        could hold a special token's name.
        """
        data = text.encode()
        return np.frombuffer(b"".join(map(self.__getitem__, (data if b"<|" in data else data.lower()).split())), "<u4")


def give_back() -> None:
    """Return free memory of this worker, which waits for its next task, to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


@contextmanager
def task_encoder(name: str = TOKENIZER, budget: int = REMEMBERED_BYTES) -> Iterator[WordIds]:
    """An encoder for one task, emptied when the task ends, however it ends.

    Encoding makes no cyclic garbage but many objects that start the search for it, so the
    search is off meanwhile.
    """
    on = gc.isenabled()
    gc.disable()
    words = WordIds(name, budget)
    try:
        yield words
    finally:
        words.clear()
        words.old.clear()
        give_back()
        if on:
            gc.enable()
