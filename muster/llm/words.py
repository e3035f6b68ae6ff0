"""Word and shingle hashes of a batch of texts.

A word is a run of bytes other than ASCII white space. It has a cryptographic digest of 128 bits, so no
words are made alike by their letters; hashes of a few words are polynomials over one half of their
digests, mixed.
"""

from __future__ import annotations

from array import array
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa

from muster.llm.workers import worker_held

WORD_BASE, OTHER_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
# Bytes of the words that a worker remembers, and the longest of them.
LIMIT, LONG = 48 << 20, 256


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base, and their inverses modulo 2**64."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(count, b, np.uint64)
        if count:
            p[0] = 1
        both.append(np.cumprod(p, dtype=np.uint64))
    return both[0], both[1]


def _sums(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=out[1:])
    return out


class Digests(dict):
    """Numbers of words, whose digests are rows of two arrays: 64 bits each of one BLAKE2 digest.

    A worker holds it up to about ``LIMIT`` bytes; then it starts anew. Results don't depend on its state.
    """

    def __init__(self):
        super().__init__()
        self.first, self.second, self.size = array("Q"), array("Q"), 0

    def __missing__(self, word: bytes) -> int:
        number = len(self.first)
        both = blake2b(word, digest_size=16).digest()
        self.first.append(int.from_bytes(both[:8], "little"))
        self.second.append(int.from_bytes(both[8:], "little"))
        self.size += 16
        if len(word) <= LONG:
            self[word] = number
            self.size += len(word) + 150
        return number

    def of(self, lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        if self.size > LIMIT:
            self.__init__()
            self.clear()
        count = sum(map(len, lists))
        numbers = np.fromiter(map(self.__getitem__, chain.from_iterable(lists)), np.int64, count)
        return tuple(np.frombuffer(a, np.uint64)[numbers] if count else np.zeros(0, np.uint64) for a in (self.first, self.second))


class Words:
    """Words of a batch of texts: digests, and the index of the first word of each text."""

    def __init__(self, texts: pa.Array, lower: bool):
        values = texts.cast(pa.large_binary()).to_pylist()
        lists = [(t.lower() if lower else t).split() if t else [] for t in values]
        self.hash, self.other = worker_held("word digests", Digests).of(lists)
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int64)
        self._grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def spans(self, start: np.ndarray, length: np.ndarray | int, base: int = WORD_BASE) -> np.ndarray:
        """Hash of ``length`` words from each ``start``; with ``OTHER_BASE`` from the other half of the digests."""
        if base not in self._grams:
            powers, inverses = _powers(base, len(self.hash) + 1)
            self._grams[base] = _sums(self.other if base == OTHER_BASE else self.hash, powers), inverses
        sums, inverses = self._grams[base]
        size = np.asarray(length).astype(np.uint64)
        return mix((sums[start + length] - sums[start]) * inverses[start] + size)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of ``length`` words inside one text, and the text of each."""
        room = np.maximum(self.counts - length + 1, 0)
        text = np.repeat(np.arange(len(room)), room)
        inside = np.arange(len(text)) - np.repeat(np.cumsum(room) - room, room)
        return self.first[text] + inside, text
