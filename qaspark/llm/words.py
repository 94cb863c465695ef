"""Words, n-grams and their 64-bit hashes, over whole batches of texts in numpy.

A word is a run of bytes other than blank and the controls 0x09 to 0x0D. Hashes are polynomials over a
fixed random table modulo 2**64, finished by a mixing step, so they are equal in every task and run.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = _U(0xD6E8FEB86659FD93)
_SPAN = 1 << 20
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table)
    return _powers[0], _powers[1]


class Words:
    """The words of several texts: ``starts`` and ``ends`` in ``buffer``, ``offsets`` of each text among the words."""

    def __init__(self, texts: list[bytes | None], lower: bool = False):
        joined = b"\n".join([b"", *[t or b"" for t in texts], b""])
        self.buffer = np.frombuffer(joined, dtype=np.uint8)
        if lower:
            self.buffer = _LOWER[self.buffer]
        space = _SPACE[self.buffer]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.starts, self.ends = edge[0::2], edge[1::2]
        lengths = np.fromiter((len(t or b"") for t in texts), dtype=np.int64, count=len(texts))
        first = np.concatenate(([0], np.cumsum(lengths + 1))) + 1
        self.offsets = np.searchsorted(self.starts, first)
        self.n_words = np.diff(self.offsets)
        self._hashes: np.ndarray | None = None

    @property
    def text_of(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.n_words)), self.n_words)

    def word(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if self._hashes is None:
            out = np.empty(len(self.starts), np.uint64)
            i, n = 0, len(out)
            while i < n:
                low = self.starts[i]
                j = max(i + 1, int(np.searchsorted(self.ends, low + _SPAN, "right")))
                size = int(self.ends[j - 1] - low)
                power, inverse = _power_tables(size + 1)
                sums = np.zeros(size + 1, np.uint64)
                np.cumsum(_VALUES[self.buffer[low : low + size]] * power[:size], out=sums[1:])
                s, e = self.starts[i:j] - low, self.ends[i:j] - low
                out[i:j] = (sums[e] - sums[s]) * inverse[s]
                i = j
            self._hashes = mix(out)
        return self._hashes

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word sequences inside a text, and the number of the word at which each starts."""
        return grams_of(self.hashes(), self.offsets, n)


def grams_of(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out *= _STEP
        out += hashes[k : k + count]
    lengths = np.diff(offsets)
    left = np.repeat(offsets[1:], lengths)[:count] - np.arange(count)
    at = np.flatnonzero(left >= n)
    return mix(out[at] + _U(n)), at


def blocks(sizes: list[int], limit: int):
    """Cut a list of items into runs of about ``limit`` in total size: pairs (from, to)."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
