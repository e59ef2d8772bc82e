"""Word shingles of whole texts as sorted 64-bit hash sets, batch-wise in numpy.

Words are maximal runs of characters other than ASCII white space; ASCII letters
are lower-cased, nothing else is changed. A text with fewer words than a shingle
holds gives one shingle of all its words; a text without words gives none. Each
word is a polynomial of its bytes' table values, each shingle a polynomial of its
words, both finished with an avalanche step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

MULTIPLIER = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
# Texts are hashed in runs of about this many bytes, which bounds working memory.
RUN_BYTES = 1 << 20


def _byte_values(fold: bool) -> np.ndarray:
    """One fixed random-looking 64-bit value per byte; with ``fold`` upper case equals lower case."""
    digest = b"".join(hashlib.sha256(bytes([i])).digest()[:8] for i in range(256))
    values = np.frombuffer(digest, dtype="<u8").copy()
    if fold:
        values[65:91] = values[97:123]
    return values


def _powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1) modulo 2 ** 64."""
    out = np.empty(count, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < count:
        step = min(done, count - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


VALUES = {fold: _byte_values(fold) for fold in (False, True)}
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Hash sets of the word shingles of texts."""

    def __init__(self, size: int, fold: bool = True) -> None:
        self.size = size
        self.values = VALUES[fold]
        self._up = _powers(MULTIPLIER, 1 << 16)
        self._down = _powers(INVERSE, 1 << 16)
        self._weights = _powers(0xD6E8FEB86659FD93, size + 1)

    def _grow(self, count: int) -> None:
        if count > len(self._up):
            self._up = _powers(MULTIPLIER, count * 2)
            self._down = _powers(INVERSE, count * 2)

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start offsets and hashes of the words of a byte array."""
        self._grow(len(data) + 1)
        inside = np.empty(len(data) + 2, dtype=bool)
        inside[0] = inside[-1] = False
        inside[1:-1] = ~SPACE[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self._up[: len(data)], out=sums[1:])
        return starts, mix((sums[ends] - sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))

    def sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The sorted distinct shingle hashes of each text, in order."""
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) < RUN_BYTES):
                size += len(texts[stop]) + 1
                stop += 1
            yield from self._run(texts[at:stop])
            at = stop

    def _run(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        lengths = np.array([len(t) + 1 for t in texts])
        begin = np.concatenate(([0], np.cumsum(lengths)))
        starts, hashes = self.words(data)
        first = np.searchsorted(starts, begin)
        whole = len(hashes) - self.size + 1
        if whole > 0:
            grams = np.zeros(whole, dtype=np.uint64)
            for k in range(self.size):
                grams += hashes[k : k + whole] * self._weights[k + 1]
            grams = mix(grams)
        for i in range(len(texts)):
            a, b = first[i], first[i + 1]
            if b - a >= self.size:
                found = np.sort(grams[a : b - self.size + 1])
                keep = np.empty(len(found), dtype=bool)
                keep[0] = True
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                yield found[keep]
            elif b > a:
                few = hashes[a:b] * self._weights[1 : b - a + 1]
                yield mix(np.array([few.sum(dtype=np.uint64) + np.uint64(b - a)], dtype=np.uint64))
            else:
                yield np.empty(0, dtype=np.uint64)
