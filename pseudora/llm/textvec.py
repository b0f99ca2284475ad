"""Whole batches of texts as numpy arrays: word bounds and 64-bit hashes, without loops per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_SPLIT = (_U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))
_RADIX = _U(0xD1342543DE82EF95)  # odd, hence invertible modulo 2**64
BATCH_BYTES = 1 << 18  # arrays over a batch's bytes take up to a hundred times as much

WORD = np.ones(256, dtype=bool)
WORD[[9, 10, 11, 12, 13, 32]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = x + _SPLIT[0]
    x = (x ^ (x >> _U(30))) * _SPLIT[1]
    x = (x ^ (x >> _U(27))) * _SPLIT[2]
    return x ^ (x >> _U(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64)) | _U(1)
_INVERSE = _U(pow(int(_RADIX), -1, 1 << 64))


class _Powers:
    """Powers of the radix and of its inverse, grown to the longest batch so far."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            for name, factor in (("up", _RADIX), ("down", _INVERSE)):
                steps = np.full(size, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up[:n], cls.down[:n]


class Words:
    """Words (runs of other characters than ASCII white space) of texts joined in one buffer."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts) + b"\n"
        self.raw = np.frombuffer(joined, dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.text_start, self.text_end = np.concatenate([[0], ends[:-1]]), ends - 1
        inside = WORD[self.raw]
        edge = np.diff(inside.astype(np.int8), prepend=0)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        #: Words of text k are first[k]:last[k].
        self.first = np.searchsorted(self.start, self.text_start)
        self.last = np.searchsorted(self.start, self.text_end)

    def hashes(self) -> np.ndarray:
        """One hash per word, A-Z lower-cased."""
        up, down = _Powers.upto(len(self.raw))
        total = np.zeros(len(self.raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[LOWER[self.raw]] * up, out=total[1:])
        length = (self.end - self.start).astype(np.uint64)
        return mixed((total[self.end] - total[self.start]) * down[self.start] + length)


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash per span of bytes, as they stand."""
    up, down = _Powers.upto(len(raw))
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * up, out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; shorter input than that is one run, none is empty."""
    count = len(words)
    if not count:
        return words
    width = min(size, count)
    total = np.full(count - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total = mixed(total ^ words[k : count - width + 1 + k]) * _SPLIT[1]
    return mixed(total)


def size_ranges(sizes: list[int], most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text is a range of its own."""
    first = held = 0
    for k, size in enumerate(sizes):
        if held and held + size > most:
            yield first, k
            first, held = k, 0
        held += size + 1
    if first < len(sizes):
        yield first, len(sizes)


def sub_batches(texts: list[bytes], most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """``size_ranges`` of the texts."""
    return size_ranges(list(map(len, texts)), most)
