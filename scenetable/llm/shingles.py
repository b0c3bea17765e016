"""Word shingles of whole texts as 64-bit hashes, a batch of texts at a time in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)
_MASK = (1 << 64) - 1
#: Powers that a worker keeps, 16 bytes each.
KEPT_POWERS = 3 << 20


def _byte_values() -> np.ndarray:
    """A random number for each byte; A-Z share theirs with a-z, blanks have 0."""
    values = np.random.default_rng(20_240_501).integers(1, 2**63, 256).astype(np.uint64)
    values[65:91] = values[97:123]
    values[[32, 9, 10, 11, 12, 13]] = 0
    return values


_VALUES = _byte_values()
_WORD = _VALUES != 0


def _grow(n: int) -> None:
    """Powers for n bytes; what one very long text needed is given back with the next short batch."""
    global _powers, _inverses
    if len(_powers) > KEPT_POWERS >= n:
        _powers, _inverses = _powers[:KEPT_POWERS].copy(), _inverses[:KEPT_POWERS].copy()
    if len(_powers) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
            _inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]))


def shrink() -> None:
    """Give back the powers that one large batch needed."""
    global _powers, _inverses
    _powers, _inverses = _powers[:1].copy(), _inverses[:1].copy()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (one-to-one)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_EXACT = np.random.default_rng(77).integers(1, 2**63, (2, 256)).astype(np.uint64)


def string_hashes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each string's bytes, and its number of bytes."""
    n = len(strings)
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + n + 1].astype(np.int64)
    held = strings.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    _grow(len(data) + 1)
    sizes, out = np.diff(offsets), []
    for values in _EXACT:
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values[data] * _powers[: len(data)])])
        out.append(mix((sums[offsets[1:]] - sums[offsets[:-1]]) * _inverses[offsets[:-1]] + sizes.astype(np.uint64)))
    return out[0], out[1], sizes


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a batch of texts, A-Z lowered.

    hashes: one for each word; begin: each text's first word, and the end of all;
    start and stop: each word's bytes in `data`.
    """

    def __init__(self, texts: pa.Array):
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
        held = texts.buffers()[2]
        self.data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        size = len(self.data)
        inside = np.zeros(size + 2, bool)
        inside[1:-1] = _WORD[self.data]
        edge = np.zeros(size + 2, bool)
        edge[self.offsets + 1] = True
        self.start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[1:-1]))
        self.stop = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[2:])) + 1
        _grow(size + 1)
        if len(self.start):
            spread = _VALUES[self.data]
            spread *= _powers[:size]
            self.hashes = mix(np.add.reduceat(spread, self.start) * _inverses[self.start])
        else:
            self.hashes = np.zeros(0, np.uint64)
        self.begin = np.searchsorted(self.start, self.offsets)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each text's k-word shingles in order, and where each text's begin.

        A text of fewer words has its whole sequence as one; one without words has none.
        """
        total = len(self.hashes)
        wide = np.concatenate([self.hashes, np.zeros(k, np.uint64)])
        n = np.diff(self.begin)
        whole = np.zeros(total, np.uint64)
        factor = 0x9E3779B97F4A7C15
        short = np.flatnonzero((n > 0) & (n < k))
        tail = np.zeros(len(short), np.uint64)
        for j in range(k):
            c = np.uint64((factor * (2 * j + 3) | 1) & _MASK)
            whole += wide[j : j + total] * c
            tail += np.where(j < n[short], wide[self.begin[short] + j], 0).astype(np.uint64) * c
            factor = factor * 0xD1342543DE82EF95 & _MASK
        starts = np.repeat(self.begin[:-1], n)
        full = np.arange(total) - starts + k <= np.repeat(n, n)
        whole[self.begin[short]] = tail ^ (n[short].astype(np.uint64) << np.uint64(56))
        full[self.begin[short]] = True
        counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
        return mix(whole[full]), np.concatenate([[0], np.cumsum(counts)])


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    h = np.sort(hashes)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h
