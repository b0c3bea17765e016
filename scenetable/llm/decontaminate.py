"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, then exact similarity."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, table
from .shingles import Words, distinct, mix

BITS = 128
#: Windows within this Hamming distance of an item are compared exactly. Similarity 0.8 turns
#: 20 of 128 bits on average with a deviation of 4, so 40 leaves out one in a million.
RADIUS = 40
#: Blocks of a fingerprint. Some block of two fingerprints within the radius differs in at
#: most RADIUS // BLOCKS bits; items are filed under every value so near to theirs.
BLOCKS = 14
#: Items held by a task at a time; a larger benchmark takes more passes.
ITEM_BLOCK = 5000


def _signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 128 bits of each shingle."""
    wide = np.stack([mix(hashes.copy()), mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))], axis=1)
    bits = np.unpackbits(wide.view(np.uint8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def fingerprints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The SimHash (two 64-bit numbers) of the windows of `size` shingles at `starts`."""
    sums = np.zeros((len(hashes) + 1, BITS), np.int32)
    np.cumsum(_signs(hashes), axis=0, out=sums[1:])
    return np.packbits(sums[starts + size] - sums[starts] > 0, axis=1).view(np.uint64)


def _block_bounds() -> list[tuple[int, int]]:
    edges = np.linspace(0, BITS, BLOCKS + 1).astype(int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


def _block_keys(prints: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each fingerprint and block a number made of window size, block and the block's value."""
    bits = np.unpackbits(prints.view(np.uint8), axis=1)
    out = []
    for b, (low, high) in enumerate(_block_bounds()):
        value = bits[:, low:high] @ (1 << np.arange(high - low))[::-1]
        out.append((sizes.astype(np.int64) * BLOCKS + b) << 16 | value)
    return np.stack(out, axis=1)


class Items:
    """A block of benchmark items: shingles, fingerprints, and the Hamming blocks' index."""

    def __init__(self, ids: list, texts: list[str], words: int):
        hashes, begin = Words(pa.array(texts, pa.string())).shingles(words)
        self.words = words
        held = [(i, hashes[a:b]) for i, a, b in zip(ids, begin[:-1], begin[1:], strict=True) if b > a]
        self.ids = [i for i, _ in held]
        self.shingles = [h for _, h in held]
        self.sizes = np.array([len(h) for h in self.shingles], np.int64)
        self.known = distinct(np.concatenate(self.shingles)) if held else np.zeros(0, np.uint64)
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[(self.known & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
        self.prints = np.concatenate([fingerprints(h, np.zeros(1, np.int64), len(h)) for h in self.shingles]) if held else np.zeros((0, 2), np.uint64)
        # which window sizes a shingle calls for
        pairs = {(int(s), int(n)) for h, n in zip(self.shingles, self.sizes, strict=True) for s in h}
        self.calls: dict[int, list[int]] = {}
        for s, n in pairs:
            self.calls.setdefault(s, []).append(n)
        keys = _block_keys(self.prints, self.sizes) if held else np.zeros((0, BLOCKS), np.int64)
        filed, whose = [], []
        for b, (low, high) in enumerate(_block_bounds()):
            for flips in _flips(high - low, RADIUS // BLOCKS):
                filed.append(keys[:, b] ^ flips)
                whose.append(np.arange(len(keys)))
        filed, whose = np.concatenate(filed), np.concatenate(whose)
        order = np.argsort(filed, kind="stable")
        self.filed, self.whose = filed[order], whose[order]

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Where `hashes` has a shingle of an item."""
        some = np.flatnonzero(self.maybe[(hashes & np.uint64((1 << 18) - 1)).astype(np.int64)])
        at = np.searchsorted(self.known, hashes[some])
        at[at == len(self.known)] = 0
        return some[self.known[at] == hashes[some]] if len(self.known) else some[:0]

    def near(self, prints: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) of one size whose fingerprints are within the radius."""
        keys = _block_keys(prints, sizes)
        low, high = np.searchsorted(self.filed, keys.ravel(), "left"), np.searchsorted(self.filed, keys.ravel(), "right")
        count = high - low
        window = np.repeat(np.repeat(np.arange(len(prints)), BLOCKS), count)
        item = self.whose[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        pair = np.unique(window * len(self.ids) + item)
        window, item = pair // len(self.ids), pair % len(self.ids)
        far = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1)
        return window[far <= RADIUS], item[far <= RADIUS]


def _flips(bits: int, most: int) -> list[int]:
    """All numbers of so many bits with at most so many ones."""
    return [v for v in range(1 << bits) if v.bit_count() <= most]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shared over all shingles, each weighed by how often it occurs."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    shared = int(np.minimum(ca[ia], cb[ib]).sum())
    return shared / (len(a) + len(b) - shared)


def windows(hashes: np.ndarray, hits: np.ndarray, items: Items) -> dict[int, np.ndarray]:
    """For each item size called for by a hit, the starts of all windows of that size over such a hit."""
    called: dict[int, list[int]] = {}
    for p in hits.tolist():
        for size in items.calls[int(hashes[p])]:
            called.setdefault(size, []).append(p)
    out = {}
    for size, at in called.items():
        last = max(0, len(hashes) - size)
        p = np.array(at)
        mark = np.zeros(last + 2, np.int64)
        np.add.at(mark, np.clip(p - size + 1, 0, last), 1)
        np.add.at(mark, np.clip(p, 0, last) + 1, -1)
        out[size] = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
    return out


def _scan(items: Items, threshold: float):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            hashes, begin = Words(batch.column("text")).shingles(items.words)
            hits = items.hits(hashes)
            owner = np.searchsorted(begin, hits, side="right") - 1
            found = []
            for doc in np.unique(owner).tolist():
                own = hashes[begin[doc] : begin[doc + 1]]
                prints, sizes, starts = [], [], []
                for size, at in windows(own, hits[owner == doc] - begin[doc], items).items():
                    width = min(size, len(own))  # a shorter document is one window
                    prints.append(fingerprints(own, at, width))
                    sizes.append(np.full(len(at), size))
                    starts.append(at)
                prints, sizes, starts = np.concatenate(prints), np.concatenate(sizes), np.concatenate(starts)
                best: dict[int, tuple[float, int, int]] = {}
                for w, i in zip(*items.near(prints, sizes), strict=True):
                    s = similarity(own[starts[w] : starts[w] + sizes[w]], items.shingles[i])
                    if s >= threshold:
                        top, at, n = best.get(i, (0.0, 0, 0))
                        best[i] = (s, int(starts[w]), n + 1) if (s, -starts[w]) > (top, -at) else (top, at, n + 1)
                found += [(doc, items.ids[i], s, at, int(items.sizes[i]) + items.words - 1, n) for i, (s, at, n) in best.items()]
            found.sort(key=lambda x: x[:1])
            cols = list(zip(*found, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64())], names=["doc_id", "item_id", "similarity", "start_word", "n_words", "n_windows"])

    return emit


def contaminated(docs: DataFrame, benchmark: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents of `docs` (doc_id, text, ...) that hold an item of `benchmark` (item_id, text, ...).

    A window is as long as the item in words (a shorter document is one window); its
    `words`-word shingles count as often as they occur. Returns one row for each document
    and item with a window of similarity at least `threshold`: doc_id, item_id, similarity
    and start_word of the best window (the first of equals), n_words of the item, and
    n_windows over the threshold. Windows without any shingle of an item have similarity 0
    and get no fingerprint. Items or documents of fewer words have one shingle, the whole.

    Null, empty and blank texts hold nothing and are held by nothing. Repeated documents are
    reported each; repeated items too. A null doc_id or item_id comes out as null.
    Other columns are left out. Empty input on either side: empty output.

    The benchmark is the query set: ITEM_BLOCK items at a time go to every task, and a larger
    one takes more passes over the documents.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, item_id long, similarity double, start_word long, n_words long, n_windows long"
    rows = benchmark.where(F.col("text").isNotNull()).select("item_id", "text").toLocalIterator()
    out, block = [], []
    for row in rows:
        block.append(row)
        if len(block) == ITEM_BLOCK:
            out.append(block)
            block = []
    if block or not out:
        out.append(block)
    scans = [texts.mapInArrow(_scan(Items([r.item_id for r in b], [r.text for r in b], words), threshold), schema) for b in out]
    return reduce(DataFrame.unionAll, scans)


def decontaminate(docs: DataFrame, benchmark: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """`docs` without those that hold a benchmark item, all columns as they were. Rows with a null doc_id stay."""
    held = contaminated(docs, benchmark, words, threshold).select("doc_id").distinct()
    return docs.join(held, "doc_id", "left_anti")


def query(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
