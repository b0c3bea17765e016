"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, compared by subtraction and peeling."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import sliced, staged, table
from .shingles import mix

#: A digest's cells, one in each part of a sketch; cells of a part in a fingerprint (a power of two); how much larger a retry is.
HASHES, CELLS, LARGER = 3, 8, 4
#: A sentence is cut into paragraphs at the first blank after so many code points, or this far behind it at the latest.
LEAST, MOST = 24, 40
#: Lengths take the low bits of a digest.
LENGTH_BITS = np.uint64(12)
#: When a sketch has so many cells for each digest and still does not peel, two digests of a text are one number; then sides are compared by sorting.
SURE = 64
#: Bytes of texts sketched at a time.
BATCH_BYTES = 1 << 20
#: Sentences end at line feeds and at .!?; behind which a blank follows; long ones are cut further. The pieces are the whole text.
PARAGRAPHS = re.compile(r"(?:(?![.!?]\s)[^\n]){1,%d}(?:(?:(?![.!?]\s)\S){0,%d}(?:[.!?](?=\s))?\s?)|[.!?]\s?|\n" % (LEAST, MOST), re.DOTALL)
_SALTS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def paragraphs(text: str) -> list[str]:
    """Short paragraphs whose texts joined are the text: lines, cut at sentence ends, long sentences at blanks.

    A cut depends only on what follows the last line or sentence end before it, so an edit changes the paragraphs near it alone.
    """
    return PARAGRAPHS.findall(text)


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The paragraph digests of each text and how many it has: 52 bits of hash of the paragraph and its occurrence, 12 of its length."""
    parts = [paragraphs(t) for t in texts]
    counts = np.array([len(p) for p in parts], np.int64)
    total = int(counts.sum())
    keys = np.fromiter((xxhash.xxh3_64_intdigest(p) for own in parts for p in own), np.uint64, total)
    sizes = np.fromiter((len(p) for own in parts for p in own), np.uint64, total)
    text = np.repeat(np.arange(len(texts)), counts)
    by = np.lexsort((keys, text))
    new = np.ones(total, bool)
    new[1:] = (keys[by][1:] != keys[by][:-1]) | (text[by][1:] != text[by][:-1])
    place = np.arange(total)
    turn = np.zeros(total, np.uint64)
    turn[by] = place - np.maximum.accumulate(np.where(new, place, 0))  # the same paragraph again is another digest
    return (mix(keys + turn * _SALTS[0]) & ~((np.uint64(1) << LENGTH_BITS) - np.uint64(1))) | sizes, counts


def lengths(keys: np.ndarray) -> np.ndarray:
    """The code points of the paragraphs of digests."""
    return (keys & ((np.uint64(1) << LENGTH_BITS) - np.uint64(1))).astype(np.int64)


def _check(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ _SALTS[3])


class Sketches:
    """A sketch for each of several rows, of the size that row wants: HASHES parts of `cells` cells.

    A cell holds how many digests fell into it, and the xor of them and of their checks.
    """

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        ends = np.cumsum(HASHES * cells)
        self.begin, self.total = ends - HASHES * cells, int(ends[-1]) if len(ends) else 0
        self.count, self.keys, self.checks = np.zeros(self.total, np.int64), np.zeros(self.total, np.uint64), np.zeros(self.total, np.uint64)

    def places(self, rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """(HASHES, n): the cells of digests in their rows' sketches."""
        wide = self.cells[rows]
        return np.stack([self.begin[rows] + k * wide + (mix(keys + _SALTS[k]) % wide.astype(np.uint64)).astype(np.int64) for k in range(HASHES)])

    def add(self, rows: np.ndarray, keys: np.ndarray, sign: np.ndarray) -> None:
        at = self.places(rows, keys)
        checks = _check(keys)
        for place in at:
            np.add.at(self.count, place, sign)
            np.bitwise_xor.at(self.keys, place, keys)
            np.bitwise_xor.at(self.checks, place, checks)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, digests and signs recovered, and which rows came out whole.

        A cell of one digest gives it away; taken out of its other cells, it may leave one alone in them.
        """
        row_of = np.repeat(np.arange(len(self.cells)), HASHES * self.cells)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        look = np.flatnonzero(self.count)
        while len(look):
            one = look[(np.abs(self.count[look]) == 1) & (_check(self.keys[look]) == self.checks[look])]
            if not len(one):
                break
            rows, keys, sign = row_of[one], self.keys[one], self.count[one]
            by = np.lexsort((keys, rows))
            rows, keys, sign = rows[by], keys[by], sign[by]
            first = np.append(True, (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1]))
            rows, keys, sign = rows[first], keys[first], sign[first]
            found.append((rows, keys, sign))
            self.add(rows, keys, -sign)
            look = np.unique(self.places(rows, keys))
        whole = np.ones(len(self.cells), bool)
        whole[row_of[(self.count != 0) | (self.keys != 0) | (self.checks != 0)]] = False
        if not found:
            none = np.zeros(0, np.uint64)
            return none.astype(np.int64), none, none.astype(np.int64), whole
        return *(np.concatenate(c) for c in zip(*found, strict=True)), whole


def differences(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, digests and signs (1: left only, -1: right only) in which the texts of each pair differ.

    `left` and `right` are `digests` of as many texts. A pair whose sketches' difference does not peel, or
    whose digests found do not explain both numbers of digests, is sketched anew, LARGER times as large.
    """
    n = len(left[1])
    rows = [np.repeat(np.arange(n), side[1]) for side in (left, right)]
    out, open_, size = [], np.arange(n), cells
    held = [(rows[0], left[0]), (rows[1], right[0])]
    while len(open_):
        number = np.full(n, -1)
        number[open_] = np.arange(len(open_))
        held = [(r[number[r] >= 0], k[number[r] >= 0]) for r, k in held]
        if size > SURE * max(1, *(int(np.bincount(r, minlength=1).max()) for r, _ in held)):
            out.append(_sorted_out(*held))
            break
        sketch = Sketches(np.full(len(open_), size, np.int64))
        for (r, k), sign in zip(held, (1, -1), strict=True):
            sketch.add(number[r], k, np.full(len(r), sign))
        r, k, sign, whole = sketch.peel()
        good = whole[r]
        out.append((open_[r[good]], k[good], sign[good]))
        open_ = open_[~whole]
        size *= LARGER
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _sorted_out(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for rows and digests of either side, by sorting."""
    rows, keys = (np.concatenate([left[k], right[k]]) for k in (0, 1))
    sign = np.repeat([1, -1], [len(left[0]), len(right[0])])
    by = np.lexsort((keys, rows))
    rows, keys = rows[by], keys[by]
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])))
    more = np.add.reduceat(sign[by], first)
    return np.repeat(rows[first], np.abs(more)), np.repeat(keys[first], np.abs(more)), np.repeat(np.sign(more), np.abs(more))


def likeness(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], size_left: np.ndarray, size_right: np.ndarray) -> np.ndarray:
    """Code points in common paragraphs over those in either text, of each pair; 1 for two empty texts.

    What only one side has is what peeling recovers, so the whole comes from sketches and the texts' lengths.
    """
    rows, keys, sign = differences(left, right)
    n = len(size_left)
    only = [np.bincount(rows[sign == s], lengths(keys[sign == s]), n).astype(np.int64) for s in (1, -1)]
    either = size_left + only[1]
    return np.where(either > 0, (size_left - only[0]) / np.maximum(either, 1), 1.0)


def packed_cells(keys: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The cells of each text's sketch: how many digests (modulo 2^16), their xor, and 32 bits of their checks' xor, little-endian."""
    sketch = Sketches(np.full(len(counts), CELLS, np.int64))
    sketch.add(np.repeat(np.arange(len(counts)), counts), keys, np.ones(len(keys), np.int64))
    packed = np.zeros(sketch.total, np.dtype([("n", "<u2"), ("key", "<u8"), ("check", "<u4")]))
    packed["n"], packed["key"], packed["check"] = sketch.count & 0xFFFF, sketch.keys, sketch.checks & np.uint64(0xFFFFFFFF)
    raw, wide = packed.tobytes(), HASHES * CELLS * packed.dtype.itemsize
    return [raw[k * wide : (k + 1) * wide] for k in range(len(counts))]


def fingerprints(keys: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> list[str]:
    """`paragraphs:code points:cells` of each text, the cells in base64."""
    return [f"{c}:{s}:{base64.b64encode(cells).decode()}" for c, s, cells in zip(counts.tolist(), sizes.tolist(), packed_cells(keys, counts), strict=True)]


def _select(side: tuple[np.ndarray, np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digests of some texts, in the order of `at`."""
    counts = side[1][at]
    ends = np.cumsum(counts)
    begin = (np.cumsum(side[1]) - side[1])[at]
    return side[0][np.repeat(begin - (ends - counts), counts) + np.arange(int(counts.sum()))], counts


def compare_versions(pairs: DataFrame) -> DataFrame:
    """How the two texts of each row of `pairs` (pair_id, old_text, new_text, ...) differ.

    Returns pair_id, old_fingerprint, new_fingerprint, likeness (0 to 1) and the digests of paragraphs that one text
    alone has: removed and added (arrays of long, ascending). Null texts count as empty, and two empty texts are alike.
    A paragraph that stands n times in a text has n digests. Other columns are left out. A row is worked out by itself.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [[t or "" for t in batch.column(c).to_pylist()] for c in ("old_text", "new_text")]
            sides = [digests(t) for t in texts]
            sizes = [np.array([len(t) for t in own], np.int64) for own in texts]
            rows, keys, sign = differences(*sides)
            lists = []
            for s in (1, -1):
                mine = sign == s
                by = np.lexsort((keys[mine].view(np.int64), rows[mine]))
                ends = np.append(0, np.cumsum(np.bincount(rows[mine], minlength=batch.num_rows)))
                lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[mine][by].view(np.int64), pa.int64())))
            prints = [pa.array(fingerprints(*side, size), pa.string()) for side, size in zip(sides, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("pair_id"), *prints, pa.array(likeness(*sides, *sizes), pa.float64()), *lists], names=["pair_id", "old_fingerprint", "new_fingerprint", "likeness", "removed", "added"])

    kind = dict(pairs.dtypes)["pair_id"]
    schema = f"pair_id {kind}, old_fingerprint string, new_fingerprint string, likeness double, removed array<long>, added array<long>"
    return pairs.select("pair_id", "old_text", "new_text").mapInArrow(compared, schema)


def _followed(ids: list, texts: list[str], after: list[str]) -> dict[str, list]:
    """Fingerprints of texts and of their edited texts, where `after` are the texts that follow them."""
    sizes = [len(t) for t in texts]
    edited = [t[: n - n // 2] + b[: n // 2] for t, b, n in zip(texts, after, sizes, strict=True)]
    place: dict[str, int] = {}
    at = [[place.setdefault(t, len(place)) for t in own] for own in (texts, edited, after)]  # most texts follow another one here
    keys = digests(list(place))
    own, new, later = (_select(keys, np.array(a, np.int64)) for a in at)
    size, size_new, size_later = (np.array([len(t) for t in x], np.int64) for x in (texts, edited, after))
    return {
        "doc_id": ids, "n_chars": sizes, "parts": own[1].tolist(), "cells": packed_cells(*own),
        "edited_chars": size_new.tolist(), "edited_parts": new[1].tolist(), "edited_cells": packed_cells(*new), "edited_sha": [hashlib.sha256(t.encode()).digest() for t in edited],
        "near_edited": likeness(own, new, size, size_new).tolist(), "near_next": likeness(own, later, size, size_later).tolist(),
    }


def half_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each whole text of `docs` (doc_id, text, ...) and of its edited text, and how alike they and the next text's are.

    Edited: the last floor(n / 2) of n code points are replaced by the first as many (or all) of the next document's
    by ascending doc_id, after the last the first's. Null texts are empty; null doc_ids come first; rows of one
    doc_id follow one another in any order; a document alone is its own next. Other columns are left out. Empty
    input: empty output.

    One sort of the texts by ranges of doc_id. A task reads its range in order and pairs each row with the one
    after it; a range's last row, with its text, waits for the first of the next range: two rows a range
    go through the shared folder, and only they are shuffled once more.
    """
    kind = dict(docs.dtypes)["doc_id"]
    fields = f"doc_id {kind}, n_chars long, parts long, cells binary, edited_chars long, edited_parts long, edited_cells binary, edited_sha binary, near_edited double, near_next double"
    names = [f.split()[0] for f in fields.replace(f"doc_id {kind}", "doc_id x").split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]

    def batch_of(ids, texts, after, id_kind, edge):
        done = _followed(ids, texts, after) if ids else {c: [] for c in names}
        n, m = len(ids), len(edge)
        columns = [pa.array(done["doc_id"] + [e[0] for e in edge], id_kind)]
        columns += [pa.array(done[c] + [None] * m, k) for c, k in zip(names[1:], kinds, strict=True)]
        columns += [pa.array([None] * n + [e[1] for e in edge], pa.string()), pa.array([None] * n + [e[2] for e in edge], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*names, "edge", "text"])

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, id_kind = None, None
        for batch in sliced(batches, "text", BATCH_BYTES):
            id_kind = batch.column("doc_id").type
            rows = list(zip(batch.column("doc_id").to_pylist(), (t or "" for t in batch.column("text").to_pylist()), strict=True))
            edge = [(rows[0][0], "first", rows[0][1])] if last is None else []
            rows = ([last] if last is not None else []) + rows
            last = rows[-1]
            yield batch_of([r[0] for r in rows[:-1]], [r[1] for r in rows[:-1]], [r[1] for r in rows[1:]], id_kind, edge)
        if last is not None:
            yield batch_of([], [], [], id_kind, [(last[0], "last", last[1])])

    def at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            done = _followed(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("after").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(done[c], k) for c, k in zip(names[1:], kinds, strict=True))], names=names)

    ordered = docs.select("doc_id", "text").repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"))
    found = staged(ordered.mapInArrow(in_order, f"{fields}, edge string, text string").withColumn("part", F.spark_partition_id()))
    edges = found.where(F.col("edge").isNotNull())
    # a row a range, without texts: which range follows which; the first follows the last
    ranges = edges.where("edge = 'first'").select("part", "doc_id")
    order = Window.orderBy(F.asc_nulls_first("doc_id"), "part")
    around = ranges.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next"))
    firsts = edges.where("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("after"))
    waiting = edges.where("edge = 'last'").select("doc_id", "text", "part").join(around, "part").join(firsts, "next").select("doc_id", "text", "after")
    rows = found.where(F.col("edge").isNull()).select(*names).unionByName(waiting.mapInArrow(at_edges, fields))
    shown = lambda parts, chars, cells: F.concat_ws(":", parts, chars, F.base64(F.col(cells)))
    return rows.select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"), shown("parts", "n_chars", "cells").alias("fingerprint"),
        shown("edited_parts", "edited_chars", "edited_cells").alias("edited_fingerprint"), "near_edited", "near_next",
    )


def query(spark, sf_dir):
    return half_edited(table(spark, sf_dir, "documents"))
