"""Suffix-array dedup: bytes under strings that an earlier document holds too are removed.

Windows of LENGTH bytes meet in ranges of the hash of their minimizer, the least hash of their GRAM-byte
substrings: equal windows have equal minimizers. Only runs of windows whose minimizer recurs go to
their range, where a suffix array, built bucket by bucket with a difference cover, brings
equal windows together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import shared_dir, sliced, table
from .shingles import mix

LENGTH, GRAM = 50, 24
#: Bytes of text in a block, and about as many in what a range's task gets at a time.
BLOCK_BYTES, RANGE_BYTES = 1 << 20, 3 << 20
#: Bytes of a range's text that one suffix array takes, and of text in a bucket of blocks.
PART_BYTES, BUCKET_BYTES = 1 << 20, 24 << 20
#: Suffixes are sorted by so many bytes first; ties are told apart by ranks of the cover sample.
PERIOD = 16
_WORDS = -(-LENGTH // 8)

_VALUES = np.random.default_rng(8).integers(1, 2**63, 256).astype(np.uint64) | np.uint64(1)


def difference_cover(period: int) -> list[int]:
    """A small set of residues whose differences give all residues, found greedily."""
    cover, have = [0], {0}
    while len(have) < period:
        best = max(range(period), key=lambda r: (len({(a - b) % period for a in [*cover, r] for b in [*cover, r]} - have), -r))
        cover.append(best)
        have = {(a - b) % period for a in cover for b in cover}
    return sorted(cover)


COVER = difference_cover(PERIOD)
#: For residues i and j the least shift that takes both into the cover.
_SHIFT = np.array([[next(d for d in range(PERIOD) if (i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER) for j in range(PERIOD)] for i in range(PERIOD)])


def _strings(padded: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The n bytes from each position, as fixed strings that compare byte by byte."""
    view = np.lib.stride_tricks.sliding_window_view(padded, n)
    return np.ascontiguousarray(view[at]).view(f"S{n}").ravel()


def cover_ranks(padded: np.ndarray, size: int) -> np.ndarray:
    """Ranks, by LENGTH bytes, of the suffixes that begin on the cover; other places hold 0."""
    at = np.flatnonzero(np.isin(np.arange(PERIOD), COVER)[np.arange(size) % PERIOD])
    keys = _strings(padded, at, LENGTH)
    order = np.argsort(keys)
    keys = keys[order]
    ranks = np.zeros(size, np.int32)
    ranks[at[order]] = np.cumsum(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return ranks


def sort_bucket(padded: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The suffixes at `at` in order of at least LENGTH bytes.

    First by PERIOD bytes; suffixes tied there are split around one of them by the ranks of the
    cover sample at the pair's common shift, again and again, as quicksort does.
    """
    keys = _strings(padded, at, PERIOD)
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    group = np.cumsum(np.concatenate([[True], keys[1:] != keys[:-1]])).astype(np.int64)
    live = np.ones(len(at), bool)
    while True:
        sizes = np.bincount(group)
        live &= sizes[group] > 1
        some = np.flatnonzero(live)
        if not len(some):
            return at
        g = group[some]
        heads = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        middle = heads + np.diff(np.concatenate([heads, [len(some)]])) // 2
        leader = np.repeat(at[some][middle], np.diff(np.concatenate([heads, [len(some)]])))
        mine = at[some]
        shift = _SHIFT[mine % PERIOD, leader % PERIOD]
        sign = np.sign(ranks[mine + shift] - ranks[leader + shift])
        inner = np.lexsort((sign, g))
        at[some] = mine[inner]
        sign, g = sign[inner], g[inner]
        # a new number for each part, in order, over all suffixes
        cut = np.zeros(len(at), bool)
        cut[np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))] = True
        part = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (sign[1:] != sign[:-1])]))
        cut[some[part]] = True
        group = np.cumsum(cut)
        live[some] = sign != 0


def equal_windows(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows at `at` in suffix order, and the number of each one's class of equal windows."""
    padded = np.concatenate([text, np.zeros(LENGTH + 2 * PERIOD, np.uint8)])
    ranks = cover_ranks(padded, len(text) + PERIOD)
    ordered, classes, last = [], [], 0
    first = text[at]
    by_first = np.argsort(first, kind="stable")
    edges = np.searchsorted(first[by_first], np.arange(257))
    for a, b in zip(edges[:-1], edges[1:], strict=True):  # one bucket of suffixes at a time
        if a == b:
            continue
        suffixes = sort_bucket(padded, ranks, at[by_first[a:b]])
        windows = _strings(padded, suffixes, LENGTH)
        new = np.concatenate([[True], windows[1:] != windows[:-1]])
        ordered.append(suffixes)
        classes.append(np.cumsum(new) - 1 + last)
        last += int(new.sum())
    return np.concatenate(ordered), np.concatenate(classes)


class Runs:
    """A block's runs of windows with one minimizer: where they begin, their windows, its hash, their document."""

    def __init__(self, text: np.ndarray, sizes: np.ndarray):
        n = len(text)
        shingles._grow(n + 1)
        self.stops = np.cumsum(sizes)
        spread = _VALUES[text]
        spread *= shingles._powers[:n]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(spread)])
        if n < LENGTH:
            self.begin = self.count = self.doc = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        least = mix((self.sums[GRAM:] - self.sums[:-GRAM]) * shingles._inverses[: n - GRAM + 1])
        width, done = LENGTH - GRAM + 1, 1
        while 2 * done <= width:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if done < width:
            least = np.minimum(least[: done - width], least[width - done :])
        new = np.concatenate([[True], least[1:] != least[:-1]])
        new[self.stops[:-1][self.stops[:-1] < len(new)]] = True
        # windows that would reach over the end of a document are none
        last = np.maximum(self.stops - LENGTH + 1, 0)
        new[last[last < len(new)]] = True
        begin = np.flatnonzero(new)
        doc = np.searchsorted(self.stops, begin, side="right")
        count = np.diff(np.concatenate([begin, [len(new)]]))
        fits = begin + LENGTH <= self.stops[doc]
        self.begin, self.count, self.doc = begin[fits], count[fits], doc[fits]
        self.hash = mix(least[self.begin])  # least hashes crowd at 0; mixed again, they fill all ranges

    def content(self, some: np.ndarray) -> np.ndarray:
        """Hashes of the bytes under some of the runs."""
        a, b = self.begin[some], self.begin[some] + self.count[some] + LENGTH - 1
        return mix((self.sums[b] - self.sums[a]) * shingles._inverses[a] + self.count[some].astype(np.uint64))


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to blocks: a number, the documents' ids and sizes, and all their bytes."""
    number = TaskContext.get().partitionId() << 40
    for batch in sliced(batches, "text", BLOCK_BYTES):
        text = b"".join(x.as_buffer().to_pybytes() for x in batch.column("text"))
        sizes = np.array([x.as_buffer().size for x in batch.column("text")], "<i8")
        ids = batch.column("doc_id").to_numpy().astype("<i8")
        number += 1
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([len(text)], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([sizes.tobytes()], pa.binary()), pa.array([text], pa.binary())], names=["block", "n", "ids", "sizes", "text"])


def _read(batch: pa.RecordBatch, i: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    held = lambda c, t: np.frombuffer(batch.column(c)[i].as_buffer(), t)
    return batch.column("block")[i].as_py(), held("ids", "<i8"), held("sizes", "<i8"), held("text", np.uint8)


def _minimizers(ranges: int):
    """Blocks to rows (range, block, blob): the block's distinct minimizers, 39 bits of each and whether two documents share it."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, _, sizes, text = _read(batch, i)
                runs = Runs(text, sizes)
                keys, shared = _distinct(runs)
                part = _range_of(keys, ranges)
                at = np.searchsorted(part, np.arange(ranges + 1))
                small = ((keys & np.uint64((1 << 39) - 1)) << np.uint64(1) | shared.astype(np.uint64)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                used = [p for p in range(ranges) if at[p + 1] > at[p]]
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()), pa.array([small[at[p] : at[p + 1]].tobytes() for p in used], pa.binary())], names=["range", "block", "blob"])

    return emit


def _distinct(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Sorted minimizers of a block, each once, and whether more than one document has it."""
    order = np.lexsort((runs.doc, runs.hash))
    h, d = runs.hash[order], runs.doc[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(h)]]) - 1 if len(h) else first
    return h[first], d[first] != d[last]


def _recurring(rows: pa.Table) -> pa.Table:
    """For each block's minimizers in a range, a bit for those that recur."""
    keys = []
    for blob in rows.column("blob"):
        wide = np.zeros((len(blob.as_buffer()) // 5, 8), np.uint8)
        wide[:, :5] = np.frombuffer(blob.as_buffer(), np.uint8).reshape(-1, 5)
        keys.append(wide.view("<u8").ravel())
    every = np.concatenate(keys)
    value, shared = every >> np.uint64(1), (every & np.uint64(1)).astype(bool)
    ordered = np.sort(value)
    again = np.unique(np.concatenate([ordered[1:][ordered[1:] == ordered[:-1]], value[shared]]))
    at = np.searchsorted(again, value)
    hit = (again[np.minimum(at, len(again) - 1)] == value) if len(again) else np.zeros(len(value), bool)
    stops = np.cumsum([0, *map(len, keys)])
    bits = [np.packbits(hit[a:b]).tobytes() for a, b in zip(stops[:-1], stops[1:], strict=True)]
    return pa.table([rows.column("block"), rows.column("range"), pa.array(bits, pa.binary())], names=["block", "range", "bits"])


def _fragments(ranges: int):
    """Blocks and their bits to rows (range, block, blob): the bytes of recurring runs.

    Of runs with equal bytes in one block only the smallest document's goes; the others'
    windows are in a smaller document for certain, and come out as range -1.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, ids, sizes, text = _read(batch, i)
                runs = Runs(text, sizes)
                keys, _ = _distinct(runs)
                at = np.searchsorted(_range_of(keys, ranges), np.arange(ranges + 1))
                again = np.zeros(len(keys), bool)
                for bits in batch.column("replies")[i].as_py() or ():
                    a, b = at[bits["range"]], at[bits["range"] + 1]
                    again[a:b] = np.unpackbits(np.frombuffer(bits["bits"], np.uint8))[: b - a].astype(bool)
                some = np.flatnonzero(again[np.searchsorted(keys, runs.hash)]) if len(keys) else np.zeros(0, np.int64)
                owner = ids[runs.doc[some]]
                content = runs.content(some)
                order = np.lexsort((owner, content))
                same = np.concatenate([[False], content[order][1:] == content[order][:-1]]) if len(some) else np.zeros(0, bool)
                head = np.maximum.accumulate(np.where(same, 0, np.arange(len(some))))
                later = order[same & (owner[order] > owner[order][head])]
                gone = np.zeros(len(some), bool)
                gone[later] = True
                out = [(-1, _pack(runs, some[gone], owner[gone], None))] if gone.any() else []
                sent = some[~gone]
                part = _range_of(runs.hash[sent], ranges)
                by_part = np.argsort(part, kind="stable")
                sent, edges = sent[by_part], np.searchsorted(part[by_part], np.arange(ranges + 1))
                for p in np.flatnonzero(np.diff(edges)):
                    own = sent[edges[p] : edges[p + 1]]
                    out.append((int(p), _pack(runs, own, ids[runs.doc[own]], text)))
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([block] * len(out), pa.int64()), pa.array([b for _, b in out], pa.binary())], names=["range", "block", "blob"])

    return emit


def _pack(runs: Runs, some: np.ndarray, owner: np.ndarray, text: np.ndarray | None) -> bytes:
    begin, count = runs.begin[some], runs.count[some]
    parts = [np.array([len(some)], "<u4").tobytes(), begin.astype("<u4").tobytes(), count.astype("<u4").tobytes(), owner.astype("<i8").tobytes()]
    if text is not None:
        size = count + LENGTH - 1
        parts += [runs.hash[some].astype(np.uint8).tobytes(), text[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())].tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(blob) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a blob: begin, windows, document; then a byte of each one's minimizer and all their text."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob.as_buffer()), np.uint8)
    n = int(raw[:4].view("<u4")[0])
    cut = lambda a, b, t: np.frombuffer(raw[a:b].tobytes(), t)
    return cut(4, 4 + 4 * n, "<u4").astype(np.int64), cut(4 + 4 * n, 4 + 8 * n, "<u4").astype(np.int64), cut(4 + 8 * n, 4 + 16 * n, "<i8"), raw[4 + 16 * n :]


def _later(text: bytes, count: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which windows of some runs (their bytes joined in `text`) a smaller document has too: run, first window, windows.

    Runs of equal bytes are one in the suffix array, that of their smallest document; all windows of the others are later.
    """
    size = count + LENGTH - 1
    stops = np.cumsum(size)
    known: dict[bytes, int] = {}
    same = np.array([known.setdefault(text[a:b], len(known)) for a, b in zip((stops - size).tolist(), stops.tolist(), strict=True)], np.int64)
    least = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(least, same, owner)
    whole = np.flatnonzero(owner > least[same])
    every = (whole, np.zeros(len(whole), np.int64), count[whole])
    if least.min() == least.max():
        return every
    once = np.frombuffer(b"".join(known), np.uint8)
    width = np.array([len(x) - LENGTH + 1 for x in known], np.int64)
    place = np.cumsum(width + LENGTH - 1) - (width + LENGTH - 1)
    del known
    windows = np.repeat(place - (np.cumsum(width) - width), width) + np.arange(width.sum())
    run = np.zeros(len(once), np.int32)
    run[windows] = np.repeat(np.arange(len(width)), width)
    suffixes, classes = equal_windows(once, windows)
    owners = least[run[suffixes]]
    heads = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
    first = np.minimum.reduceat(owners, heads)
    hit = np.zeros(len(once) + 1, bool)
    hit[suffixes[owners > first[classes]]] = True
    # runs of removable windows inside each run, for all that have its bytes and are not later as a whole
    edge = np.diff(np.concatenate([[False], hit]).astype(np.int8))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    r = run[a]
    kept = np.flatnonzero(owner == least[same])
    low, high = np.searchsorted(r, same[kept]), np.searchsorted(r, same[kept], side="right")
    n = high - low
    at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return tuple(np.concatenate(x) for x in zip(every, (np.repeat(kept, n), a[at] - place[r[at]], (b - a)[at]), strict=True))


def _removable(rows: pa.Table) -> pa.Table:
    """For each block's runs of a range: where windows begin that a smaller document has too, as (begin, windows) in the block.

    Runs of one minimizer are searched together, about PART_BYTES of text at a time.
    """
    blobs = [_unpack(b) for b in rows.column("blob")]
    begin, count = (np.concatenate([x[k] for x in blobs]) for k in range(2))
    blob = np.repeat(np.arange(len(blobs)), [len(x[0]) for x in blobs])
    if rows.column("range")[0].as_py() < 0:
        found = [(np.arange(len(begin)), np.zeros(len(begin), np.int64), count)]
    else:
        owner = np.concatenate([x[2] for x in blobs])
        key = np.concatenate([x[3][: len(x[0])] for x in blobs])
        text = np.concatenate([x[3][len(x[0]) :] for x in blobs])
        del blobs
        size = count + LENGTH - 1
        place = np.cumsum(size) - size
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.diff(key[order], prepend=-1))
        part = (np.cumsum(size[order]) - size[order])[new] // PART_BYTES
        edges = [*new[np.flatnonzero(np.diff(part, prepend=-1))], len(order)]
        found = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            some = order[a:b]
            n = size[some]
            own = text[np.repeat(place[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes()
            r, at, wide = _later(own, count[some], owner[some])
            found.append((some[r], at, wide))
    run, at, wide = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(blob[run], kind="stable")
    run, at, wide = run[order], at[order], wide[order]
    used, heads = np.unique(blob[run], return_index=True)
    edges = [*heads, len(run)]
    packed = [(begin[run[a:b]] + at[a:b]).astype("<u4").tobytes() + wide[a:b].astype("<u4").tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.table([rows.column("block").take(pa.array(used, pa.int64())), pa.array(packed, pa.binary())], names=["block", "spans"])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks and their removable windows to documents without those bytes."""
    for batch in batches:
        for i in range(batch.num_rows):
            _, ids, sizes, text = _read(batch, i)
            change = np.zeros(len(text) + 1, np.int32)
            for raw in batch.column("replies")[i].as_py() or ():
                at, n = np.frombuffer(raw, "<u4").astype(np.int64).reshape(2, -1)
                np.add.at(change, at, 1)
                np.add.at(change, at + n + LENGTH - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            stops = np.cumsum(sizes)
            cols: list[list] = [[], [], [], []]
            for a, b in zip(stops - sizes, stops, strict=True):
                g = gone[a:b]
                cols[0].append(b - a)
                cols[1].append(int(g.sum()))
                cols[2].append(int((g[1:] & ~g[:-1]).sum() + g[:1].sum()))
                cols[3].append(text[a:b][~g].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


_BLOCK = "block long, n long, ids binary, sizes binary, text binary"


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Remove each byte of `docs` (doc_id long, text, ...) under a LENGTH-byte string that also starts in a smaller doc_id.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the other bytes,
    joined; they need not be valid UTF-8), one row for each input row. Strings are judged on
    the input. Null text is empty. Rows repeated under one doc_id do not remove each other's
    bytes. A null doc_id is neither smaller nor larger than any: such rows keep all bytes.
    Other columns are left out. Empty input: empty output.

    Texts are packed into blocks, kept in a table that is bucketed by block, so that the
    replies of both exchanges (recurring minimizers, removable windows) are joined to it
    without shuffling texts again. There are more buckets as the texts grow, so that a task reads
    no more of them. A block sends each distinct run once, whatever the number of its documents
    that hold it; of runs that several blocks sent, a range puts one into its suffix array.
    """
    spark = docs.sparkSession
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(given, (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES)
    name = "blocks_" + shared_dir(spark).rpartition("/")[2]
    cut = raw.where(F.col("doc_id").isNotNull()).mapInArrow(_blocks, _BLOCK)
    cut.repartition(parts, "block").write.option("compression", "zstd").bucketBy(parts, "block").saveAsTable(name)
    blocks = spark.table(name)
    ranges = max(64, (blocks.agg(F.sum("n")).first()[0] or 0) // RANGE_BYTES)

    def with_replies(replies: DataFrame, what) -> DataFrame:
        dealt = replies.repartition(parts, "block") if parts > given else replies
        held = dealt.groupBy(F.col("block").alias("__b")).agg(F.collect_list(what).alias("replies"))
        return blocks.join(held.hint("shuffle_hash"), blocks["block"] == held["__b"], "left").drop("__b")

    asked = blocks.mapInArrow(_minimizers(ranges), "range int, block long, blob binary")
    bits = asked.groupBy("range").applyInArrow(_recurring, "block long, range int, bits binary")
    sent = with_replies(bits, F.struct("range", "bits")).mapInArrow(_fragments(ranges), "range int, block long, blob binary")
    # what a block has found out by itself is range -1, dealt by block
    spans = sent.groupBy("range", F.when(F.col("range") < 0, F.col("block")).alias("alone")).applyInArrow(_removable, "block long, spans binary")
    done = with_replies(spans, "spans").mapInArrow(_apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    lone = raw.where(F.col("doc_id").isNull()).select("doc_id", F.length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("text").alias("kept"))
    return done.union(lone)


def query(spark, sf_dir):
    done = dedup_substrings(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
