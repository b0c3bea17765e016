"""Periodic run detection: maximal repetitions of words by an enhanced suffix array and the branching-tandem test."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, sliced, table

#: Bytes of text whose words share one suffix array (a longer text has its own).
ARRAY_BYTES = 1 << 20
#: Suffixes tested at a time, and words compared in step before pairs are compared one by one.
TESTED, STEPPED = 1 << 20, 16


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of dense symbol numbers and its inverse, by doubling of the groups still tied.

    A suffix's rank is the first place of its group, so settled suffixes keep theirs. The last symbol must occur once.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    counts = np.bincount(symbols)
    rank = (np.cumsum(counts) - counts)[symbols]
    open_ = np.flatnonzero(counts[symbols[order]] > 1)  # places in `order` of tied suffixes
    step = 1
    while len(open_):
        at = order[open_]
        key = rank[at] * n + rank[np.minimum(at + step, n - 1)]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[open_] = at
        fresh = np.append(True, key[1:] != key[:-1])
        first = np.maximum.accumulate(np.where(fresh, open_, 0))  # groups are contiguous, so places serve as ranks
        rank[at] = first
        alone = fresh & np.append(fresh[1:], True)
        open_ = open_[~alone]
        step *= 2
    return order, rank


def common_prefixes(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The longest common prefix of each suffix in order and the one before it (0 for the first).

    By text place: where the words before the two suffixes agree, the value is one less than at the
    place before. Only the other places are compared, whose values sum up to n log n at most.
    """
    n = len(symbols)
    before = np.where(rank > 0, order[np.maximum(rank, 1) - 1], -1)
    prior = np.append(-1, before[:-1])
    alike = (before > 0) & (prior >= 0)
    alike[0] = False
    alike[1:] &= symbols[:-1] == symbols[np.maximum(before[1:], 1) - 1]
    alike &= prior + 1 == before
    own = np.zeros(n, np.int64)
    todo = np.flatnonzero(~alike & (before >= 0))
    for _ in range(STEPPED):
        at, other = todo + own[todo], before[todo] + own[todo]
        todo = todo[symbols[np.minimum(at, n - 1)] == symbols[np.minimum(other, n - 1)]]
        own[todo] += 1
    for i in todo.tolist():
        own[i] += _agreeing(symbols, i + int(own[i]), int(before[i] + own[i]))
    last = np.maximum.accumulate(np.where(alike, -1, np.arange(n)))
    by_place = np.maximum(own[last] - (np.arange(n) - last), 0)
    return by_place[order]


def _agreeing(symbols: np.ndarray, i: int, j: int) -> int:
    """How many symbols from i and from j on agree, in slices that double."""
    n, done, size = len(symbols), 0, 64
    while True:
        size = min(size, n - max(i, j) - done)
        other = symbols[i + done : i + done + size] != symbols[j + done : j + done + size]
        k = int(other.argmax()) if other.any() else size
        done += k
        if k < size or size == 0:
            return done
        size *= 2


def next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the first later one with a smaller value (n if none), by a pyramid of minima."""
    n = len(values)
    top = np.iinfo(values.dtype).min
    levels = [np.append(values, top)]
    while len(levels[-1]) > 1:
        a = levels[-1]
        a = a if len(a) % 2 == 0 else np.append(a, np.iinfo(values.dtype).max)
        levels[-1] = a
        levels.append(np.minimum(a[::2], a[1::2]))
    found = np.full(n, n)
    node, who = np.arange(1, n + 1), np.arange(n)
    met: list[tuple[np.ndarray, np.ndarray]] = []
    for level in levels:
        inside = node < len(level)
        hit = inside.copy()
        hit[inside] = level[node[inside]] < values[who[inside]]
        met.append((node[hit], who[hit]))
        node, who = (node[~hit] + 1) >> 1, who[~hit]
    node, who = met[-1]
    for k in range(len(levels) - 1, 0, -1):
        node = 2 * node
        node = node + (levels[k - 1][node] >= values[who])
        node, who = np.concatenate([node, met[k - 1][0]]), np.concatenate([who, met[k - 1][1]])
    found[who] = node
    return found


def branching_squares(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray, prefixes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and periods of the squares whose next symbol breaks the period.

    The suffixes of an interval of depth d part into its children; all but those of the largest child are tested:
    does the suffix d before or after lie in the interval too? Intervals are ranges of the arrays; no tree is made.
    """
    n = len(order)
    marks = np.flatnonzero(prefixes > 0)
    if not len(marks):
        return
    after = next_smaller(prefixes)
    back = n - 1 - next_smaller(prefixes[::-1])[::-1]  # the last place before with a smaller value
    low, high = back[marks], after[marks] - 1  # each mark parts two children of the interval [low, high]
    by = np.lexsort((marks, low, -high))
    marks, low, high = marks[by], low[by], high[by]
    head = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
    tail = np.append(head[1:], True)
    # children: one from the interval's start to its first mark, one from each mark to the next
    begin = np.concatenate([low[head], marks])
    end = np.concatenate([marks[head] - 1, np.where(tail, high, np.append(marks[1:], 0) - 1)])
    group = np.cumsum(head) - 1
    of = np.concatenate([group[head], group])
    lows, highs, depth = low[head], high[head], prefixes[marks[head]]
    size = end - begin + 1
    largest = np.lexsort((begin, -size, of))
    largest = largest[np.append(True, of[largest][1:] != of[largest][:-1])]
    small = np.ones(len(of), bool)
    small[largest] = False
    begin, size, of = begin[small], size[small], of[small]
    parts = np.flatnonzero(np.diff(np.cumsum(size) // TESTED, prepend=-1))
    for a, b in zip(parts, [*parts[1:], len(size)], strict=True):
        count = size[a:b]
        place = np.repeat(begin[a:b] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        g = np.repeat(of[a:b], count)
        i, d = order[place], depth[g]
        for start, partner in ((i, i + d), (i - d, i - d)):
            good = (partner >= 0) & (partner < n)
            r = rank[np.where(good, partner, 0)]
            good &= (r >= lows[g]) & (r <= highs[g])
            s, q = start[good], d[good]
            broken = symbols[s + q] != symbols[np.minimum(s + 2 * q, n - 1)]
            yield s[broken], q[broken]


def symbol_runs(symbols: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and smallest periods of all maximal runs with at least so many symbols and periods, by start and period.

    Each run of two periods or more ends with one branching square of its smallest period; rotating that
    to the left finds its start. Squares of several periods of a run with the same end are merged into it.
    """
    order, rank = suffix_array(symbols)
    prefixes = common_prefixes(symbols, order, rank)
    squares = list(branching_squares(symbols, order, rank, prefixes))
    none = np.zeros(0, np.int64)
    if not squares:
        return none, none, none
    start, period = np.concatenate([s for s, _ in squares]), np.concatenate([q for _, q in squares])
    need = np.maximum(min_length - 2 * period, (min_exponent - 2) * period)  # symbols still wanted to the left
    for k in range(STEPPED):  # most squares in prose fall out here
        left = start - 1 - k
        ok = (k >= need) | ((left >= 0) & (symbols[np.maximum(left, 0)] == symbols[np.maximum(left, 0) + period]))
        start, period, need = start[ok], period[ok], need[ok]
    end = start + 2 * period
    by = np.lexsort((period, end))
    out, last, known = [], -1, []
    for s, q, e in zip(start[by].tolist(), period[by].tolist(), end[by].tolist(), strict=True):
        if e != last:
            last, known = e, []
        if any(q % p == 0 and e - 2 * q >= a for a, p in known):
            continue  # the same square, or several periods of the same run
        a = s - _agreeing(symbols[::-1], len(symbols) - s, len(symbols) - s - q)
        known.append((a, q))
        if e - a >= max(min_length, min_exponent * q):
            out.append((a, e - a, q))
    found = np.array(sorted(out, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def _rows(texts: list[bytes], min_length: int, min_exponent: int) -> tuple[list[int], list[list[dict]], list[str]]:
    """Word counts, runs and collapsed texts of some texts, which share one suffix array.

    No two texts share a symbol, and each ends with one of its own, so no prefix crosses a text's end.
    """
    words, parts, total, at = [], [], 0, [0]
    for text in texts:
        own = text.split()  # bytes.split() cuts at space and U+0009 to U+000D only
        known: dict[bytes, int] = {}
        parts.append(np.fromiter((known.setdefault(w, len(known)) for w in own), np.int64, len(own)) + total)
        total += len(known) + 1
        parts.append(np.array([total - 1]))
        words.append(own)
        at.append(at[-1] + len(own) + 1)
    starts, lengths, periods = symbol_runs(np.concatenate(parts), min_length, min_exponent)
    bounds = np.searchsorted(starts, at)
    runs, kept = [], []
    for k, own in enumerate(words):
        a, b = bounds[k], bounds[k + 1]
        found = list(zip((starts[a:b] - at[k]).tolist(), lengths[a:b].tolist(), periods[a:b].tolist(), strict=True))
        runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
        if found:
            edge = np.zeros(len(own) + 1, np.int64)
            for s, n, q in found:
                edge[s + q] += 1
                edge[s + n] -= 1
            stay = np.cumsum(edge)[:-1] == 0
            own = [own[i] for i in np.flatnonzero(stay)]
        kept.append(b" ".join(own).decode("utf-8", "replace"))
    return [len(w) for w in words], runs, kept


def periodic_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3) -> DataFrame:
    """The periodic runs of words in each whole text of `docs` (doc_id, text, ...).

    Words are what blanks (space and U+0009 to U+000D) part, numbered from 0. A run is a maximal stretch of consecutive
    words with smallest period q, at least `min_length` words and `min_exponent` (2 or more) periods long. Returns
    doc_id, n_words, runs (array of start, length, period by start, then period) and collapsed: the words outside
    all runs and in the first period of the runs they are in, joined by one space.

    Null and empty texts have no words and no runs. Repeated rows and null doc_ids are worked out row by row; other
    columns are left out. Empty input: empty output. A run never leaves its text, so nothing is shuffled; a task
    holds one text or ARRAY_BYTES of them at a time.
    """
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", ARRAY_BYTES):
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()
            n, runs, kept = _rows(texts, min_length, min_exponent)
            kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(runs, kinds), pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(found, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, periodic from some word on where crc32(doc_id) % 10 = 0: the input that the query's contract fixes.

    With h = crc32 of the decimal doc_id, g = floor(h / 10) and n words, word i >= a becomes word a + (i - a) % p,
    where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Such a text's words are joined by one space.
    """
    blanks = "[" + "".join(f"\\x{ord(c):02x}" for c in BLANKS) + "]+"
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(BLANKS))
    chosen = (F.crc32(F.col("doc_id").cast("string")) % 10 == 0) & (trimmed != "")
    words = docs.select("doc_id", "text", F.when(chosen, F.split(trimmed, blanks)).alias("w"), F.floor(F.crc32(F.col("doc_id").cast("string")) / 10).alias("g"))
    placed = words.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    turned = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return placed.select("doc_id", F.when(F.col("w").isNotNull(), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties to the smallest start, then period."""

    def better(best: Column, r: Column) -> Column:
        over = r["length"] * best["period"] - best["length"] * r["period"]
        first = (r["start"] < best["start"]) | ((r["start"] == best["start"]) & (r["period"] < best["period"]))
        return F.when(best.isNull() | (over > 0) | ((over == 0) & first), r).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)


def query(spark, sf_dir):
    rows = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents"))).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
