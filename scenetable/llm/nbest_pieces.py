"""SentencePiece encoding and decoding: the N best segmentations over a model's piece lattice."""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, sliced, table
from .shingles import mix

#: SentencePiece's sign for a space.
SPACE = "▁"
#: Chunks are searched together by length, up to so many at a time; longer than the last, one by one.
WIDTHS, ABREAST = (4, 6, 8, 10, 12, 16, 24, 40, 64), 8192

_coders: dict[str, PieceCoder] = {}
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WIDTHS[-1])], np.uint64)
_NONE, _PREFIX = -2, -1


class _Slots:
    """Hashes of code point strings to numbers: open addressing over numpy arrays."""

    def __init__(self, held: dict[str, int]):
        bits = max(4, (4 * len(held)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, _NONE, np.int32)
        longest = max(map(len, held), default=1)
        codes = np.frombuffer("".join(x.ljust(longest, "\0") for x in held).encode("utf-32-le"), "<u4").reshape(len(held), longest).astype(np.uint64)
        there = np.arange(longest) < np.array([len(x) for x in held])[:, None]
        with np.errstate(over="ignore"):
            hashes = mix(((codes + np.uint64(1)) * _FACTORS[:longest] * there).sum(axis=1, dtype=np.uint64))
        for h, value in zip(hashes.tolist(), held.values(), strict=True):
            at = h & int(self.mask)
            while self.values[at] != _NONE:
                at = (at + 1) & int(self.mask)
            self.keys[at], self.values[at] = h, value

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, or _NONE."""
        at = hashes & self.mask
        out = self.values[at]
        wrong = np.flatnonzero((self.keys[at] != hashes) & (out != _NONE))
        at = at[wrong]
        while len(wrong):
            at = (at + np.uint64(1)) & self.mask
            out[wrong] = self.values[at]
            still = (self.keys[at] != hashes[wrong]) & (out[wrong] != _NONE)
            wrong, at = wrong[still], at[still]
        return out


class PieceCoder:
    """The lattice of a SentencePiece model's pieces with their scores.

    A segmentation's score is the sum of its pieces' scores. Characters without a piece become
    their bytes' pieces, at 10 below the lowest score for the character; so does the sign
    SPACE itself if a text holds it, which keeps decoding exact. As SPACE stands in pieces only
    at their beginning, no piece reaches from one word into the next: the lattice falls into
    chunks (spaces and the word after them), and each distinct chunk of a batch is searched
    once, many chunks of like length abreast. Nothing is remembered from batch to batch.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes_of, self.byte_ids = [], {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.pieces[piece] = (i, model.get_score(i))
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("the model has pieces that reach over words")
        #: Every beginning of a piece: the piece's id and score, or None if it is no piece itself.
        self.prefixes = {p[:k]: None for p in self.pieces for k in range(1, len(p))} | self.pieces
        self.longest = max(map(len, self.pieces))
        self.slots = _Slots({p: _PREFIX if v is None else v[0] for p, v in self.prefixes.items()})
        self.score_of = np.zeros(model.get_piece_size())
        for i, score in self.pieces.values():
            self.score_of[i] = score
        self.lowest = min(s for _, s in self.pieces.values()) - 10
        self.width = np.array([len(b) for b in self.bytes_of], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.width)])
        self.raw = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def lattice(self, chunk: str) -> list[tuple[int, int, float, int]]:
        """The edges over `chunk` by their begin: (begin, end, score, id; -1 for a character's bytes).

        `chunk` has SPACE for spaces; a SPACE of the text is a lone surrogate there.
        """
        n, prefixes, edges = len(chunk), self.prefixes, []
        for i in range(n):
            known = False
            for j in range(i + 1, n + 1):
                found = prefixes.get(chunk[i:j], 0)
                if not found:
                    if found == 0:
                        break
                    continue
                if j == i + 1:
                    known = True
                edges.append((i, j, found[1], found[0]))
            if not known:
                edges.append((i, i + 1, self.lowest, -1))
        return edges

    def ids_of(self, chunk: str, edge: tuple[int, int, float, int]) -> list[int]:
        if edge[3] >= 0:
            return [edge[3]]
        c = chunk[edge[0]]
        return [self.byte_ids[b] for b in (SPACE if c == "\ud800" else c).encode()]

    @staticmethod
    def forward(edges: list, n: int) -> tuple[list[float], list]:
        """Viterbi: the best score from the beginning to each position, and the edge it comes by."""
        best, by = [float("-inf")] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        for e in edges:
            score = best[e[0]] + e[2]
            if score > best[e[1]]:
                best[e[1]], by[e[1]] = score, e
        return best, by

    def best_and_gap(self, chunk: str) -> tuple[list[int], float, float]:
        """The best ids and score, and how much lower the second best scores (infinity: none).

        Any other path takes some edge off the best path, and forward plus backward scores
        give the best total over that edge.
        """
        n = len(chunk)
        edges = self.lattice(chunk)
        best, by = self.forward(edges, n)
        path, j = [], n
        while j:
            path.append(by[j])
            j = by[j][0]
        used = {(e[0], e[1]) for e in path}
        second, back = float("-inf"), [float("-inf")] * (n + 1)
        back[n] = 0.0
        for i, j, s, _ in reversed(edges):
            rest = back[j] + s
            if rest > back[i]:
                back[i] = rest
            if best[i] + rest > second and (i, j) not in used:
                second = best[i] + rest
        return [k for e in reversed(path) for k in self.ids_of(chunk, e)], best[n], best[n] - second

    def nbest(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations, best first: A* from the end, with forward scores as the exact rest."""
        edges = self.lattice(chunk)
        best, _ = self.forward(edges, len(chunk))
        into: list[list] = [[] for _ in range(len(chunk) + 1)]
        for e in edges:
            into[e[1]].append(e)
        heap = [(-best[-1], 0, len(chunk), 0.0, None)]
        out, pushed = [], 0
        while heap and len(out) < n:
            _, _, j, done, path = heapq.heappop(heap)
            if j == 0:
                ids: list[int] = []
                while path is not None:
                    ids += self.ids_of(chunk, path[0])
                    path = path[1]
                out.append((done, tuple(ids)))
                continue
            for e in into[j]:
                pushed += 1  # ties: deepest first, else equal paths would all be grown at once
                heapq.heappush(heap, (-(done + e[2] + best[e[0]]), -pushed, e[0], done + e[2], (e, path)))
        return out

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Spaces and the word after them; the text has a space put before it, as SentencePiece does."""
        if not text:
            return []
        marked = (" " + text).replace(SPACE, "\ud800")
        return [c.replace(" ", SPACE) for c in re.findall(r" +[^ ]*|[^ ]+", marked)]

    def _abreast(self, codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """`best_and_gap` of many chunks at once: ids, how many a chunk, scores, gaps.

        `codes` has a chunk in each column, its characters downwards, `n` of them. A start is
        final when its turn comes, as all edges into it begin before; equal scores stay with
        the earlier start, as in `forward`.
        """
        size, count = codes.shape
        every = np.arange(count)
        best = np.full((size + 1, count), -np.inf)
        best[0] = 0
        by, by_id = np.zeros((size + 1, count), np.int8), np.zeros((size + 1, count), np.int32)
        edges: list[list[tuple]] = [[] for _ in range(size)]

        def reach(i: int, length: int, cols: np.ndarray, score, ids) -> None:
            edges[i].append((length, cols, score))
            new = best[i, cols] + score
            some = new > best[i + length, cols]
            to = cols[some]
            best[i + length, to], by[i + length, to], by_id[i + length, to] = new[some], length, ids[some]

        for i in range(size):
            cols = every[n > i]
            h = np.zeros(len(cols), np.uint64)
            for length in range(1, min(self.longest, size - i) + 1):
                if length > 1:
                    live = n[cols] >= i + length
                    cols, h = cols[live], h[live]
                if not len(cols):
                    break
                h = h + (codes[i + length - 1, cols] + np.uint64(1)) * _FACTORS[length - 1]
                found = self.slots.find(mix(h))
                if length == 1 and (found < 0).any():
                    lone = cols[found < 0]
                    reach(i, 1, lone, np.full(len(lone), self.lowest), np.full(len(lone), -1, np.int32))
                piece = found >= 0
                if piece.any():
                    reach(i, length, cols[piece], self.score_of[found[piece]], found[piece])
                more = found != _NONE
                cols, h = cols[more], h[more]
        step, at_id = np.zeros((size, count), np.int8), np.zeros((size, count), np.int32)
        cols, j = every, n.copy()
        while len(cols):
            i = j - by[j, cols]
            step[i, cols], at_id[i, cols] = by[j, cols], by_id[j, cols]
            cols, j = cols[i > 0], i[i > 0]
        back, second = np.full((size + 1, count), -np.inf), np.full(count, -np.inf)
        back[n, every] = 0
        for i in range(size - 1, -1, -1):
            for length, cols, score in reversed(edges[i]):
                rest = back[i + length, cols] + score
                back[i, cols] = np.maximum(back[i, cols], rest)
                off = step[i, cols] != length
                second[cols[off]] = np.maximum(second[cols[off]], (best[i, cols] + rest)[off])
        col, i = np.nonzero(step.T)
        ids, own = at_id[i, col], np.ones(len(col), np.int64)
        raw = np.flatnonzero(ids < 0)
        if len(raw):
            of = {c: self.ids_of(chr(c), (0, 1, 0.0, -1)) for c in np.unique(codes[i[raw], col[raw]]).tolist()}
            parts = [of[c] for c in codes[i[raw], col[raw]].tolist()]
            own[raw] = [len(p) for p in parts]
            ids = np.repeat(ids, own)
            ids[ids < 0] = [b for p in parts for b in p]
        return ids, np.bincount(col, weights=own, minlength=count).astype(np.int64), best[n, every], best[n, every] - second

    def search(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The best ids of all chunks, where each one's end (0 first), scores, and gaps to the second best."""
        n = np.array([len(c) for c in chunks], np.int64)
        score, gap, counts = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n), np.int64)
        parts, owners = [], []
        low = 0
        for high in WIDTHS:
            some = np.flatnonzero((n > low) & (n <= high))
            low = high
            for a in range(0, len(some), ABREAST):
                own = some[a : a + ABREAST]
                text = "".join(chunks[k].ljust(high, "\0") for k in own.tolist())
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(own), high)
                ids, counts[own], score[own], gap[own] = self._abreast(np.ascontiguousarray(codes.T).astype(np.uint64), n[own])
                parts.append(ids)
                owners.append(np.repeat(own, counts[own]))
        for k in np.flatnonzero(n > WIDTHS[-1]).tolist():
            ids, score[k], gap[k] = self.best_and_gap(chunks[k])
            counts[k] = len(ids)
            parts.append(np.array(ids, np.int32))
            owners.append(np.full(len(ids), k))
        ids = np.concatenate([np.zeros(0, np.int32), *parts])
        owner = np.concatenate([np.zeros(0, np.int64), *owners])
        return ids[np.argsort(owner, kind="stable")].astype(np.int32), np.concatenate([[0], np.cumsum(counts)]), score, gap

    def encode(self, texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[tuple[float, list]]]]:
        """Best ids of all texts, ids a text, scores, and the n best of each text: (score, changes).

        Changes are (place of the chunk's first id in the best ids, ids replaced, new ids).
        """
        lists = pc.split_pattern(texts, " ")
        flat = lists.flatten()
        odd = np.zeros(len(texts), bool)
        begin = lists.offsets.to_numpy().astype(np.int64)[: len(texts) + 1]
        begin = begin - begin[0]
        owner = np.repeat(np.arange(len(texts)), np.diff(begin))
        odd[owner[pc.equal(flat, "").to_numpy(zero_copy_only=False)]] = True
        odd |= pc.match_substring(texts, SPACE).to_numpy(zero_copy_only=False)
        coded = flat.dictionary_encode()
        plain = np.zeros(len(coded.dictionary), bool)
        codes = coded.indices.to_numpy().astype(np.int64)
        plain[codes[~odd[owner]]] = True
        words = coded.dictionary.to_pylist()
        names = [SPACE + w if p else "" for w, p in zip(words, plain, strict=True)]
        own = {int(t): self.chunks(texts[int(t)].as_py()) for t in np.flatnonzero(odd)}
        known: dict[str, int] = {}
        for c in [*names, *(c for cs in own.values() for c in cs)]:
            if c:
                known.setdefault(c, len(known))
        piece_ids, ends, score, gap = self.search(list(known))
        place = np.array([known[c] if c else 0 for c in names], np.int64)
        parts = []
        for t in range(len(texts)) if own else ():
            parts.append(np.array([known[c] for c in own[t]], np.int64) if t in own else place[codes[begin[t] : begin[t + 1]]])
        at = np.concatenate(parts) if own else place[codes]
        begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])]) if own else begin
        length = ends[at + 1] - ends[at]
        stops = np.concatenate([[0], np.cumsum(length)])
        ids = piece_ids[np.repeat(ends[at] - stops[:-1], length) + np.arange(stops[-1])]
        sums = np.concatenate([[0], np.cumsum(score[at])])
        scores = sums[begin[1:]] - sums[begin[:-1]]
        gaps = gap[at]
        chunk_of = list(known) if n > 1 else []
        ways: dict[str, list] = {}
        ranked = []
        for t in range(len(texts)):
            a, b = begin[t], begin[t + 1]
            top = np.arange(a, b)
            if b - a > n - 1:
                top = a + np.argpartition(gaps[a:b], n - 2)[: n - 1] if n > 1 else top[:0]
            ranked.append(self._combine(float(scores[t]), [(int(stops[c] - stops[a]), int(length[c]), chunk_of[at[c]]) for c in top if gaps[c] < np.inf], n, ways))
        return ids, stops[begin[1:]] - stops[begin[:-1]], scores, ranked

    def _combine(self, score: float, places: list[tuple[int, int, str]], n: int, known: dict[str, list]) -> list[tuple[float, list]]:
        """The n best texts from each place's n best chunks: at most n - 1 chunks can differ from the best. `known` keeps the latter."""
        for _, _, chunk in places:
            if chunk not in known:
                known[chunk] = self.nbest(chunk, n)
        ways = [known[chunk] for _, _, chunk in places]
        out = [(0.0, ())]
        for p, way in enumerate(ways):
            out = heapq.nsmallest(n, ((loss + way[0][0] - s, (*picks, (p, k)) if k else picks) for loss, picks in out for k, (s, _) in enumerate(way)), key=lambda x: x[0])
        return [(score - loss, [(*places[p][:2], list(ways[p][k][1])) for p, k in picks]) for loss, picks in out]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of flat ids; the first space of each goes."""
        width = self.width[ids]
        stops = np.concatenate([[0], np.cumsum(width)])
        raw = self.raw[np.repeat(self.at[ids] - stops[:-1], width) + np.arange(stops[-1])]
        ends = stops[np.concatenate([[0], np.cumsum(counts)])]
        begins = ends[:-1] + (np.diff(ends) > 0)  # the space put before the text
        keep = np.ones(len(raw), bool)
        keep[ends[:-1][np.diff(ends) > 0]] = False
        offsets = np.concatenate([[0], np.cumsum(ends[1:] - begins)])
        return pa.Array.from_buffers(pa.large_string(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[keep])])


def coder(path: str) -> PieceCoder:
    """The worker's coder for a model file; it goes with the task."""
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]


def _free() -> None:
    """At a task's end the coder goes, as the worker may serve another stage next."""
    _coders.clear()
    give_back()


_CHANGES = pa.list_(pa.struct([("score", pa.float64()), ("changes", pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int32()))])))]))


def encode(docs: DataFrame, model: str, n: int = 4, back: bool = False) -> DataFrame:
    """The `n` best segmentations of the texts of `docs` (doc_id, text, ...).

    Returns doc_id, ids (array<int>, the best), ids_crc32 (of them as little-endian unsigned 32-bit
    integers), score, and nbest: array<struct<score, changes>>,
    best first, where changes say which ids of the best to replace: from place `at`, `n` ids
    give way to `ids`. With `back` also text, decoded from the ids in the same pass.
    Fewer segmentations than n: all of them. Null and empty texts have
    no ids, score 0 and the empty segmentation alone. Rows pass one by one: repeats and null
    doc_ids come out as they are. Other columns are left out. Empty input: empty output.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(model)
        for batch in sliced(batches, "text", 2 << 20):
            ids, counts, scores, ranked = tool.encode(batch.column("text"), n)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))
            best = pa.array([[{"score": s, "changes": [{"at": a, "n": k, "ids": i} for a, k, i in c]} for s, c in r] for r in ranked], _CHANGES)
            stops = np.cumsum(counts)
            crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(stops - counts, stops, strict=True)]
            made = {"doc_id": batch.column("doc_id"), "ids": lists, "ids_crc32": pa.array(crc, pa.int64()), "score": pa.array(scores), "nbest": best}
            if back:
                made["text"] = tool.decode(ids.astype(np.int64), counts).cast(pa.string())
            yield pa.RecordBatch.from_pydict(made)
        _free()

    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(emit, f"doc_id {kind}, ids array<int>, ids_crc32 long, score double, nbest array<struct<score:double,changes:array<struct<at:long,n:long,ids:array<int>>>>>{', text string' if back else ''}")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The texts of `encoded` (ids array<int>, ...) as column text; all other columns pass. Null ids: empty text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(model)
        for batch in batches:
            lists = batch.column("__ids")
            for a in range(0, len(lists), 500):
                part = lists.slice(a, 500)
                texts = tool.decode(part.flatten().to_numpy(zero_copy_only=False).astype(np.int64), pc.list_value_length(part).to_numpy().astype(np.int64))
                kept = [i for i, x in enumerate(batch.schema.names) if x != "__ids"]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, 500) for i in kept), texts.cast(pa.string())], names=[*(batch.schema.names[i] for i in kept), "text"])
        _free()

    rows = encoded.drop("text")
    return rows.withColumn("__ids", F.coalesce("ids", F.array().cast("array<int>"))).mapInArrow(emit, ", ".join(f"`{c}` {t}" for c, t in [*rows.dtypes, ("text", "string")]))


def token_rows(docs: DataFrame, model: str, n: int = 4) -> DataFrame:
    """Encode and decode `docs`: doc_id, n_pieces, score, nbest_scores, ids_crc32 and decoded_sha256."""
    return encode(docs, model, n, back=True).select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "score", F.col("nbest.score").alias("nbest_scores"), "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


def query(spark, sf_dir):
    import public_tokenizers

    return token_rows(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
