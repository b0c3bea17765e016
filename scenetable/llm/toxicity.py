"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

The inputs of a step are a word's embedding and the greatest value, in each dimension, of the embeddings of all
character runs in it, so unseen words that hold a seen stem anywhere are read too. A long word takes a step for
each piece of it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shingles
from .common import give_back, sliced, staged, table
from .shingles import Words, mix

#: Words of a window, and how far the next window begins: every word is in two windows. A long word counts by its pieces.
WINDOW, STRIDE = 32, 16
#: Hidden units of each direction; embedding sizes; hash buckets of words and character runs.
HIDDEN, WORD_DIMS, CHAR_DIMS, BUCKETS = 8, 6, 6, 1 << 18
#: Lengths of the character runs, which begin at every character of a word.
RUNS = (2, 3, 4, 5, 6, 7, 8)
#: Characters of a word that a step takes the runs of; distinct pieces, sample texts, and bytes of texts to score, read at a time.
PIECE, READ_PIECES, READ_TEXTS, READ_BYTES = 16, 1 << 14, 32, 1 << 19
#: The bounded sample that labels are learned from: rows of each label, their longest text, and the characters of all of a label.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS, TRAIN_ALL_CHARS = 1200, 2000, 20_000, 3_500_000
#: Share of words whose own embedding is held back in training.
UNSEEN = 0.3
#: Sample documents that a bucket must be in to have an embedding.
FREQUENT = 4


@dataclass
class Pieces:
    """The pieces of a batch's words, PIECE characters each, and the character runs that begin in them.

    bucket: the word's bucket, for each distinct piece; place: each piece's place among the
    distinct ones; begin: each text's first piece, and the end of all. A run may end in a later
    piece of its word.
    """

    bucket: np.ndarray
    place: np.ndarray
    begin: np.ndarray
    _key: np.ndarray  # names each distinct piece
    _first: np.ndarray  # characters of each distinct piece's beginning and of its word's end
    _stop: np.ndarray
    _bytes: np.ndarray  # bytes at which characters begin, counted from the batch's first
    _sums: np.ndarray  # hash sums of all bytes before each character

    @classmethod
    def of(cls, words: Words) -> Pieces:
        chars = np.append(np.flatnonzero((words.data & 0xC0) != 0x80).astype(np.int32), np.int32(len(words.data)))
        first, stop = np.searchsorted(chars, words.start), np.searchsorted(chars, words.stop)
        count = -(-(stop - first) // PIECE)
        at = np.concatenate([[0], np.cumsum(count)])
        nth = np.arange(at[-1]) - np.repeat(at[:-1], count)
        keys = np.repeat(words.hashes, count)
        keys[nth > 0] = mix(keys[nth > 0] + nth[nth > 0].astype(np.uint64))
        keys, some, place = np.unique(keys, return_index=True, return_inverse=True)
        bucket = (np.repeat(words.hashes, count)[some] & np.uint64(BUCKETS - 1)).astype(np.int64)
        spread = shingles._VALUES[words.data]
        spread *= shingles._powers[: len(spread)]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(spread)])[chars]
        return cls(bucket, place.reshape(-1), at[words.begin], keys, (np.repeat(first, count) + PIECE * nth)[some], np.repeat(stop, count)[some], chars, sums)

    def taken(self, at: np.ndarray) -> Pieces:
        """The pieces at `at`, in that order, as those of one text; only the characters of their runs are held."""
        held, place = np.unique(self.place[at], return_inverse=True)
        first = self._first[held]
        size = np.minimum(self._stop[held] - first, PIECE + max(RUNS) - 1) + 1
        begin = np.cumsum(size) - size
        chars = np.arange(size.sum()) + np.repeat(first - begin, size)
        return Pieces(self.bucket[held], place.reshape(-1), np.array([0, len(at)]), self._key[held], begin, begin + size - 1, self._bytes[chars], self._sums[chars])

    @classmethod
    def joined(cls, parts: list[Pieces]) -> Pieces:
        """The pieces of consecutive batches as those of one batch."""
        chars = np.cumsum([0, *(len(p._bytes) for p in parts)])
        held = np.cumsum([0, *(len(p._key) for p in parts)])
        begin = np.cumsum([0, *(p.begin[-1] for p in parts)])
        key, some, again = np.unique(np.concatenate([p._key for p in parts]), return_index=True, return_inverse=True)
        place = again.reshape(-1)[np.concatenate([p.place + h for p, h in zip(parts, held, strict=False)])]
        first, stop = (np.concatenate([getattr(p, name) + c for p, c in zip(parts, chars, strict=False)])[some] for name in ("_first", "_stop"))
        shingles._grow(1 + max(int(p._bytes.max(initial=0)) for p in parts))
        texts = np.concatenate([[0], *(p.begin[1:] + b for p, b in zip(parts, begin, strict=False))])
        return cls(np.concatenate([p.bucket for p in parts])[some], place, texts, key, first, stop, np.concatenate([p._bytes for p in parts]), np.concatenate([p._sums for p in parts]))

    def runs(self, which: np.ndarray | slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length of RUNS: the place in `which` of each run's piece, ascending, and the runs' buckets."""
        first, stop = self._first[which], self._stop[which]
        for n in RUNS:
            count = np.clip(stop - first - (n - 1), 0, PIECE)
            own = np.repeat(np.arange(len(first)), count)
            at = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            h = mix((self._sums[at + n] - self._sums[at]) * shingles._inverses[self._bytes[at]] + np.uint64(n))
            yield own, (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def windows(begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows over texts whose words begin at `begin`: the first word of each, and where each text's windows begin."""
    n = np.diff(begin)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    at = np.concatenate([[0], np.cumsum(count)])
    return np.repeat(begin[:-1], count) + STRIDE * (np.arange(at[-1]) - np.repeat(at[:-1], count)), at


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Parameters and passes. All arrays are float32."""

    p: dict[str, np.ndarray] = field(default_factory=dict)
    scale: tuple[float, float] = (1.0, 0.0)

    def __getstate__(self) -> tuple:
        """What is pickled: of the embeddings only the rows that are not all zero, so that little passes through the driver."""
        held = {k: np.flatnonzero(self.p[k].any(axis=1)).astype(np.int32) for k in ("word", "char") if k in self.p}
        return {k: v[held[k]] if k in held else v for k, v in self.p.items()}, held, self.scale

    def __setstate__(self, state: tuple) -> None:
        self.p, held, self.scale = dict(state[0]), *state[1:]
        for k, at in held.items():
            self.p[k], rows = np.zeros((BUCKETS, self.p[k].shape[1]), self.p[k].dtype), self.p[k]
            self.p[k][at] = rows

    @classmethod
    def fresh(cls, word_odds: np.ndarray, run_odds: np.ndarray, seed: int = 11) -> Network:
        """The first dimension of each embedding starts at the shrunken log odds of its bucket in the sample."""
        rng = np.random.default_rng(seed)
        new = lambda *s, by=0.3: (rng.standard_normal(s) * by).astype(np.float32)
        d, h = WORD_DIMS + CHAR_DIMS, HIDDEN
        p = {"word": new(BUCKETS, WORD_DIMS, by=0.05), "char": new(BUCKETS, CHAR_DIMS, by=0.05)}
        p["word"][:, 0], p["char"][:, 0] = word_odds, run_odds
        for way in "fb":
            p |= {f"W{way}": new(d, 3 * h), f"U{way}": new(h, 3 * h), f"c{way}": np.zeros(3 * h, np.float32)}
        p |= {"v": new(2 * h), "w": new(2 * h), "b": np.zeros(1, np.float32)}
        return cls(p)

    def strongest(self, count: int, runs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For each of `count` pieces the greatest value of its runs' embeddings in each dimension; without runs 0."""
        best = np.full((count, CHAR_DIMS), -np.inf, self.p["char"].dtype)
        for own, buckets in runs:
            if len(own):
                heads = np.flatnonzero(np.diff(own, prepend=-1))
                top = np.maximum.reduceat(self.p["char"][buckets], heads, axis=0)
                best[own[heads]] = np.maximum(best[own[heads]], top)
        best[np.isneginf(best)] = 0
        return best

    def winners(self, best: np.ndarray, runs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The bucket that has the greatest value in each dimension, or -1."""
        held = np.full(best.shape, -1)
        for own, buckets in runs:
            r, d = np.nonzero(self.p["char"][buckets] == best[own])
            held[own[r], d] = buckets[r]
        return held

    def inputs(self, bucket: np.ndarray, runs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return np.concatenate([self.p["word"][bucket], self.strongest(len(bucket), runs)], axis=1)

    def vectors(self, pieces: Pieces) -> np.ndarray:
        """The inputs of all distinct pieces of a batch."""
        parts = [slice(a, a + READ_PIECES) for a in range(0, len(pieces.bucket), READ_PIECES)]
        none = np.zeros((0, WORD_DIMS + CHAR_DIMS), np.float32)
        return np.concatenate([none, *(self.inputs(pieces.bucket[x], pieces.runs(x)) for x in parts)])

    def _pass(self, gates: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """One direction over (steps, windows, 3 h) projected inputs: the states of all steps."""
        t, n, h = *gates.shape[:2], HIDDEN
        state, out, u = np.zeros((n, h), np.float32), np.empty((t, n, h), np.float32), self.p[f"U{way}"]
        for s in range(t) if way == "f" else range(t - 1, -1, -1):
            past = state @ u
            rz = 1 / (1 + np.exp(-(gates[s, :, : 2 * h] + past[:, : 2 * h])))
            r, z = rz[:, :h], rz[:, h:]
            new = np.tanh(gates[s, :, 2 * h :] + r * past[:, 2 * h :])
            if keep is not None:
                keep.append((s, state, r, z, new, past[:, 2 * h :]))
            state = np.where(mask[s, :, None], new + z * (state - new), state)
            out[s] = state
        return out

    def _pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        energy = np.where(mask, states @ self.p["v"], -30)
        share = np.exp(energy - energy.max(axis=0)) * mask
        share /= np.maximum(share.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnk->nk", share, states)
        return pooled @ self.p["w"] + self.p["b"], share, pooled

    def logits(self, vectors: np.ndarray, place: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 1024) -> np.ndarray:
        """The logit of every window: words place[start : start + WINDOW], cut at the text's end.

        Features come first in all arrays, so that every operation runs over whole rows;
        each step leaves only its attention energy and its share of the logit.
        """
        p, h = self.p, HIDDEN
        out = np.full(len(starts), p["b"][0], np.float32)
        if not len(vectors):
            return out
        place = np.concatenate([place, np.zeros(WINDOW, place.dtype)])
        gates = {way: np.ascontiguousarray((vectors @ p[f"W{way}"] + p[f"c{way}"]).T) for way in "fb"}
        for a in range(0, len(starts), most):
            at = starts[a : a + most] + np.arange(WINDOW)[:, None]
            mask = at < ends[a : a + most]
            words = place[at]
            energy, part = np.zeros(mask.shape, np.float32), np.zeros(mask.shape, np.float32)
            for way, first in (("f", 0), ("b", h)):
                u, read = np.ascontiguousarray(p[f"U{way}"].T), np.stack([p["v"][first : first + h], p["w"][first : first + h]])
                state = np.zeros((h, mask.shape[1]), np.float32)
                for s in range(WINDOW) if way == "f" else range(WINDOW - 1, -1, -1):
                    g = gates[way].take(words[s], axis=1)
                    past = u @ state
                    rz = g[: 2 * h]
                    rz += past[: 2 * h]
                    np.negative(rz, out=rz)
                    np.exp(rz, out=rz)
                    rz += 1
                    np.reciprocal(rz, out=rz)
                    new = past[2 * h :]
                    new *= rz[:h]
                    new += g[2 * h :]
                    np.tanh(new, out=new)
                    moved = state - new
                    moved *= rz[h:]
                    moved += new
                    state = moved if mask[s].all() else np.where(mask[s], moved, state)
                    e, q = read @ state
                    energy[s] += e
                    part[s] += q
            energy[~mask] = -30
            share = np.exp(energy - energy.max(axis=0)) * mask
            out[a : a + most] += (share * part).sum(axis=0) / np.maximum(share.sum(axis=0), 1e-9)
        return out

    def top(self, pieces: Pieces) -> np.ndarray:
        """The largest logit of each text's windows."""
        starts, at = windows(pieces.begin)
        ends = np.repeat(pieces.begin[1:], np.diff(at))
        return np.maximum.reduceat(self.logits(self.vectors(pieces), pieces.place, starts, ends), at[:-1])

    def backward(self, x, mask, y, weight):
        """Loss gradients for windows of (steps, n) inputs."""
        p, h = self.p, HIDDEN
        t, n = mask.shape
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._pass(x @ p[f"W{way}"] + p[f"c{way}"], mask, way, kept[way]) for way in "fb"], axis=2)
        logit, share, pooled = self._pool(states, mask)
        g: dict[str, np.ndarray] = {}
        dl = ((_sigmoid(logit) - y) * weight / n).astype(np.float32)
        g["w"], g["b"] = pooled.T @ dl, dl.sum(keepdims=True)
        dp = dl[:, None] * p["w"]
        part = np.einsum("nk,tnk->tn", dp, states)
        de = share * (part - (share * part).sum(axis=0))
        g["v"] = np.einsum("tn,tnk->k", de, states)
        ds = share[:, :, None] * dp + de[:, :, None] * p["v"]
        dx = np.zeros_like(x)
        for way, at in (("f", 0), ("b", h)):
            gu, gates, carry = np.zeros_like(p[f"U{way}"]), np.zeros((t, n, 3 * h), np.float32), np.zeros((n, h), np.float32)
            for s, old, r, z, new, past in reversed(kept[way]):
                d = ds[s, :, at : at + h] + carry
                live = np.where(mask[s, :, None], d, 0)
                dn = live * (1 - z) * (1 - new * new)
                dz = live * (old - new) * z * (1 - z)
                dr = dn * past * r * (1 - r)
                through = np.concatenate([dr, dz, dn * r], axis=1)
                gu += old.T @ through
                gates[s] = np.concatenate([dr, dz, dn], axis=1)
                carry = through @ p[f"U{way}"].T + live * z + np.where(mask[s, :, None], 0, d)
            flat = gates.reshape(-1, 3 * h)
            g[f"U{way}"], g[f"W{way}"], g[f"c{way}"] = gu, x.reshape(t * n, -1).T @ flat, flat.sum(axis=0)
            dx += (flat @ p[f"W{way}"].T).reshape(x.shape)
        return g, dx

    def step(self, g: dict, moments: dict, rate: float, i: int) -> None:
        for k, grad in g.items():
            m, v = moments.setdefault(k, (np.zeros_like(grad), np.zeros_like(grad)))
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            self.p[k] -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-6)


def _odds(seen: Iterable[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of toxic among the documents that hold a bucket, shrunk to the mean by four documents.

    `seen` has arrays of buckets and of the documents that hold them. Buckets of fewer than
    FREQUENT documents say more about the sample than about words: they get 0.
    """
    rate = float(np.clip(y.mean(), 0.01, 0.99))
    pos, neg = np.full(BUCKETS, 4 * rate), np.full(BUCKETS, 4 * (1 - rate))
    for buckets, docs in seen:
        pairs = np.unique(buckets << 31 | docs)
        held, toxic = pairs >> 31, y[pairs & ((1 << 31) - 1)]
        pos += np.bincount(held, weights=toxic, minlength=BUCKETS)
        neg += np.bincount(held, weights=1 - toxic, minlength=BUCKETS)
    often = pos + neg - 4 >= FREQUENT
    return np.where(often, np.log(pos / neg) - np.log(rate / (1 - rate)), 0).astype(np.float32), often


def _read(texts: list[str]) -> Iterator[tuple[int, Pieces]]:
    """The number of the first text and the pieces of a few texts at a time.

    Pieces take some twenty bytes a character, so a pass reads the sample again and holds few of them.
    """
    for a in range(0, len(texts), READ_TEXTS):
        yield a, Pieces.of(Words(pa.array(texts[a : a + READ_TEXTS], pa.string())))


def _words_held(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of words and the documents that hold them, for a few documents at a time."""
    for first, pieces in _read(texts):
        yield pieces.bucket[pieces.place], first + np.repeat(np.arange(len(pieces.begin) - 1), np.diff(pieces.begin))


def _runs_held(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of runs and the documents that hold them, for a few documents at a time."""
    for first, pieces in _read(texts):
        part = pieces.begin[1:] // (READ_PIECES // 4)
        cuts = np.concatenate([np.flatnonzero(np.diff(part, prepend=-1)), [len(part)]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = pieces.place[pieces.begin[a] : pieces.begin[b]].astype(np.int64)
            pairs = np.unique(own << 31 | np.repeat(np.arange(a, b), np.diff(pieces.begin[a : b + 1])))
            runs = list(pieces.runs(pairs >> 31))
            docs = first + (pairs & ((1 << 31) - 1))
            yield np.concatenate([r for _, r in runs]), np.concatenate([docs[o] for o, _ in runs])


def _untrained() -> Network:
    """Nothing known: every text alike, and none toxic."""
    net = Network.fresh(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32))
    net.scale = (0.0, -5.0)
    return net


def train(texts: list[str], labels: list[int], prior: float, epochs: int = 4, least_steps: int = 320, seed: int = 5) -> Network:
    """A network from labelled texts; `prior` is the share of toxic ones among all labelled rows.

    A label holds for some window of a text. The windows of highest summed log odds, two a
    text and one at random from clean ones, are what the network learns from; a logistic
    curve then maps the largest logit of a text to its probability.
    """
    if not len(texts):
        return _untrained()
    y = np.array(labels, np.float32)
    (word_odds, word_often), (run_odds, run_often) = _odds(_words_held(texts), y), _odds(_runs_held(texts), y)
    net = Network.fresh(word_odds, run_odds)
    net.p["word"][~word_often], net.p["char"][~run_often] = 0, 0
    rng = np.random.default_rng(seed)
    kept, masks, truth = [], [], []
    total = np.zeros(1, np.float32)
    for first, pieces in _read(texts):
        starts, at = windows(pieces.begin)
        ends = np.repeat(pieces.begin[1:], np.diff(at))
        odds = net.vectors(pieces)[:, [0, WORD_DIMS]].sum(axis=1)
        sums = np.cumsum(np.concatenate([total, np.maximum(odds[pieces.place], 0)]))
        total, sums = sums[-1:], sums.astype(float)
        heat = sums[np.minimum(starts + WINDOW, ends)] - sums[np.minimum(starts, ends)]
        chosen = []
        for d in range(len(at) - 1):
            own = np.arange(at[d], at[d + 1])
            hot = own[np.argsort(-heat[own], kind="stable")[:2]]
            extra = rng.choice(own, 1) if not y[first + d] else own[:0]
            chosen += [*hot, *extra]
            truth += [y[first + d]] * (len(hot) + len(extra))
        where = starts[chosen] + np.arange(WINDOW)[:, None]
        masks.append(where < ends[chosen])
        kept.append(pieces.taken(where.T[masks[-1].T]))
    pieces = Pieces.joined(kept)
    del kept
    if not len(pieces.bucket):
        return _untrained()
    inside, truth = np.concatenate(masks, axis=1), np.array(truth, np.float32)
    place = np.zeros(inside.shape, np.int64)  # of each window's words
    place.T[inside.T] = pieces.place
    weight = np.where(truth > 0, len(truth) / max(1.0, 2 * truth.sum()), len(truth) / max(1.0, 2 * (1 - truth).sum())).astype(np.float32)
    moments: dict = {}
    blank = int(np.flatnonzero(~word_often)[0])  # a bucket without a meaning
    i, batches = 0, -(-len(truth) // 128)
    rounds = max(epochs, -(-least_steps // batches))  # small samples are gone through more often
    for _ in range(rounds):
        order = rng.permutation(len(truth))
        for a in range(0, len(order), 128):
            some = order[a : a + 128]
            mask, w = inside[:, some], place[:, some]
            read, again = np.unique(w, return_inverse=True)
            runs = list(pieces.runs(read))
            again = again.reshape(w.shape)
            chars = net.strongest(len(read), runs)
            held = net.winners(chars, runs)
            own = np.where(rng.random(w.shape) < UNSEEN, blank, pieces.bucket[w])  # so that runs are learned without the words too
            x = np.concatenate([net.p["word"][own], chars[again]], axis=2)
            g, dx = net.backward(x, mask, truth[some], weight[some])
            i += 1
            left = max(0.1, 1 - i / (rounds * batches))
            net.step(g, moments, 0.01 * left, i)
            rate = np.float32(0.5 * left)
            flat = dx.reshape(-1, dx.shape[2])
            np.add.at(net.p["word"], own.ravel(), -rate * flat[:, :WORD_DIMS])
            own = held[again.ravel()]
            told = own.min(axis=1) >= 0
            np.add.at(net.p["char"], (own[told], np.arange(CHAR_DIMS)), -rate * flat[told, WORD_DIMS:])
            net.p["word"][~word_often], net.p["char"][~run_often] = 0, 0  # rare ones stay without a meaning
    top = np.concatenate([net.top(pieces) for _, pieces in _read(texts)])
    net.scale = _logistic(top.astype(float), y.astype(float), prior)
    return net


def _logistic(x: np.ndarray, y: np.ndarray, prior: float, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of P(toxic | x), each label weighed to its share among all rows (Newton's method)."""
    w = np.where(y > 0, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    y = np.where(y > 0, 1 - 1 / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        q = _sigmoid(a * x + b)
        e, s = w * (q - y), w * q * (1 - q)
        h = np.array([[(s * x * x).sum() + 1e-3, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-3]])
        d = np.linalg.solve(h, [(e * x).sum(), e.sum()])
        d *= min(1, 2 / max(1e-9, np.abs(d).max()))
        a, b = a - d[0], b - d[1]
    return float(max(a, 0.05)), float(b)


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame | None, float]:
    """Rows (doc_id, text, toxic) to learn from, and the share of toxic among all labelled rows that are open to learning.

    Open are rows whose crc32(doc_id as text) mod 4 is not 2. Only ids and lengths are joined to
    the labels. Of each label the first rows by a hash of doc_id are chosen: TRAIN_TOXIC and
    TRAIN_CLEAN at most, of up to TRAIN_CHARS characters each and TRAIN_ALL_CHARS together;
    their texts are then picked out by their ids, which a broadcast join holds, not the plan. A doc_id with both labels is toxic; of
    texts repeated under a doc_id the shortest counts. None if a label has no rows.
    """
    open_ = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    known = labels.where(open_ & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    text = F.struct(F.char_length("text").alias("n"), F.xxhash64("text").alias("tx")).alias("t")
    rows = staged(docs.where(open_ & F.col("text").isNotNull()).select("doc_id", text).groupBy("doc_id").agg(F.min("t").alias("t")).select("doc_id", "t.n", "t.tx").join(known, "doc_id"))
    first = [F.xxhash64("doc_id"), F.col("doc_id")]
    small = [rows.where((F.col("n") <= TRAIN_CHARS) & (F.col("toxic") == y)).orderBy(*first).limit(most) for y, most in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN))]
    # The window has a bounded number of rows: the limits come first.
    chars = F.sum("n").over(Window.partitionBy("toxic").orderBy(*first))
    chosen = staged(small[0].unionByName(small[1]).withColumn("chars", chars).where(F.col("chars") <= TRAIN_ALL_CHARS).select("doc_id", "tx", "toxic"))
    if chosen.agg(F.count_distinct("toxic")).first()[0] < 2:
        return None, 0.0
    n, toxic = rows.agg(F.count("*"), F.sum("toxic")).first()
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.xxhash64("text") == F.col("tx"))
    return picked.dropDuplicates(["doc_id"]).select("doc_id", "text", "toxic"), toxic / n


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """A network from the sample, trained in one task, which holds the bounded sample and nothing else.

    Without labels of both kinds it is untrained and gives every text the same score.
    """
    rows, prior = training_sample(docs, labels)
    if rows is None:
        return train([], [], 0.0)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r["doc_id"])
        net = train([r["text"] for r in held], [r["toxic"] for r in held], prior)
        shingles.shrink()
        del held
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], names=["net"])

    return pickle.loads(rows.repartition(1).mapInArrow(learn, "net binary").first()["net"])


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """`docs` (text, ...) with `score`, the probability of the most toxic window; all other columns pass.

    Every window of the whole text is scored. Null, empty and blank texts are one window without
    words. A column named score in the input is replaced. Empty input: empty output.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", READ_BYTES):
            pieces = Pieces.of(Words(pc.fill_null(batch.column("text"), "")))
            a, b = net.scale
            score = _sigmoid(a * net.top(pieces).astype(float) + b)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])
        give_back()

    rows = docs.drop("score")
    return rows.mapInArrow(emit, ", ".join(f"`{c}` {t}" for c, t in [*rows.dtypes, ("score", "double")]))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    net = fit(docs, table(spark, sf_dir, "labels"))
    out = scored(docs.select("doc_id", "text"), net)
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
