"""Substring dedup against a table of all windows."""

import random

import numpy as np
import pyarrow as pa

from scenetable.llm import suffix_dedup as S


def brute(docs):
    least = {}
    texts = [(d, (t or "").encode()) for d, t in docs]
    for d, b in texts:
        for i in range(len(b) - 49):
            w = b[i : i + 50]
            if d is not None and least.get(w, d) >= d:
                least[w] = d
    out = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if d is not None and least[b[i : i + 50]] < d:
                gone[i : i + 50] = True
        spans = int(np.diff(np.concatenate([[False], gone]).astype(int)).clip(0).sum())
        out.append((-1 if d is None else d, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out)


def got(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


def test_suffix_order_and_classes():
    rng = np.random.default_rng(2)
    for alphabet, n in ((2, 3000), (1, 700), (256, 2000)):
        text = rng.integers(0, alphabet, n).astype(np.uint8)
        text[n // 2 : n // 2 + 300] = text[:300]
        at = np.flatnonzero(rng.random(n - 50) < 0.8)
        order, classes = S.equal_windows(text, at)
        assert sorted(order) == at.tolist()
        windows = [text[i : i + 50].tobytes() for i in order]
        assert windows == sorted(windows)
        assert [a == b for a, b in zip(windows, windows[1:])] == (classes[1:] == classes[:-1]).tolist()


def test_planted_copies(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abé ü\n") for _ in range(rng.randint(1, 9)))
    passages = ["".join(word() for _ in range(40)) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = ["".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : a + rng.randint(20, 200)], word()]
        docs.append((i * 7 % 61, "".join(parts)))
    docs += [(100, None), (101, ""), (102, "a" * 5000), (103, "a" * 49 + "b" + "a" * 51), (104, docs[3][1]), (104, docs[3][1]), (None, docs[3][1]), (105, "\0" * 120), (106, "x" + "\0" * 70)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS n")
    small = S.BLOCK_BYTES
    try:
        S.BLOCK_BYTES = 700
        assert got(S.dedup_substrings(df)) == brute(docs)
    finally:
        S.BLOCK_BYTES = small
    assert got(S.dedup_substrings(df)) == brute(docs)
    assert S.dedup_substrings(df.limit(0)).count() == 0


def test_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert got(S.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_memory_of_a_range_does_not_grow_with_what_recurs(spark, monkeypatch):
    """Equal runs of many blocks are one in the suffix array, and a range is searched by parts."""
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    docs = [(i, base[rng.randint(0, 40) : 5900 + rng.randint(0, 90)] + f"{i:05}" + base[3000 + i : 3600]) for i in range(30)] + [(7, base), (-1, base[2000:2300])]
    seen, plain = [], S.equal_windows
    monkeypatch.setattr(S, "equal_windows", lambda text, at: seen.append(len(text)) or plain(text, at))
    monkeypatch.setattr(S, "BLOCK_BYTES", 7000)
    monkeypatch.setattr(S, "PART_BYTES", 4000)
    texts = {d: np.frombuffer(t.encode(), np.uint8) for d, t in docs}
    rows, block = [], 0
    for d, t in texts.items():
        block += 1
        runs = S.Runs(t, np.array([len(t)]))
        every = np.arange(len(runs.begin))
        rows.append((0, block, S._pack(runs, every, np.full(len(every), d), t)))
    sent = pa.table({"range": pa.array([r[0] for r in rows], pa.int32()), "block": [r[1] for r in rows], "blob": pa.array([r[2] for r in rows], pa.binary())})
    got_spans = {(b, p + k) for b, raw in zip(*S._removable(sent).to_pydict().values(), strict=True) for p, n in np.frombuffer(raw, "<u4").reshape(2, -1).T.tolist() for k in range(n)}
    least, want = {}, set()
    for d, t in sorted(texts.items()):
        for i in range(len(t) - 49):
            least.setdefault(t[i : i + 50].tobytes(), d)
    for k, (d, t) in enumerate(texts.items()):
        want |= {(k + 1, i) for i in range(len(t) - 49) if least[t[i : i + 50].tobytes()] < d}
    assert got_spans == want
    sent_bytes = sum(int((S.Runs(t, np.array([len(t)])).count + 49).sum()) for t in texts.values())
    assert max(seen) < sent_bytes / 20
    monkeypatch.setattr(S, "BUCKET_BYTES", 20_000)
    assert got(S.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)
