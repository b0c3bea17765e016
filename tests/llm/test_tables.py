"""Searches, line dedup, token files and toxicity against plain restatements."""

import math
import pickle
import time
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scenetable.llm import line_dedup, token_files, toxicity, vp_search

SF = "/root/testdata/sf0.001"


def nearest(rows, asked, k):
    good = {i: v for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = set()
    for q in asked:
        if q in good:
            s = sorted((-sum(float(a) * float(b) for a, b in zip(good[q], v, strict=True)), i) for i, v in good.items() if i != q)
            out |= {(q, r + 1, i) for r, (_, i) in enumerate(s[:k])}
    return out


def test_exact_search_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(600)]
    rows += [(600 + i, rows[5][1]) for i in range(90)] + [(700, None), (701, [0.0] * 8), (702, [math.nan] * 8), (703, [None] * 8), (704, [math.inf] * 8), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("query_id", F.lit(1))
    got = vp_search.nearest(df, df.where("vec_id % 20 = 0"), 20, 1.0, shard_rows=150, block_queries=9)
    assert {(r.query_id, r["rank"], r.vec_id) for r in got.collect()} == nearest(rows, range(0, 705, 20), 20)
    assert vp_search.nearest(df.limit(0), df, 3).count() == 0
    few = df.where("vec_id < 3")
    assert vp_search.nearest(few, few, 20).count() == 6


def test_distinct_vectors_of_equal_score(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [1.0, float(x), float(y)]) for i, (x, y) in enumerate(rng.normal(size=(300, 2)))] + [(1000, [3.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for relax, shard in ((1.0, 10_000), (1.0, 70)):
        got = vp_search.nearest(df, df.where("vec_id = 1000"), 20, relax, shard_rows=shard).orderBy("rank").collect()
        assert [r.vec_id for r in got] == list(range(20)) and {r.score for r in got} == {3.0}


@pytest.mark.parametrize("norm", [30.0, 1e6])
def test_vectors_of_very_unlike_length(spark, norm):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[7] *= norm
    x[1000:] *= np.exp(rng.normal(size=(1000, 1)) * 0.6)
    rows = [(i, [float(v) for v in own]) for i, own in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = nearest(rows, range(0, 2000, 40), 20)
    for relax, least in ((1.0, 1.0), (vp_search.RELAX, 0.95)):
        got = vp_search.nearest(df, df.where("vec_id % 40 = 0"), 20, relax, shard_rows=700).collect()
        assert len({(r.query_id, r["rank"], r.vec_id) for r in got} & want if relax == 1.0 else {(r.query_id, r.vec_id) for r in got} & {(q, v) for q, _, v in want}) >= least * len(want)


def test_near_ties_are_no_ties(spark):
    rows = [(i, [1.0, i * 1e-13 + 1.0, float(i % 7)]) for i in range(400)] + [(1000, [1.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vp_search.nearest(df, df.where("vec_id = 1000"), 20, 1.0).orderBy("rank").collect()
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == nearest(rows, [1000], 20)


def test_production_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r.query_id, r.vec_id) for r in vp_search.query(spark, "/root/testdata/sf0.1").collect()}
    held = [(r.vec_id, r.embedding) for r in rows.collect()]
    x = np.array([v for _, v in held], float)
    ids = np.array([i for i, _ in held])
    want = set()
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        want |= {(int(ids[i]), int(ids[j])) for j in np.lexsort((ids, -s))[:20]}
    assert len(got & want) / len(want) >= 0.95


def lines(docs):
    strip = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for d, t in docs:
        for k in {strip(x) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                held.setdefault(k, []).append(d)
    own = {k: max(d) for k, d in held.items() if len(d) >= 3}
    out = {}
    for d, t in docs:
        kept = [x for x in (t or "").split("\n") if d >= own.get(strip(x), d)]
        out[d] = ((t or "").count("\n") + 1, (t or "").count("\n") + 1 - len(kept), "\n".join(kept))
    return out


def test_line_dedup(spark):
    long = "This line has Over twenty signs"
    docs = [(i, f"own {i}\n  {long.upper()}\t\n\n{long} x") for i in range(5)] + [(8, None), (9, ""), (10, "\n\n"), (11, f"{long}\n{long}\n" + "y\n" * 5000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.dedup_lines(df).collect()}
    assert got == lines(docs)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_is_linear_in_a_documents_lines(spark):
    text = "\n".join(f"a line of its own, number {i % 8000}" for i in range(16_000))
    rows = [(i, text) for i in range(3)] + [(0, "another row\n" + text)]
    began = time.time()
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert time.time() - began < 20
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, len(r.text)) for r in got) == [(0, 16_000, 16_000, 0), (0, 16_001, 16_000, 11), (1, 16_000, 16_000, 0), (2, 16_000, 0, len(text))]


def test_line_dedup_counts_documents_not_rows(spark):
    long = "This line has Over twenty signs"
    rows = [(1, long), (1, long), (2, long), (None, long)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.n_dropped for r in got] == [0] * 4
    got = line_dedup.dedup_lines(spark.createDataFrame([*rows, (3, long)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 0)]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, tmp_path, encoding):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [None, "", " ", "a  b", "a b ", " é\n\n x", "plain words here", "x " * 30_000, "plain words here"]
    docs = spark.createDataFrame([(20 - i, t, "extra") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    token_files.write_tokens(docs, str(tmp_path / "t"), path, encoding=encoding)
    files = spark.read.parquet(str(tmp_path / "t"))
    tool = Tokenizer.from_file(path)
    want, start = {}, 0
    for i, t in sorted((20 - i, t or "") for i, t in enumerate(texts)):
        ids = [*tool.encode(t, add_special_tokens=False).ids, 2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.with_starts(token_files.token_digests(files), files).collect()}
    assert got == want
    token_files.write_tokens(docs.limit(0), str(tmp_path / "e"), path)


def test_toxicity_learns_and_handles_edges(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    rows = []
    for i in range(400):
        w = [word() for _ in range(int(rng.integers(1, 120)))]
        if i % 4 == 0:
            w.insert(int(rng.integers(0, len(w) + 1)), "zorqu" + word())
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (500, ""), (501, "word " * 50_000)], "doc_id long, text string").withColumn("score", F.lit("clash"))
    net = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.scored(docs, net).collect()}
    held = [(got[i] >= 0.3, bool(y)) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(a == b for a, b in held) / len(held) >= 0.9
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 403
    blind = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.scored(docs.limit(5), blind).select("score").distinct().count() == 1


def test_toxicity_sends_little_through_the_driver(spark):
    """The plan holds no list of ids, and of a network's embeddings only rows with a meaning are pickled."""
    rows = [(i, ("you vile idiot " if i % 3 == 0 else "a quiet morning ") * 5, int(i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    sample, prior = toxicity.training_sample(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    plan = sample._jdf.queryExecution().toString()
    assert " IN (" not in plan and "INSET" not in plan and "LocalTableScan" not in plan
    held = sorted(map(tuple, sample.collect()))
    net = toxicity.train([t for _, t, _ in held], [y for *_, y in held], prior)
    sent = pickle.dumps(net)
    back = pickle.loads(sent)
    assert len(sent) < 1 << 20 and back.scale == net.scale and all((back.p[k] == net.p[k]).all() for k in net.p)


def test_toxicity_holds_few_pieces():
    """Training and scoring take little memory beside the texts: neither holds the pieces of all of them at once."""
    rng = np.random.default_rng(8)
    words = np.array(["".join(rng.choice(list("abcdefgh"), int(n))) for n in rng.integers(1, 9, 20_000)])
    texts = [" ".join(rng.choice(words, 600)) + (" zorqu" if i % 2 else "") for i in range(1200)]
    net = toxicity.train(texts[:40], [i % 2 for i in range(40)], 0.5, epochs=1, least_steps=1)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    emit = {}
    docs = SimpleNamespace(drop=lambda _: docs, dtypes=[("text", "string")], mapInArrow=lambda f, _: emit.setdefault("it", f))
    toxicity.scored(docs, net)
    for work in (lambda: toxicity.train(texts, [i % 2 for i in range(len(texts))], 0.5, epochs=1, least_steps=1), lambda: sum(b.num_rows for b in emit["it"](iter([batch])))):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 90e6, peak


def test_toxicity_taken_pieces_have_the_same_runs():
    pieces = toxicity.Pieces.of(toxicity.Words(pa.array(["an idiot's word", "", "abcdefghijklmnopqrstuvwxyz" * 3 + " and é天x" * 9])))
    at = np.array([7, 1, 1, 0, 5, len(pieces.place) - 1])
    some = toxicity.Pieces.joined([pieces.taken(at[:4]), pieces.taken(at[:0]), pieces.taken(at[4:])])
    runs = lambda held, places: [[r[o == k].tolist() for k in range(len(places))] for o, r in held.runs(places)]
    assert (some.bucket[some.place] == pieces.bucket[pieces.place[at]]).all()
    assert runs(some, some.place) == runs(pieces, pieces.place[at])
    assert toxicity.train(["", " "], [0, 1], 0.5).scale == toxicity.train([], [], 0.0).scale


def test_toxicity_reads_whole_words(spark):
    rng = np.random.default_rng(4)
    word = lambda signs="abcdefgh", n=6: "".join(rng.choice(list(signs), n))
    texts, labels = [], []
    for i in range(600):
        signs = "abcdefgh" if i % 2 else "天地玄黄宇宙洪荒日月"
        w = [word(signs) for _ in range(int(rng.integers(5, 60)))]
        if i % 4 < 2:
            w.insert(int(rng.integers(0, len(w) + 1)), "zorqu" if i % 2 else "恶言毒语")
        texts.append((" " if i % 2 else "").join(w))
        labels.append(int(i % 4 < 2))
    net = toxicity.train(texts, labels, 0.5)
    ways = ["(zorqu", '"zorqu"', "x-zorqu", "ab" * 40 + "zorqu", *("恶言毒语".join((word("天地玄黄宇宙洪荒日月", n), word("天地玄黄宇宙洪荒日月", 30))) for n in (5, 14, 16, 90))]
    rows = []
    for way in ways:
        for _ in range(10):
            calm = " ".join(word() for _ in range(20)) if way.isascii() else ""
            rows += [(way, True, f"{calm} {way}"), (way, False, f"{calm} {way}".replace("zorqu", "hgfed").replace("恶言毒语", "天月地日"))]
    got = toxicity.scored(spark.createDataFrame(rows, "way string, bad boolean, text string"), net).groupBy("way").pivot("bad", [True, False]).avg("score").collect()
    assert len(got) == len(ways) and all(r["true"] >= 0.3 and r["true"] > r["false"] + 0.1 for r in got), got


def test_toxicity_runs_cover_every_character():
    text = "ab " + "é天x" * 30 + " (idiot"
    pieces = toxicity.Pieces.of(toxicity.Words(pa.array([text])))
    runs = list(pieces.runs(slice(None)))
    words = text.split()
    for n, (own, _) in zip(toxicity.RUNS, runs, strict=True):
        count = np.bincount(own, minlength=len(pieces.bucket))
        assert count[pieces.place].sum() == sum(max(0, len(w) - n + 1) for w in words)
    buckets = lambda rs: {b for _, r in rs for b in r.tolist()}
    assert buckets(toxicity.Pieces.of(toxicity.Words(pa.array(["idiot"]))).runs(slice(None))) <= buckets(runs)
    assert len(pieces.place) == sum(-(-len(w) // toxicity.PIECE) for w in words)


def test_strongest_and_winners_equal_a_loop():
    rng = np.random.default_rng(2)
    net = toxicity.Network.fresh(rng.normal(size=toxicity.BUCKETS).astype("f4"), rng.normal(size=toxicity.BUCKETS).astype("f4"))
    runs = [(np.sort(rng.integers(0, 9, 20)), rng.integers(0, 30, 20)) for _ in toxicity.RUNS]
    best = net.strongest(10, runs)
    held = net.winners(best, runs)
    for i in range(10):
        own = sorted({int(b) for o, r in runs for b in r[o == i]})
        want = net.p["char"][own].max(axis=0) if own else np.zeros(toxicity.CHAR_DIMS)
        assert (best[i] == want).all()
        assert all(net.p["char"][held[i, d], d] == want[d] for d in range(toxicity.CHAR_DIMS)) if own else (held[i] == -1).all()


def test_fast_logits_equal_the_trained_pass():
    rng = np.random.default_rng(6)
    net = toxicity.Network.fresh(rng.normal(size=toxicity.BUCKETS).astype("f4"), rng.normal(size=toxicity.BUCKETS).astype("f4"))
    texts = [" ".join("".join(rng.choice(list("abcdef"), 4)) for _ in range(k)) for k in (0, 1, 5, 32, 33, 100)]
    pieces = toxicity.Pieces.of(toxicity.Words(pa.array(texts)))
    starts, at = toxicity.windows(pieces.begin)
    ends = np.repeat(pieces.begin[1:], np.diff(at))
    vectors = net.vectors(pieces)
    fast = net.logits(vectors, pieces.place, starts, ends)
    where = starts + np.arange(toxicity.WINDOW)[:, None]
    mask = where < ends
    x = vectors[pieces.place[np.minimum(where, len(pieces.place) - 1)]]
    states = np.concatenate([net._pass(x @ net.p[f"W{s}"] + net.p[f"c{s}"], mask, s) for s in "fb"], axis=2)
    slow = net._pool(states, mask)[0]
    some = mask.any(axis=0)
    assert np.allclose(fast[some], slow[some], atol=1e-4)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh(rng.normal(size=toxicity.BUCKETS).astype("f4"), rng.normal(size=toxicity.BUCKETS).astype("f4"))
    t, n = 5, 3
    bucket = rng.integers(0, 50, t * n)
    runs = [(np.flatnonzero(rng.random(t * n) < 0.7), rng.integers(0, 50, t * n)) for _ in toxicity.RUNS]
    runs = [(own, buckets[: len(own)]) for own, buckets in runs]
    mask = np.ones((t, n), bool)
    mask[3:, 1] = False
    y, w = np.array([1, 0, 1], "f4"), np.ones(3, "f4")
    net.p = {k: v.astype("f8") for k, v in net.p.items()}
    x = net.inputs(bucket, runs).reshape(t, n, -1)
    g, _ = net.backward(x, mask, y, w)

    def loss():
        states = np.concatenate([net._pass(x @ net.p[f"W{s}"] + net.p[f"c{s}"], mask, s) for s in "fb"], axis=2)
        q = toxicity._sigmoid(net._pool(states, mask)[0])
        return float(-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean())

    for k in ("Wf", "Ub", "v", "w", "cb"):
        flat = net.p[k].reshape(-1)
        i = int(np.abs(g[k]).argmax())
        was = flat[i]
        flat[i] = was + 1e-2
        up = loss()
        flat[i] = was - 1e-2
        down = loss()
        flat[i] = was
        assert abs((up - down) / 2e-2 - g[k].reshape(-1)[i]) < 2e-2 * max(1e-2, abs(g[k].reshape(-1)[i])) + 2e-4


def test_special_tokens_in_texts(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["end <|endoftext|> of", "<|endoftext|>", "<|endoftext|>x a<|endoftext|>b <|endoftext|><|endoftext|> z", "a  <|endoftext|> b", " <|endoftext|>", "plain"]
    token_files.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), str(tmp_path / "t"), path)
    tool = Tokenizer.from_file(path)
    got = {r.doc_id: r.ids for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert got == {i: [*tool.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    assert got[0] == [437, 220, 50256, 286, 2]
