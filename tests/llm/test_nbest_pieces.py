"""The N best segmentations against all segmentations, and exact round trips."""

import hashlib
from itertools import product

import public_tokenizers
import pyarrow as pa

from scenetable.llm import nbest_pieces as N

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def all_scores(tool, text):
    """Scores of all segmentations of the whole text, by enumeration."""
    marked = (" " + text).replace(N.SPACE, "\ud800").replace(" ", N.SPACE) if text else ""
    paths = [[] for _ in range(len(marked) + 1)]
    paths[0] = [0.0]
    for j in range(1, len(marked) + 1):
        for i in range(j):
            if (p := tool.pieces.get(marked[i:j])) is not None:
                paths[j] += [s + p[1] for s in paths[i]]
        if marked[j - 1] not in tool.pieces:
            paths[j] += [s + tool.lowest for s in paths[j - 1]]
    return sorted(paths[-1], reverse=True)


def apply(ids, changes):
    out, shift = list(ids), 0
    for at, n, new in sorted(changes):
        out[at + shift : at + shift + n] = new
        shift += len(new) - n
    return out


TEXTS = ["", "a", "hi yo", "  two  spaces ", "é😀\n\tx", "▁ is ▁▁", "Ähm ok", "the cat", " ", "\u0000z", "zz zz zz"]


def test_n_best_equal_enumeration():
    tool = N.PieceCoder(MODEL)
    by_id = {i: s for i, s in tool.pieces.values()}
    for n in (1, 2, 5, 9):
        ids, counts, scores, ranked = tool.encode(pa.array(TEXTS), n)
        at = 0
        for text, count, score, best in zip(TEXTS, counts, scores, ranked, strict=True):
            own = ids[at : at + count].tolist()
            at += count
            want = all_scores(tool, text)
            assert [s for s, _ in best] == want[:n] and score == want[0]
            seen = [apply(own, c) for _, c in best]
            assert len({tuple(x) for x in seen}) == len(seen) and seen[0] == own
            for s, (x, (score_x, _)) in product([0], zip(seen, best, strict=True)):
                assert tool.decode(pa.array(x, pa.int64()).to_numpy(), pa.array([len(x)]).to_numpy()).to_pylist() == [text]
                if all(i in by_id for i in x):
                    assert sum(by_id[i] for i in x) == score_x + s


def test_search_abreast_equals_one_by_one():
    tool = N.PieceCoder(MODEL)
    words = "the internationalisation of réseaux sociaux 天地玄黄 😀😀 \x00 \ud800x zzzzqqqq".split(" ")
    chunks = [N.SPACE * k + w * r for w in words for k in (0, 1, 2, 70) for r in (1, 2, 3, 5, 9) if k or w]
    ids, ends, score, gap = tool.search(chunks)
    for i, c in enumerate(chunks):
        own, best, apart = tool.best_and_gap(c)
        assert (ids[ends[i] : ends[i + 1]].tolist(), score[i], gap[i]) == (own, best, apart), c


def test_tables_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in N.token_rows(docs, MODEL).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        assert rows[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert rows[i].nbest_scores == sorted(rows[i].nbest_scores, reverse=True) and rows[i].nbest_scores[0] == rows[i].score


def test_nulls_repeats_long_and_extra_columns(spark):
    texts = [None, "", "x" * 60_000, " " * 5000, "a b", "a b"]
    docs = spark.createDataFrame([(i % 5 if i else None, t, 1.0, [1]) for i, t in enumerate(texts)], "doc_id long, text string, score double, ids array<int>")
    rows = N.decode(N.encode(docs, MODEL), MODEL).collect()
    assert sorted(r.text for r in rows) == sorted(t or "" for t in texts)
    assert N.token_rows(docs.limit(0), MODEL).count() == 0
