"""Sketches of paragraphs against plain counting of the paragraphs themselves."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from scenetable.llm import paragraph_sketch as P

SF = "/root/testdata/sf0.001"


def share(a, b):
    """Code points of common paragraphs over those of either text."""
    x, y = Counter(P.paragraphs(a)), Counter(P.paragraphs(b))
    common = sum(len(p) * n for p, n in (x & y).items())
    either = sum(len(p) * n for p, n in (x | y).items())
    return common / either if either else 1.0


def edited(text, after):
    n = len(text)
    return text[: n - n // 2] + after[: n // 2]


def plainly(rows):
    """Contract rows of (doc_id, text) in order, but for the fingerprints."""
    texts = [t or "" for _, t in rows]
    after = texts[1:] + texts[:1]
    return [(d, len(t), hashlib.sha256(edited(t, b).encode()).hexdigest(), share(t, edited(t, b)), share(t, b)) for (d, _), t, b in zip(rows, texts, after, strict=True)]


def facts(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in df.collect()]


def test_paragraphs_are_the_whole_text():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice("ab é.!? \n\r字\U0001f600") * rng.choice([1, 1, 1, 30]) for _ in range(rng.randint(0, 60)))
        parts = P.paragraphs(text)
        assert "".join(parts) == text and all(0 < len(p) <= P.LEAST + P.MOST + 2 for p in parts)
    assert P.paragraphs("One here. Two!\nThree") == ["One here. ", "Two!\n", "Three"]


@pytest.mark.parametrize("cells", [1, 8])
def test_differences_of_random_texts(cells):
    rng = random.Random(9)
    left, right = [], []
    for n in (0, 1, 2, 5, 40, 400, 3000):
        own = [f"Line {rng.randrange(n + 1)} of these.\n" for _ in range(n)]
        left.append("".join(own))
        right.append("".join(x for x in own if rng.random() < 0.7) + "More of it. " * rng.randint(0, 3))
    sides = P.digests(left), P.digests(right)
    rows, keys, sign = P.differences(*sides, cells=cells)
    for k in range(len(left)):
        x, y = Counter(P.paragraphs(left[k])), Counter(P.paragraphs(right[k]))
        for s, d in ((1, x - y), (-1, y - x)):
            mine = keys[(rows == k) & (sign == s)]
            assert sorted(P.lengths(mine)) == sorted(len(p) for p in d.elements()) and len(set(mine.tolist())) == len(mine)
    near = P.likeness(*sides, *(np.array([len(t) for t in side]) for side in (left, right)))
    assert near.tolist() == [share(a, b) for a, b in zip(left, right, strict=True)]


def test_digests_that_never_peel_are_sorted_out():
    keys = np.array([5, 5, 9], np.uint64) << np.uint64(12)
    rows, found, sign = P.differences((keys, np.array([3])), (keys[2:], np.array([1])))
    assert found.tolist() == keys[:2].tolist() and sign.tolist() == [1, 1] and rows.tolist() == [0, 0]


def test_equal_texts_have_equal_fingerprints_and_others_not():
    texts = ["One. Two. Three.", "One. Two. Three.", "One. Two. Two. Three.", ""]
    keys = P.digests(texts)
    got = P.fingerprints(*keys, np.array([len(t) for t in texts]))
    assert got[0] == got[1] and len(set(got)) == 3


def test_versions(spark):
    rows = [(1, "A first line.\nA second.\n", "A first line.\nA third.\n"), (2, None, ""), (None, "same", "same"), (4, "x", None)]
    pairs = spark.createDataFrame([(*r, 0) for r in rows], "pair_id long, old_text string, new_text string, likeness int")
    got = {r.pair_id: r for r in P.compare_versions(pairs).collect()}
    assert len(got[1].removed) == len(got[1].added) == 1 and got[1].likeness == 14 / 33
    assert (got[2].likeness, got[2].removed, got[None].likeness, got[None].added, got[4].likeness) == (1.0, [], 1.0, [], 0.0)
    assert got[None].old_fingerprint == got[None].new_fingerprint and P.compare_versions(pairs.limit(0)).count() == 0


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_next_documents_over_ranges(spark, partitions, monkeypatch):
    rng = random.Random(2)
    rows = [(3 * k, "".join(f"Sentence {rng.randrange(30)}. " for _ in range(rng.randint(0, 9)))) for k in range(60)] + [(1, None), (5, ""), (400, "é" * 90), (-7, "a\U0001f600b")]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, edge string, part int").repartition(5)
    monkeypatch.setattr(P, "BATCH_BYTES", 200)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert sorted(facts(P.half_edited(docs))) == sorted(plainly(sorted(rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_edges(spark):
    schema = "doc_id long, text string"
    one = P.half_edited(spark.createDataFrame([(1, "alone here")], schema)).collect()
    assert [(r.doc_id, r.n_chars, r.near_next) for r in one] == [(1, 10, 1.0)]
    assert P.half_edited(spark.createDataFrame([], schema)).count() == 0
    twice = P.half_edited(spark.createDataFrame([(None, "first"), (2, "same"), (2, "same"), (2, "same"), (3, None)], schema)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in twice) == [(0, 5), (2, 4), (2, 4), (2, 4), (3, 0)]
    assert {r.fingerprint for r in twice if r.doc_id == 2} == {next(r.fingerprint for r in twice if r.doc_id == 2)}


def test_query_against_plain_counting(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = P.query(spark, SF)
    assert sorted(facts(got)) == plainly(rows)
    prints = {}
    for r in got.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        assert prints.setdefault(r.text, r.fingerprint) == r.fingerprint
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)
