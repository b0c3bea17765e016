"""Periodic runs of words against the definition, stretch by stretch."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from scenetable.llm import period_runs

SF = "/root/testdata/sf0.001"


def brute(w, least, exponent):
    """Every maximal stretch of every period, of which the smallest period counts."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, exponent * q) and not any(all(w[k] == w[k + p] for k in range(i, i + n - p)) for p in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    return w


def random_words(rng):
    n, k, w = rng.randint(0, 70), rng.choice([1, 2, 3, 5]), []
    while len(w) < n:
        block = [str(rng.randrange(k)) for _ in range(rng.randint(1, 9))]
        w += (block * 6)[: rng.randint(1, 6 * len(block))] if rng.random() < 0.5 else block[:5]
    return w[:n]


@pytest.mark.parametrize(("least", "exponent"), [(2, 2), (5, 3), (24, 3)])
def test_runs_of_random_words(least, exponent):
    rng = random.Random(least)
    for _ in range(300):
        texts = [random_words(rng) for _ in range(rng.randint(1, 4))]
        n, runs, kept = period_runs._rows([" ".join(w).encode() for w in texts], least, exponent)
        want = [brute(w, least, exponent) for w in texts]
        assert n == [len(w) for w in texts]
        assert [[(r["start"], r["length"], r["period"]) for r in own] for own in runs] == want
        assert kept == [collapsed(w, r) for w, r in zip(texts, want, strict=True)]


def test_long_runs_take_no_quadratic_time():
    for text, want in ((b"a " * 200_000, (0, 200_000, 1)), (b"a " * 100_000 + b"b", (0, 100_000, 1)), (b" ".join(b"%d" % (i % 7919) for i in range(100_000)), (0, 100_000, 7919))):
        runs = period_runs._rows([text], 24, 3)[1][0]
        assert [tuple(r.values()) for r in runs] == [want]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "x " * 30), (4, "x " * 30), (None, "a b " * 12), (5, "ein\u00a0wort " * 24), (6, "x " * 40)]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, runs int")
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in period_runs.periodic_runs(docs).collect()))
    assert got == [
        (0, 24, [(0, 24, 2)], "a b"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 30, [(0, 30, 1)], "x"), (4, 30, [(0, 30, 1)], "x"),
        (5, 24, [(0, 24, 1)], "ein\u00a0wort"), (6, 1, [], "x " * 40),
    ]
    assert period_runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        period_runs.periodic_runs(docs, min_exponent=1)


def test_query_against_the_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = set()
    for d in docs:
        w = planted(d.doc_id, d.text)
        runs = brute(w, 24, 3) if len(w) < 400 else None
        if runs is None:
            continue
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        want.add((d.doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs).encode()).hexdigest()))
    got = {tuple(r) for r in period_runs.query(spark, SF).collect()}
    assert len(got) == len(docs) and want <= got and sum(1 for r in want if r[1]) > 5
