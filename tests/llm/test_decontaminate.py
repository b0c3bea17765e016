"""Decontamination against a comparison of every window with every item."""

from collections import Counter

from scenetable.llm import decontaminate as D


def sh(text, k=5):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split()]
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([(*w, "short")] if w else [])


def brute(docs, items, threshold=0.8):
    out = {}
    for d, text in docs:
        s = sh(text)
        for i, item in items:
            t = sh(item)
            if not t or not set(s) & set(t):
                continue
            ct, best, n = Counter(t), (0, 0), 0
            for a in range(max(1, len(s) - len(t) + 1)):
                w = Counter(s[a : a + len(t)])
                m = sum((w & ct).values())
                j = m / (sum(w.values()) + len(t) - m)
                if j >= threshold:
                    n += 1
                    best = max(best, (j, -a))
            if n:
                out[d, i] = (round(best[0], 9), -best[1], n)
    return out


def got(df):
    return {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word, r.n_windows) for r in df.collect()}


def test_equals_all_windows_on_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and got(D.contaminated(docs, items)) == want


def test_edges(spark):
    item = "the quick brown fox jumps over the lazy dog while nine more words follow here to make it long enough"
    repeat = "go on " * 12
    texts = [item, f"x y z {item.upper()}\n{item}", item.replace("lazy", "slow"), item.rsplit(" ", 2)[0], None, "", " \t\n", "one two three", "One  two THREE", repeat, "pad " * 30_000 + item]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, item)], "doc_id long, text string").withColumnRenamed("x", "y").selectExpr("*", "1 as item_id")
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "one two three"), (4, repeat), (5, "")], "item_id long, text string")
    want = brute([*enumerate(texts), (None, item)], [(1, item), (3, "one two three"), (4, repeat)])
    assert got(D.contaminated(docs, items)) == want
    kept = [r.doc_id for r in D.decontaminate(docs, items).collect()]
    assert sorted(x for x in kept if x is not None) == [i for i in range(len(texts)) if not any(d == i for d, _ in want)]
    assert D.contaminated(docs.limit(0), items).count() == D.contaminated(docs, items.limit(0)).count() == 0
