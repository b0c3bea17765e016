"""PII spans against Python's own pattern engine, and the term measure against plain counting."""

import hashlib
import math
import re
import time

from pyspark.sql import functions as F

from scenetable.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                "card": 12 <= len(d) <= 19 and luhn(d),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


TEXTS = [
    None,
    "",
    "a@b.c_d@e.f, x.y+z@q-r.co.uk. @no.de a@b a@@b.c é@x.y.. u@v.w..z",
    "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.0004 1..2.3.4 9.9.9.99999999999999999999999999999999999999999999",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111 1111 1111 0" + "1 2" * 40 + " 378282246310005x",
    "+1 (555) 123-4567, +33 1.22.33.44.55 ++4930 123456 +1 2 +123456789012345678 +49(0)30-1234567)",
    "𝒳 émoji 😀 a@b.cd 😀 +44 20 7946 0958 and 192.168.0.1",
    "7" * 50_000,
    "a" * 50_000 + "@",
    "1 " * 30_000,
    "+1 " * 20_000,
]


def test_base_spans_equal_plain_matching(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.k, s.stop, s.kind) for s in r.base] for r in pii.find_spans(docs).select("doc_id", "base").collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_terms_that_give_an_entity_away(spark):
    texts = [f"agent zorro{i % 2} lives near bob@x.org with common words {'zorrox' if i < 2 else ''}{'far off ' * 40}{'Kim' if i != 2 else ''}" for i in range(6)] + ["far off"] * 4 + ["common words with agent"] * 30
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_e int")
    rows = {r.doc_id: r for r in pii.find_spans(docs).collect()}
    n = len(texts)
    words = [set(re.findall(r"\w+", t.lower())) for t in texts]
    told = {t for t in set.union(*words[:6]) if sum(t in w for w in words[:6]) >= 3 and math.log(n * sum(t in w for w in words[:6]) / 6 / sum(t in w for w in words)) / math.log(n / 6) >= 0.95}
    assert {s.value.lower() for r in rows.values() for s in r.spans if s.kind in ("general", "remove")} == told - {"bob", "x", "org"} == {"zorro0", "zorro1", "lives", "near", "kim"}
    assert all(r.spans == r.base for i, r in rows.items() if 6 <= i < 36)
    done = pii.find_spans(docs).select("doc_id", pii.sanitise(F.col("text"), F.col("spans")).alias("s"))
    assert {r.doc_id: r.s for r in done.collect()}[2] == "agent    [email] with common words " + "far off " * 40 + ""


def test_terms_are_marked_wherever_they_stand(spark):
    """The entity and its term are far apart, and the term stands in a text without the entity too."""
    far = " ".join(f"w{i % 7}" for i in range(300))
    texts = [f"mail {c}@x.org now {far} Kim{'' if c != 'a' else ' 77'}" for c in "aaaaaaaaaaaabbb"] + [f"{far} Kim"] + [far + " mail now"] * 3000
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find_spans(docs, disclosure=0.9, removal=0.999).collect()}
    kinds = {(s.value, s.kind) for s in rows[0].spans if s.kind in ("general", "remove")}
    assert kinds == {("77", "remove"), ("Kim", "general")} and [s.value for s in rows[15].spans] == ["Kim"]
    done = {r.doc_id: r.s for r in pii.find_spans(docs, 0.9, 0.999).where("doc_id in (0, 15)").select("doc_id", pii.sanitise(F.col("text"), F.col("spans")).alias("s")).collect()}
    assert done == {0: f"mail [email] now {far} [name] ", 15: f"{far} [name]"}


def test_many_spans_take_time_in_proportion(spark):
    text = " ".join(f"u{i}@mail.org" for i in range(16_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    row = pii.find_spans(docs).select("base", pii.sanitise(F.col("text"), F.col("spans")).alias("s")).first()
    assert [(s.start, s.k, s.stop, s.kind) for s in row.base] == brute(text) and row.s == " ".join(["[email]"] * 16_000)
    assert time.time() - began < 30


def test_many_told_words_take_time_in_proportion(spark):
    """Long texts with one entity, all of whose words give it away; words next to and inside base spans stay out."""
    text = "one@mail.org " + " ".join(f"word{i}" for i in range(20_000)) + " 10.0.0.1x 1.2.3.4"
    docs = spark.createDataFrame([(i, text) for i in range(3)] + [(9 + i, f"other text {i}") for i in range(40)], "doc_id long, text string")
    began = time.time()
    row = pii.find_spans(docs).where("doc_id = 1").first()
    assert time.time() - began < 120  # every word against every told one took minutes
    extra = [s for s in row.spans if s.kind in ("general", "remove")]
    assert [s.value for s in extra] == [f"word{i}" for i in range(20_000)] and all(text[s.start : s.stop] == s.value for s in extra[:50] + extra[-50:])
    assert [s.kind for s in row.base] == ["email", "ip", "ip"]


def test_empty_nulls_and_repeats(spark):
    kind = "doc_id long, text string, spans int"
    assert pii.find_spans(spark.createDataFrame([], kind)).count() == 0
    rows = pii.find_spans(spark.createDataFrame([(None, "a@b.cc", 1), (None, None, 2), (3, "a@b.cc", None), (3, "a@b.cc", None)], kind)).collect()
    assert sorted((r.doc_id is None, len(r.base)) for r in rows) == [(False, 1), (False, 1), (True, 0), (True, 1)]


def test_query_digest(spark):
    rows = pii.query(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in base).encode()).hexdigest()
        assert set(f"{k}:{a}:{b}" for a, _, b, k in base) <= set(r.spans.split(",")) | {""}
