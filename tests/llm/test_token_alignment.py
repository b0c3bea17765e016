"""Alignment of two tokenizers against whole texts encoded one by one."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from scenetable.llm import token_alignment

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plainly(rows):
    """Each row's measures from its own text: groups by a walk over both token lists, links by comparing ranges."""
    one, two = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    table = bytes_of_characters()
    piece = lambda i: bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
    kept = []
    for doc_id, text in rows:
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        spelt_a, spelt_b = [bytes(table[c] for c in one.id_to_token(i)) for i in a], [piece(i) for i in b]
        if not text or b"".join(spelt_a) != (" " + text).encode() or b"".join(spelt_b) != (" " + text).encode():
            kept.append((doc_id, [], [], [], []))
            continue
        i = j = at_a = at_b = 0
        groups, links, own_a, own_b = [], [], [], []
        while i < len(a):
            links.append((a[i], b[j]))
            end_a, end_b = at_a + len(spelt_a[i]), at_b + len(spelt_b[j])
            if end_a <= end_b:
                own_a.append(a[i])
                at_a, i = end_a, i + 1
            if end_b <= end_a:
                own_b.append(b[j])
                at_b, j = end_b, j + 1
            if at_a == at_b:
                groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
                own_a, own_b = [], []
        kept.append((doc_id, a, b, groups, links))
    count = Counter(link for *_, links in kept for link in links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(
        ((d or 0), len(a), len(b), len(g), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for d, a, b, g, links in kept
    ), count


def bytes_of_characters():
    """The byte that each character of a byte-level entry stands for: printable bytes themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}


ODD = [
    "a  b", " lead", "   lead", "tail ", "tail\n", "x\x00y", "ﬁ ① 字字字", "a\tb\n c", "<s> hi</s> <|endoftext|> end <|endoftext|>", "　q   z", "▁x y", "fine ▁", "\x1c a \x85 b", "I'll we've",
    "1234567 12 3", "...!!! ??", "éa \U0001f600\U0001f600 x", "w" * 3000, "no space here   there",
]


def test_query_against_whole_texts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in token_alignment.query(spark, SF).collect())
    assert got == plainly(rows)[0]


@pytest.mark.parametrize("known", [300_000, 3])
def test_odd_texts(spark, known, monkeypatch):
    monkeypatch.setattr(token_alignment, "KNOWN_CHUNKS", known)
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 64)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(100, None), (101, ""), (None, "a  b"), (7, "x\x00y")] + [(200 + k, "the same words here") for k in range(50)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, copies int, pair int")
    measures, pairs = token_alignment.align_tokens(docs, A, B)
    want, count = plainly(rows)
    assert sorted((r[0] or 0, *r[1:]) for r in measures.collect()) == want
    assert {(r.a_id, r.b_id): r.n_links for r in pairs.collect()} == dict(count)
    assert token_alignment.align_tokens(docs.limit(0), A, B)[0].count() == 0
