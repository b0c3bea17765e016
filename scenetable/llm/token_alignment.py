"""Cross-tokenizer alignment: tokens of two tokenizers linked where their bytes overlap, each distinct text once."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sliced, staged, table

#: Bytes of texts in a block, distinct chunks that a worker remembers, and characters tokenized at a time.
BLOCK_BYTES, KNOWN_CHUNKS, JOINED_CHARS = 4 << 20, 300_000, 20_000
#: A text with more than this share of all rows is joined by broadcast: fewer than 1 / share such texts can exist.
HOT_SHARE = 0.001
#: Spaces at which both tokenizers always part: single ones between visible characters. Others stay in a chunk.
CUT = re.compile(r"(?<=\S) (?=\S)")
ODD = re.compile(r"(?:^|\s) | (?:\s|$)")
SPACE = "▁"

_aligners: dict[tuple[str, str], Aligner] = {}


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each of several ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Aligner:
    """Alignments of chunks of text under a byte-level BPE (A) and a piece BPE with byte fallback (B).

    A chunk stands for a space and the chunk's text. Both tokenizers part at every chunk's end, so a text's
    groups and links are those of its chunks one after the other, and each distinct chunk is encoded once.
    """

    def __init__(self, byte_file: str, piece_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_file=piece_file)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in byte-level entries
        others = [i for i in range(256) if i not in set(plain)]
        byte_of = {chr(i): i for i in plain} | {chr(256 + k): i for k, i in enumerate(others)}
        size = self.a.get_vocab_size()
        self.a_bytes = [b""] * size
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.parts = not any(SPACE in p.lstrip(SPACE) for p in pieces)  # no piece reaches over a space to a word before it
        self.a_width, self.b_width = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.shown = [f"{i}{c}" for i in range(size) for c in ",|"] + [f"{i}{c}" for i in range(len(pieces)) for c in ",;"]
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.groups: list[str] = []
        #: By chunk: tokens of A, of B, groups, links, and whether the bytes of a tokenizer differ from the text's.
        self.facts = np.zeros((0, 5), np.int64)
        self.pairs, self.ends = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def chunks(self, text: str) -> list[str]:
        if not self.parts:
            return [text]
        return CUT.split(text) if ODD.search(text) else text.split(" ")

    def _encode(self, joined: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of A and of B, and whether both spell a space and the text."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in joined], add_special_tokens=False)]
        b = self.b.encode(joined, num_threads=1)
        spelt = [(" " + t).encode() for t in joined]
        good = [b"".join(map(self.a_bytes.__getitem__, x)) == s and b"".join(map(self.b_bytes.__getitem__, y)) == s for x, y, s in zip(a, b, spelt, strict=True)]
        return a, b, good

    def learn(self, chunks: list[str]) -> None:
        """Encode and align new chunks. Those of visible ends are joined, and cut again where their bytes end."""
        alone, groups, part, length = [], [], [], 0
        for c in chunks:
            if SPACE in c or c[0].isspace() or c[-1].isspace() or not self.parts:
                alone.append(c)
                continue
            part.append(c)
            length += len(c)
            if length >= JOINED_CHARS:
                groups.append(part)
                part, length = [], 0
        groups += [part] if part else []
        a, b, good = self._encode([" ".join(g) for g in groups])
        bad = [k for k, ok in enumerate(good) if not ok]
        alone += [c for k in bad for c in groups[k]]
        kept = [k for k, ok in enumerate(good) if ok]
        names = [c for k in kept for c in groups[k]]
        a, b = [a[k] for k in kept], [b[k] for k in kept]
        one_a, one_b, ok = self._encode(alone)
        wrong = [c for c, fine in zip(alone, ok, strict=True) if not fine]
        names += [c for c, fine in zip(alone, ok, strict=True) if fine]
        a += [x for x, fine in zip(one_a, ok, strict=True) if fine]
        b += [x for x, fine in zip(one_b, ok, strict=True) if fine]
        self._align(names, np.concatenate([np.zeros(0, np.int64), *a]).astype(np.int64), np.concatenate([np.zeros(0, np.int64), *b]).astype(np.int64))
        for c in wrong:
            self.numbers[c] = len(self.groups)
            self.groups.append("")
        self.facts = np.concatenate([self.facts, np.tile(np.array([0, 0, 0, 0, 1]), (len(wrong), 1))])
        self.ends = np.append(self.ends, np.full(len(wrong), self.ends[-1]))

    def _align(self, chunks: list[str], a: np.ndarray, b: np.ndarray) -> None:
        """Add chunks whose ids follow one another in `a` and `b`."""
        ends_a, ends_b = np.cumsum(self.a_width[a]), np.cumsum(self.b_width[b])
        stops = np.cumsum(np.array([len(c.encode()) + 1 for c in chunks], np.int64))
        both, every = np.intersect1d(ends_a, ends_b, True), np.union1d(ends_a, ends_b)
        links = a[np.searchsorted(ends_a, every)] * len(self.b_bytes) + b[np.searchsorted(ends_b, every)]
        in_a, in_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        count_a, count_b = np.bincount(in_a, minlength=len(both)), np.bincount(in_b, minlength=len(both))
        shown = np.zeros(len(a) + len(b), np.int64)  # A's ids of a group before B's
        shown[np.arange(len(a)) + (np.cumsum(count_b) - count_b)[in_a]] = 2 * a + (ends_a == both[in_a])
        shown[np.arange(len(b)) + np.cumsum(count_a)[in_b]] = 2 * (len(self.a_bytes) + b) + (ends_b == both[in_b])
        at = [np.searchsorted(x, stops, side="right") for x in (ends_a, ends_b, both, every)]
        strings = [self.shown[i] for i in shown.tolist()]
        last, first = 0, len(self.groups)
        for c, stop in zip(chunks, (at[0] + at[1]).tolist(), strict=True):
            self.numbers[c] = len(self.groups)
            self.groups.append("".join(strings[last:stop])[:-1])
            last = stop
        sizes = [np.diff(x, prepend=0) for x in at]
        assert len(self.groups) == first + len(chunks)
        self.facts = np.concatenate([self.facts, np.stack([*sizes, np.zeros(len(chunks), np.int64)], 1)])
        self.pairs = np.concatenate([self.pairs, links])
        self.ends = np.concatenate([self.ends, self.ends[-1] + at[3]])

    def block(self, texts: list[str], copies: np.ndarray) -> dict[str, np.ndarray | list[str]]:
        """Measures of distinct non-empty texts, and what is needed to sum up corpus-wide counts over their links.

        sums (n, 4): tokens of A, of B, groups, links; digests; chunk: each text's chunks by number within the
        block, chunk_end by text; link: pairs of each such chunk by number, link_end by chunk; pair and its weighted count.
        """
        cut = [self.chunks(t) for t in texts]
        known = self.numbers
        new = {c for own in cut for c in own if c not in known}
        if len(new) + len(known) > KNOWN_CHUNKS:
            self.forget()
            known = self.numbers
            new = {c for own in cut for c in own}
        if new:
            self.learn(list(new))
        sizes = np.array([len(own) for own in cut], np.int64)
        codes = np.fromiter((known[c] for own in cut for c in own), np.int64, int(sizes.sum()))
        ends = np.cumsum(sizes)
        begin = ends - sizes
        sums = np.add.reduceat(self.facts[codes], begin, axis=0) if len(codes) else np.zeros((0, 5), np.int64)
        fine = sums[:, 4] == 0
        sums = np.where(fine[:, None], sums[:, :4], 0)
        listed, names = codes.tolist(), self.groups
        digests = [hashlib.sha256(";".join([names[k] for k in listed[x:y]]).encode()).hexdigest() if ok else "" for x, y, ok in zip(begin.tolist(), ends.tolist(), fine.tolist(), strict=True)]
        codes, sizes = codes[np.repeat(fine, sizes)], np.where(fine, sizes, 0)
        used, chunk = np.unique(codes, return_inverse=True)
        weight = np.zeros(len(used), np.int64)
        np.add.at(weight, chunk, np.repeat(copies, sizes))
        n_links = self.ends[used + 1] - self.ends[used]
        pair, link = np.unique(self.pairs[_spread(self.ends[used], n_links)], return_inverse=True)
        count = np.zeros(len(pair), np.int64)
        np.add.at(count, link, np.repeat(weight, n_links))
        return {"sums": sums, "digests": digests, "chunk": chunk, "chunk_end": np.cumsum(sizes), "link": link, "link_end": np.cumsum(n_links), "pair": pair, "count": count}


def aligner(byte_file: str, piece_file: str) -> Aligner:
    """The worker's aligner of two tokenizer files."""
    if (byte_file, piece_file) not in _aligners:
        _aligners[byte_file, piece_file] = Aligner(byte_file, piece_file)
    return _aligners[byte_file, piece_file]


def text_key(text: Column) -> Column:
    """The SHA-256 of a text as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


_BLOCK = """block binary, text_key array<binary>, copies array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>,
 groups_sha256 array<string>, chunk array<int>, chunk_end array<long>, link array<int>, link_end array<long>, pair array<long>, pair_count array<long>"""


def _aligned(texts: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Blocks of distinct texts (text, copies) with their measures, one row a block, named by its first text's key."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_file, piece_file)
        listed = lambda values, kind: pa.array([values], pa.list_(kind))
        for batch in sliced(batches, "text", BLOCK_BYTES):
            raw = batch.column("text").to_pylist()
            copies = batch.column("copies").to_numpy()
            out = tool.block(raw, copies)
            keys = [hashlib.sha256(t.encode()).digest() for t in raw]
            long, small = pa.int64(), pa.int32()
            columns = [
                pa.array([keys[0]], pa.binary()), listed(keys, pa.binary()), listed(copies, long), *(listed(out["sums"][:, k], long) for k in range(4)), listed(out["digests"], pa.string()),
                listed(out["chunk"], small), listed(out["chunk_end"], long), listed(out["link"], small), listed(out["link_end"], long), listed(out["pair"], long), listed(out["count"], long),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _BLOCK.replace("\n", "").split(",")])

    return texts.mapInArrow(blocks, _BLOCK)


def _measured(blocks: DataFrame) -> DataFrame:
    """One row a text of blocks with `found` (array of at, count, top of the block's pairs): the sums over its links."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lists = {name: batch.column(name)[k].values for name in batch.schema.names}
                arrays = {name: lists[name].to_numpy(zero_copy_only=False) for name in ("chunk", "chunk_end", "link", "link_end")}
                n = len(lists["text_key"])
                sums = []
                for field in ("count", "top"):
                    values = np.zeros(len(lists["found"]), np.int64)
                    at = lists["found"].field("at").to_numpy()
                    values[at] = lists["found"].field(field).to_numpy(zero_copy_only=False).astype(np.int64)
                    over = np.append(0, np.cumsum(values[arrays["link"]]))[np.append(0, arrays["link_end"])]
                    over = np.append(0, np.cumsum(np.diff(over)[arrays["chunk"]]))[np.append(0, arrays["chunk_end"])]
                    sums.append(np.diff(over))
                own = [lists[c] for c in ("text_key", "copies", "n_a", "n_b", "n_groups", "n_links")]
                assert len(sums[0]) == n
                yield pa.RecordBatch.from_arrays([*own, pa.array(sums[1], pa.int64()), pa.array(sums[0], pa.int64()), lists["groups_sha256"]], names=["text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    columns = ["text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "chunk", "chunk_end", "link", "link_end", "found"]
    return blocks.select(*columns).mapInArrow(rows, "text_key binary, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align_tokens(docs: DataFrame, byte_file: str, piece_file: str) -> tuple[DataFrame, DataFrame]:
    """Align the tokens of a byte-level BPE (A, of a space and the text) and a piece BPE (B) in each whole text of `docs` (doc_id, text, ...).

    Byte offsets where tokens of both end cut a text into groups; tokens of A and B whose bytes overlap are
    linked. Returns two tables. One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose
    pair has the most links in the corpus of all pairs of that B id, ties included), count_sum (the pairs'
    corpus-wide links, over all links) and groups_sha256 (of `a1,a2|b1;a3|b2,b3`). One row a pair: a_id, b_id,
    n_links in the corpus, best.

    Equal texts are shuffled together (copies are counted before), and each distinct text is encoded and aligned once,
    in blocks; a pair's links in a block count once for every copy. Corpus-wide counts go back to blocks,
    not to texts, so a pair that all texts have is one row a block. Measures go to documents by SHA-256 of the text;
    texts with over HOT_SHARE of all rows, of which there are fewer than 1 / HOT_SHARE, by broadcast.

    Null and empty texts, and texts whose tokens do not spell a space and the text (U+2581 in it), have no tokens: zeros
    and ''. Repeated rows and null doc_ids come out once each; other columns are left out. Empty input: empty output.
    """
    keyed = staged(docs.select("doc_id", F.when(F.col("text") != "", text_key(F.col("text"))).alias("text_key")))
    texts = docs.where(F.col("text") != "").groupBy("text").agg(F.count("*").alias("copies"))
    blocks = staged(_aligned(texts, byte_file, piece_file))
    each = blocks.select(F.explode(F.arrays_zip("pair", "pair_count")).alias("e")).select("e.*")
    counts = staged(each.groupBy("pair").agg(F.sum("pair_count").alias("count")))
    size = _pieces(piece_file)
    most = counts.groupBy((F.col("pair") % size).alias("b_id")).agg(F.max("count").alias("most"))  # a row a piece: as many as the vocabulary at most
    pairs = counts.withColumn("b_id", F.col("pair") % size).join(F.broadcast(most), "b_id").withColumn("top", F.col("count") == F.col("most"))
    used = blocks.select("block", F.posexplode("pair").alias("at", "pair"))
    found = used.join(pairs.select("pair", "count", "top"), "pair").groupBy("block").agg(F.collect_list(F.struct("at", "count", "top")).alias("found"))
    measures = staged(_measured(blocks.join(found, "block", "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<at: int, count: bigint, top: boolean>>")))))
    rows = _joined(keyed, measures)
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    listed = pairs.select(F.expr(f"pair div {size}").alias("a_id"), "b_id", F.col("count").alias("n_links"), F.col("top").alias("best"))
    return rows.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")), listed


def _pieces(piece_file: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=piece_file).get_piece_size()


def _joined(keyed: DataFrame, measures: DataFrame) -> DataFrame:
    """Every row of `keyed` with its text's measures (null without a text): frequent texts by broadcast, the others by a shuffle."""
    often = F.col("copies") > F.lit(HOT_SHARE * keyed.count())
    hot, rest = measures.where(often).drop("copies"), measures.where(~often).drop("copies")
    mine = keyed.join(F.broadcast(hot), "text_key")
    others = keyed.where(F.col("text_key").isNotNull()).join(F.broadcast(hot.select("text_key")), "text_key", "left_anti").join(rest, "text_key", "left")
    none = keyed.where(F.col("text_key").isNull())
    return mine.unionByName(others).unionByName(none, allowMissingColumns=True)


def query(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return align_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))[0]
