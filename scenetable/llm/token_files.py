"""Token-ID / binary output: documents as Parquet lists of token ids, and their way back."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_dir, sliced, table
from .shingles import mix, string_hashes

#: What a Python worker remembers before it starts afresh: distinct chunks of 28 bytes each, and their ids of 4.
CACHE_CHUNKS, CACHE_IDS = 1_200_000, 8_000_000
#: Characters given to the tokenizer at a time when it encodes new chunks.
JOINED_CHARS = 20_000
#: A space before other white space or at the end: the white space of Unicode.
SPACE_RUN = r" ([\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)"

_encoders: dict[str, ChunkEncoder] = {}


def _put(buffer: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """`buffer` with `values` from `at` on, grown by doubling."""
    if at + len(values) > len(buffer):
        buffer = np.concatenate([buffer, np.zeros(max(len(buffer), len(values)), buffer.dtype)])
    buffer[at : at + len(values)] = values
    return buffer


class ChunkEncoder:
    """A byte-level BPE tokenizer behind a memory of encoded chunks.

    A byte-level pre-tokenizer never lets a token reach over a single space that is followed
    by a visible character, so a text without other runs of spaces can be cut there and each
    distinct chunk encoded once. Texts in which a space is followed by white space or by the
    end go to the tokenizer whole. A special token such as <|endoftext|> in a text is its own id,
    as the tokenizer has it; none holds a space, so it stays inside a chunk. The memory
    knows chunks by 128 bits of hash, in arrays, so its size is bounded in bytes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core; threads would each keep memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = np.zeros(size, np.int64)  # a byte-level token has one character a byte
        for token, i in self.tokenizer.get_vocab().items():
            self.width[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        """Chunk 0 is the end id, put there by `encode`; chunk 1 is empty."""
        self.keys, self.checks, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids, self.ends, self.count = np.zeros(1 << 20, np.int32), np.zeros(1 << 18, np.int32), 2
        self.ends[1:3] = 1

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The numbers of remembered chunks; -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (self.checks[at] == checks), self.numbers[at], -1)

    def _learn(self, words: list[str], inner: int, keys: np.ndarray, checks: np.ndarray) -> None:
        """Encode new chunks: the first `inner` words have a space before them, the others begin their texts.

        The former are joined and cut again where their bytes end.
        """
        joined, a, length = words[inner:], 0, 0
        for b, w in enumerate(words[:inner], 1):
            length += len(w)
            if length >= JOINED_CHARS or b == inner:
                joined.append(" " + " ".join(words[a:b]))
                a, length = b, 0
        found = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate(found)
        sizes = pc.binary_length(pa.array(words, pa.string())).to_numpy().astype(np.int64)
        sizes[:inner] += 1
        order = np.concatenate([np.arange(inner, len(words)), np.arange(inner)])  # as they were encoded
        ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(sizes[order]), side="left") + 1
        last = int(self.ends[self.count])
        self.ends = _put(self.ends, self.count + 1, (ends + last).astype(np.int32))
        self.ids = _put(self.ids, last, ids)
        keys, checks = keys[order], checks[order]
        by_key = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[by_key])
        self.keys, self.checks = np.insert(self.keys, at, keys[by_key]), np.insert(self.checks, at, checks[by_key])
        self.numbers = np.insert(self.numbers, at, (self.count + by_key).astype(np.int32))
        self.count += len(words)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by `end`, and the number of ids of each text."""
        n = len(texts)
        whole = pc.match_substring_regex(texts, SPACE_RUN).to_numpy(zero_copy_only=False)
        cut = pc.if_else(pa.array(whole), "", texts) if whole.any() else texts
        lists = pc.split_pattern(cut, " ")
        starts = lists.offsets.to_numpy()[:n].astype(np.int64) - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        head = np.zeros(len(codes), bool)
        head[starts] = True
        some = len(coded.dictionary)
        codes = codes + np.where(head, some, 0).astype(np.int32)  # a text's first chunk has no space before it
        need = np.flatnonzero(np.bincount(codes, minlength=2 * some))
        word = need % some
        keys, checks, sizes = string_hashes(coded.dictionary)
        number = np.ones(2 * some, np.int32)
        need, word = need[(need < some) | (sizes[word] > 0)], word[(need < some) | (sizes[word] > 0)]
        keys, checks = keys[word], checks[word]
        keys[need >= some] = mix(~keys[need >= some])
        number[need] = self._find(keys, checks)
        new = number[need] < 0
        if new.any():
            if self.count + new.sum() > CACHE_CHUNKS or self.ends[self.count] > CACHE_IDS:
                self._forget()
                new[:] = True
            self._learn(coded.dictionary.take(pa.array(word[new])).to_pylist(), int((need[new] < some).sum()), keys[new], checks[new])
            number[need] = self._find(keys, checks)
        self.ids[0] = end
        at = np.insert(number[codes], np.append(starts[1:], len(codes)), 0)
        begin = self.ends[at]
        length = self.ends[at + 1] - begin
        stops = np.cumsum(length, dtype=np.int32)
        index = np.repeat(begin - stops + length, length)
        index += np.arange(len(index), dtype=np.int32)
        flat = self.ids[index]
        counts = np.diff(stops[np.append(starts[1:], len(codes)) + np.arange(n)], prepend=0).astype(np.int64)
        odd = np.flatnonzero(whole)
        if len(odd):
            found = self.tokenizer.encode_batch_fast(texts.take(pa.array(odd)).to_pylist(), add_special_tokens=False)
            pieces, last = [], 0
            begins = np.cumsum(counts) - counts
            for i, e in zip(odd, found, strict=True):
                pieces += [flat[last : begins[i]], np.array(e.ids, np.int32)]
                last = begins[i]
                counts[i] += len(e.ids)
            flat = np.concatenate([*pieces, flat[last:]])
        return flat, counts


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def _id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
) -> None:
    """Encode `docs` (doc_id, text, ...) into Parquet at `path`, in ascending doc_id order over all files.

    Each row has doc_id, part (the file's place in the order), n_tokens and ids
    (array<int>), `end_id` last. `encoding` is "dictionary" or "delta" (DELTA_BINARY_PACKED).
    Row groups and pages have the given sizes and the files carry page indexes, so a
    reader can fetch doc_id and n_tokens alone or the ids of a range of documents.

    Null and empty texts become the end id alone. Repeated doc_id rows are all written, next
    to each other; null doc_id rows come first. Other columns of the input are left out.
    """
    end = int(end_id)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in sliced(batches, "text", 2 << 20):
            texts = pc.fill_null(batch.column("text"), "")
            if len(texts):
                ids, counts = tool.encode(texts, end)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(counts, pa.int64()), _id_lists(ids, counts)], names=["doc_id", "part", "n_tokens", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    ordered = docs.select("doc_id", "text").repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"))
    rows = ordered.withColumn("part", F.spark_partition_id()).mapInArrow(encoded, f"doc_id {kind}, part int, n_tokens long, ids array<int>")
    options = {"parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes, "parquet.enable.dictionary": "true" if encoding == "dictionary" else "false", "parquet.dictionary.page.size": 1 << 20, "compression": "snappy"}
    if encoding == "delta":
        options["parquet.writer.version"] = "PARQUET_2_0"
    rows.write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Add `start`, the number of ids before each document, to rows with doc_id, part and n_tokens.

    `files` are the rows of the files, of which only part and n_tokens are read.

    Starts come from per-part totals (one row a file) and a running sum inside each part, so
    no task sees more than one file's counts. Repeated doc_ids get starts in any order.
    """
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    before = totals.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"))
    inside = Window.partitionBy("part").orderBy(F.asc_nulls_first("doc_id")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return rows.join(before, "part").withColumn("start", start).drop("before")


def token_digests(rows: DataFrame) -> DataFrame:
    """doc_id, part, n_tokens and ids_crc32 (of little-endian unsigned 32-bit ids) of rows read from token files."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            at = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "part", "n_tokens", "ids_crc32"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", "part", "ids").mapInArrow(digests, f"doc_id {kind}, part int, n_tokens long, ids_crc32 long")


def query(spark, sf_dir):
    import public_tokenizers

    path = shared_dir(spark)
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    files = spark.read.parquet(path)
    return with_starts(token_digests(files), files).select("doc_id", "start", "n_tokens", "ids_crc32")
