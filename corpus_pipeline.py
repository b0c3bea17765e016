"""The corpus pipeline: toxicity, line dedup, near copies, benchmark passages, pieces.

Each stage takes (spark, docs, sf_dir) with docs as its predecessor left them, and works on all of
them. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenetable.llm import decontaminate, jaccard_join, line_dedup, nbest_pieces, toxicity
from scenetable.llm.common import staged, table

#: Documents whose most toxic window scores at least this go.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring under TOXIC, by a network learned from the labels of the full documents table."""
    net = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, net).where(F.col("score") < TOXIC).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur; n_chars follows the text."""
    done = line_dedup.dedup_lines(docs)
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the smallest doc_id.

    Documents with a null doc_id stay, as nothing names them.
    """
    groups = jaccard_join.jaccard_join(docs, words=5, percent=80)
    kept = groups.where(F.col("component_id").eqNullSafe(F.col("doc_id"))).select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").select(docs.columns)
    return named.unionByName(docs.where(F.col("doc_id").isNull()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids and N-best scores of each document, and the digest of its decoded text."""
    return nbest_pieces.token_rows(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]

#: SQL has neither the network nor the piece lattice; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
