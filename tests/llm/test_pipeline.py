"""The pipeline's stages on the small tables and on planted documents."""

import corpus_pipeline as P
from . import test_decontaminate as decontaminated
from . import test_jaccard_join as jaccard

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece"]
    kept = docs
    for name, stage in P.STAGES[:-1]:
        before, kept = kept, P.staged(stage(spark, kept, SF))
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
        if name == "line_dedup":
            assert len(ids) == len(rows)
        if name == "ngram_jaccard_join":
            assert ids == {c for _, _, c in jaccard.brute(rows, 5, 80)}
        if name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert ids == {d for d, _ in rows} - {d for d, _ in decontaminated.brute(rows, items)}
    assert kept.count() == P.STAGES[-1][1](spark, kept, SF).count() > 0


def test_nulls_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900001, None, "en", "s", None), (900002, "", None, "s", 0), (900003, "a b", "en", None, 3)], docs.schema)
    kept = odd
    for _, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, SF)
    assert kept.count() == 4
    assert P.STAGES[-1][1](spark, odd.limit(0), SF).count() == 0
