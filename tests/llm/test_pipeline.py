"""Stages one by one against what their operators' plain forms say of the same input."""

import brute

import corpus_pipeline
from tillforge.llm import queries


def test_stages_take_effect(spark, base):
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = stage(spark, docs, base)
        assert after.columns == columns
        kept = {r.doc_id for r in after.collect()}
        if name == "line_dedup":
            assert len(kept) == len(before)
        if name == "near_dedup":
            assert kept == {d for d, _, _, stays in brute.near_duplicates(before) if stays}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{base}/benchmark.parquet").collect()]
            assert kept == {d for d, *_, bad in brute.contamination(before, items) if not bad}
        docs = after


def test_the_run_packs_what_is_left(spark, base):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    docs = spark.read.parquet(f"{base}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, base)
    table = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, base).collect()]
    brute.check_packing(table, pieces, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
