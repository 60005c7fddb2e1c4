from __future__ import annotations

import corpus_pipeline
from odd import empty_table, odd_table

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_drop_only_what_they_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    keys = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = corpus_pipeline.stored(stage(spark, docs, SF))
        assert done.columns == docs.columns, name
        left = {r["doc_id"] for r in done.collect()}
        assert left <= keys and len(left) > 0.6 * len(keys), name
        assert done.where("n_chars <> length(text)").count() == 0
        docs, keys = done, left
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == keys


def test_stages_take_odd_rows(spark):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (odd_table(spark), empty_table(spark)):
            done = stage(spark, table, SF)
            assert done.columns == table.columns, name
            assert done.count() <= table.count()
