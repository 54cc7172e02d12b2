from __future__ import annotations

import corpus_pipeline
from cartoscope.llm import storage

SF = "/root/testdata/sf0.001"


def test_run_is_its_stages_and_leaves_one_table(spark, monkeypatch):
    made, gone = [], []
    store, forget = storage.store, storage.forget
    monkeypatch.setattr(corpus_pipeline, "store", lambda df, name: made.append(store(df, name)) or made[-1])
    monkeypatch.setattr(corpus_pipeline, "forget", lambda df: gone.append(df) or forget(df))
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and gone == made[:-1] and len(made) == 4
    kept = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in got.collect())
