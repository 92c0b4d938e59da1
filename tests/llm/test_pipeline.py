"""The corpus pipeline against a brute-force version of its stages, on a small table."""

import re

from .test_llm import DOCS, made_up


def test_pipeline_keeps_what_brute_force_keeps(spark, tmp_path):
    import corpus_pipeline

    rows = made_up(60, 11)
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near-dedup", "substring dedup", "packing"]
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left[name] = {r.doc_id for r in docs.collect()}
        assert left[name] <= before
    text = {r[0]: r[1] for r in rows}
    assert all(len((text[i] or "").split()) >= 10 for i in left["quality rules"])
    first = {}
    for i in sorted(left["quality rules"]):
        first.setdefault(re.sub(r"\s+", " ", text[i]), i)
    assert left["exact dedup"] == set(first.values())
    assert left["substring dedup"] == left["near-dedup"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == left["substring dedup"]
