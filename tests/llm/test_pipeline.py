"""The pipeline against plain Python, stage by stage, over a whole table."""

from collections import defaultdict

import corpus_pipeline
from test_decontamination import plain as windows
from test_near_dup import plain as components

from tributary.llm import quality, secrets


def test_pipeline(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    columns, frames = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "batches":
            assert docs.columns == columns
        frames.append(docs.collect())
    good, one, clean, masked, packed = frames

    kept = quality.measure(spark.read.parquet(f"{folder}/documents.parquet")).filter("kept")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in good)
    want = {c for _, n, c, k in components([(r.doc_id, r.text) for r in good], 5) if k}
    assert sorted(r.doc_id for r in one) == sorted(want)
    hits = {r.doc_id for r in one if windows(r.text, items, 10)[1]}
    assert hits and sorted(r.doc_id for r in clean) == sorted({r.doc_id for r in one} - hits)
    assert sorted(r.doc_id for r in masked) == sorted(r.doc_id for r in clean)
    left = secrets.digest(secrets.scan(spark.createDataFrame(masked, docs_schema(spark, folder))))
    assert left.filter("n_live > 0").count() == 0
    before = {r.doc_id: r.text for r in clean}
    assert any(before[r.doc_id] != r.text for r in masked)
    assert all(before[r.doc_id] == r.text or "[REDACTED]" in r.text for r in masked)
    parts = defaultdict(list)
    for r in packed:
        parts[r.doc_id].append((r.piece, r.piece_text))
    joined = {k: "".join(t for _, t in sorted(v)) for k, v in parts.items()}
    assert joined == {r.doc_id: r.text for r in masked}


def docs_schema(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").schema


def test_run_is_registered(spark, folder):
    import __spark_entry__

    result = __spark_entry__.queries()["pipeline"](spark, folder)
    assert "doc_id" in result.columns and result.count() > 0
