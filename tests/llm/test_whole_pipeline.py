"""Rows with null ids go through the pipeline's stages as others do."""

import corpus_pipeline
from grafloom.llm import decontaminate, mixing


def test_null_ids_are_decontaminated(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x one two three four five six"), (None, "y one two three four five six"), (None, "clean"), (None, None), (2, "seven eight nine ten eleven"), (None, "seven eight nine ten eleven")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "one two three four five six"), (None, "seven eight nine ten eleven"), (6, None)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(str(r["text"]) for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()) == ["None", "clean"]
    assert decontaminate.without_items(docs, items, block_chars=10).count() == 2 and decontaminate.without_items(docs, items.limit(0)).count() == 6


def test_null_ids_are_thinned(spark):
    """Non-null ids stay just where mix keeps them; null ids are thinned, each by its text."""
    text = lambda i: ("idiot fool " if i % 5 == 0 else "calm kind ") * 10 + f"word{i}"
    rows = [(i, text(i)) for i in range(400)] + [(None, text(i)) for i in range(1000, 1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "bad" if i % 5 == 0 else "good") for i in range(200)], "doc_id long, domain string")
    weights = {"good": 0.9, "bad": 0.1}
    kept = mixing.thin(docs, labelled, weights).collect()
    mixed = mixing.mix(docs, labelled, weights).where("doc_id is not null and copies > 0").collect()
    assert {r["doc_id"] for r in kept if r["doc_id"] is not None} == {r["doc_id"] for r in mixed}
    bad = sum(r["doc_id"] is None and "idiot" in r["text"] for r in kept)
    assert 15 < bad < 60 and sum(r["doc_id"] is None and "calm" in r["text"] for r in kept) > 300
