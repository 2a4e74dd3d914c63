import corpus_pipeline
from grafloom.llm import decontaminate, simhash

DATA = "/root/testdata/sf0.01"


def test_stages(spark):
    """Each stage keeps a part of its input's rows and columns; what leaves holds no near copies and no benchmark items."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, sizes, out = docs.columns, [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES:
        before, out = out, corpus_pipeline.materialise(stage(spark, out, DATA), name)
        assert out.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
        assert out.columns == columns or name == "sharding"
        sizes.append(out.count())
        if name == "near_dedup":
            prints = simhash.near_duplicates(out)
            assert prints.select("component_id").distinct().count() == prints.count() == sizes[-1]
            assert simhash.near_duplicates(before).select("component_id").distinct().count() == sizes[-1]
        if name == "decontamination":
            assert decontaminate.contained(out, spark.read.parquet(f"{DATA}/benchmark.parquet")).count() == 0
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] and sizes[1] >= 0.98 * sizes[0] and sizes[4] >= 0.6 * sizes[3]
    assert out.select("shard").distinct().count() == 40


def test_run_on_odd_rows(spark, tmp_path):
    """Null ids and texts, repeats and further columns pass through all stages; an empty table gives no rows."""
    rows = [(1, "The thing of that nature is here and there", "en", "s", 3, "x"), (1, "The thing of that nature is here and there", "en", "s", 3, "x"), (None, "Das ist ein Satz und noch einer", "de", None, None, "y"), (3, None, None, None, None, None), (4, "", "en", "s", 0, ""), (5, "12 3", None, "s", 4, "")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, shard string"
    for name, t in (("documents", spark.createDataFrame(rows, kind)), ("benchmark", spark.createDataFrame([], "item_id long, text string")), ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int"))):
        t.write.parquet(f"{tmp_path}/{name}.parquet")
    assert sorted(str(r["doc_id"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == ["1", "None"]
    spark.createDataFrame([], kind).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
