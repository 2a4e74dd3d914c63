"""The whole job, on rows that a prefix or a subset of ids would leave out."""

from oracle import assert_same
from pyspark.sql import functions as F

from grafloom.plans import io_queries, kg_queries, more_queries
from grafloom.sources import sinks


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_shards_hold_all_suppliers(spark, tmp_path, monkeypatch):
    d = write(spark, tmp_path, "lineitem", [(1, 7), (1, 7), (49, 8), (50, 9), (999, 7)], "l_suppkey long, l_partkey long")
    found = lambda name: sorted((r["key"], r["item"]) for r in io_queries.QUERIES[name](spark, d).collect())
    written, write_shards = [], sinks.write_shards

    def spy(df, path, key, value):
        written.extend(r[0] for r in df.select(F.col(key)).collect())
        write_shards(df, path, key, value)

    monkeypatch.setattr(sinks, "write_shards", spy)
    assert found("json_shards") == [("1", 7), ("49", 8), ("50", 9), ("999", 7)] and sorted(written) == ["1", "49", "50", "999"]


def test_flat_export_takes_all_plants(spark, tmp_path):
    write(spark, tmp_path, "part", [(1, "C"), (2, "CC"), (3, "CCC")], "p_partkey long, p_name string")
    write(spark, tmp_path, "lineitem", [(1, 3), (1, 4), (1, 4), (2, 999)], "l_partkey long, l_suppkey long")
    d = write(spark, tmp_path, "supplier", [(3, "three"), (4, "four"), (999, "last")], "s_suppkey long, s_name string")
    found = more_queries.QUERIES["flat_export"](spark, d).collect()
    assert sorted((r["smiles"], r["plant"]) for r in found) == [("C", "four"), ("C", "three"), ("CC", "last"), ("CCC", "N/A")]


def test_junk_is_found_anywhere_in_a_text(spark, tmp_path):
    ends = {"": None, " 7": "contains digits (strain/catalog id)", " (x": "contains brackets/parens (strain designation)", " et x": "Latin drug phrase (seu/et)", " Yeast": "non-plant/unknown marker ('yeast')", " shark": "non-plant common-name token", " isolate": "microbial strain / unknown marker", " herba": None}
    rows = [(i, "plain words " * 200 + "and" + end) for i, end in enumerate(ends)] + [(100, None), (101, " \n"), (102, "Radix  x")]
    d = write(spark, tmp_path, "documents", rows, "doc_id long, text string")
    found = {r["doc_id"]: r["reason"] for r in kg_queries.QUERIES["junk_tag"](spark, d).collect()}
    assert found == dict(enumerate(ends.values())) | {100: "empty", 101: "empty", 102: "pharmacognosy part-name ('radix')"}


def test_triage_reads_whole_texts(spark, tmp_path):
    late = "words " * 500 + "7"
    write(spark, tmp_path, "documents", [(1, late), (2, "words"), (3, late), (4, None), (5, "words")], "doc_id long, text string")
    d = write(spark, tmp_path, "labels", [(1, 1), (2, 1), (4, 0)], "doc_id long, quality int")
    found = {r["doc_id"]: r["tier"] for r in more_queries.QUERIES["triage"](spark, d).collect()}
    assert found == {1: "junk", 2: "plant", 3: "junk", 4: "nonplant", 5: "possible"}


def test_typos_of_whole_names(spark, tmp_path):
    """Short, long and late slips count; another epithet, two slips or none don't."""
    docs = ["Aloa vera gel", "Chrysanthemun indicum, dried", "Salvla officinalis", "Salvla miltiorrhiza", "Pnx ginseng", "Älo vera", "Aloe vera", "Word", None, ""]
    write(spark, tmp_path, "documents", list(enumerate(docs)), "doc_id long, text string")
    known = ["Aloe vera", "Chrysanthemum indicum", "Salvia officinalis L.", "Panax ginseng"]
    d = write(spark, tmp_path, "benchmark", list(enumerate(known)), "item_id long, text string")
    make = more_queries.QUERIES["typo_rescue"]
    assert {tuple(r) for r in make(spark, d).collect()} == {("Aloa vera", "Aloe vera"), ("Chrysanthemun indicum", "Chrysanthemum indicum"), ("Salvla officinalis", "Salvia officinalis")}
    assert_same(spark, make, more_queries.ORACLE_SQL["typo_rescue"], d)


def test_fallback_join_tries_the_whole_name(spark, tmp_path):
    rows = [(1, "Aloe vera var x", "zz"), (2, "none", "aloe vera VAR x"), (3, "Aloe vera  other", "aloe vera"), (4, "The other one", "zz")]
    d = write(spark, tmp_path, "documents", rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: (r["value"], r["rank"]) for r in kg_queries.QUERIES["name_fallback_join"](spark, d).collect()}
    assert found == {1: (2, 0), 2: (None, None), 3: (3, 1), 4: (7, 2)}
