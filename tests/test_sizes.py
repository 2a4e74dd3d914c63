"""Queries on tables that are larger, or other, than the driver's small ones."""

import pyarrow as pa
import pytest
from oracle import assert_same
from pyspark.sql import functions as F

from grafloom.functions import mining
from grafloom.operators import entities, graph, rules, search
from grafloom.plans import graph_queries, table_queries
from grafloom.sources import datasource, store


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_small_ranges_grow_with_the_files(tmp_path):
    """a range of 1000 bytes doesn't make a task for each 1000 bytes, and records stay whole."""
    (tmp_path / "m.sdf").write_text("$$$$".join(f"> <id>\nm{k}\n\n" for k in range(40_000)))
    reader = datasource.SdfSource({"path": str(tmp_path / "m.sdf"), "tags": "id", "pieceBytes": "1000"}).reader(None)
    pieces = reader.partitions()
    assert len(pieces) <= datasource.MOST_PIECES + 1
    assert [x[0] for p in pieces for x in reader.read(p)] == [f"m{k}" for k in range(40_000)]


def test_profile_without_a_frequent_subject(spark, tmp_path):
    """more distinct subjects than are tracked, none of them frequent."""
    n = 9_000
    write(spark, tmp_path, "part", [(k, f"name {k}", "B", k % 50) for k in range(n)], "p_partkey long, p_name string, p_brand string, p_size int")
    write(spark, tmp_path, "supplier", [(k, f"s {k}", 1) for k in range(n)], "s_suppkey long, s_name string, s_nationkey int")
    d = write(spark, tmp_path, "documents", [(k,) for k in range(100)], "doc_id long")
    assert_same(spark, graph_queries.QUERIES["sketched_profile"], graph_queries.ORACLE_SQL["sketched_profile"], d)


@pytest.mark.parametrize("text", ["Plain. This worthless thing, it is rare. Worthless thing.", None])
def test_names_that_texts_themselves_seem_to_begin_with(spark, tmp_path, text):
    """only the names that the query puts in front count, also for rows without a text."""
    d = write(spark, tmp_path, "documents", [(k, text) for k in range(10)], "doc_id long, text string")
    assert_same(spark, table_queries.QUERIES["names_in_prose"], table_queries.ORACLE_SQL["names_in_prose"], d)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_frequent_predicates_are_not_dealt_by_predicate(spark):
    """axioms and pairs of a schema come to the triples."""
    t = spark.createDataFrame([("a", "in", "b"), ("b", "type", "Place")], "s string, p string, o string")
    axioms = spark.createDataFrame([("in", "range", "Place"), ("in", "domain", "Thing")], "p string, side string, class string")
    types = graph.inferred_types(t, axioms, "type")
    assert [tuple(x) for x in types.collect()] == [("a", "type", "Thing")] and "hashpartitioning(p#" not in _plan(types).split("LeftAnti")[-1]
    both = graph.with_inverses(t, spark.createDataFrame([("in", "holds")], "p string, inverse string"))
    assert {tuple(x) for x in both.collect()} == {("a", "in", "b"), ("b", "holds", "a"), ("b", "type", "Place")} and "SortMergeJoin" not in _plan(both)


def test_uses_behind_odd_letters(spark):
    """places are those of the text itself, also where lower letters are more than upper ones."""
    texts = {"İİ x Used in TRADITIONAL medicine to treat Cold. in TCM": ["Used in TRADITIONAL medicine to treat Cold", "in TCM", "respiratory"], "no use": [], "": [], None: None, "In Chinese medicine painkiller": ["In Chinese medicine", "analgesic"]}
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string").select("k", mining.traditional_uses(F.col("x")).alias("u"))
    assert [r["u"] for r in df.orderBy("k").collect()] == list(texts.values())


def test_postings_of_a_chunk_are_one_list(monkeypatch):
    """names in a row share lists, so a posting isn't a row."""
    names = ["abcab", "xabc", "ab", "Ñ😀a😀"]
    b = pa.RecordBatch.from_pydict({"chunk": pa.array([0, 0, 1, 1], pa.int32()), "no": pa.array([0, 1, 0, 1], pa.int32()), "name": names})
    found = lambda: [(r["gram"], r["chunk"], r["nos"]) for x in search._postings(iter([b])) for r in x.to_pylist()]
    assert sorted(found()) == sorted([("abc", 0, [0, 1]), ("bca", 0, [0]), ("cab", 0, [0]), ("xab", 0, [1]), ("Ñ😀a", 1, [1]), ("😀a😀", 1, [1])])
    monkeypatch.setattr(search, "MOST_HELD", 2)
    assert ("abc", 0, [0]) in found() and ("abc", 0, [1]) in found()


def test_merged_nodes_are_hashed(spark):
    """F8: triples aren't sorted to be merged."""
    t = spark.createDataFrame([("a", "p", "b"), ("a", "p", "c"), ("b", "p", "a")], "s string, p string, o string")
    merged = entities.merge(t, spark.createDataFrame([("b", "c")], "node string, keep string"))
    assert {tuple(x) for x in merged.collect()} == {("a", "p", "c"), ("c", "p", "a")} and "SortMergeJoin" not in _plan(merged)


def test_edits_are_merged_without_a_sort(spark, tmp_path):
    """the last word on a triple is a number; a node that went takes what came after its triples went before, but nothing later."""
    t = spark.createDataFrame([("a", "p", "b"), ("a", "p", "c"), ("b", "p", "c")], "s string, p string, o string")
    kept = store.TripleStore.create(t, f"file://{tmp_path}/store", 4)
    kept.edit(remove=t.where("o = 'c' and s = 'a'"))
    kept.remove_nodes(spark.createDataFrame([("c",)], "node string"))
    kept.edit(add=t.where("s = 'b'"))
    assert sorted(tuple(x) for x in kept.read().collect()) == [("a", "p", "b"), ("b", "p", "c")]
    assert "SortAggregate" not in _plan(kept.read())
    kept.compact()
    kept.replace_subjects(t.where("s = 'a' and o = 'c'"))
    assert sorted(tuple(x) for x in kept.read().collect()) == [("a", "p", "c"), ("b", "p", "c")]


def test_words_are_looked_at_once(spark, tmp_path):
    """the hints of a language are looked for in each word once."""
    d = write(spark, tmp_path, "documents", [(0, " Über the\tniño\n\nthe ÜBER "), (1, None), (2, ""), (3, " ")], "doc_id long, text string")
    df = table_queries.QUERIES["word_languages"](spark, d)
    assert {tuple(x) for x in df.collect()} == {("de", 2, 1), ("en", 2, 1), ("es", 1, 1)}
    assert "distinct" not in _plan(df).lower()


def test_rounds_are_compared_with_their_own_properties_only(spark, monkeypatch):
    """a chain's rounds, of a property each, are compared with no fact that was found before."""
    t = spark.createDataFrame([("a", "p0", "b"), ("b", "p0", "a")], "s string, p string, o string")
    r = spark.createDataFrame([("sub", f"p{k}", f"p{k + 1}") for k in range(5)], "kind string, a string, b string")
    compared, keep = [], rules.materialise
    monkeypatch.setattr(rules, "materialise", lambda df, name: compared.append("LeftAnti" in df._jdf.queryExecution().optimizedPlan().toString()) or keep(df, name))
    found = {tuple(x) for x in rules.fixpoint(t, r).collect()}
    assert found == {(s, f"p{k}", o, k) for s, o in (("a", "b"), ("b", "a")) for k in range(6)} and not any(compared)
