"""Rules to a fixpoint, samples and sketches that merge, the trigram index, the store of triples, slim modules, counters, look-ups."""

import os
import random

import pytest
from pyspark.sql import functions as F

from grafloom.operators import audit, graph, ingest, rules, search
from grafloom.operators import triples as T
from grafloom.sources import external, store

SPO = "s string, p string, o string"


def plain_fixpoint(facts, given):
    known = set(facts)
    while True:
        new = set()
        for kind, a, b in given:
            for s, p, o in known:
                lit = o.startswith('"')
                if kind == "sub" and p == a:
                    new.add((s, b, o))
                if kind == "inverse" and not lit and p in (a, b):
                    new.add((o, b if p == a else a, s))
                if kind == "inverse" and not lit and a == b == p:
                    new.add((o, p, s))
                if kind == "symmetric" and p == a and not lit:
                    new.add((o, p, s))
                if kind == "domain" and p == a:
                    new.add((s, "type", b))
                if kind == "range" and p == a and not lit:
                    new.add((o, "type", b))
                if kind == "subclass" and p == "type" and o == a:
                    new.add((s, "type", b))
                if kind == "transitive" and p == a:
                    new |= {(s, p, z) for x, q, z in known if q == p and x == o}
        if new <= known:
            return known
        known |= new


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_against_plain_loops(spark, seed):
    r = random.Random(seed)
    facts = [(f"n{r.randrange(25)}", f"p{r.randrange(4)}", r.choice([f"n{r.randrange(25)}", '"text"'])) for _ in range(60)] + [("n1", "type", "C0")]
    given = [("sub", "p0", "q1"), ("sub", "q1", "q2"), ("sub", "q2", "q3"), ("sub", "q3", "q4"), ("inverse", "q4", "q5"), ("symmetric", "p1", None), ("transitive", "p2", None), ("domain", "q5", "C0"), ("range", "p1", "C3"), ("subclass", "C0", "C1"), ("subclass", "C1", "C0"), ("subclass", "C3", "C0")]
    out = rules.fixpoint(spark.createDataFrame(facts, SPO), spark.createDataFrame(given, "kind string, a string, b string"), "type").collect()
    assert len(out) == len({tuple(x)[:3] for x in out}) and {tuple(x)[:3] for x in out} == plain_fixpoint(facts, given)
    assert max(x["round"] for x in out) <= 12


def test_rules_end(spark):
    t, r = spark.createDataFrame([("a", "p", "b"), ("b", "p", "c"), ("c", "p", "d")], SPO), lambda rows: spark.createDataFrame(rows, "kind string, a string, b string")
    assert {tuple(x) for x in rules.fixpoint(t, r([]), "type").collect()} == {("a", "p", "b", 0), ("b", "p", "c", 0), ("c", "p", "d", 0)}
    with pytest.raises(ValueError, match="unknown rule"):
        rules.fixpoint(t, r([("what", "p", "q")]))
    with pytest.raises(RuntimeError, match="after 1 rounds"):
        rules.fixpoint(t, r([("sub", "p", "q"), ("sub", "q", "r")]), most_rounds=1)
    assert rules.fixpoint(t.limit(0), r([("transitive", "p", None)])).collect() == []


def test_bottom_k_is_the_same_for_any_partitions(spark):
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "warm").alias("g"))
    take = lambda df: sorted((str(r["g"]), r["id"]) for r in audit.bottom_k(df, 2000, ["g"], [F.col("id")], seed=3).collect())
    ranked = [(str(r["g"]), r["id"]) for r in rows.orderBy(F.xxhash64("id", F.lit(3)), "id").collect()]
    want = sorted(x for g in ("hot", "warm", "None") for x in [y for y in ranked if y[0] == g][:2000])
    assert take(rows.repartition(1)) == take(rows.repartition(13)) == want
    assert audit.bottom_k(rows, 5, [], [F.col("id")]).count() == 5 and audit.bottom_k(rows.limit(0), 5, ["g"], [F.col("id")]).collect() == []


def test_profiles_merge(spark):
    rows = [(f"s{i % 3000}", "many", f'"{"x" * (i % 50)}"') for i in range(9000)] + [("s1", "one", "<http://x>")] * 700 + [(f"s{i}", "one", f"<http://y{i}>") for i in range(300)] + [("s2", "odd", '"N/A"@en'), ("s2", "odd", '"QPJVMBTYPHYUOC-UHFFFAOYSA-N"'), ("s3", "odd", "_:b")]
    t = spark.createDataFrame(rows, SPO)
    one, parts = audit.profile(t), [audit.profile(t.where(F.crc32(F.col("o").cast("binary")) % 3 == i)) for i in range(3)]
    for found in (one, audit.merge_profiles(*parts)):
        by = {r["p"]: r for r in audit.profile_figures(found).collect()}
        assert [by[p]["triples"] for p in ("many", "one", "odd")] == [9000, 1000, 3] and (by["odd"]["na"], by["odd"]["inchikeys"], by["odd"]["bnode"], by["odd"]["lit"]) == (1, 1, 1, 2)
        assert abs(by["many"]["subjects"] - 3000) <= 3000 * audit.WITHIN_DISTINCT and by["many"]["largest_length"] == 49 and abs(by["many"]["median_length"] - 24) <= 1
        assert by["one"]["frequent"][0]["item"] == "s1" and 701 <= by["one"]["frequent"][0]["count"] <= 702 and by["one"]["median_length"] is None


def index_files(df):
    return {f.split("/index/")[1] for f in df.inputFiles()}


def test_index_reads_few_files(spark, tmp_path):
    r = random.Random(4)
    names = [(i, " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 7))) for _ in range(3))) for i in range(3000)] + [(9001, "Zürich wölf"), (9002, None), (9003, ""), (9004, "ab"), (9005, "xyzzy"), (9005, "xyzzy")]
    path = str(tmp_path / "index")
    search.build(spark.createDataFrame(names, "id long, name string"), path, chunk_names=200, buckets=16)
    for q in ("abc", "ABCD", "a b", "j", "ab", "", "WÖLF", "xyzzy", "nothing here", "cde f"):
        want = sorted((i, n) for i, n in names if n is not None and q.lower() in n.lower())
        assert sorted(tuple(x) for x in search.candidates(spark, path, q, 16).collect()) == want, q
    all_names = len(spark.read.parquet(f"{path}/names").inputFiles())
    # a name that is in one chunk opens one chunk of names
    chunks = spark.read.parquet(f"{path}/names").where("name = 'xyzzy'").select("chunk").distinct().count()
    assert all_names >= 12 and chunks == 1
    plan = search.candidates(spark, path, "xyzzy", 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(chunk") or "chunk#" in plan


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_store_edits_are_as_a_rewrite(spark, tmp_path):
    r, root = random.Random(6), str(tmp_path / "store")
    facts = {(f"s{r.randrange(40)}", f"p{r.randrange(3)}", f"s{r.randrange(40)}") for _ in range(200)}
    frame = lambda rows, schema=SPO: spark.createDataFrame(sorted(rows), schema)
    kept = store.TripleStore.create(frame(facts), root, 8)
    stands = lambda: {tuple(x) for x in store.TripleStore(spark, root).read().collect()}
    assert stands() == facts
    for n in range(6):
        add, remove = {(f"s{r.randrange(40)}", "p9", f"s{n}") for _ in range(3)}, set(r.sample(sorted(facts), 4))
        kept.edit(add=frame(add), remove=frame(remove))
        facts = (facts - remove) | add
        node = f"s{r.randrange(40)}"
        if n % 2:
            kept.replace_subjects(frame({(node, "p", "new")}))
            facts = {x for x in facts if x[0] != node} | {(node, "p", "new")}
        else:
            kept.remove_nodes(frame({(node,)}, "node string"))
            facts = {x for x in facts if node not in (x[0], x[2])}
        assert stands() == facts
        if n == 3:
            assert kept.compact() and stands() == facts and kept.compact() == []
    kept.compact()
    before = files(f"{root}/base")
    kept.edit(add=frame({("s1", "p", "last")}))
    touched = kept.compact()
    assert len(touched) == 1 and stands() == facts | {("s1", "p", "last")}
    after = files(f"{root}/base")
    assert all(after[f] == t for f, t in before.items()) and all(f"bucket={touched[0]}" in f for f in set(after) - set(before))
    assert {tuple(x) for x in kept.read(["s1", "s2"]).collect()} == {x for x in facts | {("s1", "p", "last")} if x[0] in ("s1", "s2")}
    assert all(f.split("bucket=")[1].split("/")[0] == str(touched[0]) for f in kept.read(["s1"]).inputFiles() if "/base/" in f)


def test_an_edit_that_broke_off_is_not_seen(spark, tmp_path):
    root = str(tmp_path / "store")
    kept = store.TripleStore.create(spark.createDataFrame([("a", "p", "b")], SPO), root, 4)
    kept.edit(add=spark.createDataFrame([("c", "p", "d")], SPO))
    os.remove(f"{root}/delta-done/{1:012d}.json")
    assert [tuple(x) for x in kept.read().collect()] == [("a", "p", "b")]
    kept.edit(remove=spark.createDataFrame([("a", "p", "b")], SPO))  # takes the place of what broke off
    assert kept.read().collect() == [] and kept.compact() and kept.read().collect() == []


def test_slim_modules(spark):
    edges = [(f"a{i + 1}", f"a{i}") for i in range(12)] + [("x", "a5"), ("x", "b0"), ("y", "x"), ("a2", "a8")]  # two parents, and a cycle
    found = {r["node"]: (r["below"], r["above"]) for r in graph.modules(spark.createDataFrame(edges, "child string, parent string"), ["a6", "b0", "a12", "none"], up=4).collect()}

    def spread(start, step, levels=99):
        seen, last = {start}, {start}
        while last and levels:
            last, levels = {n for x in last for n in step(x)} - seen, levels - 1
            seen |= last
        return seen

    down, climb = lambda x: [c for c, p in edges if p == x], lambda x: [p for c, p in edges if c == x]
    want = {}
    for i, root in enumerate(["a6", "b0", "a12", "none"]):
        for at, nodes in enumerate((spread(root, down), spread(root, climb, 4))):
            for n in nodes:
                want.setdefault(n, [0, 0])[at] |= 1 << i
    assert found == {k: tuple(v) for k, v in want.items()}
    sub = ingest.SUBCLASS
    t = spark.createDataFrame([("<x#CHEBI_A>", sub, "<x#CHEBI_B>"), ("<x#CHEBI_B>", sub, "<x#CHEBI_C>"), ("<x#CHEBI_C>", sub, "<x#CHEBI_D>"), ("<x#CHEBI_A>", "label", '"a"'), ("<x#CHEBI_D>", "label", '"d"')], SPO)
    assert {tuple(x) for x in ingest.slim_module(t, ["<x#CHEBI_B>"], 1, "CHEBI_").collect()} == {("<x#A>", sub, "<x#B>"), ("<x#B>", sub, "<x#C>"), ("<x#A>", "label", '"a"')}


def test_counts_of_the_pass_itself(spark):
    r = T.Rules().drop("gone", F.col("p") == "x").replace("renamed", F.col("p") == "y", p=F.lit("z")).drop("never", F.lit(False))
    t = spark.createDataFrame([("a", "x", "b"), ("a", "y", "b"), ("a", "y", "c"), ("a", "k", "b")], SPO)
    out, marks = r.observed(t, "marks")
    assert out.count() == 3 and marks.get == {"gone": 1, "renamed": 2, "never": 0, "kept": 1}


def test_failed_look_ups_leave_a_trace(spark, tmp_path):
    path = str(tmp_path / "cache")

    def fetch(keys):
        if any(k.startswith("bad") for k in keys):
            raise OSError("down")
        return {k: (None if k == "empty" else k.upper()) for k in keys if k != "unknown"}

    table = external.LookupTable(spark, path, fetch, batch=1, workers=2, tries=2, pause=0.0, most_rounds=2)
    keys = spark.createDataFrame([("a",), ("bad1",), ("empty",), ("unknown",), ("b",)], "key string")
    table.fill(keys)
    assert {r["key"] for r in table.todo(keys).collect()} == {"bad1", "unknown"} and table.dead().collect() == []
    table.fill(keys)
    assert {r["key"]: r["rounds"] for r in table.dead().collect()} == {"bad1": 2, "unknown": 2} and table.todo(keys).collect() == []
    assert {r["key"]: r["value"] for r in table.known().collect()} == {"a": "A", "b": "B", "empty": None}
    table.fill(keys)  # nothing is asked again
    later = external.LookupTable(spark, path, fetch, batch=1, most_rounds=2, keep_empty=0.0)
    assert {r["key"] for r in later.todo(keys).collect()} == {"empty"}
