from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.operators import audit, entities, evidence, graph
from grafloom.operators import triples as T

LABEL = "<http://www.w3.org/2000/01/rdf-schema#label>"


def spo(df):
    return {tuple(r) for r in df.select("s", "p", "o").collect()}


def test_set_algebra(spark):
    t = T.from_rows(spark, [("a", "p", "b"), ("a", "p", "b"), ("b", "q", '"n/a"'), ("c", "p", "a")])
    assert spo(T.triples(t, t)) == spo(t) and T.triples(t, t).count() == 3
    assert spo(T.drop(t, ["q"], exact=T.from_rows(spark, [("c", "p", "a")]))) == {("a", "p", "b")}
    assert spo(T.drop_nodes(t, spark.createDataFrame([("b",)], "node string"))) == {("c", "p", "a")}
    assert spo(T.without_na(t)) == {("a", "p", "b"), ("c", "p", "a")}
    assert spo(T.remap(t, spark.createDataFrame([("a", "z"), ("p", "r")], "old string, new string"), predicates=True)) == {("z", "r", "b"), ("b", "q", '"n/a"'), ("c", "r", "z")}
    assert spo(T.keep_existing(t, spark.createDataFrame([("a",)], "node string"))) == {("a", "p", "b")}


def test_phase1_rules(spark):
    ns = "http://x#"
    kind = "<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>"
    t = T.from_rows(
        spark,
        [("<http://x#Chemical_1>", f"<{ns}hasMolecularWeight>", '"1"'), ("<http://x#Chemical_1>", LABEL, '"old"'), ("<http://x#Chemical_1>", kind, f"<{ns}Flavonoid>"), ("<http://x#Plant_1>", LABEL, '"n/a"'), ("<http://x#Plant_1>", LABEL, '"Panax"'), ("<http://x#Chemical_1>", f"<{ns}targetsPathway>", "<http://x#T>"), ("<http://x#Plant_1>", kind, f"<{ns}Flavonoid>")],
    )
    rules = T.phase1_rules(ns, "<none>", ["<http://x#Chemical_"], ["<http://x#Plant_"], [f"<{ns}Flavonoid>", f"<{ns}ChemicalConcept>"], [f"<{ns}Plant>"])
    assert spo(rules.apply(t)) == {("<http://x#Chemical_1>", f"<{ns}heuristicPhytochemicalClass>", '"Flavonoid"'), ("<http://x#Plant_1>", LABEL, '"Panax"'), ("<http://x#Chemical_1>", f"<{ns}targetsProtein>", "<http://x#T>")}
    assert {r["action"]: r["n"] for r in rules.counts(t).collect()} == {"molecular_weight": 1, "old_compound_label": 1, "heuristic_type": 1, "na_literal": 1, "kept": 1, "targets_pathway": 1, "plant_chemical_type": 1}


def test_retype(spark):
    t = T.from_rows(spark, [("c", "type", "Chem"), ("a", "has", "c"), ("a", "hasPerDuke", "c"), ("a", "has", "d")])
    out = T.retype(t, spark.createDataFrame([("c",)], "node string"), "type", "Chem", "Other", "has", "hasConstituent", ["hasPerDuke"])
    assert spo(out) == {("c", "type", "Other"), ("a", "hasConstituent", "c"), ("a", "has", "d")}


def test_labels(spark):
    labels = spark.createDataFrame([("s", "panax ginseng"), ("s", "Panax ginseng"), ("s", "Panax ginseng var. x"), ("q", "abc"), ("q", "ab"), ("q", "aa")], "s string, v string")
    best = {r["s"]: (r["label"], r["alternatives"]) for r in entities.best_label(labels).collect()}
    assert best["s"] == ("Panax ginseng", ["Panax ginseng var. x", "panax ginseng"])
    assert {r[0]: r[1] for r in labels.groupBy("s").agg(entities.shortest(F.col("v"))).collect()}["q"] == "aa"
    t = T.from_rows(spark, [("s", LABEL, '"x"'), ("s", LABEL, '"Aa bb"'), ("s", "p", '"x"')])
    assert spo(entities.label_triples(t, LABEL, "alt")) == {("s", LABEL, '"Aa bb"'), ("s", "alt", '"x"'), ("s", "p", '"x"')}


def test_conflict_guard_and_merge(spark):
    nodes = spark.createDataFrame([("A", "g", 5, "1"), ("B", "g", 3, "2"), ("C", "g", 1, None)], "node string, grp string, n int, taxon string")
    order = (-F.col("n"), F.col("taxon").isNull(), F.length("node"), F.col("node"))
    assert [tuple(r) for r in entities.canonical(nodes, "grp", *order, guard="taxon").collect()] == [("C", "A")]
    assert [tuple(r) for r in entities.conflicts(nodes, "grp", *order, guard="taxon").collect()] == [("B", "A")]
    t = T.from_rows(spark, [("A", LABEL, '"a"'), ("C", LABEL, '"c"'), ("C", "taxon", '"1"'), ("A", "taxon", '"1"'), ("C", "status", '"x"'), ("x", "has", "C"), ("x", "has", "A")])
    out = entities.merge(t, spark.createDataFrame([("C", "A")], "node string, keep string"), LABEL, "alt", ["taxon", "status"])
    assert spo(out) == {("A", LABEL, '"a"'), ("A", "alt", '"c"'), ("A", "taxon", '"1"'), ("A", "status", '"x"'), ("x", "has", "A")}
    assert spo(entities.merge(out, spark.createDataFrame([("C", "A")], "node string, keep string"), LABEL, "alt", ["taxon", "status"])) == spo(out)


def test_plants_and_trials(spark):
    rows = spark.createDataFrame([("1", "Salvia officinalis"), ("9", "Panax ginseng L."), ("8", "Aloe vera"), ("7", "Homo sapiens"), ("6", "x")], "id string, name string")
    by_id, by_b = spark.createDataFrame([("1", "n1")], "id string, node string"), spark.createDataFrame([("panax ginseng", "n2")], "binomial string, node string")
    out = {r["id"]: (r["node"], r["how"]) for r in entities.resolve_plants(rows, by_id, by_b, spark.createDataFrame([("aloe vera",)], "binomial string")).collect()}
    assert out == {"1": ("n1", "id"), "9": ("n2", "binomial"), "8": ("Plant_Aloe_vera", "minted"), "7": (None, "unresolved"), "6": (None, "unresolved")}
    trials = entities.mint_trials(spark.createDataFrame([("p", "b NCT00000002 NCT00000001"), ("p", "none")], "plant string, text string"), "plant", "text").collect()
    assert sorted(r["trial"] for r in trials)[-1] == "NCT00000001" and len({r["trial"] for r in trials}) == 2
    p = entities.papers(spark.createDataFrame([("https://doi.org/10.1234/A", None), ("10.1234/a", "T"), ("bad", "x")], "doi string, title string"), "doi", "title").collect()
    assert [tuple(r) for r in p] == [("10.1234/a", "T", 2)]


def test_closures(spark):
    e = spark.createDataFrame([(4053, 4447), (4447, 33090), (33090, 2759), (1, 2), (2, 1)], "child long, parent long")
    verdicts = {r["node"]: r["verdict"] for r in graph.has_ancestor(e, spark.createDataFrame([(4053,), (2759,), (1,), (99,), (33090,)], "node long"), 33090).collect()}
    assert verdicts == {4053: True, 2759: False, 1: False, 99: None, 33090: True}
    deep = spark.createDataFrame([(i, i + 1) for i in range(12)], "child long, parent long")
    assert graph.closure(deep, spark.createDataFrame([(0,)], "node long")).count() == 12
    try:
        graph.closure(deep, spark.createDataFrame([(0,)], "node long"), most_depth=5)
        raise AssertionError
    except RuntimeError:
        pass


def test_neighbourhood_and_inverses(spark):
    t = T.from_rows(spark, [("a", "p", "b"), ("b", "p", "c"), ("c", "p", "d"), ("a", "q", "a")])
    nodes, inside = graph.neighbourhood(t, "a")
    assert {r["node"] for r in nodes.collect()} == {"a", "b", "c"} and spo(inside) == {("a", "p", "b"), ("b", "p", "c"), ("a", "q", "a")}
    assert {r["node"]: r["degree"] for r in graph.degree(t).collect()} == {"a": 2, "b": 2, "c": 2, "d": 1}
    pairs = spark.createDataFrame([("p", "inv")], "p string, inverse string")
    once = graph.with_inverses(t, pairs)
    assert spo(graph.with_inverses(once, pairs)) == spo(once) and ("b", "inv", "a") in spo(once)
    lists = T.from_rows(spark, [("h", "first", "x"), ("h", "rest", "h2"), ("h2", "first", "y"), ("h2", "rest", "nil")])
    assert graph.rdf_lists(lists, spark.createDataFrame([("h",)], "node string"), "first", "rest", "nil").first()["members"] == ["x", "y"]


def test_evidence(spark):
    facts = spark.createDataFrame([(p, 1, s) for p, s in [(1, "C"), (2, "C"), (3, "C"), (4, "C"), (4, "D"), (5, "C")]], "a long, b long, source string")
    families = spark.createDataFrame([(1, "f1"), (2, "f2"), (3, "f3"), (4, "f4"), (5, None)], "a long, family string")
    assert {r["a"] for r in evidence.unreplicated(evidence.occurrences(facts), families, "C").collect()} == {1, 2, 3}
    names = spark.createDataFrame([("Panax ginseng",), ("Salvla officinalis",)], "name string")
    assert [tuple(r) for r in evidence.typo_matches(names, spark.createDataFrame([("Salvia officinalis",)], "name string")).collect()] == [("Salvla officinalis", "Salvia officinalis")]
    names = {"Panax ginseng": None, "marine fungus-like form": "non-plant/unknown marker ('fungus')", "mutant x": "microbial strain / unknown marker", "Folia sennae": "pharmacognosy part-name ('folia')", "A b 3": "contains digits (strain/catalog id)", "": "empty", "sea mackerel": "non-plant common-name token", "A seu B": "Latin drug phrase (seu/et)", "Aloe endophyte": "microbial strain / unknown marker", "common myrtle": None}
    assert {r[0]: r[1] for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", evidence.junk_reason(F.col("n"))).collect()} == names
    rows = spark.createDataFrame([("1", "a"), ("2", None)], "k string, v string")
    assert [tuple(r) for r in rows.select("k", evidence.decide(("x", F.col("v") == "a"), otherwise="y")).orderBy("k").collect()] == [("1", "x"), ("2", "y")]


def test_audit(spark):
    t = T.from_rows(spark, [("s", "p", '"1"^^<http://www.w3.org/2001/XMLSchema#double>'), ("s", "q", '"x"'), ("<bad iri>", "<http://p>", "<http://o>")])
    bad = audit.datatype_mismatches(t, spark.createDataFrame([("p", "http://www.w3.org/2001/XMLSchema#integer"), ("q", "http://www.w3.org/2001/XMLSchema#string")], "p string, dt string")).collect()
    assert [(r["p"], r["n"]) for r in bad] == [("p", 1)]
    assert [r["problem"] for r in audit.invalid_iris(t).collect()] == ["no scheme"]
    mass = spark.createDataFrame([("C2H6O", 46.07), ("C2H6O", 50.0), ("??", 1.0)], "f string, m double")
    assert audit.mass_mismatches(mass, "f", "m").count() == 1
    rows = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(4000)], "i int, g string")
    got = sorted(r["i"] for r in audit.stratified_sample(rows, "g", "i").collect())
    assert got == sorted(set(range(40)) | {i for i in range(4000) if (i + 1) % 613 == 0})
    assert audit.literal_profile(t).count() == 2 and audit.predicate_sets(t, spark.createDataFrame([("s", "C")], "s string, class string")).count() == 2


def test_star_and_conversion(spark):
    rows = spark.createDataFrame([("1", "N"), (None, "M"), ("", "n/a"), (None, None)], "id string, name string")
    found = spo(entities.entity_triples(rows, "id", "name", "Plant", "http://x#"))
    assert {s for s, _, _ in found} == {"<http://x#1>", "<http://x#M>", "<http://x#n_a>"}
    assert terms.namespace("http://x/") == "http://x/"
