from pyspark.sql import functions as F

from grafloom.operators import ingest as I
from grafloom.operators import triples as T

NS = "http://x#"


def spo(df):
    return {tuple(r) for r in df.select("s", "p", "o").collect()}


def test_targets_and_names(spark):
    a = spark.createDataFrame([("P1", "i1"), ("P1", "i1"), ("P2", "i2")], "plant string, ingredient string")
    b = spark.createDataFrame([("i1", "t1"), ("i1", "t2"), ("i2", "t2")], "ingredient string, target string")
    t = spark.createDataFrame([("t1", "ABC"), ("t2", "zzz")], "target string, symbol string")
    assert [tuple(r) for r in I.gated_targets(a, b, t, spark.createDataFrame([("abc ",)], "gene string")).collect()] == [("P1", "abc")]
    named = I.with_fallback_name(t, "target", spark.createDataFrame([("t1", "b"), ("t1", "a"), ("t2", "nan")], "target string, name string"), "name")
    assert {r["target"]: r["name"] for r in named.collect()} == {"t1": "b", "t2": "t2"}
    agg = spark.createDataFrame([("A-1", 1)], "chem string, n int")
    side = spark.createDataFrame([("a1", "x"), ("a 1", "y"), ("a1", "x")], "chem string, v string")
    assert {r["v_0"] for r in I.many_to_many(agg, (side, "chem")).collect()} == {"x", "y"}


def test_trials(spark):
    rows = spark.createDataFrame([("p", "NCT00000001", "T", "2", "flu", "Association_by_Clinical_Trials_of_Plant"), ("p", "NCT00000001", "S", "na", "cold", "Association_by_Clinical_Trials_of_Plant_Ingredients"), ("p", "bad", "x", "1", "x", None), ("q", "NCT00000002", None, None, None, None)], "plant string, nct string, title string, phase string, condition string, associated_by string")
    found = spo(I.trial_triples(rows, NS))
    one, two = "<http://x#ClinicalTrial_CT_NCT00000001>", "<http://x#ClinicalTrial_CT_NCT00000002>"
    assert {(s, p) for s, p, o in found if o == one} == {("<http://x#p>", "<http://x#hasClinicalStudy>"), ("<http://x#p>", "<http://x#hasIngredientClinicalStudy>")}
    assert (one, I.LABEL, '"S"') in found and (two, I.LABEL, '"NCT00000002"') in found and ("<http://x#q>", "<http://x#hasIngredientClinicalStudy>", two) in found
    assert len([1 for s, p, _ in found if s == one and p == "<http://x#hasCondition>"]) == 2 and len([1 for s, p, _ in found if s == one and p == "<http://x#hasPhase>"]) == 1


def test_diseases_and_descriptors(spark):
    rows = spark.createDataFrame([("A1", "flu", "3. Infection"), ("A1", "Flu", None), (None, "x y", "n/a"), (None, None, None)], "code string, name string, category string")
    nodes = I.disease_nodes(rows)
    assert {tuple(r) for r in nodes.collect()} == {("Disease_ICD11_A1", "Flu", "Infection"), ("Disease_ICD11_x_y", "x y", "n/a")}
    assert {r["name"]: r["id"] for r in I.exact_matches(nodes, spark.createDataFrame([("D1", "FLU"), ("D0", "flu")], "id string, name string")).collect()} == {"Flu": "D0", "x y": None}
    d = spark.createDataFrame([("c", 1.5, 2), ("e", None, 3)], "n string, mw double, hbd long")
    assert spo(I.descriptor_triples(d, "n", {"mw": "double", "hbd": "integer"}, NS)) == {("<http://x#c>", "<http://x#mw>", f'"1.5"^^<{I.XSD}double>'), ("<http://x#c>", "<http://x#hbd>", f'"2"^^<{I.XSD}integer>'), ("<http://x#e>", "<http://x#hbd>", f'"3"^^<{I.XSD}integer>')}


def test_class_repairs(spark):
    t = T.from_rows(spark, [("a", I.TYPE, "Old"), ("Old", I.LABEL, '"o"'), ("b", "mw1", '"1"'), ("c", "mw2", '"1"'), ("mw1", "range", "x")])
    assert spo(I.retire_class(t, "Old", "New")) == {("a", I.TYPE, "New"), ("b", "mw1", '"1"'), ("c", "mw2", '"1"'), ("mw1", "range", "x")}
    kept = T.triples(t, T.from_rows(spark, [("Sub", I.SUBCLASS, "Old")]))
    assert ("Old", I.LABEL, '"o"') in spo(I.retire_class(kept, "Old", "New"))
    assert {("b", "mw", '"1"'), ("c", "mw", '"1"'), ("mw", "range", "x")} <= spo(I.consolidate_property(t, ["mw1", "mw2"], "mw"))
    assert ("a", I.TYPE, "New") in spo(I.retarget_type(t, "Old", "New", F.col("s") == "a"))
    nodes = spark.createDataFrame([("n",), ("m",)], "node string")
    classes = spark.createDataFrame([("n", "B"), ("n", "A")], "node string, class string")
    assert {tuple(r) for r in I.classify(nodes, classes, ["B", "A"]).collect()} == {("n", "B"), ("m", "Unknown")} and I.classify(nodes, classes, [], multiple=True).count() == 3
    tree = T.from_rows(spark, [("<x#Gen_R>", I.LABEL, '"r"'), ("<x#Gen_A>", I.SUBCLASS, "<x#Gen_R>"), ("<x#Gen_B>", I.SUBCLASS, "<x#Gen_A>"), ("<x#Z>", I.LABEL, '"z"')])
    assert spo(I.copy_subtree(tree, "<x#Gen_R>", "Gen_")) == {("<x#R>", I.LABEL, '"r"'), ("<x#A>", I.SUBCLASS, "<x#R>"), ("<x#B>", I.SUBCLASS, "<x#A>")}
    ax = I.synchronised_axioms(spark.createDataFrame([("p", "domain", "C")], "p string, side string, class string"), spark.createDataFrame([("p", "q")], "p string, inverse string"))
    assert {tuple(r) for r in ax.collect()} == {("p", "domain", "C"), ("q", "range", "C")}


def test_labels(spark):
    rows = spark.createDataFrame([("a", None, "Panax", "ginseng"), ("b", "B", None, None), ("c", "nan", None, None)], "node string, label string, genus string, species string")
    assert {r["node"]: r["label"] for r in I.missing_labels(rows).collect()} == {"a": "Panax ginseng", "b": "B", "c": None}
    t = T.from_rows(spark, [("c", I.LABEL, '"KEY"'), ("c", "flag", '"true"'), ("d", I.LABEL, '"d"'), ("e", I.LABEL, '"e"')])
    names = spark.createDataFrame([("c", "CID 12", "ethanol"), ("d", "Name", None), ("e", "ABCDEFGHIJKLMN-ABCDEFGHIJ-N", None), ("zz", "Z", None)], "node string, title string, iupac string")
    assert spo(I.apply_names(t, names, "flag")) == {("c", I.LABEL, '"ethanol"'), ("d", I.LABEL, '"Name"'), ("e", I.LABEL, '"e"')}
    p = I.with_placeholders(spark.createDataFrame([("a", None, "K1"), ("b", " x ", "K2")], "node string, label string, key string"))
    assert {tuple(r) for r in p.select("label", "is_placeholder").collect()} == {("Compound K1", True), ("x", False)}
    g = T.from_rows(spark, [("c", "smi", '"CCO"'), ("c", "from", "<http://x#P_1>"), ("c", "from", "<http://x#P_2>"), ("<http://x#P_2>", "label", '"Panax"'), ("d", "smi", '"C"')])
    assert {tuple(r) for r in I.flat_export(g, "smi", "from", "label").collect()} == {("CCO", "P_1"), ("CCO", "Panax"), ("C", "N/A")}


def test_schema(spark):
    s = spo(I.schema_triples(spark, NS, {"Plant": "plant", "Chem": "chemical"}, {"has": (["Plant"], ["Chem"]), "paper": (["Plant", "Chem"], ["Plant"])}, {"mw": (["Chem"], "double")}, {"has": "of"}, {"hasPerX": "has"}))
    assert ("<http://x#has>", f"<{I.RDFS}domain>", "<http://x#Plant>") in s and ("<http://x#mw>", f"<{I.RDFS}range>", f"<{I.XSD}double>") in s
    union = next(o for a, p, o in s if a == "<http://x#paper>" and p.endswith("#domain>"))
    assert union.startswith("_:") and len([1 for _, p, _ in s if p.endswith("#first>")]) == 2
    keys = spark.createDataFrame([("b", "k"), ("a", "k"), ("c", None)], "node string, key string")
    assert spo(I.merge_by_key(T.from_rows(spark, [("b", "p", "c"), ("a", "p", "c")]), keys, F.col("node"))) == {("a", "p", "c")}
