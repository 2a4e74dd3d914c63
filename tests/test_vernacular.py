"""Vernacular names in prose: rules, guards, recurrence and places."""

import pytest
from pyspark.sql import functions as F

from grafloom.functions import vernacular as v

CASES = [  # text, narrative field, (name, rule) in order
    ("The species is commonly known as the devil's claw, and grows in sand.", False, [("devil's claw", "explicit")]),
    ("Referred to locally as umbrella thorn or flat crown.", False, [("umbrella thorn", "explicit")]),
    ("It is called variously as red ivory; known as mountain 2 wood.", False, [("red ivory", "explicit")]),
    ("Vernacular names: sjambok pod (English)", False, [("sjambok pod", "vernacular")]),
    ("Known as Smith, J., Jones & Co. 1999", False, [("smith", "explicit")]),
    ("Adanson, M., 1763. Plain.", True, []),
    ("This tree sea lavender, found on islands, is rare. Plain words.", True, [("tree sea lavender", "this"), ("tree sea lavender", "lead")]),
    ("This tree sea lavender, found on islands, is rare.", False, []),
    ("Baobab, the giant of the plains. Baobab trees live long.", True, [("baobab", "lead")]),
    ("One. Two. Kapok, soft.", True, []),
    ("It is known as the widespread genus of herbs.", False, []),
    ("Known as panax, known as a an its, known as x", False, []),
    ("", True, []),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_scanner(case):
    text, narrative, want = CASES[case]
    found = [(name, rule) for a, b, rule in v.scan(text, narrative) if (name := v.accepted(text[a:b], {"panax", "ginseng"}))]
    assert found == want
    for a, b, _ in v.scan(text, narrative):
        assert 0 <= a < b <= len(text) and text[a:b] == text[a:b].strip()


def test_best_names(spark):
    plants = [(1, "Adansonia digitata"), (2, "Zingiber officinale"), (3, "Limonium arboreum"), (4, "Panax ginseng"), (5, "Aloe vera"), (6, None)]
    fields = [
        (1, "KSP", "snippet", "Baobab,  the giant.   A baobab lives long."), (1, "FWTA", "general", "Kapok, a tree. Kapok again."), (2, "IMG", "caption", "Zingiber officinale (Ginger) in flower"), (2, "KSP", "general", "Also known as stem root."), (2, "IMG", "caption", "Other plant (weed)"),
        (3, "KSP", "general", "This tree sea lavender, rare."), (3, "KSP", "summary", "This shrub, rare."), (4, "KSP", "general", "Lonely, once only."), (5, "B", "x", "known as burn plant."), (5, "A", "x", "known as first aid plant. The burn plant heals; a burn plant."), (6, "A", "x", "Vernacular name sang"), (7, "A", "x", "known as nobody."), (5, "A", "y", None),
    ]
    out = v.best_names(spark.createDataFrame(fields, "id int, source string, field string, text string").repartition(4), spark.createDataFrame(plants, "id int, scientific string"))
    found = {r["id"]: (r["name"], r["source"], r["rule"], r["occurrences"]) for r in out.collect()}
    assert found == {1: ("baobab", "KSP", "lead", 2), 2: ("ginger", "IMG", "caption", 0), 3: ("tree sea lavender", "KSP", "this", 1), 5: ("burn plant", "B", "explicit", 3), 6: ("sang", "A", "vernacular", 1)}


def test_snippets_and_hints(spark):
    rows = [("<b>Common Name</b>: Restong Bark, sang. ", "restong bark", "Restong Bark, sang", "en"), ("common names: rosaceae", None, "rosaceae", "und"), ("No list", None, None, "und"), (None, None, None, "und"), ("Common names: x; y", None, "x; y", "und")]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, s string")
    found = df.select("i", v.snippet_name(F.col("s")).alias("a"), v.snippet_list(F.col("s")).alias("b"), v.english_hint(F.coalesce(v.snippet_name(F.col("s")), F.lit(""))).alias("c")).orderBy("i").collect()
    assert [tuple(r)[1:] for r in found] == [r[1:] for r in rows]
