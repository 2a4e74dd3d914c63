import pytest
from pyspark.sql import functions as F

from grafloom.functions import terms as t


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (t.literal_value, '"x \\"y\\" z"@en', 'x \\"y\\" z'),
        (t.literal_language, '"x"@en', "en"),
        (t.literal_datatype, '"1"^^<http://d>', "http://d"),
        (t.literal_value, "<http://a>", "<http://a>"),
        (t.djb2_shard, "Plant_Panax_ginseng", 91),
        (t.djb2_shard, "Organism_227", 207),
        (t.binomial, "Salvia  Officinalis L.", "salvia officinalis"),
        (t.binomial, "Salvia", ""),
        (t.binomial_web, "Salvia", "salvia"),
        (t.binomial_loose, "Aloe-x Vera", "aloe-x vera"),
        (t.binomial_unicode, "Érica çarnea L", "érica çarnea"),
        (t.binomial_author, "Artemisia abrotanum L.", "Artemisia abrotanum"),
        (t.binomial_author, "Citrus reticulata tangerine", None),
        (t.binomial_author, "Rosa x alba", None),
        (t.normalize_doi, "https://doi.org/10.1/x.),", "10.1/x"),
        (t.split_multi, "a || b;b // c", ["a", "b", "c"]),
        (t.nct_ids, "NCT00000002, NCT00000001", ["NCT00000001", "NCT00000002"]),
        (t.constituent_kind, "ESTERASES", "enzyme"),
        (t.constituent_kind, "TANNINS", "element_or_nutrient_class"),
        (t.constituent_kind, "FLAVONE-DERIVATIVES", "compound_class"),
        (t.constituent_kind, "LINALOOL", None),
        (t.title_case, "alpha-glucan X", "Alpha-Glucan X"),
        (t.valid_pmid, "4999999", False),
        (t.valid_pmid, "5000000", True),
        (t.valid_pmid, "x", False),
        (t.unescape, 'a\\"b\\n\\\\"c', 'a"b\n\\"c'),
        (t.safe_identifier, "1a b", "_1a_b"),
        (t.safe_local, "  %%", "unknown"),
        (t.percent_encode, "a b<é", "a%20b%3C%C3%A9"),
        (t.iri_problem, "http://h/a b", "char  "),
        (t.iri_problem, "nohost", "no scheme"),
        (t.iri_problem, "http://h/%zz", "char %"),
        (t.iri_problem, "http://h/#a#b", "two #"),
        (t.iri_problem, "http://h/é%20x", None),
        (t.words_of_predicate, "<http://x#hasClinicalStudy>", "has clinical study"),
        (t.inchikey_local, "ABCDEFGHIJKLMN-ABCDEFGHIJ-N", "Chemical_ik_ABCDEFGHIJKLMN_ABCDEFGHIJ_N"),
        (t.inchikey_local, "x", None),
        (t.clean_infraspecific, "Panax ginseng var. x y", "Panax ginseng"),
        (t.without_language_tag, "ginseng [en]", "ginseng"),
        (t.normalize_text, " A   b\n", "a b"),
        (t.extract_doi, "see 10.1234/AB.c).", "10.1234/AB.c"),
        (t.is_citation, "see species file", False),
        (t.is_citation, "Smith 1990. A study.", True),
    ],
)
def test_function(spark, f, value, want):
    assert one(spark, f, value) == want


def test_formula_and_profiles(spark):
    assert abs(one(spark, t.formula_mass, "C2H6O") - 46.069) < 1e-9
    assert abs(one(spark, t.formula_mass, "C6H12HgPtSr2") - (6 * 12.011 + 12 * 1.008 + 200.59 + 195.08 + 2 * 87.62)) < 1e-9
    assert [one(spark, t.formula_mass, x) for x in ("Xx2", "", "C6H5(CH3)2", "C2H6O.HCl", "c6", None)] == [None] * 6
    assert one(spark, lambda c: t.is_na(c, "phase1"), " n/a ") and not one(spark, lambda c: t.is_na(c, "phase2"), "n/a")
    assert one(spark, lambda c: t.nt_literal(c, "http://d"), 'a"\\\n') == '"a\\"\\\\\\n"^^<http://d>'
    assert one(spark, lambda c: t.cut_label(c, 3), "abcd") == "abc…"
    assert one(spark, lambda c: t.compact(c, {"x": "http://x#"}), "<http://x#a>") == "x:a"
    assert t.year_windows(2000, 2004, 2) == [(2000, 2001), (2002, 2003), (2004, 2004)] and t.namespace("http://a") == "http://a#"
    assert one(spark, lambda c: t.xref_iri(F.lit("chebi"), c, {"chebi": "http://c/{}"}), "5") == "<http://c/5>"
