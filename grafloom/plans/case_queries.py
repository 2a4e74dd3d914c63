"""Queries on literal inputs, each with the rows that follow by hand from the rules that its operator restates.

Their SQL only lists those rows, so it shares no logic with the operators.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.functions import mining, terms
from grafloom.operators import audit, evidence, graph, ingest
from grafloom.operators import triples as T
from grafloom.plans import build
from grafloom.scratch import scratch_path
from grafloom.sources import external, formats, ntriples, rdfxml, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

NS = "http://x#"
TYPE, LABEL, SUB, IRI = ingest.TYPE, ingest.LABEL, ingest.SUBCLASS, "<http://x#{}>".format


def _sql(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else repr(value)


def case(columns: str, *rows: Sequence):
    """Registers a function under its name, with the rows of the given typed columns (as in 'a VARCHAR, n BIGINT')."""

    def add(f):
        names = [c.split() for c in columns.split(", ")]
        values = ", ".join("(" + ", ".join(map(_sql, r)) + ")" for r in rows)
        ORACLE_SQL[f.__name__] = f"SELECT {', '.join(f'{n}::{t} AS {n}' for n, t in names)} FROM (VALUES {values}) AS v({', '.join(n for n, _ in names)})"
        QUERIES[f.__name__] = f
        return f

    return add


def frame(spark: SparkSession, schema: str, *rows) -> DataFrame:
    return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)


def file(spark: SparkSession, name: str, text: str) -> str:
    """A text file in the shared folder."""
    path = scratch_path(spark, name)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    return path


def spo(spark: SparkSession, *rows) -> DataFrame:
    return T.from_rows(spark, rows)


# ---- sources ----


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("<a>", "<p>", '"x . y"'), ("<b>", "<p>", "<c>"), ("_:n", "<q>", '"1"^^<int>'))
def nt_files(spark, d):
    """Several files at once, comments and empty lines skipped, a line in both files once (A3)."""
    one = file(spark, "nt", '<a> <p> "x . y" .\n# note\n\n<b> <p> <c> .')
    two = file(spark, "nt", '_:n <q> "1"^^<int> .\n<b> <p> <c> .')
    return T.triples(ntriples.read(spark, f"{one},{two}"))


_RDF = f'<rdf:RDF xmlns:rdf="{rdfxml.RDF}" xmlns:x="http://x#" xml:base="http://b">{{}}</rdf:RDF>'


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("<http://x#a>", TYPE, "<http://x#Plant>"), ("<http://x#a>", "<http://x#name>", '"R & B"@en'), ("<http://x#a>", "<http://x#mass>", '"2.5"^^<http://d>'), ("<http://x#a>", "<http://x#has>", "<http://x#c>"), ("<http://x#c>", TYPE, "<http://x#Chem>"), ("<http://b#own>", "<http://x#has>", "<http://x#a>"))
def rdfxml_read(spark, d):
    """Typed and nested nodes, references, languages, datatypes, ids under the base; an inverse predicate is left out on load."""
    text = """<x:Plant rdf:about="http://x#a"><x:name xml:lang="en">R &amp; B</x:name><x:mass rdf:datatype="http://d">2.5</x:mass><x:has><x:Chem rdf:about="http://x#c"/></x:has></x:Plant>
      <rdf:Description rdf:ID="own"><x:has rdf:resource="http://x#a"/><x:isIn rdf:resource="http://x#z"/></rdf:Description>"""
    return rdfxml.read(spark, file(spark, "rdf", _RDF.format(text)), drop=("http://x#isIn",))


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("<http://x#a>", "<http://x#has>", "<http://x#c>"), ("<http://x#c>", TYPE, "<http://x#Chem>"), ("<http://x#c>", "<http://x#name>", '"one"'), ("<http://x#b>", TYPE, "<http://x#Plant>"), ("<http://x#b>", "<http://x#has>", "<http://x#c>"), ("<http://x#d>", "<http://x#name>", '"</x:Plant> in a comment"'))
def rdfxml_split(spark, d):
    """One file cut at its top-level elements, whatever their names and depth, by a scan for tags."""
    text = """<rdf:Description rdf:about="http://x#a"><x:has><x:Chem rdf:about="http://x#c"><x:name>one</x:name></x:Chem></x:has></rdf:Description>
      <!-- </rdf:Description> --><x:Plant rdf:about="http://x#b"><x:has rdf:resource="http://x#c"/></x:Plant><rdf:Description rdf:about="http://x#d" x:name="&lt;/x:Plant> in a comment"/>"""
    return rdfxml.read_split(spark, file(spark, "rdf", _RDF.format(text)), piece_bytes=64)


@case("whole BOOLEAN, triples BIGINT", (True, 2), (False, 1))
def xml_checks(spark, d):
    """Well-formedness and triples of each file."""
    good = file(spark, "rdf", _RDF.format('<x:P rdf:about="http://x#a"><x:n>1</x:n></x:P>'))
    bad = file(spark, "rdf", _RDF.format('<x:P rdf:about="http://x#a"/><x:P>').replace("</rdf:RDF>", ""))
    return rdfxml.well_formed(spark, good).unionByName(rdfxml.well_formed(spark, bad)).select(F.col("error").isNull().alias("whole"), "triples")


@case("smiles VARCHAR, inchikey VARCHAR", ("CCO", "LFQSCWFLJHTTHZ-UHFFFAOYSA-N"), ("C", None))
def structure_scan(spark, d):
    """SMILES with their keys from RDF/XML; nodes without SMILES are left out."""
    text = """<x:C rdf:about="http://x#1"><x:smiles>CCO</x:smiles><x:hasInChIKey>LFQSCWFLJHTTHZ-UHFFFAOYSA-N</x:hasInChIKey></x:C><x:C rdf:about="http://x#2"><x:smiles>C</x:smiles></x:C><x:C rdf:about="http://x#3"><x:hasInChIKey>AAAAAAAAAAAAAA-BBBBBBBBBB-C</x:hasInChIKey></x:C>"""
    t = rdfxml.read(spark, file(spark, "rdf", _RDF.format(text)))
    return T.star(t, {"smiles": (IRI("smiles"), "min"), "inchikey": (IRI("hasInChIKey"), "min")}).where("smiles is not null").select(*[terms.literal_value(F.col(c)).alias(c) for c in ("smiles", "inchikey")])


@case("sep VARCHAR, encoding VARCHAR, found VARCHAR, a VARCHAR, b VARCHAR", (";", "UTF-8", "Taxon Name", "Aloe", "ü"), (";", "UTF-8", "Taxon Name", "Äpfel", None))
def sniffed_table(spark, d):
    """Delimiter, encoding and column alias found, rows under a comment line read by place."""
    path = file(spark, "csv", "# made by hand | and | more\nTaxon Name;b\nAloe;ü\nÄpfel;")
    sep, encoding = formats.sniff_delimiter(spark, path), formats.sniff_encoding(spark, path)
    rows = formats.read_rows(spark, path)
    column = formats.resolve_column(rows.columns, ["species", "taxon name"])
    return rows.select(F.lit(sep).alias("sep"), F.lit(encoding).alias("encoding"), F.lit(column).alias("found"), F.col(f"`{column}`").alias("a"), "b")


@case("a VARCHAR, b VARCHAR", ("1", "x y"), ("#2", None))
def headless_table(spark, d):
    """A table without a header and without comments."""
    return formats.read_rows(spark, file(spark, "tsv", "1\tx y\n#2\t"), "\t", names=["a", "b"], header=False, comment=None)


@case("kind VARCHAR, name VARCHAR, taxid BIGINT", ("name", "panax", 4053), ("name", "panax l.", 5), ("name", "sang", 4054), ("name", "red sang", 4054), ("name", "panax trifolius", 4055), ("node", "genus", 4053), ("node", "species", 4054))
def taxonomy_dump(spark, d):
    """Nodes, and names of seven classes: scientific names win, authorities and type material don't count."""
    nodes = formats.taxonomy_nodes(spark, file(spark, "nodes", "4053\t|\t1\t|\tgenus\t|\n4054\t|\t4053\t|\tspecies\t|"))
    line = "{}\t|\t{}\t|\t\t|\t{}\t|".format
    names = [(5, "Panax  L.", "synonym"), (4053, "Panax", "scientific name"), (9, "panax", "includes"), (4054, "Sang", "genbank common name"), (4054, "red sang", "genbank synonym"), (4054, "Panax L., 1753", "authority"), (3, "x", "type material"), (4055, "Panax trifolius", "equivalent name")]
    found = formats.taxonomy_names(spark, file(spark, "names", "\n".join(line(*n) for n in names)))
    return found.select(F.lit("name").alias("kind"), "name", "taxid").unionByName(nodes.select(F.lit("node").alias("kind"), F.col("rank").alias("name"), "taxid"))


@case("pmid VARCHAR, title VARCHAR, abstract VARCHAR, year VARCHAR, doi VARCHAR, mesh VARCHAR, chemicals VARCHAR, keywords VARCHAR", ("7", "Panax roots", "One. Two.", "2001", "10.1/x", "Plants, Medicinal|Mice", "quercetin", "sang"))
def articles(spark, d):
    """Articles of a literature service."""
    text = """<PubmedArticleSet><PubmedArticle><PMID Version="1">7</PMID><Journal><PubDate><Year>2001</Year></PubDate><Title>J</Title></Journal><ArticleTitle>Panax <i>roots</i></ArticleTitle><Abstract><AbstractText Label="A">One.</AbstractText><AbstractText>Two.</AbstractText></Abstract><Chemical><NameOfSubstance UI="D1">quercetin</NameOfSubstance></Chemical><DescriptorName UI="D">Plants, Medicinal</DescriptorName><DescriptorName>Mice</DescriptorName><Keyword>sang</Keyword><ArticleId IdType="doi">10.1/X</ArticleId></PubmedArticle></PubmedArticleSet>"""
    rows = formats.read_articles(spark, file(spark, "xml", text))
    return rows.select("pmid", "title", "abstract", "year", "doi", *[F.array_join(c, "|").alias(c) for c in ("mesh", "chemicals", "keywords")])


@case("plant VARCHAR, key VARCHAR", ("Aloe vera", "K1"), ("Aloe vera", "K2"), ("Vitis vinifera", "K1"))
def pushed_sql(spark, d):
    """The inner joins that a database ran before."""
    tables = {"organisms": frame(spark, "id int, name string", (1, "Aloe vera"), (2, "Vitis vinifera"), (3, "none")), "links": frame(spark, "org int, chem int", (1, 10), (1, 11), (2, 10), (9, 11)), "chemicals": frame(spark, "id int, key string", (10, "K1"), (11, "K2"))}
    return external.sql(spark, tables, "SELECT DISTINCT o.name AS plant, c.key FROM {organisms} o JOIN {links} l ON l.org = o.id JOIN {chemicals} c ON c.id = l.chem")


@case("id VARCHAR, name VARCHAR, n BIGINT", ("Plant_b", "B", 5), ("Plant_a", "A", 2))
def written_index(spark, d):
    """An index written in order and read back."""
    path = scratch_path(spark, "index")
    sinks.write_index(frame(spark, "id string, name string, n long", ("Plant_a", "A", 2), ("Plant_b", "B", 5)), path, F.desc("n"), "name")
    return spark.read.schema("id string, name string, n long").json(path)


# ---- triples ----


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("n1", "p", "n2"), ("n1", "q", "x"))
def remapped(spark, d):
    """Names replaced on both sides; triples that become equal are one."""
    t = spo(spark, ("a", "p", "b"), ("n1", "p", "b"), ("n1", "p", "n2"), ("a", "q", "x"))
    return T.remap(t, frame(spark, "old string, new string", ("a", "n1"), ("b", "n2"), ("absent", "n3")))


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("iron", TYPE, "Other"), ("plant", "hasOther", "iron"), ("plant", "hasCompound", "rutin"), ("rutin", TYPE, "Chem"), ("plant", "perSource", "rutin"))
def retyped(spark, d):
    """Constituents that aren't compounds change class and edge, and lose the edges by source."""
    t = spo(spark, ("iron", TYPE, "Chem"), ("plant", "hasCompound", "iron"), ("plant", "perSource", "iron"), ("plant", "hasCompound", "rutin"), ("rutin", TYPE, "Chem"), ("plant", "perSource", "rutin"))
    return T.retype(t, frame(spark, "node string", "iron"), TYPE, "Chem", "Other", "hasCompound", "hasOther", ["perSource"])


@case("text VARCHAR, citation BOOLEAN", ("Duke, J.A. 1992. Handbook", True), ("See species file", False), ("J. Duke", False), ("Personal files", False), ("", False), ("An aggregate of all these", False))
def citations(spark, d):
    """Texts that cite something, and pointers and names that don't."""
    texts = ("Duke, J.A. 1992. Handbook", "See species file", "J. Duke", "Personal files", "", "An aggregate of all these")
    return frame(spark, "text string", *texts).select("text", terms.is_citation(F.col("text")).alias("citation"))


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("a", "p", "1"), ("a", "p", "2"))
def existing_only(spark, d):
    """New triples of nodes that the graph has."""
    graph_ = spo(spark, ("a", "q", "x"), ("c", "q", "x"))
    return T.keep_existing(spo(spark, ("a", "p", "1"), ("a", "p", "2"), ("b", "p", "3")), graph_.select(F.col("s").alias("node")))


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("P1", IRI("hasTaxon"), '"33090"'), ("P1", "<http://www.w3.org/2004/02/skos/core#exactMatch>", "<http://purl.obolibrary.org/obo/NCBITaxon_33090>"), ("P2", IRI("hasTaxon"), '"n/a"'), ("C1", IRI("hasMechanismOfAction"), "E1"), ("E1", TYPE, IRI("MechanismOfAction")), ("C1", IRI("hasTherapeuticEffect"), "E2"), ("E2", TYPE, IRI("Effect")), (IRI("hasTaxon"), LABEL, '"has taxon"'))
def first_pass(spark, d):
    """Taxon ids as links, action types as mechanisms, and old axioms of redeclared properties dropped."""
    rdfs = ingest.RDFS
    t = spo(spark, ("P1", IRI("hasTaxon"), '"33090"'), ("P2", IRI("hasTaxon"), '"n/a"'), ("C1", IRI("hasTherapeuticEffect"), "E1"), ("E1", TYPE, IRI("Effect")), ("C1", IRI("hasTherapeuticEffect"), "E2"), ("E2", TYPE, IRI("Effect")), (IRI("hasTaxon"), f"<{rdfs}domain>", IRI("Old")), (IRI("hasTaxon"), f"<{rdfs}range>", IRI("Old")), (IRI("hasTaxon"), LABEL, '"has taxon"'))
    t = T.redeclared(t, frame(spark, "node string", IRI("hasTaxon")))
    return T.with_taxon_links(T.as_mechanisms(t, frame(spark, "node string", "E1"), NS), IRI("hasTaxon"))


# ---- joins ----


@case("target VARCHAR, protein VARCHAR", ("T1", "Kinase"), ("T2", "T2"), ("T3", "T3"))
def fallback_names(spark, d):
    """A target's protein name, or its id."""
    return ingest.with_fallback_name(frame(spark, "target string", "T1", "T2", "T3"), "target", frame(spark, "target string, name string", ("T1", "Kinase"), ("T2", " n.a. ")), "protein")


@case("node VARCHAR, name VARCHAR, id VARCHAR", ("d1", "Type 2 Diabetes", "DOID_9352"), ("d2", "gout", None), ("d3", "ASTHMA", "DOID_2841"))
def diseases_by_name(spark, d):
    """Diseases and targets matched by equal names in lower case."""
    names = frame(spark, "node string, name string", ("d1", "Type 2 Diabetes"), ("d2", "gout"), ("d3", "ASTHMA"))
    return ingest.exact_matches(names, frame(spark, "id string, name string", ("DOID_9352", "type 2 diabetes"), ("DOID_2841", "asthma"), ("DOID_9999", "Asthma")))


@case("name VARCHAR, value BIGINT", ("a", 1), ("b", 9))
def first_of_each(spark, d):
    """The first row of each key in a given order."""
    return graph.first_by(frame(spark, "name string, value long", ("a", 3), ("a", 1), ("b", 9)), ["name"], "value")


@case("formula VARCHAR, mass DOUBLE, formula_mass DOUBLE", ("C2H6O", 100.0, 46.069), ("HgCl2", 10.0, 271.49))
def mass_conflicts(spark, d):
    """Masses more than 2 off their formula's; formulas with brackets, dots or unknown elements aren't judged."""
    rows = frame(spark, "formula string, mass double", ("C2H6O", 46.1), ("C2H6O", 100.0), ("C6H5(CH3)2", 500.0), ("", 500.0), ("C2H6O.HCl", 1.0), ("Xx2", 9.0), ("HgCl2", 10.0), (None, 5.0))
    return audit.mass_mismatches(rows, "formula", "mass").withColumn("formula_mass", F.round("formula_mass", 3))


_JUNK = {
    "Panax ginseng": None, "common myrtle": None, "coral vine": None, "Endophytic form": "microbial strain / unknown marker", "streptomyces nrrl": "microbial strain / unknown marker", "Blue mackerel": "non-plant common-name token", "Folia sennae": "pharmacognosy part-name ('folia')",
    "Gummi arabicum": "pharmacognosy part-name ('gummi')", "Herba seu Radix x": "Latin drug phrase (seu/et)", "sp. 12": "contains digits (strain/catalog id)", "Aloe (red)": "contains brackets/parens (strain designation)", "Black Yeast-like": "non-plant/unknown marker ('yeast')", "  ": "empty",
}


@case("name VARCHAR, reason VARCHAR", *_JUNK.items())
def junk_names(spark, d):
    """Names that are no plants', with the reason."""
    return frame(spark, "name string", *_JUNK).select("name", evidence.junk_reason(F.col("name")).alias("reason"))


# ---- literature ----


@case("id BIGINT, plants VARCHAR, about BOOLEAN", (1, "Panax quinquefolius|Salvia officinalis var. alba", True), (2, "", True), (3, "", True), (4, "Mentha piperita", False), (5, "Vitis vinifera", True), (6, "", False))
def plant_names(spark, d):
    """Latin binomials of texts and headings, and whether a text is about plants."""
    rows = frame(spark, "id long, text string, mesh array<string>", (1, "Salvia officinalis var. alba and Panax quinquefolius leaves", None), (2, "The decoction helps patients greatly", None), (3, "Polyphenols of green tea. Results show", None), (4, "Oil of Mentha piperita", None), (5, "Wine", ["Vitis vinifera", "Plants, Medicinal", "mice albus"]), (6, "Planted steel and Human serum", ["Steel"]))
    found = mining.botanical_names(F.col("text"), F.col("mesh"))
    return rows.select("id", F.array_join(found, "|").alias("plants"), mining.plant_context(F.lit(""), F.col("text"), F.col("mesh")).alias("about"))


@case("id BIGINT, uses VARCHAR", (1, "diuretic|traditionally used in Asia to calm"), (2, "antipyretic; respiratory|used in folk medicine to treat cold and fever"), (3, ""), (4, "antiulcer; gastroprotective|in TCM"))
def folk_uses(spark, d):
    """Phrases of traditional use and the indications that a text names."""
    rows = frame(spark, "id long, text string", (1, "It is traditionally used in Asia to calm; a diuretic."), (2, "used in folk medicine  to treat cold and fever."), (3, "Steel bridges"), (4, "Known in TCM, against ulcer"))
    return rows.select("id", F.array_join(mining.traditional_uses(F.col("text")), "|").alias("uses"))


@case("id BIGINT, compounds VARCHAR", (1, "EGCG|gallic acid|quercetin"), (2, "naringenin|quercetin|quercetin-3-o-glucoside"), (3, "scopolamine|zinc"), (4, ""))
def compound_names(spark, d):
    """Listed compounds, acids, glycosides, words with their endings, and registered substances."""
    rows = frame(spark, "id long, text string, registered array<string>", (1, "Egcg, QUERCETIN and gallic acid", None), (2, "Quercetin-3-O-glucoside, naringenin", None), (3, "Scopolamine, atropine of the skin", ["Zinc ", ""]), (4, "certain origin", None))
    return rows.select("id", F.array_join(mining.compounds(F.col("text"), F.col("registered")), "|").alias("compounds"))


@case("pmid VARCHAR, species VARCHAR", ("1", "Panax quinquefolius L."), ("2", "Salvia officinalis"), ("3", ""))
def checked_species(spark, d):
    """Candidates checked against a look-up: plants by their accepted names."""
    rows = frame(spark, "pmid string, title string, abstract string, mesh array<string>", ("1", "Panax quinquefolius", "Homo sapiens erectus", None), ("2", "Salvia officinalis", None, None), ("3", "Agaricus campestris", None, None))
    known = frame(spark, "name string, kingdom string, canonical string", ("Panax quinquefolius", "Plantae", "Panax quinquefolius  L."), ("Salvia officinalis", "Plantae", None), ("Agaricus campestris", "Fungi", "Agaricus campestris"))
    return mining.validated_names(rows, known).select("pmid", F.array_join("species", "|").alias("species"))


@case("articles BIGINT, about_plants BIGINT, with_plants BIGINT, with_compounds BIGINT, with_uses BIGINT", (4, 3, 2, 1, 1))
def literature_funnel(spark, d):
    """How many articles each step keeps."""
    rows = frame(spark, "title string, abstract string", ("Panax quinquefolius extract", "quercetin against fever"), ("Salvia officinalis herb", ""), ("A seed", ""), ("Steel", "bridge"))
    return mining.funnel(rows.withColumns({"mesh": F.lit(None).cast("array<string>"), "chemicals": F.lit(None).cast("array<string>")}))


@case("name VARCHAR, language VARCHAR", ("Süßholz", "de"), ("哈", "zh"), ("さくら", "ja"), ("palo de vaca", "es"), ("licorice", "en"), ("женьшень", "ru"))
def name_languages(spark, d):
    """The language that a vernacular name's letters hint at."""
    return frame(spark, "name string", "Süßholz", "哈", "さくら", "palo de vaca", "licorice", "женьшень").select("name", mining.vernacular_language(F.col("name")).alias("language"))


@case("id BIGINT, name VARCHAR", (1, "sang"), (2, "Ginseng"), (3, "red sang"), (4, None))
def chosen_names(spark, d):
    """A registered name, else the label, else an alias, none of them the scientific name."""
    rows = frame(spark, "id long, props array<string>, label string, aliases array<string>, sci string", (1, ["sang"], "x", None, "Panax"), (2, None, "Ginseng", ["a"], "Panax"), (3, [" "], "panax", ["PANAX", "red sang"], "Panax"), (4, None, None, None, "Panax"))
    return rows.select("id", mining.pick_name(F.col("props"), F.col("label"), F.col("aliases"), F.col("sci")).alias("name"))


# ---- terms ----


@case("key VARCHAR, node VARCHAR, words VARCHAR, plain VARCHAR, untagged VARCHAR, cut BIGINT", ("LFQSCWFLJHTTHZ-UHFFFAOYSA-N", "Chemical_ik_LFQSCWFLJHTTHZ_UHFFFAOYSA_N", "has compound", "Salvia officinalis", "sang", 121), ("LFQ", None, "has compound", "Salvia officinalis", "sang", 3))
def term_helpers(spark, d):
    """Keys as nodes, predicates as words, names without ranks and language tags, long labels cut."""
    label = F.when(F.length("key") > 20, F.repeat(F.lit("x"), 200)).otherwise("abc")
    return frame(spark, "key string", "LFQSCWFLJHTTHZ-UHFFFAOYSA-N", "LFQ").select("key", terms.inchikey_local(F.col("key")).alias("node"), terms.words_of_predicate(F.lit("<http://x#hasCompound>")).alias("words"), terms.clean_infraspecific(F.lit("Salvia officinalis var. alba")).alias("plain"), terms.without_language_tag(F.lit("sang [en]")).alias("untagged"), F.length(terms.cut_label(label)).cast("long").alias("cut"))


@case("a BIGINT, b BIGINT", (2000, 2004), (2005, 2009), (2010, 2011))
def year_windows(spark, d):
    """Years that cover a span, five at a time."""
    return frame(spark, "a long, b long", *terms.year_windows(2000, 2011, 5))


@case("pmid VARCHAR, valid BOOLEAN", ("5000000", True), ("4999999", False), ("12a", False), ("38000000", True))
def article_ids(spark, d):
    """Article ids are digits of at least five million."""
    return frame(spark, "pmid string", "5000000", "4999999", "12a", "38000000").select("pmid", terms.valid_pmid(F.col("pmid")).alias("valid"))


@case("uri VARCHAR, ns VARCHAR", ("http://x", "http://x#"), ("http://x/", "http://x/"), ("http://x#", "http://x#"))
def namespaces(spark, d):
    """A namespace ends in # or / (P25)."""
    return frame(spark, "uri string, ns string", *[(u, terms.namespace(u)) for u in ("http://x", "http://x/", "http://x#")])


# ---- ingest and repairs ----


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("<http://x#m1>", "<http://x#hbd>", '"2"^^<http://www.w3.org/2001/XMLSchema#integer>'), ("<http://x#m1>", "<http://x#logp>", '"1.5"^^<http://www.w3.org/2001/XMLSchema#double>'), ("<http://x#m2>", "<http://x#hbd>", '"0"^^<http://www.w3.org/2001/XMLSchema#integer>'))
def descriptors(spark, d):
    """Numbers of molecules as typed literals, missing ones left out."""
    return ingest.descriptor_triples(frame(spark, "node string, hbd int, logp double", ("m1", 2, 1.5), ("m2", 0, None)), "node", {"hbd": "integer", "logp": "double"}, NS)


@case("s VARCHAR, p VARCHAR, o VARCHAR", *[(IRI("ClinicalTrial_CT_NCT00000001"), p, o) for p, o in ((TYPE, IRI("ClinicalTrial")), (LABEL, '"Tea"'), (IRI("hasNCTId"), '"NCT00000001"'), (IRI("hasPhase"), '"2"'), (IRI("hasCondition"), '"Gout"'), (IRI("hasCondition"), '"Pain"'), (IRI("sourceColumn"), '"by_Plant"'), (IRI("sourceColumn"), '"by_Ingredient"'))], (IRI("Aloe_vera"), IRI("hasIngredientClinicalStudy"), IRI("ClinicalTrial_CT_NCT00000001")), (IRI("Aloe_vera"), IRI("hasClinicalStudy"), IRI("ClinicalTrial_CT_NCT00000001")))
def trial_table(spark, d):
    """A trial's node once, its conditions distinct, links to plants or only to their ingredients; other ids don't count (P10)."""
    rows = frame(spark, "plant string, nct string, title string, phase string, condition string, associated_by string", ("Aloe vera", "NCT00000001", "Tea", "2", "Gout", "Association_by_Clinical_Trials_of_Plant"), ("Aloe vera", "NCT00000001", "Tea", "2", "Pain", "by_Ingredient"), ("Aloe vera", "NCT1", "Bad", "2", "Pain", "plant"))
    return ingest.trial_triples(rows, NS).withColumn("o", F.replace("o", F.lit("Association_by_Clinical_Trials_of_Plant"), F.lit("by_Plant")))


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("a", TYPE, "New"), ("b", TYPE, "Kept2"), ("New", LABEL, '"n"'), ("Child", SUB, "Kept"), ("Kept", LABEL, '"k"'))
def retired_class(spark, d):
    """Instances move; a class without subclasses goes, one with a subclass keeps its own triples."""
    t = spo(spark, ("a", TYPE, "Old"), ("Old", LABEL, '"o"'), ("New", LABEL, '"n"'), ("b", TYPE, "Kept"), ("Child", SUB, "Kept"), ("Kept", LABEL, '"k"'))
    return ingest.retire_class(ingest.retire_class(t, "Old", "New"), "Kept", "Kept2")


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("c1", LABEL, '"rutin"'), ("c2", LABEL, '"3-hydroxy"'), ("c3", LABEL, '"old"'), ("c3", "flag", '"true"'), ("c1", "x", "y"))
def applied_names(spark, d):
    """Titles as labels unless they are keys or numbers, else IUPAC names; named nodes lose the placeholder flag (P20)."""
    t = spo(spark, ("c1", LABEL, '"CID 1"'), ("c1", "flag", '"true"'), ("c1", "x", "y"), ("c2", LABEL, '"k"'), ("c3", LABEL, '"old"'), ("c3", "flag", '"true"'))
    names = frame(spark, "node string, title string, iupac string", ("c1", "rutin", "long"), ("c2", "CID 77", "3-hydroxy"), ("c3", "LFQSCWFLJHTTHZ-UHFFFAOYSA-N", None), ("c9", "absent", None))
    return ingest.apply_names(t, names, "flag")


@case("node VARCHAR, label VARCHAR, key VARCHAR, is_placeholder BOOLEAN", ("a", "rutin", "K1", False), ("b", "Compound K2", "K2", True), ("c", "Compound K3", "K3", True))
def placeholders(spark, d):
    """Missing labels made of the key, and marked (M5)."""
    return ingest.with_placeholders(frame(spark, "node string, label string, key string", ("a", " rutin", "K1"), ("b", None, "K2"), ("c", "n.a.", "K3")))


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("<http://x#Gene>", SUB, "<http://x#Thing>"), ("<http://x#Exon>", SUB, "<http://x#Gene>"), ("<http://x#Exon>", LABEL, '"exon"'))
def copied_subtree(spark, d):
    """A class and all below it, without the prefix of their names."""
    t = spo(spark, ("<http://x#ncGene>", SUB, "<http://x#ncThing>"), ("<http://x#ncExon>", SUB, "<http://x#ncGene>"), ("<http://x#ncExon>", LABEL, '"exon"'), ("<http://x#ncOther>", SUB, "<http://x#ncThing>"))
    return ingest.copy_subtree(t, "<http://x#ncGene>", "nc")


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("a", TYPE, "Plant"), ("b", TYPE, "Plant"), ("b", "p", "PlantConcept"))
def retargeted(spark, d):
    """A class renamed where it is a type, and only there."""
    return ingest.retarget_type(spo(spark, ("a", TYPE, "PlantConcept"), ("a", TYPE, "Plant"), ("b", TYPE, "PlantConcept"), ("b", "p", "PlantConcept")), "PlantConcept", "Plant")


@case("p VARCHAR, o VARCHAR", *[(TYPE, f"<{ingest.OWL}Class>")] * 4, (LABEL, '"A"'), (LABEL, '"B"'), (LABEL, '"C"'), (TYPE, f"<{ingest.OWL}ObjectProperty>"), (f"<{ingest.RDFS}domain>", IRI("A")), (f"<{ingest.RDFS}range>", "_:union"), (f"<{ingest.OWL}unionOf>", "_:list"), (f"<{rdfxml.RDF}first>", IRI("B")), (f"<{rdfxml.RDF}rest>", "_:list"), (f"<{rdfxml.RDF}first>", IRI("C")), (f"<{rdfxml.RDF}rest>", f"<{rdfxml.RDF}nil>"), (TYPE, f"<{ingest.OWL}DatatypeProperty>"), (f"<{ingest.RDFS}domain>", IRI("A")), (f"<{ingest.RDFS}range>", f"<{ingest.XSD}double>"), (f"<{ingest.OWL}inverseOf>", IRI("of")))
def schema(spark, d):
    """Classes, properties with domains and ranges of one class or a union, inverses."""
    t = ingest.schema_triples(spark, NS, {"A": "A", "B": "B", "C": "C"}, {"has": (["A"], ["B", "C"])}, {"mass": (["A"], "double")}, {"has": "of"})
    return t.select("p", F.when(F.col("o").startswith("_:u"), "_:union").when(F.col("o").startswith("_:l"), "_:list").otherwise(F.col("o")).alias("o"))


@case("s VARCHAR, p VARCHAR, o VARCHAR", ("<http://x#1>", TYPE, "<http://x#Plant>"), ("<http://x#1>", LABEL, '"Aloe vera"'), ("<http://x#9>", TYPE, "<http://x#Chem>"), ("<http://x#9>", LABEL, '"rutin"'), ("<http://x#1>", "<http://x#has>", "<http://x#9>"))
def declared_build(spark, d):
    """A graph built from a configuration: entities of two classes and a link."""
    config = {"namespace": "http://x", "entities": {"plants": {"class": "Plant", "id": "id", "name": "name"}, "chems": {"class": "Chem", "id": "id", "name": "name"}}, "links": {"pairs": {"from": "plant", "to": "chem", "predicate": "has"}}}
    tables = {"plants": frame(spark, "id string, name string", ("1", "Aloe vera")), "chems": frame(spark, "id int, name string", (9, "rutin")), "pairs": frame(spark, "plant string, chem string", ("1", "9"))}
    return build.build(spark, config, tables)


@case("key VARCHAR, value VARCHAR", ("a", "A"), ("b", None), ("c", "C"))
def looked_up(spark, d):
    """A service as a cached table: unknown keys are fetched once, an empty answer is remembered."""
    table = external.LookupTable(spark, scratch_path(spark, "lookup"), fetch=lambda keys: {k: k.upper() if k != "b" else None for k in keys})
    rows = frame(spark, "key string", "a", "b", "c")
    table.fill(rows.limit(2))
    table.fill(rows)
    return table.join(rows, "key")


# ---- release checks ----


@case("item VARCHAR, n BIGINT", ("triples", 9), ("expected missing", 1), ("forbidden present", 1), ("domain or range", 1), ("datatype", 1), ("invalid IRI", 1))
def release_checks(spark, d):
    """A release's checks as one table: wanted and unwanted triples, domains and ranges, datatypes, IRIs."""
    has, mass, xsd = IRI("has"), IRI("mass"), ingest.XSD
    t = spo(spark, (IRI("a"), TYPE, IRI("Plant")), (IRI("c"), TYPE, IRI("Chem")), (IRI("a"), has, IRI("c")), (IRI("c"), has, IRI("a")), (IRI("c"), mass, f'"1.5"^^<{xsd}double>'), (IRI("a"), mass, f'"2"^^<{xsd}integer>'), ("<http://x/bad iri>", LABEL, '"x"'), (IRI("old"), LABEL, '"gone"'), (IRI("c"), LABEL, '"c"'))
    expected = frame(spark, "s string, p string, o string, present boolean", (IRI("a"), has, IRI("c"), True), (IRI("a"), LABEL, '"a"', True), (IRI("old"), LABEL, '"gone"', False))
    axioms = frame(spark, "p string, side string, classes array<string>", (has, "domain", [IRI("Plant")]))
    types = t.where(F.col("p") == TYPE).select("s", F.col("o").alias("class"))
    groups = frame(spark, "class string, grp string, sub string", (IRI("Plant"), "plant", None), (IRI("Chem"), "chem", None))
    ranges = frame(spark, "p string, dt string", (mass, f"{xsd}double"))
    return audit.release_report(t, expected, axioms, types, groups, ranges)


# ---- decisions, structures, Turtle ----


@case("node VARCHAR, status VARCHAR, keep BOOLEAN", ("a", "ncbi_plant_name", True), ("b", "ncbi_plant_genus", True), ("c", "ncbi_viridiplantae", True), ("d", "ncbi_lineage_not_viridiplantae", False), ("e", "junk_name", False), ("f", "classification_nonplant", False), ("g", "ncbi_viridiplantae_by_name", True), ("h", "unverified", True), ("i", "junk_name", False), ("j", "ncbi_viridiplantae", True))
def plant_statuses(spark, d):
    """What a node's label, lineage and class make of it, in order."""
    rows = frame(spark, "node string, label string, is_plant boolean", ("a", "Panax ginseng", False), ("b", "Panax novus", False), ("c", "Odd thing", True), ("d", "Homo sapiens", False), ("e", "Aloe sp. X1", None), ("f", "Agaric one", None), ("g", "Herb one", None), ("h", "Thing one", None), ("i", "Panax tagged", None), ("j", "Panax engineered", True))
    return evidence.plant_status(rows, frame(spark, "name string", "panax ginseng"), frame(spark, "genus string", "panax"), frame(spark, "node string", "i"), frame(spark, "node string, status string", ("f", "nonplant"), ("g", "plant"))).select("node", "status", "keep")


@case("id BIGINT, level VARCHAR", (1, "species"), (2, "rejected_coarse"), (3, "rejected_coarse"), (4, "unmatched"))
def match_levels(spark, d):
    """Matches of a taxonomy that count for a species."""
    rows = frame(spark, "id long, rank string, kind string, key long", (1, "variety", "Fuzzy", 9), (2, "GENUS", "EXACT", 9), (3, "SPECIES", "HIGHERRANK", 9), (4, None, "NONE", None))
    return rows.select("id", evidence.match_level(F.col("rank"), F.col("kind"), F.col("key")).alias("level"))


@case("node VARCHAR, kingdom VARCHAR", ("panax", "Viridiplantae"), ("virus", "Riboviria"), ("none", "unknown"), ("bare", "taxid:k2"))
def kingdoms(spark, d):
    """The nearest kingdom, else superkingdom, else unknown."""
    edges = frame(spark, "child string, parent string", ("panax", "k"), ("k", "e"), ("virus", "v"), ("bare", "k2"), ("k2", "e"))
    ranks = frame(spark, "node string, rank string, name string", ("k", "kingdom", "Viridiplantae"), ("e", "superkingdom", "Eukaryota"), ("v", "superkingdom", "Riboviria"), ("k2", "kingdom", None))
    return graph.kingdom(edges, frame(spark, "node string", "panax", "virus", "none", "bare"), ranks)


@case("id VARCHAR, name VARCHAR, score DOUBLE", ("c1", "Ginseng", -0.5), ("c2", "Panax", 1.5), ("p2", "ginsengoside plant", 1.0), ("p3", "red ginseng", 2.0), ("p4", "wild ginseng", 2.0))
def suggestions(spark, d):
    """Curated entries half a step ahead, equal names hidden, then the richest."""
    names = frame(spark, "id string, name string, nc long", ("p1", "ginseng", 9), ("p2", "ginsengoside plant", 1), ("p3", "red ginseng", 7), ("p4", "wild ginseng", None), ("p5", "aloe", 3))
    curated = frame(spark, "id string, name string, common string", ("c1", "Ginseng", ""), ("c2", "Panax", "true Ginseng"), ("c3", "Aloe", "aloe"))
    return graph.suggest(names, curated, "ginseng")


@case("id BIGINT, classes VARCHAR", (1, "Polyphenol|Phytosterol"), (2, "Carotenoid|Saponin|Isoprenoid"), (3, "Polysaccharide|DietaryFiber"), (4, "Unknown"), (5, "Unknown"))
def heuristic_classes(spark, d):
    """The deprecated classes of structures by counts of their parts (O3)."""
    from grafloom.functions import chem

    rows = frame(spark, "id long, smiles string, mw double, rings int, hydroxyls int, carbons int, oxygens int, double_bonds int", (1, "C1", 400.0, 4, 2, 27, 2, 0), (2, "CC=CC", 550.0, 2, 0, 40, 5, 9), (3, "OC", 501.0, 1, 9, 21, 16, 0), (4, "CC=C", 42.0, 0, 0, 3, 0, 1), (5, "broken", None, None, None, None, None, None))
    return rows.select("id", F.array_join(chem.heuristic_classes(), "|").alias("classes"))


@case("smiles VARCHAR, bits VARCHAR", ("CCO", "0101"), ("C", None))
def fingerprints_by_smiles(spark, d):
    """Fingerprints joined from a table by the structure's text."""
    rows = formats.read_rows(spark, file(spark, "csv", "smiles,ecfp\nCCO,0101\nN,1111"), ",")
    return frame(spark, "smiles string", "CCO", "C").join(rows, "smiles", "left").select("smiles", F.col("ecfp").alias("bits"))


@case("s VARCHAR, p VARCHAR, o VARCHAR", (IRI("a"), TYPE, IRI("Plant")), (IRI("a"), LABEL, '"Aloe \\"v\\" . ; #"@en'), (IRI("a"), IRI("n"), f'"3"^^<{ingest.XSD}integer>'), (IRI("a"), IRI("n"), f'"2.5"^^<{ingest.XSD}decimal>'), (IRI("a"), IRI("has"), IRI("b.c")), (IRI("a"), IRI("ok"), f'"true"^^<{ingest.XSD}boolean>'), ("_:x", LABEL, '"two\\nlines"'), (IRI("l"), IRI("list"), "_:x"), ("_:x", f"<{rdfxml.RDF}first>", IRI("a")), ("_:x", f"<{rdfxml.RDF}rest>", f"<{rdfxml.RDF}nil>"), (IRI("l"), IRI("node"), "_:x"))
def turtle_read(spark, d):
    """Prefixes, lists of predicates and objects, nested nodes, collections, literals of all kinds."""
    text = f"""@prefix x: <http://x#> . PREFIX rdfs: <{ingest.RDFS}>\n# note\nx:a a x:Plant ; rdfs:label "Aloe \\\\"v\\\\" . ; #"@en ; x:n 3, 2.5 ; x:has x:b.c; x:ok true; .\nx:l x:list (x:a); x:node [ rdfs:label '''two\nlines''' ]."""
    from grafloom.sources import turtle

    t = turtle.read(spark, file(spark, "ttl", text.replace('\\\\"', '\\"')))
    return t.select(*[F.when(F.col(c).startswith("_:"), "_:x").otherwise(F.col(c)).alias(c) for c in T.SPO])


@case("s VARCHAR, p VARCHAR, o VARCHAR", (IRI("a"), TYPE, IRI("Plant")), (IRI("a"), LABEL, '"say \\"x\\"\\n"@en'), (IRI("a/b"), "<http://y/p>", "_:n"))
def turtle_round_trip(spark, d):
    """Triples as Turtle with prefixes, read again."""
    from grafloom.sources import turtle

    path = scratch_path(spark, "ttl")
    turtle.write(spo(spark, (IRI("a"), TYPE, IRI("Plant")), (IRI("a"), LABEL, '"say \\"x\\"\\n"@en'), (IRI("a/b"), "<http://y/p>", "_:n")), path, {"x": NS, "rdfs": ingest.RDFS})
    return turtle.read(spark, path).withColumn("o", F.when(F.col("o").startswith("_:"), "_:n").otherwise(F.col("o")))


@case("s VARCHAR, p VARCHAR, o VARCHAR", (IRI("a"), LABEL, '"Aloe"'), (IRI("a"), TYPE, IRI("Plant")), (IRI("a"), IRI("taxon"), '"34199"'), (IRI("b"), LABEL, '"aloin"'), (IRI("b"), TYPE, IRI("Chemical")), (IRI("a"), IRI("hasCompound"), IRI("b")))
def graph_json(spark, d):
    """A curated subset kept as nodes and edges."""
    text = '{"nodes": {"a": {"label": "Aloe", "role": "Plant", "props": {"taxon": "34199"}}, "b": {"label": "aloin", "role": "Chemical"}}, "edges": [{"s": "a", "t": "b", "p": "hasCompound"}]}'
    return formats.read_graph(spark, file(spark, "json", text), NS)
