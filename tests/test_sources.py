import gzip

import pytest
from pyspark.sql import functions as F

from grafloom.operators import triples as T
from grafloom.plans import build, staged
from grafloom.sources import external, formats, ntriples, rdfxml, sinks
from grafloom.streaming.lookups import merge_stream


def put(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_ntriples(spark, tmp_path):
    put(tmp_path / "a.nt", '<s> <p> "x y ." .\n# c\n<s> <q> _:b .\n')
    with gzip.open(tmp_path / "b.nt.gz", "wt") as f:
        f.write("<s> <p> <o> .\nbroken line\n")
    spec = f"{tmp_path}/a.nt,{tmp_path}/b.nt.gz"
    good, bad = ntriples.read_strict(spark, spec)
    assert {tuple(r) for r in good.collect()} == {("<s>", "<p>", '"x y ."'), ("<s>", "<q>", "_:b"), ("<s>", "<p>", "<o>")} and bad.count() == 1
    ntriples.write(good.union(good), str(tmp_path / "out"))
    assert {tuple(r) for r in ntriples.read(spark, str(tmp_path / "out")).collect()} == {tuple(r) for r in good.collect()}
    lines = [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(lines) == lines and len(lines) == 3


RDF = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:x="http://x#" xml:base="http://b/">
  <rdf:Description rdf:about="http://x#a"><x:p rdf:resource="http://x#b"/><x:l xml:lang="en">Q "q" &amp; z</x:l><x:n rdf:datatype="http://d">1</x:n></rdf:Description>
  <x:Plant rdf:ID="c" x:k="v"><x:has><x:Part rdf:nodeID="n1"/></x:has><x:list rdf:parseType="Collection"><rdf:Description rdf:about="http://x#1"/><rdf:Description rdf:about="http://x#2"/></x:list></x:Plant>
</rdf:RDF>"""


def test_rdfxml(spark, tmp_path):
    path = put(tmp_path / "a.rdf", RDF)
    found = {tuple(r) for r in rdfxml.read(spark, path, drop=("http://x#p",)).collect()}
    assert ("<http://x#a>", "<http://x#l>", '"Q \\"q\\" & z"@en') in found and ("<http://x#a>", "<http://x#n>", '"1"^^<http://d>') in found
    assert ("<http://b/#c>", "<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>", "<http://x#Plant>") in found and ("<http://b/#c>", "<http://x#k>", '"v"') in found
    assert len([1 for _, p, _ in found if p.endswith("#first>")]) == 2 and not [1 for _, p, _ in found if p == "<http://x#p>"]
    assert spark.createDataFrame(list(found), "s string, p string, o string").where("s like '\\_:%n1' and o = '<http://x#Part>'").count() == 1
    assert rdfxml.well_formed(spark, path).first()["error"] is None
    put(tmp_path / "bad.rdf", RDF[:-20])
    assert rdfxml.well_formed(spark, str(tmp_path / "bad.rdf")).first()["error"]


def test_rdfxml_round_trip(spark, tmp_path):
    t = T.from_rows(spark, [("<http://x#a>", "<http://x#p>", "<http://x#b?a&b>"), ("<http://x#a>", "<http://x#l>", '"a <b> \\"c\\"\\n"@en'), ("<http://x#a>", "<http://x#n>", '"1"^^<http://d>'), ("<http://x#z>", "<http://x#p>", "<http://x#a>")])
    rdfxml.write(t, str(tmp_path / "out"), {"x": "http://x#"})
    document = "\n".join(r[0] for p in sorted((tmp_path / "out").glob("part-*")) for r in spark.read.text(str(p)).collect())
    path = put(tmp_path / "b.rdf", document)
    want = {tuple(r) for r in t.collect()}
    assert {tuple(r) for r in rdfxml.read(spark, path).collect()} == want
    assert {tuple(r) for r in rdfxml.read_split(spark, path, piece_bytes=50).collect()} == want
    rdfxml.write(t, str(tmp_path / "parts"), {"x": "http://x#"}, whole_parts=True)
    assert {tuple(r) for r in rdfxml.read(spark, str(tmp_path / "parts")).collect()} == want


def test_rdfxml_is_split_anywhere(spark, tmp_path):
    """Comments that hold tags, nested elements of one name, CDATA and `>` in values, cut at every few bytes."""
    odd = "<!-- </rdf:Description> <x:P> " + "<" * 30 + " -->"
    body = "".join(f'{odd if i % 3 == 0 else ""}<x:P rdf:about="http://x#{i}" x:k="a > b"><x:has><x:P rdf:about="http://x#{i}n"><x:t><![CDATA[</x:P> & <]]></x:t></x:P></x:has><x:has rdf:parseType="Resource"><x:v>{i}</x:v></x:has></x:P><rdf:Description rdf:about="http://x#{i}e" x:k="v"/>' for i in range(12))
    path = put(tmp_path / "c.rdf", RDF[: RDF.index("  <rdf:Description")].replace("<rdf:RDF", "<!DOCTYPE rdf:RDF [<!ENTITY z 'zz'>]>\n<!-- head <x> --><rdf:RDF") + body + "<?pi <x> ?></rdf:RDF>")
    plain = lambda df: sorted((s[:14] if s[0] == "_" else s, p, "_" if o[0] == "_" else o) for s, p, o in df.collect())
    want = plain(rdfxml.read(spark, path))
    assert len(want) == 12 * 8
    for size in (7, 100, 333, 100_000):
        found = rdfxml.read_split(spark, path, piece_bytes=size)
        assert [(p, o) for _, p, o in plain(found)] and sorted((p, o) for _, p, o in plain(found)) == sorted((p, o) for _, p, o in want), size
        assert found.where("s like '\\_:%'").select("s").distinct().count() == 12


GOOD = "".join(f'<x:P rdf:about="http://x#{i}"><x:n>{i} &lt; </x:n></x:P>\n<!-- </x:P> & -->' for i in range(9))
ODD = {
    "whole": (GOOD, True), "nothing inside": ("", True), "behind": (GOOD + "</rdf:RDF>  \n<!-- end -->\n", True), "junk behind": (GOOD + "</rdf:RDF>  \n<x/>", False), "text behind": (GOOD + "</rdf:RDF> text", False),
    "unclosed": (GOOD + "<x:P>", False), "closed twice": (GOOD + "</x:P>" + GOOD, False), "ampersand between": (GOOD + " & " + GOOD, False), "text between": (GOOD + " text " + GOOD, True), "bad name": (GOOD + "<1x/>" + GOOD, False),
    "crossed": (GOOD + "<x:a><x:b></x:a></x:b>" + GOOD, False), "less than": (GOOD + "<x:a> < </x:a>" + GOOD, False), "no prefix": (GOOD + "<q:a/>", False), "open comment": (GOOD + "<!-- ", False), "twice an attribute": (GOOD + '<x:a x:b="1" x:b="2"/>', False),
}


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_well_formed_by_ranges(spark, tmp_path, size):
    """What a parser says of a whole file, said range by range; breaks at either end and between elements."""
    head = '<?xml version="1.0"?>\n<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:x="http://x#">'
    for name, (body, _) in ODD.items():
        put(tmp_path / f"{name}.rdf", head + body + ("" if "</rdf:RDF>" in body else "</rdf:RDF>"))
    put(tmp_path / "cut.rdf", head + GOOD), put(tmp_path / "text.rdf", "no tag"), put(tmp_path / "single.rdf", head[:-1] + "/>")
    want = {n: good for n, (_, good) in ODD.items()} | {"cut": False, "text": False, "single": True}
    found = {r["path"].rsplit("/", 1)[1].replace("%20", " ")[:-4]: (r["error"] is None, r["triples"]) for r in rdfxml.well_formed(spark, str(tmp_path), size).collect()}
    assert {n: x[0] for n, x in found.items()} == want
    assert found["whole"][1] == found["behind"][1] == 18 and found["text between"][1] == 36


def test_delimited(spark, tmp_path):
    path = put(tmp_path / "a.tsv", "# note\nPlant_ID\t Name \n1\tCafé\n2\n", "latin-1")
    assert formats.sniff_encoding(spark, path) == "ISO-8859-1" and formats.sniff_delimiter(spark, path) == "\t"
    rows = formats.read_rows(spark, path, columns=["Plant_ID", "Name", "None"], rename={"Plant_ID": "id"}).collect()
    assert [tuple(r) for r in rows] == [("1", "Café", None), ("2", None, None)]
    bare = put(tmp_path / "b.csv", "1;x\n2;y\n")
    assert [tuple(r) for r in formats.read_rows(spark, bare, names=["a", "b"]).collect()] == [("1", "x"), ("2", "y")]
    assert formats.resolve_column(["Smiles ", "X"], ["smi", "SMILES"]) == "Smiles " and formats.resolve_column(["a"], ["b"]) is None


def test_taxonomy(spark, tmp_path):
    nodes = put(tmp_path / "nodes.dmp", "1\t|\t1\t|\tno rank\t|\n4053\t|\t1\t|\tgenus\t|\t\t|\n")
    names = put(tmp_path / "names.dmp", "5\t|\tPanax  L.\t|\t\t|\tsynonym\t|\n4\t|\tpanax l.\t|\t\t|\tcommon name\t|\n4053\t|\tPanax\t|\t\t|\tscientific name\t|\n9\t|\tPanax\t|\t\t|\tsynonym\t|\n3\t|\tx\t|\t\t|\ttype material\t|\n")
    assert {tuple(r) for r in formats.taxonomy_nodes(spark, nodes).collect()} == {(1, 1, "no rank"), (4053, 1, "genus")}
    assert {tuple(r) for r in formats.taxonomy_names(spark, names).collect()} == {("panax l.", 4), ("panax", 4053)}


def test_records(spark, tmp_path):
    sdf = put(tmp_path / "a.sdf", "mol\n> <identifier>\nCNP1\n\n> <name>\nFoo\nbar\n\n$$$$\nm\n> <identifier> (2)\nCNP2\n\n$$$$\n")
    assert [tuple(r) for r in formats.read_sdf(spark, sdf, ["identifier", "name"]).collect()] == [("CNP1", "Foo bar"), ("CNP2", None)]
    assert formats.read_sdf(spark, sdf, ["name"], "first").first()[0] == "Foo"
    obo = put(tmp_path / "d.obo", "format-version: 1\n\n[Term]\nid: DOID:1\nname: a\nis_a: DOID:2 ! b\nis_a: DOID:3\n\n[Term]\nid: DOID:4\nis_obsolete: true\n\n[Typedef]\nid: x\n")
    assert [tuple(r) for r in formats.read_obo(spark, obo).collect()] == [("DOID:1", "a", ["DOID:2", "DOID:3"])]
    tsv = put(tmp_path / "g.tsv", "E1\tABC\tDOID:7\tflu\t1.5\tx\t4.5\nE2\tDEF\tnone\n")
    assert [tuple(r) for r in formats.read_gene_disease(spark, tsv).collect()] == [("abc", "DOID:7", "flu", 4.5)]
    xml = put(tmp_path / "g.rdf", '<r><Gene rdf:about="#gene_x"><commonName rdf:datatype="s">X</commonName><geneInPathway rdf:resource="#p1"/><geneInPathway rdf:resource="#p2"/></Gene>\n<Gene rdf:about="#gene_y"></Gene></r>')
    assert [tuple(r) for r in formats.read_xml_blocks(spark, xml, "Gene", {"name": "commonName"}, {"pathways": "geneInPathway"}).collect()] == [("gene_x", "X", ["p1", "p2"]), ("gene_y", None, [])]


def test_articles(spark, tmp_path):
    from grafloom.functions import mining

    path = put(
        tmp_path / "p.xml",
        '<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID Version="1">7</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><Year>2001</Year></PubDate></JournalIssue></Journal><ArticleTitle>Panax ginseng roots and <i>quercetin</i></ArticleTitle><Abstract><AbstractText>The plant is used for treating fever. Commonly known as red ginseng, sang and ren shen.</AbstractText></Abstract></Article><MeshHeadingList><DescriptorName UI="D">Plants, Medicinal</DescriptorName></MeshHeadingList></MedlineCitation><ArticleId IdType="doi">10.1/X</ArticleId></PubmedArticle></PubmedArticleSet>',
    )
    rows = formats.read_articles(spark, path)
    r = rows.first()
    assert (r["pmid"], r["year"], r["doi"], r["mesh"]) == ("7", "2001", "10.1/x", ["Plants, Medicinal"])
    out = mining.mine(rows).collect()
    assert out == [] and rows.select(mining.compounds(F.col("title"))).first()[0] == ["quercetin"]  # "ginseng" has no Latin ending
    assert rows.select(mining.vernacular_names(F.col("abstract"))).first()[0] == ["red ginseng", "sang", "ren shen"]
    assert tuple(mining.funnel(rows).first())[:3] == (1, 1, 0)


def test_json(spark, tmp_path):
    a = put(tmp_path / "m.json", '{"p1": ["c1", "c2"], "p2": []}')
    assert {r["key"]: r["value"] for r in formats.read_json_map(spark, a, "array<string>").collect()} == {"p1": ["c1", "c2"], "p2": []}
    b = put(tmp_path / "i.json", '[{"id": "x", "nc": 2}]')
    assert [tuple(r) for r in formats.read_json_array(spark, b, "struct<id:string,nc:long>").collect()] == [("x", 2)]
    indented = put(tmp_path / "n.json", '{\n  "p1": ["c1",\n "c2"],\n  "p2": []\n}\n')
    assert {r["key"]: r["value"] for r in formats.read_json_map(spark, indented, "array<string>").collect()} == {"p1": ["c1", "c2"], "p2": []}
    lines = put(tmp_path / "j.json", '[\n  {"id": "x", "nc": 2},\n  {"id": "y"}\n]')
    assert sorted(tuple(r) for r in formats.read_json_array(spark, lines, "struct<id:string,nc:long>").collect()) == [("x", 2), ("y", None)]
    g = put(tmp_path / "g.json", '{\n "nodes": {\n  "a": {"label": "A", "role": "R", "props": {}}},\n "edges": []\n}')
    assert formats.read_graph(spark, g, "http://x#").count() == 2
    broken = put(tmp_path / "b.json", '{"p1": ["c1"')
    for read in (formats.read_json_map, formats.read_shards):
        with pytest.raises(Exception, match="not the JSON"):
            read(spark, broken, "array<string>").collect()
    c = put(tmp_path / "l.jsonl", '{"ik": "K", "sources": {"a": ["1"]}}\nbroken{\n')
    assert formats.read_json_lines(spark, c, "ik string, sources map<string,array<string>>").count() == 1


@pytest.mark.parametrize(("most_entries", "parts"), [(1000, 1), (2, 2)])
def test_shards_of_several_keys(spark, tmp_path, most_entries, parts):
    # djb2 of three letters repeats: many of these keys share a shard
    keys = [f"{a}{b}{c}" for a in "abcd" for b in "abcdef" for c in "ghijkl"] + ['q"uote', "új}", "br{ace", "li\nne"]
    rows = spark.createDataFrame([(k, len(k)) for k in keys], "id string, n int").repartition(4)
    path = str(tmp_path / "s")
    sinks.write_shards(rows, path, "id", F.struct("n", F.array(F.lit("}")).alias("x")), most_entries)
    assert sorted((r["key"], r["value"]["n"]) for r in formats.read_shards(spark, path, "struct<n:int,x:array<string>>").collect()) == sorted((k, len(k)) for k in keys)
    assert sorted(r["key"] for r in formats.read_json_map(spark, path, "struct<n:int>").collect()) == sorted(keys)  # each file is a JSON object
    per = spark.read.text(path).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("part").alias("parts")).collect()
    assert max(r["n"] for r in per) > 2 and max(r["parts"] for r in per) >= parts


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("Plant_Panax_ginseng", 2), ("Organism_227", 1)], "id string, n int")
    sinks.write_shards(rows, str(tmp_path / "s"), "id", F.struct("n"))
    assert {r["shard"]: r["value"] for r in spark.read.text(str(tmp_path / "s")).collect()} == {91: '{"Plant_Panax_ginseng":{"n":2}}', 207: '{"Organism_227":{"n":1}}'}
    sinks.write_report(rows, str(tmp_path / "r"), ["two plants"])
    assert formats.read_rows(spark, str(tmp_path / "r"), "\t").count() == 2
    sinks.write_index(rows, str(tmp_path / "i"), F.desc("n"))
    assert spark.read.json(str(tmp_path / "i")).count() == 2
    first = sinks.write_version(rows, str(tmp_path / "v"))
    second = sinks.write_version(rows, str(tmp_path / "v"))
    assert sinks.newest_version(spark, str(tmp_path / "v")).endswith(second.rsplit("/", 1)[1]) and first < second
    assert '"@id":"Organism_227"' in sinks.json_ld(rows, "id", "Plant", {"n": "http://x#n"}).where("value like '%227%'").first()[0]
    kept, gone = sinks.split_removed(rows, F.col("n") > 1)
    assert (kept.count(), gone.count()) == (1, 1)


def test_lookup_table(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def fetch(keys):
        with open(calls, "a") as f:
            f.write(",".join(keys) + ";")
        return {k: k.upper() if k != "none" else None for k in keys if k != "fails"}

    look = external.LookupTable(spark, str(tmp_path / "cache"), fetch, batch=2)
    rows = spark.createDataFrame([("a",), ("b",), ("none",), ("fails",), (None,)], "k string")
    look.fill(rows)
    assert {r["k"]: r["value"] for r in look.join(rows, "k").collect()} == {"a": "A", "b": "B", "none": None, "fails": None, None: None}
    assert [r["key"] for r in look.todo(rows).collect()] == ["fails"]
    with pytest.raises(ValueError):
        external.jdbc(spark, "select 1")
    assert external.sql(spark, {"t": rows}, "select count(*) as n from {t}").first()["n"] == 5


def test_staging(tmp_path):
    import zipfile

    put(tmp_path / "x.txt", "hi")
    assert external.first_existing([str(tmp_path)], "y.txt", "x.txt").endswith("x.txt") and external.first_existing([str(tmp_path)], "q", required=False) is None
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("d/in.txt", "inside")
    assert open(external.unzip_member(str(tmp_path / "z.zip"), "d/in.txt", str(tmp_path))).read() == "inside"
    assert open(external.stage_file((tmp_path / "x.txt").as_uri(), str(tmp_path / "copy"))).read() == "hi"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: merge_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), "ik string, v string", "ik").awaitTermination()
    put(tmp_path / "in/a.json", '{"ik":"1","v":"b"}\n{"ik":"1","v":"a"}\n')
    run()
    put(tmp_path / "in/b.json", '{"ik":"1","v":"c"}\n{"ik":"2","v":"d"}\n')
    run()
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("1", "a"), ("2", "d")]


def test_build(spark, tmp_path):
    plants = put(tmp_path / "p.tsv", "pid\tname\n1\tPanax\n\tAloe\n\t\n")
    config = {"namespace": "http://x", "files": {"plants": {"path": plants, "sep": "\t"}}, "entities": {"plants": {"class": "Plant", "id": "pid", "name": "name"}}, "links": {"has": {"from": "a", "to": "b", "predicate": "has"}}}
    links = spark.createDataFrame([("1", "c"), ("1", None)], "a string, b string")
    found = {tuple(r) for r in build.build(spark, config, {"has": links}).collect()}
    assert ("<http://x#1>", "<http://x#has>", "<http://x#c>") in found and len(found) == 5
    import json

    put(tmp_path / "c.json", json.dumps(config))
    assert build.build_and_export(spark, str(tmp_path / "c.json"), str(tmp_path / "o"), {"has": links})["triples"] == 5


def test_staged(spark, tmp_path):
    made = []

    def stage(name, n):
        def make(prev):
            made.append(name)
            return spark.range(n) if prev is None else prev.limit(n)

        return staged.Stage(name, make)

    stages = [stage("a", 5), stage("b", 3)]
    run = staged.Pipeline(spark, str(tmp_path), stages)
    assert run.run().count() == 3 and run.run().count() == 3 and made == ["a", "b"]
    assert run.run(only=["b"]).count() == 3 and made == ["a", "b", "b"] and run.manifest()["b"]["rows"] == 3
    failing = staged.Pipeline(spark, str(tmp_path), [*stages, staged.Stage("c", lambda _: 1 / 0)])
    with pytest.raises(ZeroDivisionError):
        failing.run()
    assert failing.manifest()["c"]["status"] == "failed"
    with pytest.raises(ValueError):
        staged.select(stages, only=["x"])


def test_chemistry_needs_its_package(spark):
    from grafloom.functions import chem

    if __import__("importlib").util.find_spec("rdkit") is None:
        with pytest.raises(Exception, match="rdkit"):
            spark.createDataFrame([("C",)], "s string").select(chem.inchikey()("s")).collect()


def test_turtle_that_is_not_read():
    from grafloom.sources import turtle

    for bad in ("x:a a x:B .", "<a> <b> <c>", '<a> <b> "c', "<a> <b> <c> ; <d> .", "@prefix x: <http://x#> x:a x:b x:c ."):
        with pytest.raises(ValueError):
            list(turtle.parse(bad))
    assert list(turtle.parse("<a> <b> ( ) . [] <p> 1e3 .")) == [[("<a>", "<b>", f"<{rdfxml.RDF}nil>")], [("_:bg1", "<p>", '"1e3"^^<http://www.w3.org/2001/XMLSchema#double>')]]
