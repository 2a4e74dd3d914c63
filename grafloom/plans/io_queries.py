"""Queries that write a format into the shared folder and read it back, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.operators import evidence
from grafloom.operators import triples as T
from grafloom.plans import views as V
from grafloom.scratch import scratch_path
from grafloom.sources import formats, ntriples, rdfxml, sinks

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"SELECT DISTINCT s, p, o FROM ({V.LITERALS_SQL})")
def ntriples_round_trip(spark, d):
    """A1, A2, B1, B2: written sorted and distinct, gzipped, read again."""
    path = scratch_path(spark, "nt")
    ntriples.write(V.literals(spark, d), path, "gzip")
    return ntriples.read(spark, path)


@query(f"SELECT 'bad' AS kind, count(*) AS n FROM supplier UNION ALL SELECT 'good', count(*) FROM (SELECT '<x:' || s_suppkey || '>' FROM supplier)")
def ntriples_strict(spark, d):
    """A4: lines that aren't triples are kept apart and counted."""
    path, s = scratch_path(spark, "nt"), V.table(spark, d, "supplier")
    good = s.select(F.concat(F.lit("<x:"), F.col("s_suppkey").cast("string"), F.lit('> <x:name> "'), "s_name", F.lit('" .')).alias("value"))
    good.union(s.select(F.concat(F.lit("<x:"), F.col("s_suppkey").cast("string"), F.lit("> broken")))).write.text(path)
    a, b = ntriples.read_strict(spark, path)
    return a.agg(F.lit("good").alias("kind"), F.count("*").alias("n")).unionByName(b.agg(F.lit("bad").alias("kind"), F.count("*").alias("n")))


@query("""SELECT '<http://x#' || s_suppkey || '>' AS s, unnest([{'p': '<http://x#name>', 'o': '"' || s_name || ' & <co>"@en'}, {'p': '<http://x#nation>', 'o': '<http://x#n' || s_nationkey || '>'}, {'p': '<http://x#key>', 'o': '"' || s_suppkey || '"^^<http://www.w3.org/2001/XMLSchema#integer>'}], recursive := true) FROM supplier""")
def rdfxml_round_trip(spark, d):
    """One element a subject, written in parts, read by ranges of bytes."""
    s = V.table(spark, d, "supplier")
    t = T.unpivot(s, terms.iri(F.col("s_suppkey").cast("string"), "http://x#"), {"<http://x#name>": terms.nt_literal(F.concat("s_name", F.lit(" & <co>")), language="en"), "<http://x#nation>": terms.iri(V.node("n", "s_nationkey"), "http://x#"), "<http://x#key>": terms.nt_literal(F.col("s_suppkey").cast("string"), "http://www.w3.org/2001/XMLSchema#integer")})
    path = scratch_path(spark, "rdf")
    rdfxml.write(t, path, {"x": "http://x#"}, whole_parts=True)
    return rdfxml.read_split(spark, path, piece_bytes=1 << 16)


@query("SELECT c_custkey::VARCHAR AS id, c_name AS name, NULL::VARCHAR AS missing FROM customer")
def delimited_round_trip(spark, d):
    """A report with notes, read by chosen and renamed columns."""
    path = scratch_path(spark, "tsv")
    sinks.write_report(V.table(spark, d, "customer"), path, ["customers"])
    return formats.read_rows(spark, path, "\t", ["c_custkey", "c_name", "missing"], {"c_custkey": "id", "c_name": "name"})


def _shards(spark, d):
    """(key, item) of all suppliers, written to 256 shards of JSON objects and read back from all of them."""
    path = scratch_path(spark, "shards")
    rows = V.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("key")).agg(F.array_sort(F.collect_set("l_partkey")).alias("items"))
    sinks.write_shards(rows, path, "key", F.col("items"))
    return formats.read_shards(spark, path, "array<long>").select("key", F.explode("value").alias("item"))


@query("SELECT DISTINCT l_suppkey::VARCHAR AS key, l_partkey AS item FROM lineitem")
def json_shards(spark, d):
    """All suppliers sharded and read back."""
    return _shards(spark, d)


@query("""SELECT user_id::VARCHAR AS key, array_to_string(list(event_id ORDER BY event_id)[1:3], ',') AS items, count(*) AS n FROM events GROUP BY 1""")
def evidence_shards(spark, d):
    """Capped lists with their full counts, in shards."""
    path = scratch_path(spark, "evidence")
    rows = evidence.capped_lists(V.table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), "event_id"), "key", [F.col("event_id")], F.col("event_id"), 3)
    sinks.write_shards(rows, path, "key", F.struct("items", "n"))
    return formats.read_shards(spark, path, "struct<items:array<long>,n:long>").select("key", F.array_join(F.transform("value.items", lambda x: x.cast("string")), ",").alias("items"), "value.n")


@query("SELECT event_id, event_type FROM events WHERE event_id % 10 <> 0")
def json_lines(spark, d):
    """Lines that don't parse are left out."""
    path, e = scratch_path(spark, "jsonl"), V.table(spark, d, "events")
    whole = F.to_json(F.struct("event_id", "event_type"))
    e.select(F.when(F.col("event_id") % 10 == 0, F.substring(whole, 1, 9)).otherwise(whole).alias("value")).write.text(path)
    return formats.read_json_lines(spark, path, "event_id long, event_type string")


@query("SELECT p_partkey::VARCHAR AS identifier, p_name || ' ' || p_type AS name, CASE WHEN p_size % 2 = 0 THEN p_brand END AS brand FROM part")
def sdf_records(spark, d):
    """Values of several lines joined, missing tags null."""
    path, p = scratch_path(spark, "sdf"), V.table(spark, d, "part")
    text = F.concat(F.lit("\n  mol\n> <identifier>\n"), F.col("p_partkey").cast("string"), F.lit("\n\n> <name>\n"), "p_name", F.lit("\n"), "p_type", F.lit("\n\n"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("> <brand>\n"), "p_brand", F.lit("\n\n"))).otherwise(""))
    p.select(text.alias("value")).write.option("lineSep", "$$$$").text(path)
    return formats.read_sdf(spark, path, ["identifier", "name", "brand"])


@query("SELECT 'DOID:' || n_nationkey AS id, n_name AS name, 'DOID:' || (100 + n_regionkey) AS parent FROM nation WHERE n_nationkey % 5 <> 0")
def obo_terms(spark, d):
    """Stanzas without obsolete terms, parents exploded."""
    path, n = scratch_path(spark, "obo"), V.table(spark, d, "nation")
    text = F.concat(F.lit("[Term]\nid: DOID:"), F.col("n_nationkey").cast("string"), F.lit("\nname: "), "n_name", F.lit("\nis_a: DOID:"), (100 + F.col("n_regionkey")).cast("string"), F.lit(" ! x"), F.when(F.col("n_nationkey") % 5 == 0, "\nis_obsolete: true").otherwise(""))
    n.select(text.alias("value")).write.option("lineSep", "\n\n").text(path)
    return formats.read_obo(spark, path).select("id", "name", F.explode("parents").alias("parent"))


@query("""SELECT lower(p_name) AS name, coalesce(max(CASE WHEN p_size > 25 THEN p_partkey END), min(p_partkey)) AS taxid FROM part GROUP BY 1""")
def taxonomy_names(spark, d):
    """Scientific names win, of several the last; else the first."""
    path, p = scratch_path(spark, "dmp"), V.table(spark, d, "part")
    sep = F.lit("\t|\t")
    p.select(F.concat(F.col("p_partkey").cast("string"), sep, "p_name", sep, F.lit(""), sep, F.when(F.col("p_size") > 25, "scientific name").otherwise("synonym"), F.lit("\t|")).alias("value")).write.text(path)
    return formats.taxonomy_names(spark, path)


@query("""SELECT 'gene' || s_suppkey AS symbol, 'DOID:' || s_nationkey AS doid, s_name AS name, s_nationkey + 0.5::DOUBLE AS confidence FROM supplier WHERE s_nationkey + 0.5 >= 5""")
def gene_disease_table(spark, d):
    """The disease in any cell, the last number as confidence, a least one kept."""
    path, s = scratch_path(spark, "tsv"), V.table(spark, d, "supplier")
    s.select(F.concat_ws("\t", F.lit("E1"), F.concat(F.lit("GENE"), F.col("s_suppkey").cast("string")), F.concat(F.lit("DOID:"), F.col("s_nationkey").cast("string")), "s_name", F.lit("3"), (F.col("s_nationkey") + 0.5).cast("string")).alias("value")).write.text(path)
    return formats.read_gene_disease(spark, path, 5.0)


@query("SELECT 'gene_' || s_suppkey AS id, s_name AS label, 'pathway_' || s_nationkey AS pathway FROM supplier")
def xml_blocks(spark, d):
    """Elements of one tag with a field and a list of references."""
    path, s = scratch_path(spark, "xml"), V.table(spark, d, "supplier")
    s.select(F.concat(F.lit('<Gene rdf:about="#gene_'), F.col("s_suppkey").cast("string"), F.lit('"><commonName rdf:datatype="s">'), "s_name", F.lit('</commonName><geneInPathway rdf:resource="#pathway_'), F.col("s_nationkey").cast("string"), F.lit('"/></Gene>')).alias("value")).write.text(path)
    return formats.read_xml_blocks(spark, path, "Gene", {"label": "commonName"}, {"pathways": "geneInPathway"}).select("id", "label", F.explode("pathways").alias("pathway"))


@query("SELECT user_id, min(event_type) AS event_type FROM events GROUP BY 1")
def stream_merge(spark, d):
    """A file stream merged by key, run twice; the second run adds nothing."""
    from grafloom.streaming.lookups import merge_stream

    source, target, cp = (scratch_path(spark, x) for x in ("stream", "merged", "cp"))
    V.table(spark, d, "events").select("user_id", "event_type").coalesce(4).write.json(source)
    for _ in range(2):
        merge_stream(spark, source, target, cp, "user_id long, event_type string", "user_id").awaitTermination()
    return spark.read.parquet(target)


@query("SELECT s_suppkey::VARCHAR AS id, s_name AS name FROM supplier")
def json_ld_slice(spark, d):
    """JSON-LD objects of a slice, parsed again."""
    rows = V.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    out = sinks.json_ld(rows, "id", "Plant", {"name": "http://x#name"})
    return out.select(F.get_json_object("value", "$['@id']").alias("id"), F.get_json_object("value", "$.name").alias("name"))


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey < 10")
def versions(spark, d):
    """The newest of two versions, without removed rows."""
    root, s = scratch_path(spark, "versions"), V.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    sinks.write_version(s, root)
    sinks.write_version(sinks.split_removed(s, F.col("s_nationkey") < 10)[0], root)
    return spark.read.parquet(sinks.newest_version(spark, root)).drop("s_nationkey")
