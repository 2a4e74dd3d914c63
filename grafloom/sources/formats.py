"""The other file formats: delimited text, taxonomy dumps, SDF, OBO, XML and JSON. Files are read by Spark, so any store will do."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.functions import terms

# ---- delimited text ----


def head_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """The first line that isn't a comment."""
    rows = spark.read.option("encoding", encoding).text(path).where("value not like '#%'").limit(1).collect()
    return rows[0][0] if rows else ""


def sniff_delimiter(spark: SparkSession, path: str, candidates: str = "|\t,;") -> str:
    """The candidate that is most frequent in the head."""
    head = head_line(spark, path)
    return max(candidates, key=lambda c: (head.count(c), -candidates.index(c)))


def sniff_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8, or ISO-8859-1 if the file isn't valid UTF-8."""
    bad = spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count()
    return "ISO-8859-1" if bad else "UTF-8"


def resolve_column(columns: Sequence[str], candidates: Sequence[str], ignore_case: bool = True) -> str | None:
    """The first candidate that is among the columns, as it is written there."""
    fold = (lambda x: x.strip().lower()) if ignore_case else (lambda x: x)
    there = {}
    for c in columns:
        there.setdefault(fold(c), c)
    return next((there[fold(x)] for x in candidates if fold(x) in there), None)


def read_rows(spark: SparkSession, path: str, sep: str | None = None, columns: Sequence[str] | None = None, rename: Mapping[str, str] | None = None, header: bool = True, names: Sequence[str] | None = None, encoding: str | None = None, comment: str | None = "#") -> DataFrame:
    """Delimited text, all strings: the wanted columns (those missing as null), then renamed. Without a header the names are given."""
    reader = spark.read.option("sep", sep or sniff_delimiter(spark, path)).option("encoding", encoding or sniff_encoding(spark, path)).option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"')
    if comment:
        reader = reader.option("comment", comment)
    if header and names is None:
        df = reader.option("header", True).csv(path)
        df = df.toDF(*[c.strip() for c in df.columns])
    else:
        df = reader.schema(", ".join(f"`{n}` string" for n in names)).csv(path)
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    return df.withColumnsRenamed(dict(rename or {}))


# ---- taxonomy dumps ----


def _dump(spark: SparkSession, path: str):
    return spark.read.text(path).select(F.split(F.regexp_replace("value", r"\t\|\s*$", ""), r"\t\|\t").alias("f"))


def taxonomy_nodes(spark: SparkSession, path: str) -> DataFrame:
    return _dump(spark, path).select(F.trim(F.get("f", F.lit(0))).cast("long").alias("taxid"), F.trim(F.get("f", F.lit(1))).cast("long").alias("parent"), F.trim(F.get("f", F.lit(2))).alias("rank"))


# The classes of names that can resolve a name.
NAME_CLASSES = ("scientific name", "synonym", "equivalent name", "genbank synonym", "common name", "genbank common name", "includes")


def taxonomy_names(spark: SparkSession, path: str) -> DataFrame:
    """(name, taxid): one id for each normalised name. Scientific names win; of several the largest id does, of several others the smallest."""
    f = _dump(spark, path).select(F.trim(F.get("f", F.lit(0))).cast("long").alias("taxid"), terms.normalize_text(F.get("f", F.lit(1))).alias("name"), F.trim(F.get("f", F.lit(3))).alias("kind"))
    f = f.where(F.col("kind").isin(*NAME_CLASSES) & (F.col("name") != ""))
    sci = F.col("kind") == "scientific name"
    return f.groupBy("name").agg(F.coalesce(F.max(F.when(sci, F.col("taxid"))), F.min("taxid")).alias("taxid"))


# ---- records in text ----


def read_sdf(spark: SparkSession, path: str, tags: Sequence[str], multiline: str = "join") -> DataFrame:
    """A row per SDF record with the values of the tags; lines of a value are joined by a space, or the `first` is taken."""
    records = spark.read.option("lineSep", "$$$$").text(path).where(F.col("value").rlike(r"\S"))
    cols = []
    for t in tags:
        raw = F.regexp_extract("value", rf"(?s)>\s*<{t}>[^\n]*\n(.*?)(?:\r?\n\r?\n|\r?\n>|\s*$)", 1)
        parts = F.filter(F.transform(F.split(raw, r"\r?\n"), terms.strip), lambda x: x != "")
        cols.append(F.nullif(F.array_join(parts, " ") if multiline == "join" else F.coalesce(F.get(parts, F.lit(0)), F.lit("")), F.lit("")).alias(t))
    return records.select(*cols)


def read_obo(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, parents) of the terms that aren't obsolete."""
    stanzas = spark.read.option("lineSep", "\n\n").text(path).where(F.col("value").contains("[Term]") & ~F.col("value").rlike(r"(?m)^is_obsolete:\s*true"))
    one = lambda tag: F.regexp_extract("value", rf"(?m)^{tag}:\s*(.*?)\s*$", 1)
    return stanzas.select(one("id").alias("id"), one("name").alias("name"), F.regexp_extract_all("value", F.lit(r"(?m)^is_a:\s*(\S+)"), F.lit(1)).alias("parents")).where("id <> ''")


def read_gene_disease(spark: SparkSession, path: str, least: float = 0.0) -> DataFrame:
    """(symbol, doid, name, confidence) of rows with a DOID in any cell: the name is in the next cell, the confidence the last number."""
    cells = F.transform(F.split("value", "\t"), terms.strip)
    rows = spark.read.text(path).select(cells.alias("c"))
    at = F.array_position(F.transform("c", lambda x: x.rlike(r"^DOID:\d+$")), True).cast("int")
    number = F.filter(F.transform("c", lambda x: x.try_cast("double")), lambda x: x.isNotNull())
    out = rows.withColumn("at", at).where("at > 0").select(F.lower(F.get("c", F.lit(1))).alias("symbol"), F.get("c", F.col("at") - 1).alias("doid"), F.get("c", F.col("at")).alias("name"), F.try_element_at(number, F.lit(-1)).alias("confidence"))
    return out.where(F.coalesce("confidence", F.lit(0.0)) >= least)


# ---- XML ----


def read_xml_blocks(spark: SparkSession, path: str, tag: str, fields: Mapping[str, str], lists: Mapping[str, str] | None = None) -> DataFrame:
    """A row per <tag> element: `id` from rdf:about, the text of one child for each field, the rdf:resource of all for each list."""
    close = f"</{tag}>"
    pieces = spark.read.option("lineSep", close).text(path).where(F.col("value").rlike(rf"<{tag}[\s>]"))
    body = F.regexp_extract("value", rf"(?s).*(<{tag}[\s>].*)$", 1)
    text = lambda c: F.nullif(terms.strip(F.regexp_extract("b", rf"(?s)<{c}[^>/]*>(.*?)</{c}>", 1)), F.lit(""))
    many = lambda c: F.transform(F.regexp_extract_all("b", F.lit(rf'<{c}\s[^>]*rdf:resource="([^"]*)"'), F.lit(1)), lambda x: F.regexp_replace(x, "^#", ""))
    rows = pieces.select(body.alias("b"))
    about = F.regexp_replace(F.regexp_extract("b", r'rdf:about="([^"]*)"', 1), "^#", "")
    return rows.select(about.alias("id"), *[text(c).alias(n) for n, c in fields.items()], *[many(c).alias(n) for n, c in (lists or {}).items()]).where("id <> ''")


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """PubMed articles: pmid, title, abstract, year, journal, mesh, chemicals, keywords, doi."""
    pieces = spark.read.option("lineSep", "</PubmedArticle>").text(path).where(F.col("value").contains("<PubmedArticle"))
    plain = lambda c: terms.squeeze(F.regexp_replace(c, "<[^>]+>", ""))
    one = lambda rx: F.nullif(plain(F.regexp_extract("value", rx, 1)), F.lit(""))
    many = lambda rx: F.array_distinct(F.transform(F.regexp_extract_all("value", F.lit(rx), F.lit(1)), plain))
    return pieces.select(
        one(r"(?s)<PMID[^>]*>(.*?)</PMID>").alias("pmid"),
        one(r"(?s)<ArticleTitle[^>]*>(.*?)</ArticleTitle>").alias("title"),
        F.nullif(F.array_join(many(r"(?s)<AbstractText[^>]*>(.*?)</AbstractText>"), " "), F.lit("")).alias("abstract"),
        one(r"(?s)<PubDate>.*?<Year>(\d{4})</Year>").alias("year"),
        one(r"(?s)<Journal>.*?<Title>(.*?)</Title>").alias("journal"),
        many(r"(?s)<DescriptorName[^>]*>(.*?)</DescriptorName>").alias("mesh"),
        many(r"(?s)<NameOfSubstance[^>]*>(.*?)</NameOfSubstance>").alias("chemicals"),
        many(r"(?s)<Keyword[^>]*>(.*?)</Keyword>").alias("keywords"),
        F.lower(one(r'(?s)<ArticleId IdType="doi">(.*?)</ArticleId>')).alias("doi"),
    )


# ---- JSON ----


def _whole_json(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(x): each file as one JSON value of the type; a file that doesn't parse raises."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return files.select(_parsed(F.from_json("value", kind), F.col("file")).alias("x"))


def _parsed(x: Column, where: Column) -> Column:
    return F.when(x.isNull(), F.raise_error(F.concat(F.lit("not the JSON that was expected: "), where))).otherwise(x)


def read_json_map(spark: SparkSession, path: str, value: str = "string") -> DataFrame:
    """(key, value) of files that each hold one JSON object, laid out in any way; `value` is the type of its values. A file is read by one task."""
    return _whole_json(spark, path, f"map<string,{value}>").select(F.explode("x").alias("key", "value"))


def read_json_array(spark: SparkSession, path: str, element: str) -> DataFrame:
    """Rows of files that each hold one JSON array of objects of the given struct type, laid out in any way."""
    return _whole_json(spark, path, f"array<{element}>").select(F.explode("x").alias("x")).select("x.*")


def read_shards(spark: SparkSession, path: str, value: str = "string") -> DataFrame:
    """(key, value) of the JSON objects that `sinks.write_shards` writes: an entry is a line, so files of any size are split. A line that isn't an entry raises."""
    lines = spark.read.text(path).where("value <> '' and value <> '{}'").select("value", F.col("_metadata.file_path").alias("file"))
    entry = F.concat(F.lit("{"), F.substr("value", F.lit(2)))  # the line begins with { or a comma, and the last one ends with }
    kind = f"map<string,{value}>"
    found = F.coalesce(F.from_json(F.concat(entry, F.lit("}")), kind), F.from_json(entry, kind))
    return lines.select(F.explode(_parsed(found, F.concat_ws(": ", "file", "value"))).alias("key", "value"))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON Lines cache; lines that don't parse are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_graph(spark: SparkSession, path: str, ns: str = "") -> DataFrame:
    """(s, p, o) of JSON files with nodes {id: {label, role, props}} and edges [{s, t, p}]: labels and properties as literals, roles as types."""
    label, kind = "<http://www.w3.org/2000/01/rdf-schema#label>", "<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>"
    shape = "nodes map<string,struct<label:string,role:string,props:map<string,string>>>, edges array<struct<s:string,t:string,p:string>>"
    whole = _whole_json(spark, path, shape)
    name = lambda c: terms.iri(c, ns)
    n = whole.select(F.explode("x.nodes").alias("id", "n"))
    about = n.select(name(F.col("id")).alias("s"), F.explode(F.array(F.struct(F.lit(label).alias("p"), terms.nt_literal(F.col("n.label")).alias("o")), F.struct(F.lit(kind).alias("p"), name(F.col("n.role")).alias("o")))).alias("x")).select("s", "x.p", "x.o")
    props = n.select("id", F.explode("n.props").alias("k", "v")).select(name(F.col("id")).alias("s"), name(F.col("k")).alias("p"), terms.nt_literal(F.col("v")).alias("o"))
    links = whole.select(F.explode("x.edges").alias("e")).select(name(F.col("e.s")).alias("s"), name(F.col("e.p")).alias("p"), name(F.col("e.t")).alias("o"))
    return about.unionByName(props).unionByName(links).where("o is not null")
