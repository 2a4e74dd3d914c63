"""Further knowledge-graph queries: joins of the older generations, triage, minting, text mining; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from grafloom.functions import mining, terms
from grafloom.operators import audit, entities, evidence, graph, ingest
from grafloom.operators import triples as T
from grafloom.plans import views as V

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("""SELECT l_suppkey, count(*) AS n FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem) a JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) b USING (l_orderkey) GROUP BY 1""")
def propagated_edges(spark, d):
    """Trials handed on to all compounds (E25, an older generation's many-to-many join), counted."""
    item = V.table(spark, d, "lineitem")
    a, b = item.select("l_suppkey", "l_orderkey").distinct(), item.select("l_orderkey", "l_partkey").distinct()
    return a.join(b, "l_orderkey").groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, coalesce(n1.n_name, n2.n_name) AS name, coalesce(a.n_name, n1.n_name, n2.n_name) AS accepted FROM part
    LEFT JOIN nation n1 ON n1.n_nationkey = p_size AND p_size < 20 LEFT JOIN nation n2 ON n2.n_nationkey = p_size % 7 LEFT JOIN nation a ON a.n_nationkey = coalesce(n1.n_regionkey, n2.n_regionkey)""")
def accepted_names(spark, d):
    """An exact match, else a coarser one; then a synonym's accepted name by a self-join."""
    n = V.table(spark, d, "nation")
    rows = V.table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") < 20, F.col("p_size")).alias("k1"), (F.col("p_size") % 7).alias("k2"))
    both = n.select(F.col("n_nationkey").alias("key"), F.struct(F.col("n_name").alias("n"), F.col("n_regionkey").alias("r")).alias("v"))
    hit = evidence.fallback_join(rows, [F.col("k1"), F.col("k2")], both, "key", "v")
    accepted = n.select(F.col("n_nationkey").alias("r"), F.col("n_name").alias("a"))
    return hit.withColumn("r", F.col("v.r")).join(accepted, "r", "left").select("p_partkey", F.col("v.n").alias("name"), F.coalesce("a", "v.n").alias("accepted"))


@query("""SELECT c_custkey, coalesce(s_name, n_name) AS old_name FROM customer LEFT JOIN (SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0) ON c_custkey = s_suppkey JOIN nation ON c_nationkey = n_nationkey""")
def carry_over(spark, d):
    """Names carried over by id, else by a group's key."""
    by_id = V.table(spark, d, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    rows = V.table(spark, d, "customer").join(by_id, "c_custkey", "left").join(V.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", F.coalesce("s_name", "n_name").alias("old_name"))


#: A whole word.
_WORD = r"\p{L}+"


def _names_sql(table):
    return f"SELECT DISTINCT regexp_extract(text, '({_WORD})[^\\p{{L}}]+({_WORD})', 1) AS g, regexp_extract(text, '({_WORD})[^\\p{{L}}]+({_WORD})', 2) AS e FROM {table} WHERE regexp_matches(text, '{_WORD}[^\\p{{L}}]+{_WORD}')"


#: One character replaced, or one more on either side; DuckDB's levenshtein counts bytes.
_SLIP_SQL = """(length(a.g) = length(b.g) AND a.g <> b.g AND len(list_filter(range(1, length(a.g) + 1), lambda i: left(a.g, i - 1) = left(b.g, i - 1) AND substr(a.g, i + 1) = substr(b.g, i + 1))) > 0
    OR length(a.g) = length(b.g) + 1 AND len(list_filter(range(1, length(a.g) + 1), lambda i: left(a.g, i - 1) || substr(a.g, i + 1) = b.g)) > 0
    OR length(b.g) = length(a.g) + 1 AND len(list_filter(range(1, length(b.g) + 1), lambda i: left(b.g, i - 1) || substr(b.g, i + 1) = a.g)) > 0)"""


@query(f"""WITH a AS ({_names_sql('documents')}), b AS ({_names_sql('benchmark')}) SELECT a.g || ' ' || e AS name, b.g || ' ' || e AS match FROM a JOIN b USING (e) WHERE {_SLIP_SQL}""")
def typo_rescue(spark, d):
    """Names, the first two whole words of a text, whose genus is one letter off a known one, blocked by the epithet."""
    word = lambda i: F.regexp_extract("text", rf"({_WORD})[^\p{{L}}]+({_WORD})", i)
    names = lambda t: V.table(spark, d, t).select(F.concat_ws(" ", word(1), word(2)).alias("name")).where("length(name) > 1").distinct()
    return evidence.typo_matches(names("documents"), names("benchmark"))


@query(f"""WITH l AS ({V.LITERALS_SQL}), x AS (SELECT p, coalesce(nullif(regexp_extract(o, '\\^\\^<(.*)>$', 1), ''), 'plain') AS dt FROM l WHERE starts_with(o, '"')) SELECT p, dt, count(*) AS n, 0::BIGINT AS na, 0::BIGINT AS inchikeys FROM x GROUP BY 1, 2""")
def literal_profile(spark, d):
    return audit.literal_profile(V.literals(spark, d))


@query(f"""WITH e AS ({V.EDGES_SQL}) SELECT CASE WHEN s[1] = 's' THEN 'Supplier' WHEN s[1] = 'c' THEN 'Customer' ELSE '' END AS combo, preds AS predicates, count(*) AS n FROM (SELECT s, string_agg(DISTINCT p, '|' ORDER BY p) AS preds FROM e GROUP BY s) GROUP BY 1, 2""")
def predicate_sets(spark, d):
    t = V.edges(spark, d)
    kind = F.when(F.col("s").startswith("s"), "Supplier").when(F.col("s").startswith("c"), "Customer")
    return audit.predicate_sets(t, t.select("s", kind.alias("class")).where("class is not null").distinct())


@query("""SELECT p_partkey FROM part WHERE abs(p_size * 12.011 + 15.999 - (p_size * 12 + p_size % 7 + 15)) > 2""")
def mass_check(spark, d):
    """Formula masses against stated ones."""
    rows = V.table(spark, d, "part").select("p_partkey", F.concat(F.lit("C"), F.col("p_size").cast("string"), F.lit("O")).alias("f"), (F.col("p_size") * 12 + F.col("p_size") % 7 + 15).cast("double").alias("m"))
    return audit.mass_mismatches(rows, "f", "m").select("p_partkey")


@query("""SELECT 'l' || n_regionkey AS node, string_agg(n_name, '|' ORDER BY n_nationkey) AS members FROM nation GROUP BY 1""")
def rdf_lists(spark, d):
    """first/rest chains flattened in order."""
    n = V.table(spark, d, "nation")
    from pyspark.sql import Window

    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    cell = F.when(F.col("i") == 1, V.node("l", "n_regionkey")).otherwise(V.node("b", "n_nationkey"))
    c = n.withColumn("i", F.row_number().over(w)).withColumn("cell", cell).withColumn("next", F.coalesce(F.lead("cell").over(w), F.lit("nil")))
    t = T.unpivot(c, F.col("cell"), {"first": F.col("n_name"), "rest": F.col("next")})
    heads = n.select(V.node("l", "n_regionkey").alias("node")).distinct()
    return graph.rdf_lists(t, heads, "first", "rest", "nil").withColumn("members", F.array_join("members", "|"))


@query("""SELECT DISTINCT '<http://x#' || regexp_replace(p_brand, '[^A-Za-z0-9_.-]', '_', 'g') || '>' AS s, 'p' AS p, '<http://y#a b>' AS o FROM part""")
def sanitize_iris(spark, d):
    t = V.table(spark, d, "part").select(terms.iri(F.col("p_brand"), "http://x#").alias("s"), F.lit("p").alias("p"), F.lit("<http://y#a b>").alias("o"))
    return entities.sanitize_iris(t, "http://x#")


@query("""SELECT page_id, replace(replace(url, '?', '%3F'), '=', '%3D') AS coded FROM (SELECT page_id, replace(replace(regexp_replace(url, '#.*$', ''), '&', 'and'), ' ', '') AS url FROM pages)""")
def percent_encode(spark, d):
    u = F.replace(F.replace(F.regexp_replace("url", "#.*$", ""), F.lit("&"), F.lit("and")), F.lit(" "), F.lit(""))
    return V.table(spark, d, "pages").select("page_id", terms.percent_encode(u).alias("coded"))


@query("""SELECT event_id, source, '<http://' || source || '.org/' || id || '>' AS iri FROM (SELECT event_id, unnest(['chebi', 'chembl']) AS source, user_id AS id FROM events)""")
def xref_iris(spark, d):
    """Cross-references from a map of sources to ids, as IRIs by the source's pattern."""
    rows = V.table(spark, d, "events").select("event_id", F.explode(F.create_map(F.lit("chebi"), F.array("user_id"), F.lit("chembl"), F.array("user_id"), F.lit("other"), F.array("user_id"))).alias("source", "ids")).select("event_id", "source", F.explode("ids").alias("id"))
    made = terms.xref_iri(F.col("source"), F.col("id").cast("string"), {"chebi": "http://chebi.org/{}", "chembl": "http://chembl.org/{}"})
    return rows.select("event_id", "source", made.alias("iri")).where("iri is not null")


def _tiers(spark, d, text):
    # judged before the join, so that no text is shuffled
    rows = V.table(spark, d, "documents").select("doc_id", text.rlike("[0-9]").alias("digit")).join(V.table(spark, d, "labels").select("doc_id", "quality").distinct(), "doc_id", "left")
    tier = evidence.decide(("junk", F.col("digit")), ("plant", F.col("quality") == 1), ("nonplant", F.col("quality") == 0), otherwise="possible")
    return rows.select("doc_id", tier.alias("tier"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]') THEN 'junk' WHEN quality = 1 THEN 'plant' WHEN quality = 0 THEN 'nonplant' ELSE 'possible' END AS tier FROM documents LEFT JOIN (SELECT DISTINCT doc_id, quality FROM labels) USING (doc_id)""")
def triage(spark, d):
    """An ordered decision over joined flags (D11, M4), junk by whole texts."""
    return _tiers(spark, d, F.col("text"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'orders' WHEN c_custkey % 3 = 0 THEN 'nation' END AS source FROM customer""")
def source_attribution(spark, d):
    """The first source that has a value (M3)."""
    keys = V.table(spark, d, "customer").select("c_custkey", "c_name")
    has = [("orders", keys.where("c_custkey % 2 = 0").select("c_custkey", F.lit("x").alias("name"))), ("nation", keys.where("c_custkey % 3 = 0").select("c_custkey", F.lit("y").alias("name")))]
    return evidence.layered_names(keys, "c_custkey", has).select("c_custkey", "source")


@query("""WITH r AS (SELECT c_custkey::VARCHAR AS id, CASE c_custkey % 4 WHEN 0 THEN 'Panax ginseng' WHEN 1 THEN 'Aloe vera L.' WHEN 2 THEN 'Salvia officinalis' ELSE 'Single' END AS name FROM customer)
    SELECT id, CASE WHEN id = '7' THEN 'n7' WHEN starts_with(name, 'Panax') THEN 'np' WHEN starts_with(name, 'Aloe') THEN 'Plant_Aloe_vera' END AS node,
    CASE WHEN id = '7' THEN 'id' WHEN starts_with(name, 'Panax') THEN 'binomial' WHEN starts_with(name, 'Aloe') THEN 'minted' ELSE 'unresolved' END AS how FROM r""")
def resolve_plants(spark, d):
    """By id, by binomial, minted for known plant names, else unresolved."""
    m = F.col("c_custkey") % 4
    rows = V.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.when(m == 0, "Panax ginseng").when(m == 1, "Aloe vera L.").when(m == 2, "Salvia officinalis").otherwise("Single").alias("name"))
    by_id, by_b = spark.createDataFrame([("7", "n7")], "id string, node string"), spark.createDataFrame([("panax ginseng", "np")], "binomial string, node string")
    return entities.resolve_plants(rows, by_id, by_b, spark.createDataFrame([("aloe vera",)], "binomial string")).select("id", "node", "how")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'NCT' || lpad(o_custkey::VARCHAR, 8, '0') ELSE substr(sha1(o_custkey || '|' || o_orderpriority), 1, 12) END AS trial FROM orders""")
def mint_trials(spark, d):
    """The first registered id in a text, else a key of its content."""
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("see NCT"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"))).otherwise(F.col("o_orderpriority"))
    rows = V.table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("plant"), text.alias("text"))
    return entities.mint_trials(rows, "plant", "text").select("o_orderkey", "trial")


@query("""SELECT '10.1000/p' || (page_id % 50) AS doi_key, min(CASE WHEN page_id % 3 = 0 THEN 't' || page_id END) AS t, count(*) AS n FROM pages GROUP BY 1""")
def paper_groups(spark, d):
    """Rows grouped to papers by normalised DOI."""
    key = F.concat(F.lit("https://doi.org/10.1000/P"), (F.col("page_id") % 50).cast("string"), F.lit(". "))
    rows = V.table(spark, d, "pages").select(key.alias("doi"), F.when(F.col("page_id") % 3 == 0, V.node("t", "page_id")).alias("title"))
    return entities.papers(rows, "doi", "title").select("doi_key", F.when(F.col("label").startswith("t"), F.col("label")).alias("t"), "n")


@query("""SELECT page_id, 'Panax quinquefolius var. albus' AS plant, unnest(['gallic acid', 'quercetin' || chr((97 + page_id % 5)::INTEGER) || 'ol']) AS compound FROM pages WHERE page_id % 3 <> 0""")
def literature(spark, d):
    """Articles about plants, mined for species and compounds, crossed in each article."""
    letter = F.char((97 + F.col("page_id") % 5).cast("int"))
    title = F.when(F.col("page_id") % 3 == 0, F.lit("Steel bridges of Pontus altus")).otherwise(F.concat(F.lit("Panax quinquefolius var. albus extracts: Gallic acid, quercetin"), letter, F.lit("ol")))
    articles = V.table(spark, d, "pages").select(F.col("page_id").alias("pmid"), title.alias("title"), *[F.lit(None).cast("string").alias(c) for c in ("abstract", "doi", "year", "journal")], *[F.lit(None).cast("array<string>").alias(c) for c in ("mesh", "chemicals")])
    return mining.mine(articles).select(F.col("pmid").alias("page_id"), "plant", "compound")


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'enzyme' WHEN p_size % 4 = 1 THEN 'element_or_nutrient_class' WHEN p_size % 4 = 2 THEN 'compound_class' END AS kind FROM part""")
def constituent_kinds(spark, d):
    """Classes of constituents by their names."""
    m = F.col("p_size") % 4
    name = F.when(m == 0, F.concat(F.upper("p_name"), F.lit(" ESTERASES"))).when(m == 1, "Tannins").when(m == 2, "flavone derivatives").otherwise("LINALOOL")
    return V.table(spark, d, "part").select("p_partkey", terms.constituent_kind(name).alias("kind"))


@query("""SELECT s_suppkey, lower(split_part(s_name, '#', 1)) AS loose, 'Genus epithet' AS author FROM supplier""")
def binomials(spark, d):
    """Name normalisers (L2)."""
    return V.table(spark, d, "supplier").select("s_suppkey", terms.binomial_loose(F.col("s_name")).alias("loose"), terms.binomial_author(F.concat(F.lit("Genus epithet L. "), "s_name")).alias("author"))


@query(f"""WITH e AS ({V.EDGES_SQL}) SELECT s AS child, o AS parent FROM e WHERE p IN ('inNation', 'inRegion') AND s[1] IN ('n', 'r') AND o[1] IN ('n', 'r')""")
def restricted_edges(spark, d):
    """Edges between kept nodes only."""
    t = V.edges(spark, d).where("p in ('inNation', 'inRegion')").select(F.col("s").alias("child"), F.col("o").alias("parent"))
    kept = t.select(F.explode(F.array("child", "parent")).alias("node")).distinct().where("node like 'n%' or node like 'r%'")
    return graph.restrict(t, kept)


@query("""SELECT c_custkey, c_mktsegment AS match, 1 AS rank FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, c_mktsegment, 2 FROM customer WHERE c_custkey % 2 = 1""")
def resolution_keys(spark, d):
    """Keys of different kinds never meet."""
    key = entities.resolution_key(("id", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))), ("label", F.col("c_mktsegment")))
    rows = V.table(spark, d, "customer").select("c_custkey", key.alias("key"))
    return rows.select("c_custkey", F.split("key", ":")[1].alias("match"), F.when(F.col("key").startswith("id:"), 1).otherwise(2).alias("rank"))


@query("""SELECT DISTINCT l_suppkey AS plant, lower(c_mktsegment) AS gene FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment LIKE 'B%' OR c_mktsegment LIKE 'M%'""")
def gated_targets(spark, d):
    """Plant to gene through three tables, for known genes."""
    t = lambda n: V.table(spark, d, n)
    plants = t("lineitem").select(F.col("l_suppkey").alias("plant"), F.col("l_orderkey").alias("ingredient"))
    pairs = t("orders").select(F.col("o_orderkey").alias("ingredient"), F.col("o_custkey").alias("target"))
    targets = t("customer").select(F.col("c_custkey").alias("target"), F.col("c_mktsegment").alias("symbol"))
    genes = t("customer").where("c_mktsegment like 'B%' or c_mktsegment like 'M%'").select(F.col("c_mktsegment").alias("gene"))
    return ingest.gated_targets(plants, pairs, targets, genes)


@query("""SELECT n_nationkey, count(*) AS n FROM nation LEFT JOIN (SELECT DISTINCT s_nationkey AS k, s_suppkey FROM supplier) ON k = n_nationkey LEFT JOIN (SELECT DISTINCT c_nationkey AS k2, c_mktsegment FROM customer) ON k2 = n_nationkey GROUP BY 1""")
def many_to_many(spark, d):
    """Left joins that multiply rows (E3), counted."""
    key = lambda c: F.concat(F.lit("n-"), F.col(c).cast("string"))
    base = V.table(spark, d, "nation").select("n_nationkey", key("n_nationkey").alias("k"))
    a = V.table(spark, d, "supplier").select(F.upper(key("s_nationkey")).alias("k"), "s_suppkey")
    b = V.table(spark, d, "customer").select(key("c_nationkey").alias("k"), "c_mktsegment")
    return ingest.many_to_many(base, (a, "k"), (b, "k")).groupBy("n_nationkey").agg(F.count("*").alias("n"))


@query("""SELECT 'Disease_ICD11_' || n_regionkey AS node, min(n_name) AS name, 'r' || n_regionkey AS category FROM nation GROUP BY n_regionkey""")
def disease_nodes(spark, d):
    """Nodes by code with the smallest name and a category without its number."""
    n = V.table(spark, d, "nation").select(F.col("n_regionkey").cast("string").alias("code"), F.col("n_name").alias("name"), F.concat(F.lit("4. r"), F.col("n_regionkey").cast("string")).alias("category"))
    return ingest.disease_nodes(n)


@query("""SELECT c_custkey AS node, CASE WHEN c_acctbal > 5000 THEN 'rich' WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'Unknown' END AS class FROM customer""")
def classify_first(spark, d):
    """The first class by priority, a fallback where there is none."""
    c = V.table(spark, d, "customer").withColumnRenamed("c_custkey", "node")
    classes = c.where("node % 2 = 0").select("node", F.lit("even").alias("class")).union(c.where("c_acctbal > 5000").select("node", F.lit("rich")))
    return ingest.classify(c, classes, ["rich", "even"])


def _plants_of(spark, d, i):
    """Compound strings with the labels of the plants that they come from by the rows i of lineitem."""
    p, s = V.table(spark, d, "part"), V.table(spark, d, "supplier")
    t = T.triples(
        T.unpivot(p, V.node("p", "p_partkey"), {"smiles": terms.nt_literal(F.col("p_name"))}),
        T.unpivot(i, V.node("p", "l_partkey"), {"from": V.node("s", "l_suppkey")}),
        T.unpivot(s, V.node("s", "s_suppkey"), {"label": terms.nt_literal(F.col("s_name"))}),
    )
    return ingest.flat_export(t, "smiles", "from", "label")


@query("""SELECT DISTINCT p_name AS smiles, coalesce(s_name, 'N/A') AS plant FROM part LEFT JOIN (SELECT DISTINCT l_partkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) ON p_partkey = l_partkey""")
def flat_export(spark, d):
    """Compound strings with the labels of all their plants."""
    return _plants_of(spark, d, V.table(spark, d, "lineitem"))


@query(f"""SELECT s, 'brand' AS p, o FROM ({V.LITERALS_SQL}) WHERE p = 'size' UNION SELECT s, p, o FROM ({V.LITERALS_SQL}) WHERE p <> 'size'""")
def consolidate_property(spark, d):
    """Several predicates become one."""
    return ingest.consolidate_property(V.literals(spark, d), ["size", "brand"], "brand")


@query("""SELECT c_custkey AS node, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_mktsegment || ' x' END AS label FROM customer""")
def missing_labels(spark, d):
    """Labels made of genus and species where there is none."""
    m = F.col("c_custkey") % 3
    rows = V.table(spark, d, "customer").select(F.col("c_custkey").alias("node"), F.when(m == 0, F.col("c_name")).otherwise("nan").alias("label"), F.when(m == 1, F.col("c_mktsegment")).alias("genus"), F.when(m == 1, "x").alias("species"))
    return ingest.missing_labels(rows).select("node", "label")
