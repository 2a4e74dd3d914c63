"""Knowledge-graph queries over the driver tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.operators import audit, entities, evidence, graph
from grafloom.operators import triples as T
from grafloom.plans import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---- index, evidence ----


@query("""SELECT s_suppkey, s_name, coalesce(nc, 0) AS nc, coalesce(trials, 0) AS trials
    FROM supplier LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS nc, count(DISTINCT l_orderkey) AS trials FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey""")
def plants_index(spark, d):
    """Entities with their distinct compounds and trials, richest first."""
    n = V.table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("nc"), F.countDistinct("l_orderkey").alias("trials"))
    out = V.table(spark, d, "supplier").join(n, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    return out.select("s_suppkey", "s_name", F.coalesce("nc", F.lit(0)).alias("nc"), F.coalesce("trials", F.lit(0)).alias("trials")).orderBy(F.desc("nc"), "s_name")


OCC = "SELECT l_suppkey AS a, l_partkey AS b, list_sort(list(DISTINCT l_returnflag)) AS src FROM lineitem GROUP BY 1, 2"


@query(f"SELECT a, b, array_to_string(src, '|') AS sources, len(src)::BIGINT AS n_sources FROM ({OCC})")
def occurrence_sources(spark, d):
    return evidence.occurrences(V.facts(spark, d)).withColumn("sources", F.array_join("sources", "|"))


@query(f"SELECT len(src)::BIGINT AS n_sources, count(*) AS n FROM ({OCC}) GROUP BY 1")
def source_histogram(spark, d):
    return evidence.occurrences(V.facts(spark, d)).groupBy("n_sources").agg(F.count("*").alias("n"))


@query(f"""WITH x AS (SELECT o.*, s_nationkey AS f FROM ({OCC}) o JOIN supplier ON a = s_suppkey),
    t AS (SELECT b, count(*) AS n FROM x GROUP BY b), tf AS (SELECT b, f, count(*) AS nf FROM x GROUP BY b, f)
    SELECT a, b FROM x JOIN t USING (b) JOIN tf USING (b, f) WHERE n >= 4 AND src = ['R'] AND n - nf >= 3 AND nf = 1""")
def family_unreplicated(spark, d):
    families = V.table(spark, d, "supplier").select(F.col("s_suppkey").alias("a"), F.col("s_nationkey").alias("family"))
    return evidence.unreplicated(evidence.occurrences(V.facts(spark, d)), families, "R")


@query(f"SELECT a, b, array_to_string(src, '|') AS kinds, src = ['R'] AS only FROM ({OCC})")
def evidence_union(spark, d):
    flags = {x: F.col("source") == x for x in "ANR"}
    return evidence.evidence_union(V.facts(spark, d), ["a", "b"], flags, "R").withColumn("kinds", F.array_join("kinds", "|"))


@query("""SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem JOIN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%') ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def guarded_links(spark, d):
    """Facts whose trial is known (E18, semi-join on a key)."""
    urgent = V.table(spark, d, "orders").where("o_orderpriority like '1%'").select(F.col("o_orderkey").alias("l_orderkey"))
    return evidence.guarded_links(V.table(spark, d, "lineitem"), urgent, ["l_orderkey"]).groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))


# ---- graph ----


@query(f"""WITH RECURSIVE t AS ({V.TREE_SQL}), a(origin, node, depth) AS (SELECT child, parent, 1 FROM t UNION ALL SELECT a.origin, t.parent, a.depth + 1 FROM a JOIN t ON a.node = t.child)
    SELECT origin, node, depth FROM a""")
def lineage_closure(spark, d):
    t = V.tree(spark, d)
    return graph.closure(t, t.select(F.col("child").alias("node")))


@query("SELECT 's' || s_suppkey AS node, 'n' || s_nationkey AS genus, 'r' || n_regionkey AS family FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def lineage(spark, d):
    """Nearest ancestors of two ranks (J2): nations as genera, regions as families."""
    t = V.tree(spark, d)
    ranks = t.select(F.explode(F.array("child", "parent")).alias("node")).distinct().select("node", F.when(F.col("node").startswith("n"), "genus").when(F.col("node").startswith("r"), "family").otherwise("species").alias("rank"))
    return graph.lineage(t, V.table(spark, d, "supplier").select(V.node("s", "s_suppkey").alias("node")), ranks)


@query("""SELECT 's' || s_suppkey AS node, n_regionkey = 2 AS verdict FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT 'x1', NULL""")
def is_descendant(spark, d):
    nodes = V.table(spark, d, "supplier").select(V.node("s", "s_suppkey").alias("node")).union(spark.createDataFrame([("x1",)], "node string"))
    return graph.has_ancestor(V.tree(spark, d), nodes, "r2")


@query(f"""WITH RECURSIVE t AS ({V.TREE_SQL}), a(node, depth) AS (SELECT child, 1 FROM t WHERE parent = 'r1' UNION ALL SELECT t.child, a.depth + 1 FROM a JOIN t ON a.node = t.parent) SELECT node, depth FROM a""")
def subclass_closure(spark, d):
    down = V.tree(spark, d).select(F.col("parent").alias("child"), F.col("child").alias("parent"))
    return graph.closure(down, spark.createDataFrame([("r1",)], "node string")).select("node", "depth")


@query("""SELECT DISTINCT l_suppkey AS s, o_custkey AS o FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def property_chain(spark, d):
    a = V.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_orderkey").alias("o")).distinct()
    return graph.chain(a, V.table(spark, d, "orders").select(F.col("o_orderkey").alias("s"), F.col("o_custkey").alias("o")))


@query(f"""WITH e AS ({V.EDGES_SQL}) SELECT s, p, o FROM e UNION SELECT o, CASE p WHEN 'inNation' THEN 'nationOf' ELSE 'regionOf' END, s FROM e WHERE p IN ('inNation', 'inRegion')""")
def inverse_edges(spark, d):
    pairs = spark.createDataFrame([("inNation", "nationOf"), ("inRegion", "regionOf")], "p string, inverse string")
    return graph.with_inverses(V.edges(spark, d), pairs)


@query(f"""WITH e AS ({V.EDGES_SQL}), u AS (SELECT s AS a, o AS b FROM e UNION SELECT o, s FROM e), h1 AS (SELECT b FROM u WHERE a = 'c1' UNION SELECT 'c1'),
    h2 AS (SELECT u.b FROM u JOIN h1 ON u.a = h1.b UNION SELECT b FROM h1) SELECT s, p, o FROM e WHERE s IN (SELECT b FROM h2) AND o IN (SELECT b FROM h2)""")
def neighborhood_2hop(spark, d):
    return graph.neighbourhood(V.stored_edges(spark, d), "c1")[1]


@query(f"""WITH e AS ({V.EDGES_SQL}), r AS (SELECT o AS neighbour, 'out' AS direction, p FROM e WHERE s = 'n3' UNION ALL SELECT s, 'in', p FROM e WHERE o = 'n3' AND s <> 'n3')
    SELECT neighbour, direction, p FROM r QUALIFY row_number() OVER (PARTITION BY neighbour ORDER BY direction DESC, p) = 1""")
def relations_directed(spark, d):
    return graph.relations(V.edges(spark, d), "n3")


@query(f"""WITH e AS ({V.EDGES_SQL}) SELECT node, count(*) AS degree FROM (SELECT s AS node FROM e UNION ALL SELECT o FROM e WHERE s <> o) GROUP BY 1""")
def degrees(spark, d):
    return graph.degree(V.edges(spark, d))


@query(f"""WITH e AS ({V.EDGES_SQL}), g AS (SELECT node, count(*) AS degree FROM (SELECT s AS node FROM e UNION ALL SELECT o FROM e WHERE s <> o) GROUP BY 1)
    SELECT node, degree FROM g WHERE node IN (SELECT o FROM e WHERE s = 'n3' UNION SELECT s FROM e WHERE o = 'n3') ORDER BY degree DESC, node LIMIT 32""")
def best_connected(spark, d):
    return graph.best_connected(V.stored_edges(spark, d), "n3")


NAMES = "SELECT p_partkey AS id, p_name AS name, count(DISTINCT l_suppkey) AS weight FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY 1, 2"


def _names(spark, d):
    n = V.table(spark, d, "lineitem").groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("weight"))
    out = V.table(spark, d, "part").join(n, F.col("p_partkey") == F.col("l_partkey"), "left")
    return out.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.coalesce("weight", F.lit(0)).alias("weight"))


@query(f"""SELECT id, name, weight, rank FROM (SELECT *, CASE WHEN id::VARCHAR = 're' OR lower(name) = 're' THEN 0 WHEN starts_with(lower(name), 're') THEN 1 WHEN contains(lower(name), 're') THEN 2 END AS rank FROM ({NAMES}))
    WHERE rank IS NOT NULL ORDER BY rank, weight DESC, name, id LIMIT 10""")
def find_by_label(spark, d):
    return graph.find(_names(spark, d), "re")


@query(f"SELECT id, name, weight FROM ({NAMES}) WHERE id % 2 = 0 AND contains(lower(name), 'e') ORDER BY weight DESC, name, id LIMIT 8")
def typeahead(spark, d):
    names = _names(spark, d)
    return graph.typeahead(names, names.where("id % 2 <> 0"), "e")


@query("""SELECT p_partkey AS node FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')
    AND p_partkey NOT IN (SELECT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority LIKE '1%')""")
def orphan_prune(spark, d):
    item = V.table(spark, d, "lineitem")
    urgent = V.table(spark, d, "orders").where("o_orderpriority like '1%'")
    used = item.join(urgent, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select(F.col("l_partkey").alias("node"))
    return graph.orphans(V.table(spark, d, "part").select(F.col("p_partkey").alias("node")), item.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("node")), used)


@query("""SELECT DISTINCT p_partkey, p_name, p_brand FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_suppkey IN (1, 2, 3)""")
def slice_export(spark, d):
    """Records of the compounds of selected plants."""
    mine = V.table(spark, d, "lineitem").where(F.col("l_suppkey").isin(1, 2, 3)).select(F.col("l_partkey").alias("p_partkey"))
    return V.table(spark, d, "part").join(mine, "p_partkey", "left_semi").select("p_partkey", "p_name", "p_brand")


@query("""SELECT count(DISTINCT l_suppkey) AS plants, count(DISTINCT l_partkey) AS compounds, count(DISTINCT (l_suppkey, l_partkey)) AS links FROM lineitem WHERE l_suppkey IN (1, 2, 3)""")
def slice_counts(spark, d):
    mine = V.table(spark, d, "lineitem").where(F.col("l_suppkey").isin(1, 2, 3))
    return mine.agg(F.countDistinct("l_suppkey").alias("plants"), F.countDistinct("l_partkey").alias("compounds"), F.countDistinct("l_suppkey", "l_partkey").alias("links"))


@query("""SELECT DISTINCT 'c' || c_custkey AS s, 'type' AS p, 'Place' AS o FROM customer WHERE false UNION SELECT 'n' || n_nationkey, 'type', 'Nation' FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier UNION SELECT c_nationkey FROM customer)
    UNION SELECT 'o' || o_orderkey, 'type', 'Order' FROM orders""")
def inferred_types(spark, d):
    """Types that domains and ranges imply."""
    axioms = spark.createDataFrame([("inNation", "range", "Nation"), ("placedBy", "domain", "Order")], "p string, side string, class string")
    return graph.inferred_types(V.edges(spark, d), axioms, "type")


# ---- entities ----

PART_GROUP = "p_name || '|' || p_brand || '|' || p_type"


def _part_nodes(spark, d):
    n = V.table(spark, d, "lineitem").groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("n"))
    p = V.table(spark, d, "part").join(n, F.col("p_partkey") == F.col("l_partkey"), "left")
    return p.select(F.col("p_partkey").alias("node"), F.concat_ws("|", "p_name", "p_brand", "p_type").alias("grp"), F.coalesce("n", F.lit(0)).alias("n"), "p_size")


@query(f"""WITH k AS (SELECT p_partkey, min(p_partkey) OVER (PARTITION BY {PART_GROUP}) AS keep FROM part)
    SELECT DISTINCT 's' || l_suppkey AS s, 'hasCompound' AS p, 'p' || keep AS o FROM lineitem JOIN k ON l_partkey = p_partkey""")
def node_merge(spark, d):
    """Equal parts merged to the smallest, edges redirected as a set."""
    merged = entities.canonical(_part_nodes(spark, d), "grp", F.col("node")).select(F.concat(F.lit("p"), "node").alias("node"), F.concat(F.lit("p"), "keep").alias("keep"))
    return entities.merge(V.edges(spark, d).where("p = 'hasCompound'"), merged)


CANON = f"""WITH n AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1), x AS (SELECT p_partkey AS node, {PART_GROUP} AS g, coalesce(n, 0) AS n, p_size FROM part LEFT JOIN n ON p_partkey = l_partkey),
    k AS (SELECT *, first_value(node) OVER w AS keep, first_value(p_size) OVER w AS ks FROM x WINDOW w AS (PARTITION BY g ORDER BY n DESC, p_size, node)) SELECT node, keep FROM k WHERE node <> keep"""


@query(CANON + " AND p_size = ks")
def canonical_pick(spark, d):
    """The keeper of each group by four keys, with a conflict guard."""
    return entities.canonical(_part_nodes(spark, d), "grp", -F.col("n"), F.col("p_size"), F.col("node"), guard="p_size")


@query(CANON + " AND p_size <> ks")
def canonical_conflicts(spark, d):
    return entities.conflicts(_part_nodes(spark, d), "grp", -F.col("n"), F.col("p_size"), F.col("node"), guard="p_size")


@query("""SELECT s, v AS label FROM (SELECT DISTINCT p_brand AS s, p_name AS v FROM part)
    QUALIFY row_number() OVER (PARTITION BY s ORDER BY CASE WHEN regexp_matches(v, '^[A-Z]\\S* [a-z-]+( |$)') THEN 0 ELSE 1 END, contains(v, 'var.') OR contains(v, 'subsp.'), length(v), v) = 1""")
def best_label(spark, d):
    labels = V.table(spark, d, "part").select(F.col("p_brand").alias("s"), F.col("p_name").alias("v")).distinct()
    return entities.best_label(labels).select("s", "label")


@query("""SELECT c_custkey, coalesce(u, h, c_name) AS label, CASE WHEN u IS NOT NULL THEN 'u' WHEN h IS NOT NULL THEN 'h' ELSE 'c_name' END AS label_source FROM customer
    LEFT JOIN (SELECT o_custkey AS k1, min(o_orderpriority) AS u FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1) ON c_custkey = k1
    LEFT JOIN (SELECT o_custkey AS k2, min(o_orderpriority) AS h FROM orders WHERE o_orderpriority LIKE '2%' GROUP BY 1) ON c_custkey = k2""")
def label_priority(spark, d):
    o = V.table(spark, d, "orders")
    pick = lambda n, c: o.where(f"o_orderpriority like '{n}%'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias(c))
    rows = V.table(spark, d, "customer").join(pick(1, "u"), "c_custkey", "left").join(pick(2, "h"), "c_custkey", "left")
    return entities.first_label(rows, "u", "h", "c_name").select("c_custkey", "label", "label_source")


@query("""SELECT DISTINCT lower(p_brand) AS key, coalesce('k' || s_suppkey, 'New_' || regexp_replace(lower(p_brand), '[^A-Za-z0-9_]', '_', 'g')) AS node, s_suppkey IS NULL AS is_new
    FROM part LEFT JOIN supplier ON lower(p_brand) = 'brand#' || (s_suppkey + 11)""")
def mint_entities(spark, d):
    """Distinct keys, known ones looked up, the rest minted."""
    known = V.table(spark, d, "supplier").select(F.concat(F.lit("brand#"), (F.col("s_suppkey") + 11).cast("string")).alias("key"), V.node("k", "s_suppkey").alias("node"))
    return entities.mint(V.table(spark, d, "part"), F.lower("p_brand"), known, "New_")


@query("""SELECT '<http://x#' || s_name2 || '>' AS s, p, o FROM (SELECT regexp_replace(regexp_replace(s_name, '[^A-Za-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g') AS s_name2, unnest([
    {'p': '<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>', 'o': '<http://x#Plant>'}, {'p': '<http://www.w3.org/2000/01/rdf-schema#label>', 'o': '"' || s_name || '"'}], recursive := true) FROM supplier)""")
def entity_triples(spark, d):
    return entities.entity_triples(V.table(spark, d, "supplier").withColumn("none", F.lit(None).cast("string")), "none", "s_name", "Plant", "http://x#")


@query("""SELECT DISTINCT '<http://x#' || l_suppkey || '>' AS s, '<http://x#has>' AS p, '<http://x#' || l_partkey || '>' AS o FROM lineitem""")
def link_triples(spark, d):
    rows = V.table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("a"), F.col("l_partkey").cast("string").alias("b"))
    return entities.link_triples(rows, "a", "b", "has", "http://x#")


@query("""SELECT event_id, 'Bioactivity_' || substr(sha1(event_id || '|' || user_id || '|' || event_type), 1, 16) AS node, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS number FROM events""")
def bioactivities(spark, d):
    """Content-keyed measurements with numeric or text values."""
    rows = V.table(spark, d, "events").withColumn("v", F.regexp_extract("props", r"(\d+)", 1))
    return entities.bioactivities(rows, ["event_id", "user_id", "event_type"], "v").select("event_id", "node", "number")


# ---- joins ----


@query("""WITH k AS (SELECT doc_id, regexp_extract(lower(text), '^\\s*(\\S+)', 1) AS w1, regexp_extract(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), '^(\\S+ \\S+)', 1) AS w2 FROM documents),
    t AS (SELECT lower(lang) AS key, min(doc_id) AS value FROM documents GROUP BY 1 UNION ALL SELECT 'the', 7)
    SELECT k.doc_id, coalesce(a.value, b.value) AS value, CASE WHEN a.value IS NOT NULL THEN 1 WHEN b.value IS NOT NULL THEN 2 END AS rank FROM k LEFT JOIN t a ON a.key = nullif(w2, '') LEFT JOIN t b ON b.key = w1""")
def name_fallback_join(spark, d):
    docs = V.table(spark, d, "documents")
    known = docs.groupBy(F.lower("lang").alias("key")).agg(F.min("doc_id").alias("value")).union(spark.createDataFrame([("the", 7)], "key string, value long"))
    return evidence.fallback_join(docs.select("doc_id", "text"), evidence.name_keys(F.col("text")), known, "key", "value").select("doc_id", "value", "rank")


@query("""WITH t AS (SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 10), r AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS k FROM customer)
    SELECT c_custkey, n_name, 1 AS pass FROM r JOIN t ON k = n_nationkey UNION ALL
    SELECT c_custkey, n_name, 2 FROM r JOIN t ON c_nationkey % 10 = n_nationkey WHERE k IS NULL OR k NOT IN (SELECT n_nationkey FROM t)""")
def two_pass_join(spark, d):
    rows = V.table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey")).alias("k"), (F.col("c_nationkey") % 10).alias("k2"))
    known = V.table(spark, d, "nation").where("n_nationkey < 10").select("n_nationkey", "n_name")
    return evidence.two_pass_join(rows, known, ("k", "n_nationkey"), ("k2", "n_nationkey")).select("c_custkey", "match.n_name", "pass")


@query("SELECT p_name || '|' || p_brand || '|' || p_size AS key, min(p_partkey) AS p_partkey FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) = 1")
def unique_hit_join(spark, d):
    return evidence.unique_hits(V.table(spark, d, "part"), F.concat_ws("|", "p_name", "p_brand", "p_size"), "p_partkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def gap_fill_anti(spark, d):
    done = V.table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return evidence.todo(V.table(spark, d, "customer"), done, ["c_custkey"])


@query("""SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, u, n_name) AS common, CASE WHEN c_custkey % 3 = 0 THEN 'own' WHEN u IS NOT NULL THEN 'orders' ELSE 'nation' END AS common_source
    FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS u FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1) ON c_custkey = o_custkey""")
def gap_fill_layers(spark, d):
    rows = V.table(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("common"))
    a = V.table(spark, d, "orders").where("o_orderpriority like '1%'").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("value"))
    b = rows.join(V.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("value"))
    return evidence.gap_fill(rows, "common", "c_custkey", [("orders", a), ("nation", b)]).select("c_custkey", "common", "common_source")


@query("""WITH u AS (SELECT c_custkey AS k, 0 AS r, 'segment' AS source, c_mktsegment AS name FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 1, 'nation', n_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
    o AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY k, lower(name) ORDER BY r, name) = 1)
    SELECT k AS c_custkey, first(name ORDER BY r, name) AS name, first(source ORDER BY r, name) AS source, string_agg(name, '|' ORDER BY r, name) AS names FROM o GROUP BY 1""")
def layered_names(spark, d):
    c = V.table(spark, d, "customer")
    layers = [("segment", c.where("c_custkey % 2 = 0").select("c_custkey", F.col("c_mktsegment").alias("name"))), ("nation", c.join(V.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("name")))]
    return evidence.layered_names(c, "c_custkey", layers).withColumn("names", F.array_join("names", "|"))


@query("""SELECT DISTINCT a.l_orderkey AS article, a.l_suppkey AS species, b.l_partkey AS compound FROM lineitem a JOIN lineitem b USING (l_orderkey)""")
def cross_product(spark, d):
    """Each article's species crossed with its compounds (E21): two lists in its own record, both exploded, no join."""
    record = V.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("article")).agg(F.collect_set("l_suppkey").alias("species"), F.collect_set("l_partkey").alias("compounds"))
    return record.select("article", F.explode("species").alias("species"), "compounds").select("article", "species", F.explode("compounds").alias("compound"))


@query("""SELECT DISTINCT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def left_join_chain(spark, d):
    """A chain of left equi-joins, then distinct."""
    o = V.table(spark, d, "orders").join(V.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.join(V.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_name", "n_name").distinct()


# ---- triples ----


@query(f"""WITH e AS ({V.EDGES_SQL}) SELECT s, p, o, CASE WHEN s IN (SELECT 's' || s_suppkey FROM supplier WHERE s_nationkey = 1) OR o IN (SELECT 's' || s_suppkey FROM supplier WHERE s_nationkey = 1) THEN 'drop'
    WHEN s = 's2' OR o = 's2' OR p = 'inRegion' THEN 'module' ELSE 'core' END AS part FROM e""")
def three_way_split(spark, d):
    gone = V.table(spark, d, "supplier").where("s_nationkey = 1").select(V.node("s", "s_suppkey").alias("node"))
    return T.split_three(V.edges(spark, d), gone, spark.createDataFrame([("s2",)], "node string"), ["inRegion"])


def _rules():
    return T.Rules().drop("region", F.col("p") == "inRegion").replace("nation", F.col("p") == "inNation", p=F.lit("locatedIn")).replace("even_order", (F.col("p") == "placedBy") & F.col("o").rlike("[02468]$"), p=F.lit("placedByEven"), o=F.upper("o"))


ACTION = "CASE WHEN p = 'inRegion' THEN 'region' WHEN p = 'inNation' THEN 'nation' WHEN p = 'placedBy' AND regexp_matches(o, '[02468]$') THEN 'even_order' ELSE 'kept' END"


@query(f"""SELECT s, CASE a WHEN 'nation' THEN 'locatedIn' WHEN 'even_order' THEN 'placedByEven' ELSE p END AS p, CASE a WHEN 'even_order' THEN upper(o) ELSE o END AS o FROM (SELECT *, {ACTION} AS a FROM ({V.EDGES_SQL})) WHERE a <> 'region'""")
def rewrite_rules(spark, d):
    return _rules().apply(V.edges(spark, d))


@query(f"SELECT {ACTION} AS action, count(*) AS n FROM ({V.EDGES_SQL}) GROUP BY 1")
def rewrite_counts(spark, d):
    return _rules().counts(V.edges(spark, d))


@query(f"""WITH l AS ({V.LITERALS_SQL}) SELECT s, p, o FROM l WHERE NOT (p = 'brand' AND s IN (SELECT 'p' || p_partkey FROM part WHERE p_size < 10)) UNION SELECT 'p' || p_partkey, 'brand', '"fixed"' FROM part WHERE p_size < 10""")
def replace_values(spark, d):
    fixes = V.table(spark, d, "part").where("p_size < 10").select(V.node("p", "p_partkey").alias("s"), F.lit("brand").alias("p"), F.lit('"fixed"').alias("o"))
    return T.replace_values(V.literals(spark, d), fixes)


@query("""SELECT 's' || s_suppkey AS s, 'brand' AS p, '"none"' AS o FROM supplier""")
def fill_missing(spark, d):
    t = V.literals(spark, d)
    wanted = t.select("s").distinct().select("s", F.lit("brand").alias("p"), F.lit('"none"').alias("o"))
    return T.fill_missing(t, wanted)


@query("""SELECT 'p' || p_partkey AS s, p_name AS name, p_size::VARCHAR AS size, 1::BIGINT AS brands FROM part""")
def star_rows(spark, d):
    """Predicates of a subject as columns, in one aggregation."""
    found = T.star(V.literals(spark, d).where("s like 'p%'"), {"name": ("name", "min"), "size": ("size", "max"), "brands": ("brand", "count")})
    return found.select("s", terms.literal_value(F.col("name")).alias("name"), terms.literal_value(F.col("size")).alias("size"), "brands")


@query(f"""SELECT s, p, regexp_replace(o, '^"(.*)"(@en|\\^\\^<.*>)?$', '\\1') AS lex, nullif(regexp_extract(o, '"@([a-z]+)$', 1), '') AS lang, nullif(regexp_extract(o, '\\^\\^<(.*)>$', 1), '') AS dt FROM ({V.LITERALS_SQL}) WHERE starts_with(o, '"')""")
def literal_parse(spark, d):
    return T.with_terms(V.literals(spark, d)).where("o_kind = 'lit'").select("s", "p", "lex", "lang", "dt")


@query("""SELECT k, max(a)::BOOLEAN AS in_union, min(i)::BOOLEAN AS in_both, max(x)::BOOLEAN AS in_first_only FROM (SELECT p_partkey AS k, 1 AS a, CASE WHEN p_size < 30 AND p_size > 10 THEN 1 ELSE 0 END AS i, CASE WHEN p_size < 30 AND p_size <= 10 THEN 1 ELSE 0 END AS x FROM part WHERE p_size < 30 OR p_size > 10) GROUP BY 1""")
def set_ops(spark, d):
    p = V.table(spark, d, "part")
    a, b = (p.where(c).select(F.col("p_partkey").alias("k")) for c in ("p_size < 30", "p_size > 10"))
    both, only = a.intersect(b).withColumn("b", F.lit(True)), a.subtract(b).withColumn("x", F.lit(True))
    return a.union(b).distinct().join(both, "k", "left").join(only, "k", "left").select("k", F.lit(True).alias("in_union"), F.coalesce("b", F.lit(False)).alias("in_both"), F.coalesce("x", F.lit(False)).alias("in_first_only"))


@query(f"""SELECT s, p, o FROM ({V.EDGES_SQL}) WHERE p <> 'placedBy' AND s NOT IN (SELECT 's' || s_suppkey FROM supplier WHERE s_suppkey < 5) AND NOT (p = 'inRegion' AND s = 'n1')""")
def drop_sets(spark, d):
    small = V.table(spark, d, "supplier").where("s_suppkey < 5").select(V.node("s", "s_suppkey").alias("s"))
    return T.drop(V.edges(spark, d), ["placedBy"], subjects=small, pairs=spark.createDataFrame([("n1", "inRegion")], "s string, p string"))


# ---- audit ----


@query(f"SELECT p, count(*) AS n FROM ({V.EDGES_SQL}) GROUP BY 1")
def predicate_counts(spark, d):
    return audit.predicate_counts(V.edges(spark, d))


TYPES_SQL = "SELECT 'c' || c_custkey AS s, 'Customer' AS class FROM customer UNION ALL SELECT 'c' || c_custkey, 'Rich' FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT 'c' || c_custkey, 'Individual' FROM customer"


def _types(spark, d):
    c = V.table(spark, d, "customer")
    s = V.node("c", "c_custkey").alias("s")
    return c.select(s, F.lit("Customer").alias("class")).union(c.where("c_acctbal > 5000").select(s, F.lit("Rich"))).union(c.select(s, F.lit("Individual")))


@query(f"SELECT combo, count(*) AS n FROM (SELECT s, string_agg(class, '|' ORDER BY class) AS combo FROM ({TYPES_SQL}) WHERE class <> 'Individual' GROUP BY s) GROUP BY 1")
def type_combos(spark, d):
    return audit.type_combinations(_types(spark, d), ("Individual",))


@query(f"""SELECT p, sum(n)::BIGINT AS triples, count(*) AS subjects, max(n) AS most, sum(i)::BIGINT AS iri, 0::BIGINT AS bnode, sum(l)::BIGINT AS lit FROM (SELECT p, s, count(*) AS n, count_if(starts_with(o, '<')) AS i, count_if(starts_with(o, '"')) AS l FROM ({V.LITERALS_SQL}) GROUP BY 1, 2) GROUP BY 1""")
def tracked_stats(spark, d):
    return audit.subject_stats(V.literals(spark, d))


@query("SELECT p_brand AS s, count(DISTINCT p_name) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_name) > 1")
def multi_label(spark, d):
    return audit.several_values(V.table(spark, d, "part").select(F.col("p_brand").alias("s"), F.lit("label").alias("p"), F.col("p_name").alias("o")), "label")


@query("SELECT l_orderkey, l_linenumber, count(DISTINCT l_quantity) AS n_values FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_quantity) > 1")
def conflicts(spark, d):
    return audit.conflicts(V.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_quantity")


@query("SELECT l_partkey, count(DISTINCT l_discount) AS n_values FROM lineitem GROUP BY 1 HAVING max(l_discount) - min(l_discount) > 0.055")
def conflicts_tolerance(spark, d):
    return audit.conflicts(V.table(spark, d, "lineitem"), ["l_partkey"], "l_discount", 0.055)


@query("SELECT sum(c - 1)::BIGINT AS duplicates FROM (SELECT count(*) AS c FROM part GROUP BY p_name)")
def duplicate_labels(spark, d):
    return audit.duplicate_labels(V.table(spark, d, "part").select(F.col("p_name").alias("v")))


@query("""SELECT 'size' AS p, 'http://www.w3.org/2001/XMLSchema#integer' AS declared, 'http://www.w3.org/2001/XMLSchema#double' AS actual, count(*) AS n, min('p' || p_partkey) AS example FROM part WHERE p_size % 2 = 0""")
def datatype_check(spark, d):
    ranges = spark.createDataFrame([("size", "http://www.w3.org/2001/XMLSchema#integer"), ("brand", "http://www.w3.org/2001/XMLSchema#string")], "p string, dt string")
    return audit.datatype_mismatches(V.literals(spark, d), ranges)


@query("""SELECT 'inNation' AS p, 'domain' AS side, count(*) AS n, min('c' || c_custkey) AS example FROM customer""")
def domain_range_check(spark, d):
    """Customers break the domain that says only suppliers lie in nations."""
    t = V.stored_edges(spark, d).where("p in ('inNation', 'inRegion')")
    kind = F.substring("x", 1, 1)
    types = t.select(F.explode(F.array("s", "o")).alias("x")).distinct().select(F.col("x").alias("s"), kind.alias("class"))
    groups = spark.createDataFrame([("s", "agent", "supplier"), ("c", "agent", "customer"), ("n", "place", None), ("r", "place", None)], "class string, grp string, sub string")
    axioms = spark.createDataFrame([("inNation", "domain", ["s"]), ("inNation", "range", ["n", "r"]), ("inRegion", "domain", ["n"]), ("inRegion", "range", ["zone"])], "p string, side string, classes array<string>")
    return audit.domain_range_violations(t, axioms, types, groups)


@query("""SELECT problem, count(*) AS n, min(iri) AS example FROM (SELECT url AS iri, CASE WHEN NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN 'no scheme' WHEN length(regexp_replace(url, '[^#]', '', 'g')) > 1 THEN 'two #' END AS problem
    FROM (SELECT url FROM pages UNION ALL SELECT 'x' || replace(url, ':', '') FROM pages UNION ALL SELECT url || '#a#b' FROM pages)) WHERE problem IS NOT NULL GROUP BY 1""")
def iri_check(spark, d):
    u = V.table(spark, d, "pages").select("url")
    u = u.union(u.select(F.concat(F.lit("x"), F.replace("url", F.lit(":"), F.lit(""))))).union(u.select(F.concat("url", F.lit("#a#b"))))
    return audit.invalid_iris(u.select(terms.iri(F.col("url")).alias("s"), F.lit("p").alias("p"), F.lit("o").alias("o")))


@query(f"""SELECT e.*, (e.s, e.p, e.o) IN (SELECT s, p, o FROM ({V.EDGES_SQL})) = e.present AS ok FROM (SELECT 'n' || n_nationkey AS s, 'inRegion' AS p, 'r1' AS o, n_nationkey < 12 AS present FROM nation) e""")
def release_check(spark, d):
    expected = V.table(spark, d, "nation").select(V.node("n", "n_nationkey").alias("s"), F.lit("inRegion").alias("p"), F.lit("r1").alias("o"), (F.col("n_nationkey") < 12).alias("present"))
    return audit.release_check(V.edges(spark, d), expected)


@query("""SELECT source, count(*) AS n, count(quality) AS n_with, round(count(quality) / count(*), 6) AS share FROM documents LEFT JOIN (SELECT DISTINCT doc_id, quality FROM labels) USING (doc_id) GROUP BY 1""")
def coverage(spark, d):
    rows = V.table(spark, d, "documents").join(V.table(spark, d, "labels").select("doc_id", "quality").distinct(), "doc_id", "left")
    return evidence.coverage(rows, "source", F.col("quality").isNotNull())


@query("""SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS own, row_number() OVER (ORDER BY event_id) AS place FROM events)
    WHERE own <= 20 OR place % 613 = 0 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 80""")
def sample_stratified(spark, d):
    return audit.stratified_sample(V.table(spark, d, "events").select("event_id", "event_type"), "event_type", "event_id")


@query(f"SELECT p, count_if(NOT starts_with(o, '\"')) AS as_object, count_if(starts_with(o, '\"')) AS as_data FROM ({V.LITERALS_SQL}) GROUP BY 1")
def used_properties(spark, d):
    return audit.used_properties(V.literals(spark, d))


@query(f"""SELECT c AS class, count(DISTINCT s) AS n FROM (VALUES ('Customer'), ('Rich'), ('Unused')) v(c) LEFT JOIN ({TYPES_SQL}) ON c = class GROUP BY 1""")
def class_counts(spark, d):
    return audit.class_counts(_types(spark, d), spark.createDataFrame([("Customer",), ("Rich",), ("Unused",)], "class string"))


# ---- scalar functions ----


@query("""SELECT s_name, list_reduce(list_prepend(5, list_transform(string_split(s_name, ''), lambda x: ord(x) & 255)), lambda h, x: xor(h * 33, x) & 255)::BIGINT AS shard FROM supplier""")
def djb2_shard(spark, d):
    return V.table(spark, d, "supplier").select("s_name", terms.djb2_shard(F.col("s_name")).cast("long").alias("shard"))


@query("SELECT doc_id, substr(sha1(text), 1, 16) AS id16, ('0x' || substr(sha1(text), 1, 15))::BIGINT AS number FROM documents")
def stable_id(spark, d):
    return V.table(spark, d, "documents").select("doc_id", terms.stable_id(F.col("text")).alias("id16"), terms.stable_number(F.col("text")).alias("number"))


@query("SELECT doc_id, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS norm FROM documents")
def normalize_text(spark, d):
    return V.table(spark, d, "documents").select("doc_id", terms.normalize_text(F.col("text")).alias("norm"))


@query("SELECT min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) HAVING count(*) > 1")
def dedupe_text(spark, d):
    """Groups of equal normalised texts, by digest, so that no text is shuffled."""
    rows = V.table(spark, d, "documents").select("doc_id", F.sha1(terms.normalize_text(F.col("text"))).alias("k"))
    return rows.groupBy("k").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).where("n > 1").drop("k")


@query("""SELECT p_partkey, array_to_string(list_filter(list_transform(string_split_regex(p_type || '; ' || p_name || '|' || p_type, '\\|\\||\\||;;|;|//|,|\\n|\\r'), lambda x: trim(x)), lambda x, i: x <> '' AND NOT list_contains(list_transform(string_split_regex(p_type || '; ' || p_name || '|' || p_type, '\\|\\||\\||;;|;|//|,|\\n|\\r'), lambda y: trim(y))[:i - 1], x)), '~') AS parts FROM part""")
def split_multi(spark, d):
    return V.table(spark, d, "part").select("p_partkey", F.array_join(terms.split_multi(F.concat("p_type", F.lit("; "), "p_name", F.lit("|"), "p_type")), "~").alias("parts"))


@query("""SELECT event_id, v FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' N/A ' WHEN 1 THEN 'null' WHEN 2 THEN event_type ELSE '' END AS v FROM events) WHERE lower(trim(v)) NOT IN ('', 'n.a.', 'na', 'nan', 'none', 'null')""")
def na_filter(spark, d):
    m = F.col("event_id") % 4
    rows = V.table(spark, d, "events").select("event_id", F.when(m == 0, " N/A ").when(m == 1, "null").when(m == 2, F.col("event_type")).otherwise("").alias("v"))
    return rows.where(~terms.is_na(F.col("v"), "phase2"))


@query("""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_replace('https://doi.org/10.1000/' || page_id || '.),', '[).,;\\]]+$', '')[17:] AS doi FROM pages""")
def doi_normalise(spark, d):
    return V.table(spark, d, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"), terms.normalize_doi(F.concat(F.lit("https://doi.org/10.1000/"), F.col("page_id").cast("string"), F.lit(".),"))).alias("doi"))


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all('NCT' || lpad((doc_id % 7)::VARCHAR, 8, '0') || ' NCT00000003, ' || text, 'NCT[0-9]{8}'))), '|') AS ids FROM documents""")
def regex_extract(spark, d):
    text = F.concat(F.lit("NCT"), F.lpad((F.col("doc_id") % 7).cast("string"), 8, "0"), F.lit(" NCT00000003, "), "text")
    return V.table(spark, d, "documents").select("doc_id", F.array_join(terms.nct_ids(text), "|").alias("ids"))


_MARKERS_SQL = " ".join(f"WHEN contains(low, '{x}') THEN 'non-plant/unknown marker (' || chr(39) || '{x}' || chr(39) || ')'" for x in evidence.NON_PLANT_MARKERS)


@query(rf"""SELECT doc_id, CASE WHEN low = '' THEN 'empty' {_MARKERS_SQL} WHEN regexp_matches(low, '[0-9]') THEN 'contains digits (strain/catalog id)' WHEN regexp_matches(low, '[\[\]()]') THEN 'contains brackets/parens (strain designation)'
    WHEN regexp_matches(' ' || low || ' ', ' seu | et ') THEN 'Latin drug phrase (seu/et)' WHEN w[1] IN {evidence.PART_NAMES} THEN 'pharmacognosy part-name (' || chr(39) || w[1] || chr(39) || ')'
    WHEN list_has_any(w, {list(evidence.ANIMAL_WORDS)}) THEN 'non-plant common-name token' WHEN list_has_any(w, {list(evidence.STRAIN_WORDS)}) THEN 'microbial strain / unknown marker' END AS reason
    FROM (SELECT doc_id, low, string_split(low, ' ') AS w FROM (SELECT doc_id, lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS low FROM documents))""")
def junk_tag(spark, d):
    """D12 on whole texts."""
    return V.table(spark, d, "documents").select("doc_id", evidence.junk_reason(F.col("text")).alias("reason"))


@query("""SELECT event_id, key, (props::JSON ->> key)::VARCHAR AS value FROM (SELECT event_id, props, unnest(json_keys(props::JSON)) AS key FROM events)""")
def json_map_explode(spark, d):
    return V.table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))


@query("""SELECT user_id, string_agg(event_id::VARCHAR, '|' ORDER BY value DESC, event_id) AS items, max(n) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE r <= 5 GROUP BY 1""")
def capped_list(spark, d):
    found = evidence.capped_lists(V.table(spark, d, "events"), "user_id", [F.desc("value"), F.col("event_id")], F.col("event_id").cast("string"), 5)
    return found.withColumn("items", F.array_join("items", "|"))


@query("""SELECT p_partkey, lower(regexp_replace('hasCompoundOf' || p_partkey, '([a-z0-9])([A-Z])', '\\1 \\2', 'g')) AS words, upper(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) AS nname, regexp_replace(p_brand, '[^A-Za-z0-9_]', '_', 'g') AS safe FROM part""")
def name_functions(spark, d):
    return V.table(spark, d, "part").select("p_partkey", terms.words_of_predicate(F.concat(F.lit("hasCompoundOf"), F.col("p_partkey").cast("string"))).alias("words"), terms.alnum_upper(F.col("p_name")).alias("nname"), terms.safe_key(F.col("p_brand")).alias("safe"))


@query("""SELECT p_partkey, round((p_size * 12.011 + (p_size + 2) * 1.008 + 15.999)::DOUBLE, 3) AS mass FROM part""")
def formula_mass(spark, d):
    p = V.table(spark, d, "part")
    return p.select("p_partkey", F.round(terms.formula_mass(F.concat(F.lit("C"), F.col("p_size").cast("string"), F.lit("H"), (F.col("p_size") + 2).cast("string"), F.lit("O"))), 3).alias("mass"))


@query("""SELECT stage, rows FROM (SELECT 'base' AS stage, count(*) AS rows FROM supplier UNION ALL SELECT 'links', count(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) UNION ALL SELECT 'pruned', count(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'))""")
def staged_pipeline(spark, d):
    """Stages with their row counts, run by the staged runner."""
    from grafloom.plans.staged import Stage, count_stages

    item = V.table(spark, d, "lineitem")
    stages = [
        Stage("base", lambda _: V.table(spark, d, "supplier")),
        Stage("links", lambda _: item.select("l_suppkey", "l_partkey", "l_returnflag").distinct(), view=lambda df: df.select("l_suppkey", "l_partkey").distinct()),
        Stage("pruned", lambda prev: prev.where("l_returnflag = 'R'").select("l_suppkey", "l_partkey").distinct()),
    ]
    return count_stages(spark, stages)
