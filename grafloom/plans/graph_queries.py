"""Queries by iterated joins: classes of nodes over several identifiers, labelled trees, rules to a fixpoint; each with its recursive SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.operators import audit, entities, graph, hierarchy, rules, search
from grafloom.plans import kg_queries
from grafloom.plans import views as V
from grafloom.scratch import materialise, scratch_path
from grafloom.sources import store

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---- entities ----


def _document_keys(spark, d):
    """(node, kind, key): a document's whole text, by its digest, its first and its last line."""
    text, line = F.coalesce("text", F.lit("")), lambda c: F.nullif(F.trim(c), F.lit(""))
    body = F.rtrim(text, F.lit("\n"))
    keys = {"text": F.sha2(text, 256), "first": line(F.substring_index(text, "\n", 1)), "last": line(F.substring_index(body, "\n", -1))}
    keys = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), c.alias("key")) for n, c in keys.items()]))
    return V.table(spark, d, "documents").select(F.col("doc_id").alias("node"), keys.alias("x")).select("node", "x.*")


_KEYS_SQL = r"""
    SELECT doc_id AS node, 'text:' || sha256(coalesce(text, '')) AS k FROM documents
    UNION SELECT doc_id, 'first:' || trim(split_part(text, chr(10), 1)) FROM documents WHERE trim(split_part(text, chr(10), 1)) <> ''
    UNION SELECT doc_id, 'last:' || trim(split_part(rtrim(text, chr(10)), chr(10), -1)) FROM documents WHERE trim(split_part(rtrim(text, chr(10)), chr(10), -1)) <> ''"""


@query(f"""WITH RECURSIVE k AS ({_KEYS_SQL}), e AS (SELECT DISTINCT a.node AS u, b.node AS v FROM k a JOIN k b USING (k)), r(a, b) AS (SELECT u, v FROM e UNION SELECT r.a, e.v FROM r JOIN e ON r.b = e.u)
    SELECT doc_id, coalesce(min(b), doc_id) AS entity FROM documents LEFT JOIN r ON doc_id = a GROUP BY doc_id""")
def resolved_documents(spark, d):
    """Documents that are one by text, first or last line, also by way of others."""
    return entities.resolve(_document_keys(spark, d)).select(F.col("node").alias("doc_id"), "entity")


@query(f"""WITH RECURSIVE k AS (SELECT k.*, CASE WHEN substr(source, 4)::INTEGER % 2 = 1 THEN source END AS g FROM ({_KEYS_SQL}) k JOIN documents ON node = doc_id),
    fe AS (SELECT DISTINCT a.node AS u, b.node AS v FROM k a JOIN k b USING (k) WHERE a.g IS NULL AND b.g IS NULL), fr(a, b) AS (SELECT u, v FROM fe UNION SELECT fr.a, fe.v FROM fr JOIN fe ON fr.b = fe.u),
    block AS (SELECT node, coalesce(min(b), node) AS block FROM (SELECT DISTINCT node FROM k WHERE g IS NULL) LEFT JOIN fr ON node = a GROUP BY node),
    met AS (SELECT block, count(DISTINCT o.g) AS n, min(o.g) AS g FROM block JOIN k f USING (node) JOIN k o ON o.k = f.k AND o.g IS NOT NULL GROUP BY block),
    w AS (SELECT doc_id AS node, coalesce(CASE WHEN substr(source, 4)::INTEGER % 2 = 1 THEN source END, CASE WHEN n = 1 THEN met.g END) AS guard, coalesce(n > 1, false) AS contested FROM documents LEFT JOIN block ON doc_id = node LEFT JOIN met USING (block)),
    j AS (SELECT k.node, k, coalesce(guard, '') AS side FROM k JOIN w USING (node)), e AS (SELECT DISTINCT a.node AS u, b.node AS v FROM j a JOIN j b USING (k, side)), r(a, b) AS (SELECT u, v FROM e UNION SELECT r.a, e.v FROM r JOIN e ON r.b = e.u)
    SELECT node AS doc_id, coalesce(min(b), node) AS entity, guard, contested FROM w LEFT JOIN r ON node = a GROUP BY node, guard, contested""")
def resolved_with_guard(spark, d):
    """The same, but an entity may have one source; documents of every other source have none."""
    guard = F.when(F.substring("source", 4, 9).cast("int") % 2 == 1, F.col("source"))
    guards = V.table(spark, d, "documents").select(F.col("doc_id").alias("node"), guard.alias("guard"))
    return entities.resolve(_document_keys(spark, d), guards).withColumnRenamed("node", "doc_id")


# ---- trees ----


def _tree(spark, d):
    """(child, parent): parts under parts by their keys' halves, seven levels at least, and suppliers in nations in regions."""
    p = V.table(spark, d, "part").where("p_partkey > 0").select(V.node("p", "p_partkey").alias("child"), F.concat(F.lit("p"), F.floor(F.col("p_partkey") / 2).cast("string")).alias("parent"))
    return p.unionByName(V.tree(spark, d))


_TREE = f"SELECT 'p' || p_partkey AS child, 'p' || (p_partkey // 2) AS parent FROM part WHERE p_partkey > 0 UNION ALL ({V.TREE_SQL})"


@query(f"""WITH RECURSIVE t AS ({_TREE}), n AS (SELECT child AS node FROM t UNION SELECT parent FROM t),
    a(node, path, depth) AS (SELECT node, [node], 0 FROM n WHERE node NOT IN (SELECT child FROM t) UNION ALL SELECT child, list_append(path, child), depth + 1 FROM a JOIN t ON parent = node),
    below(up, node) AS (SELECT node, node FROM n UNION ALL SELECT up, child FROM below JOIN t ON parent = node), s AS (SELECT up AS node, count(*) AS size FROM below GROUP BY up),
    o AS (SELECT node, depth, row_number() OVER (ORDER BY path) - 1 AS pre FROM a) SELECT node, pre, pre + size - 1 AS last, depth::BIGINT AS depth FROM o JOIN s USING (node)""")
def tree_intervals(spark, d):
    """Numbers of a walk, so that an ancestor test is one comparison."""
    return hierarchy.intervals(_tree(spark, d))


@query(f"""WITH RECURSIVE t AS ({_TREE}), up(node, anc) AS (SELECT child, parent FROM t UNION ALL SELECT node, parent FROM up JOIN t ON child = anc), p AS (SELECT 'p' || p_partkey AS node, 'p' || p_size AS ancestor FROM part),
    n AS (SELECT child AS node FROM t UNION SELECT parent FROM t) SELECT p.node, p.ancestor, CASE WHEN p.node IN (SELECT node FROM n) AND ancestor IN (SELECT node FROM n) THEN p.node = ancestor OR (p.node, ancestor) IN (SELECT (node, anc) FROM up) END AS verdict FROM p""")
def ancestor_tests(spark, d):
    """Is each part under the part of its size's number?"""
    pairs = V.table(spark, d, "part").select(V.node("p", "p_partkey").alias("node"), V.node("p", "p_size").alias("ancestor"))
    return hierarchy.ancestor_tests(hierarchy.intervals(_tree(spark, d)), pairs)


@query(f"""WITH RECURSIVE t AS ({_TREE}), m AS (SELECT 'p' || p_partkey AS node, p_type, p_size FROM part), up(node, anc, depth) AS (SELECT node, node, 0 FROM m UNION ALL SELECT up.node, parent, depth + 1 FROM up JOIN t ON child = anc),
    x AS (SELECT up.node, anc, depth, p_type, p_size FROM up JOIN m ON anc = m.node),
    r AS (SELECT node, min(CASE WHEN p_size < 10 THEN depth END) AS g, min(CASE WHEN p_type = 'ECONOMY' THEN depth END) AS f, arg_min(anc, depth) FILTER (p_size < 10) AS genus, arg_min(anc, depth) FILTER (p_type = 'ECONOMY') AS family FROM x GROUP BY node)
    SELECT node, CASE WHEN f IS NULL OR g <= f THEN genus END AS genus, family FROM r""")
def nearest_ranks(spark, d):
    """The nearest of two ranks on paths of any length, found by doubling."""
    p = V.table(spark, d, "part")
    rank = F.explode(F.array(F.when(F.col("p_size") < 10, "genus"), F.when(F.col("p_type") == "ECONOMY", "family")))
    return graph.lineage(_tree(spark, d), p.select(V.node("p", "p_partkey").alias("node")), p.select(V.node("p", "p_partkey").alias("node"), rank.alias("rank")))


@query(f"""WITH RECURSIVE t AS ({V.TREE_SQL}), up(node, anc, depth) AS (SELECT 's' || s_suppkey, 's' || s_suppkey, 0 FROM supplier UNION ALL SELECT node, parent, depth + 1 FROM up JOIN t ON child = anc),
    k AS (SELECT 'n' || n_nationkey AS anc, 0 AS level, n_name AS name FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT 'r' || r_regionkey, 1, CASE WHEN r_regionkey % 2 = 0 THEN r_name ELSE 'taxid:r' || r_regionkey END FROM region WHERE r_regionkey <> 4)
    SELECT 's' || s_suppkey AS node, coalesce(name, 'unknown') AS kingdom FROM supplier LEFT JOIN (SELECT node, arg_min(name, level * 100 + depth) AS name FROM up JOIN k USING (anc) GROUP BY node) ON node = 's' || s_suppkey""")
def kingdoms_of_suppliers(spark, d):
    """Kingdoms are every third nation, else superkingdoms are regions, some without a name."""
    nations = V.table(spark, d, "nation").select(V.node("n", "n_nationkey").alias("node"), F.when(F.col("n_nationkey") % 3 == 0, "kingdom").otherwise("family").alias("rank"), F.col("n_name").alias("name"))
    regions = V.table(spark, d, "region").select(V.node("r", "r_regionkey").alias("node"), F.when(F.col("r_regionkey") != 4, "superkingdom").alias("rank"), F.when(F.col("r_regionkey") % 2 == 0, F.col("r_name")).alias("name"))
    return graph.kingdom(V.tree(spark, d), V.table(spark, d, "supplier").select(V.node("s", "s_suppkey").alias("node")), nations.unionByName(regions))


@query(f"""WITH RECURSIVE t AS ({V.TREE_SQL} UNION ALL SELECT DISTINCT 'p' || l_partkey, 's' || l_suppkey FROM lineitem), r(root, bit) AS (VALUES ('r1', 1), ('n3', 2), ('s7', 4)),
    d(node, bit) AS (SELECT root, bit FROM r UNION SELECT child, bit FROM d JOIN t ON parent = node), u(node, bit, depth) AS (SELECT root, bit, 0 FROM r UNION SELECT parent, bit, depth + 1 FROM u JOIN t ON child = node WHERE depth < 1),
    x AS (SELECT node, bit, 0 AS bit2 FROM d UNION SELECT node, 0, bit FROM u) SELECT node, bit_or(bit)::BIGINT AS below, bit_or(bit2)::BIGINT AS above FROM x GROUP BY node""")
def slim_modules(spark, d):
    """Three roots over regions, nations, suppliers and their parts (a part has many suppliers), down all levels and up one, in one run."""
    parts = V.table(spark, d, "lineitem").select(V.node("p", "l_partkey").alias("child"), V.node("s", "l_suppkey").alias("parent")).distinct()
    return graph.modules(V.tree(spark, d).unionByName(parts), ["r1", "n3", "s7"], up=1)


# ---- rules ----

#: A chain of five sub-properties, an inverse at its end, places within places, and classes of classes.
RULES = [
    ("sub", "placedBy", "p1"), ("sub", "p1", "p2"), ("sub", "p2", "p3"), ("sub", "p3", "p4"), ("sub", "p4", "p5"), ("inverse", "p5", "q5"), ("sub", "q5", "touches"), ("symmetric", "touches", None),
    ("sub", "inNation", "within"), ("sub", "inRegion", "within"), ("transitive", "within", None), ("inverse", "within", "holds"), ("domain", "placedBy", "Order"), ("range", "q5", "Order"),
    ("range", "placedBy", "Customer"), ("domain", "within", "Place"), ("subclass", "Order", "Document"), ("subclass", "Document", "Thing"), ("subclass", "Place", "Thing"), ("subclass", "Customer", "Place"),
]


@query(f"""WITH RECURSIVE e AS ({V.EDGES_SQL}),
    r(k, a, b) AS (VALUES ('same', 'placedBy', 'p1'), ('same', 'p1', 'p2'), ('same', 'p2', 'p3'), ('same', 'p3', 'p4'), ('same', 'p4', 'p5'), ('turned', 'p5', 'q5'), ('turned', 'q5', 'p5'), ('same', 'q5', 'touches'), ('turned', 'touches', 'touches'),
        ('same', 'inNation', 'within'), ('same', 'inRegion', 'within'), ('turned', 'within', 'holds'), ('turned', 'holds', 'within'), ('s', 'placedBy', 'Order'), ('o', 'q5', 'Order'), ('o', 'placedBy', 'Customer'), ('s', 'within', 'Place'),
        ('up', 'Order', 'Document'), ('up', 'Document', 'Thing'), ('up', 'Place', 'Thing'), ('up', 'Customer', 'Place')),
    f(s, p, o) AS (SELECT s, p, o FROM e UNION SELECT a.s, 'within', b.o FROM e a JOIN e b ON a.o = b.s WHERE a.p = 'inNation' AND b.p = 'inRegion'
        UNION SELECT CASE WHEN k = 'turned' OR k = 'o' THEN o ELSE s END, CASE WHEN k IN ('same', 'turned') THEN b ELSE 'type' END, CASE WHEN k = 'same' THEN o WHEN k = 'turned' THEN s ELSE b END FROM f JOIN r ON (k <> 'up' AND p = a) OR (k = 'up' AND p = 'type' AND o = a))
    SELECT s, p, o FROM f EXCEPT SELECT s, p, o FROM e""")
def closed_rules(spark, d):
    """All that follows from rules that feed each other, round by round from new facts only."""
    r = spark.createDataFrame(RULES, "kind string, a string, b string")
    return rules.fixpoint(V.edges(spark, d), r, "type").where("round > 0").select("s", "p", "o")


# ---- samples and sketches ----


@query(f"""WITH e AS ({V.EDGES_SQL}), k AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY p ORDER BY md5(s || ' ' || o), s, o) <= 500),
    c AS (SELECT p, CASE o[1] WHEN 'c' THEN 'Agent|Customer' WHEN 'n' THEN 'Nation' WHEN 'r' THEN '' ELSE CASE WHEN substr(o, 2)::BIGINT % 3 = 0 THEN 'Part' ELSE '' END END AS combo, o FROM k)
    SELECT p, combo, count(*) AS n, min(o) AS example FROM c GROUP BY p, combo""")
def object_types(spark, d):
    """Classes of the objects in a sample of 500 triples of each predicate, kept by hash in one pass."""
    e = V.stored_edges(spark, d)
    classes = F.when(F.col("s").startswith("c"), F.array(F.lit("Customer"), F.lit("Agent"))).when(F.col("s").startswith("n"), F.array(F.lit("Nation"))).when(F.col("s").startswith("p") & (F.substring("s", 2, 20).cast("long") % 3 == 0), F.array(F.lit("Part")))
    types = e.select(F.col("o").alias("s")).distinct().select("s", F.explode(classes).alias("class"))
    return audit.object_types(e, types, 500, by=F.md5(F.concat("s", F.lit(" "), "o").cast("binary")))


@query("""SELECT event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id::VARCHAR), event_id) <= 1500""")
def bottom_k_sample(spark, d):
    """H6: a sample of each stratum by hash, larger than Spark's own limit on ranks."""
    e = V.table(spark, d, "events").select("event_id", "event_type")
    return audit.bottom_k(e, 1500, ["event_type"], [F.col("event_id")], by=F.md5(F.col("event_id").cast("string").cast("binary")))


@query(f"""WITH l AS ({V.LITERALS_SQL} UNION ALL SELECT 'x' || doc_id, 'text', '"' || CASE WHEN doc_id % 7 = 0 THEN 'n/a' ELSE 'text ' || doc_id END || '"' FROM documents)
    SELECT p, count(*) AS triples, count_if(starts_with(o, '"')) AS lit, count_if(o = '"n/a"') AS na, true AS subjects_hold, true AS objects_hold, true AS most_holds, true AS median_holds FROM l GROUP BY p""")
def sketched_profile(spark, d):
    """A merged profile of two halves, and whether its estimates keep their bounds against exact figures."""
    more = V.table(spark, d, "documents").select(F.concat(F.lit("x"), F.col("doc_id").cast("string")).alias("s"), F.lit("text").alias("p"), terms.nt_literal(F.when(F.col("doc_id") % 7 == 0, "n/a").otherwise(F.concat(F.lit("text "), F.col("doc_id").cast("string")))).alias("o"))
    t = V.literals(spark, d).unionByName(more)
    half = F.crc32(F.col("s").cast("binary")) % 2
    found = audit.profile_figures(audit.merge_profiles(audit.profile(t.where(half == 0)), audit.profile(t.where(half == 1))))
    per = t.groupBy("p", "s").agg(F.count("*").alias("n")).groupBy("p").agg(F.count("*").alias("n_s"), F.max("n").alias("n_most"))
    lengths = F.length(F.regexp_extract("o", r'(?s)^"(.*)"[^"]*$', 1))
    # beside a distinct count, the percentiles would be kept for each object
    objects = t.groupBy("p").agg(F.countDistinct("o").alias("n_o"))
    middle = t.groupBy("p").agg(F.percentile_approx(lengths, [0.5 - audit.WITHIN_RANK, 0.5 + audit.WITHIN_RANK], F.lit(100_000)).alias("mid"))
    x = found.join(per, "p").join(objects, "p").join(middle, "p")
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= audit.WITHIN_DISTINCT * F.col(b)
    first, slack = F.get("frequent", F.lit(0))["count"], F.col("triples") / audit.TRACKED * 4
    # no subject is told where none has more triples than a count may be off by
    most = F.when(first.isNull(), F.col("n_most") <= slack).otherwise(first.between(F.col("n_most"), F.col("n_most") + slack))
    median = F.col("median_length").isNull() | F.col("median_length").between(F.col("mid")[0], F.col("mid")[1])
    return x.select("p", "triples", "lit", "na", near("subjects", "n_s").alias("subjects_hold"), near("objects", "n_o").alias("objects_hold"), most.alias("most_holds"), median.alias("median_holds"))


# ---- search, edits, counters ----


@query("""SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ing') ORDER BY CASE WHEN lower(p_name) = 'ing' THEN 0 WHEN starts_with(lower(p_name), 'ing') THEN 1 ELSE 2 END, p_retailprice DESC, p_name, p_partkey LIMIT 10""")
def indexed_find(spark, d):
    """The top names by a trigram index."""
    path = scratch_path(spark, "index")
    search.build(V.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("weight")), path, chunk_names=500)
    return graph.find(search.candidates(spark, path, "Ing"), "ing", 10).select(F.col("id").alias("p_partkey"), F.col("name").alias("p_name"))


@query("""SELECT doc_id FROM documents WHERE contains(lower(text), 'ation') OR contains(lower(text), 'heon th')""")
def indexed_texts(spark, d):
    """All documents with either of two strings, by the index of their whole texts."""
    path = scratch_path(spark, "index")
    search.build(V.table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("name")), path, chunk_names=400)
    found = search.candidates(spark, path, "ation").select("id").union(search.candidates(spark, path, "heon th").select("id"))
    return found.distinct().select(F.col("id").alias("doc_id"))


@query(f"""WITH e AS ({V.EDGES_SQL}) SELECT s, p, o FROM e WHERE s NOT IN ('s1', 'c2') AND o <> 'c2' AND NOT (p = 'placedBy' AND substr(s, 2)::BIGINT % 5 = 0) UNION SELECT 's1', 'hasCompound', 'p' || p_partkey FROM part WHERE p_size = 1 UNION SELECT 'o' || o_orderkey, 'urgent', 'yes' FROM orders WHERE o_orderpriority LIKE '1%'""")
def edited_store(spark, d):
    """A node's triples replaced, triples added and removed, a node taken out, with a compaction between the edits."""
    kept = store.TripleStore.create(V.edges(spark, d), scratch_path(spark, "store"), 16)
    orders = V.table(spark, d, "orders").select(V.node("o", "o_orderkey").alias("s"), "o_orderkey", "o_custkey", "o_orderpriority")
    kept.edit(remove=orders.where("o_orderkey % 5 = 0").select("s", F.lit("placedBy").alias("p"), V.node("c", "o_custkey").alias("o")))
    kept.compact()
    kept.replace_subjects(V.table(spark, d, "part").where("p_size = 1").select(F.lit("s1").alias("s"), F.lit("hasCompound").alias("p"), V.node("p", "p_partkey").alias("o")))
    kept.edit(add=orders.where("o_orderpriority like '1%'").select("s", F.lit("urgent").alias("p"), F.lit("yes").alias("o")))
    kept.remove_nodes(spark.createDataFrame([("c2",)], "node string"))
    return kept.read()


@query(f"SELECT {kg_queries.ACTION} AS action, count(*) AS n FROM ({V.EDGES_SQL}) GROUP BY 1")
def observed_counts(spark, d):
    """Counts by rule that the rewriting pass itself takes while its result is written."""
    out, marks = kg_queries._rules().observed(V.edges(spark, d), "rules")
    materialise(out, "rewritten")
    return spark.createDataFrame([(k, n) for k, n in marks.get.items() if n], "action string, n long")
