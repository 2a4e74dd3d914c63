"""Operators over edges: closures, lineage, inverses, chains, neighbourhoods, look-ups.

Closures expand from a start set, one join a level; each level is written to the folder that all
executors share, so that plans stay short, and they end when a level finds nothing new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grafloom.operators import hierarchy
from grafloom.scratch import discard, materialise


def closure(edges: DataFrame, start: DataFrame, most_depth: int = 100) -> DataFrame:
    """(origin, node, depth): every node reached from each start (node) along edges (child, parent), with its least depth; cycles are safe.

    Raises RuntimeError if `most_depth` levels don't suffice.
    """
    e = materialise(edges.select(F.col("child").alias("__c"), F.col("parent").alias("__p")).distinct(), "edges")
    last = found = materialise(start.select(F.col("node").alias("origin"), "node").distinct().withColumn("depth", F.lit(0)), "level")
    for depth in range(1, most_depth + 2):
        step = last.join(e, F.col("node") == F.col("__c")).select("origin", F.col("__p").alias("node")).distinct()
        last = materialise(step.join(found, ["origin", "node"], "left_anti").withColumn("depth", F.lit(depth)), "level")
        if last.isEmpty():
            break
        if depth > most_depth:
            raise RuntimeError(f"paths longer than {most_depth}")
        found = found.unionByName(last)
        if depth % 8 == 0:  # few files to compare the next levels with
            found = materialise(found, "levels")
    return found.where("depth > 0")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of the edges (u, v), which count in both directions: root is the smallest node that can be reached, roots themselves are left out.

    Two alternating steps hook nodes to the smallest they know, the first those above a node, the second those below; each sums by task
    before its exchange and is written out, until the edges stay the same. Rounds grow with the logarithm of the longest path.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    e = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    was, now = None, state(e)
    while now[0] and now != was:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        above = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = above.groupBy("u").agg(F.min("v").alias("m"))
        below = above.join(least, "u").select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        old, e = e, materialise(below.where("u <> v").distinct(), "links")
        discard(old)
        was, now = now, state(e)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _nearest(edges: DataFrame, nodes: DataFrame, marks: DataFrame, names: list[str], most_depth: int) -> DataFrame:
    """hierarchy.nearest for the nodes; where a node has several parents, by all its ancestors."""
    if hierarchy.is_forest(edges):
        found = hierarchy.nearest(edges, marks, names, most_depth)
    else:
        up = closure(edges, nodes, most_depth).unionByName(nodes.select(F.col("node").alias("origin"), "node", F.lit(0).alias("depth")))
        at = up.join(marks, "node")
        best = [F.min(F.when(F.col(n), F.struct("depth", "node"))).alias(n) for n in names]
        found = at.groupBy(F.col("origin").alias("node")).agg(*best).select("node", *[c for n in names for c in (F.col(f"{n}.node").alias(n), F.col(f"{n}.depth").alias(f"{n}_depth"))])
    return nodes.select("node").distinct().join(found, "node", "left")


def lineage(edges: DataFrame, nodes: DataFrame, ranks: DataFrame, most_depth: int = 60) -> DataFrame:
    """(node, genus, family) for each node: the nearest ancestors, itself included, of these ranks (node, rank); a genus beyond the family doesn't count."""
    names = ["genus", "family"]
    near = _nearest(edges, nodes, ranks.select("node", *[(F.col("rank") == n).alias(n) for n in names]), names, most_depth)
    return near.select("node", F.when(F.col("family").isNull() | (F.col("genus_depth") <= F.col("family_depth")), F.col("genus")).alias("genus"), "family")


def kingdom(edges: DataFrame, nodes: DataFrame, ranks: DataFrame, most_depth: int = 100) -> DataFrame:
    """(node, kingdom): the name of the nearest node, itself included, of rank kingdom, else of superkingdom, else 'unknown'; ranks is (node, rank, name), a missing name gives taxid:node."""
    # Ranks that count as kingdom and as superkingdom.
    level = {"low": F.col("rank") == "kingdom", "high": F.col("rank").isin("superkingdom", "domain", "realm", "acellular root", "cellular root")}
    near = _nearest(edges, nodes, ranks.select("node", *[c.alias(n) for n, c in level.items()]), list(level), most_depth)
    names = ranks.groupBy(F.col("node").alias("at")).agg(F.min("name").alias("name"))
    near = near.select("node", F.coalesce("low", "high").alias("at")).join(names, "at", "left")
    name = F.when(F.col("at").isNotNull(), F.coalesce("name", F.concat(F.lit("taxid:"), F.col("at").cast("string")))).otherwise("unknown")
    return near.select("node", name.alias("kingdom"))


def has_ancestor(edges: DataFrame, nodes: DataFrame, ancestor) -> DataFrame:
    """(node, verdict): true if the ancestor is the node or above it; null if the node isn't in the tree. Expands once, down from the ancestor."""
    spark = edges.sparkSession
    root = spark.createDataFrame([(ancestor,)], f"node {dict(edges.dtypes)['child']}")
    down = closure(edges.select(F.col("parent").alias("child"), F.col("child").alias("parent")), root).select("node").union(root).distinct()
    known = edges.select(F.col("child").alias("node")).union(edges.select("parent")).distinct()
    return nodes.select("node").distinct().join(known.withColumn("known", F.lit(True)), "node", "left").join(down.withColumn("below", F.lit(True)), "node", "left").select("node", F.when(F.col("known"), F.coalesce("below", F.lit(False))).alias("verdict"))


def modules(edges: DataFrame, roots: Sequence[str], up: int = 4, most_depth: int = 100) -> DataFrame:
    """(node, below, above) of slim modules: bit i of `below` is set if the node is root i or under it, of `above` if it is at most `up` levels over root i.

    All roots spread at once: a round sends on only the bits that a node did not have, down without a limit, up while levels are left.
    Several parents and cycles are fine. At most 63 roots; raises RuntimeError if `most_depth` rounds don't suffice.
    """
    if len(roots) > 63:
        raise ValueError("more than 63 roots")
    spark, kind = edges.sparkSession, dict(edges.dtypes)["child"]
    e = materialise(edges.select("child", "parent").distinct(), "edges")
    bits = {r: sum(1 << i for i, x in enumerate(roots) if x == r) for r in roots}
    start = spark.createDataFrame([(r, way, b) for r, b in bits.items() for way in ("below", "above")], f"node {kind}, way string, mask long")
    last = known = materialise(start, "masks")
    for n in range(1, most_depth + 2):
        down = last.where("way = 'below'").join(e, F.col("node") == F.col("parent")).select(F.col("child").alias("node"), "way", "mask")
        climb = last.where("way = 'above'").join(e, F.col("node") == F.col("child")).select(F.col("parent").alias("node"), "way", "mask")
        step = down.unionByName(climb) if n <= up else down
        step = step.groupBy("node", "way").agg(F.bit_or("mask").alias("mask")).join(known.withColumnRenamed("mask", "had"), ["node", "way"], "left")
        new = F.col("mask").bitwiseAND(F.bitwise_not(F.coalesce("had", F.lit(0))))
        last = materialise(step.select("node", "way", new.alias("mask")).where("mask <> 0"), "masks")
        if last.isEmpty():
            break
        if n > most_depth:
            raise RuntimeError(f"paths longer than {most_depth}")
        known = materialise(known.unionByName(last).groupBy("node", "way").agg(F.bit_or("mask").alias("mask")), "masks")
    of = lambda way: F.coalesce(F.max(F.when(F.col("way") == way, F.col("mask"))), F.lit(0)).alias(way)
    return known.groupBy("node").agg(of("below"), of("above"))


def restrict(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose both ends are kept nodes."""
    n = nodes.select("node").distinct()
    return edges.join(n.withColumnRenamed("node", "child"), "child", "left_semi").join(n.withColumnRenamed("node", "parent"), "parent", "left_semi")


def with_inverses(t: DataFrame, inverses: DataFrame, symmetric: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The triples and, for each pair (p, inverse) in either reading and each symmetric predicate, the swapped ones; as a set."""
    both = inverses.select("p", "inverse").union(inverses.select("inverse", "p")).union(t.sparkSession.createDataFrame([(x, x) for x in symmetric], "p string, inverse string"))
    both = both.groupBy("p").agg(F.collect_set("inverse").alias("__to"))  # a row a predicate, so t is read once
    own = F.array(F.struct("s", "p", "o"))
    swapped = F.when(F.col("__to").isNotNull() & ~F.col("o").startswith('"'), F.transform("__to", lambda x: F.struct(F.col("o").alias("s"), x.alias("p"), F.col("s").alias("o"))))
    # few predicates have most of the triples, so those aren't dealt by predicate
    return t.join(F.broadcast(both), "p", "left").select(F.explode(F.concat(own, F.coalesce(swapped, F.slice(own, 1, 0)))).alias("x")).select("x.s", "x.p", "x.o").distinct()


def inferred_types(t: DataFrame, axioms: DataFrame, kind: str) -> DataFrame:
    """Type triples that domains and ranges, axioms (p, side, class), imply and that aren't there yet."""
    said = t.join(F.broadcast(axioms), "p").select(F.when(F.col("side") == "domain", F.col("s")).otherwise(F.col("o")).alias("s"), F.lit(kind).alias("p"), F.col("class").alias("o"))
    there = t.where(F.col("p") == kind).select("s", "p", "o")  # nothing else can equal them
    return said.where("s not like '\"%'").distinct().join(there, ["s", "p", "o"], "left_anti")


def chain(first: DataFrame, second: DataFrame) -> DataFrame:
    """(s, o) of first(s, o) followed by second(s, o), each pair once."""
    return first.select("s", F.col("o").alias("__m")).join(second.select(F.col("s").alias("__m"), "o"), "__m").select("s", "o").distinct()


def neighbourhood(edges: DataFrame, centre, hops: int = 2) -> tuple[DataFrame, DataFrame]:
    """The nodes (node, hop) within so many hops of the centre, either direction, and the edges between them."""
    found = last = edges.sparkSession.createDataFrame([(centre,)], f"node {dict(edges.dtypes)['s']}").withColumn("hop", F.lit(0))
    for hop in range(1, hops + 1):
        # only the edges at the frontier are looked at, and only their far ends are made distinct
        out = edges.join(last.select(F.col("node").alias("s")), "s", "left_semi").select(F.col("o").alias("node"))
        into = edges.join(last.select(F.col("node").alias("o")), "o", "left_semi").select(F.col("s").alias("node"))
        last = materialise(out.union(into).distinct().join(found, "node", "left_anti").withColumn("hop", F.lit(hop)), "hop")
        found = found.unionByName(last)
    inside = edges.join(found.select(F.col("node").alias("s")), "s", "left_semi").join(found.select(F.col("node").alias("o")), "o", "left_semi")
    return found, inside


def relations(t: DataFrame, centre: Column | str) -> DataFrame:
    """(neighbour, direction, p): the centre's direct relations, the first predicate of each neighbour, outgoing before incoming."""
    c = F.lit(centre) if isinstance(centre, str) else centre
    out = t.where(F.col("s") == c).select(F.col("o").alias("neighbour"), F.lit("out").alias("direction"), "p")
    into = t.where((F.col("o") == c) & (F.col("s") != c)).select(F.col("s").alias("neighbour"), F.lit("in").alias("direction"), "p")
    best = out.unionByName(into).groupBy("neighbour").agg(F.min(F.struct((F.col("direction") == "in").alias("i"), "p", "direction")).alias("x"))
    return best.select("neighbour", "x.direction", "x.p")


def _ends(t: DataFrame) -> DataFrame:
    return t.select(F.explode(F.when(F.col("s") == F.col("o"), F.array("s")).otherwise(F.array("s", "o"))).alias("node"))


def degree(t: DataFrame) -> DataFrame:
    """(node, degree): triples that a node is in; a self-loop counts once."""
    return _ends(t).groupBy("node").agg(F.count("*").alias("degree"))


def best_connected(t: DataFrame, centre: str, most: int = 32) -> DataFrame:
    """The centre's neighbours of the highest degree; only they are counted."""
    near = materialise(relations(t, centre).select(F.col("neighbour").alias("node")), "near")
    return _ends(t).join(near, "node", "left_semi").groupBy("node").agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), "node").limit(most)


def find(names: DataFrame, query: str, most: int = 10) -> DataFrame:
    """Names (id, name, weight) that contain the query: exact first, then prefix, then others; heavier first, then by name and id."""
    n, q = F.lower("name"), query.lower()
    rank = F.when((F.col("id").cast("string") == query) | (n == q), 0).when(n.startswith(q), 1).when(n.contains(q), 2)
    return names.withColumn("rank", rank).where("rank is not null").orderBy("rank", F.desc("weight"), "name", "id").limit(most)


def suggest(names: DataFrame, curated: DataFrame, query: str, most: int = 10) -> DataFrame:
    """(id, name, score) of names (id, name, nc) and curated entries (id, name, common) that contain the query.

    0 is exact, 1 a prefix, 2 another place; curated entries come half a step earlier, may match by their common name, and
    hide names that are equal but for case. Then the richest, then by name.
    """
    q = F.lit(query.lower())
    rank = F.when(F.lower("name") == q, 0.0).when(F.lower("name").startswith(q), 1.0).otherwise(2.0)
    chosen = curated.where(F.lower("name").contains(q) | F.lower("common").contains(q)).select("id", "name", (rank - 0.5).alias("score"), F.lit(1_000_000_000).cast("long").alias("nc"))
    known = curated.select(F.lower("name").alias("k")).distinct()
    others = names.where(F.lower("name").contains(q)).join(known, F.lower("name") == F.col("k"), "left_anti").select("id", "name", rank.alias("score"), F.coalesce("nc", F.lit(0)).cast("long").alias("nc"))
    return chosen.unionByName(others).orderBy("score", F.desc("nc"), "name", "id").limit(most).select("id", "name", "score")


def typeahead(index: DataFrame, selected: DataFrame, query: str, most: int = 8) -> DataFrame:
    """Rows of index (id, name, weight) not selected yet whose name contains the query, in index order."""
    return index.join(selected.select("id"), "id", "left_anti").where(F.lower("name").contains(query.lower())).orderBy(F.desc("weight"), "name", "id").limit(most)


def rdf_lists(t: DataFrame, heads: DataFrame, first: str, rest: str, nil: str, most: int = 200) -> DataFrame:
    """(node, members): each head's list members in order."""
    links = t.where(F.col("p") == rest).select(F.col("s").alias("child"), F.col("o").alias("parent")).where(F.col("parent") != nil)
    cells = closure(links, heads, most).unionByName(heads.select(F.col("node").alias("origin"), "node", F.lit(0).alias("depth")).distinct())
    items = cells.join(t.where(F.col("p") == first).select(F.col("s").alias("node"), F.col("o").alias("item")), "node")
    return items.groupBy(F.col("origin").alias("node")).agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "item"))), lambda x: x["item"]).alias("members"))


def orphans(nodes: DataFrame, *uses: DataFrame) -> DataFrame:
    """Nodes (node) that none of the uses (node) has."""
    for u in uses:
        nodes = nodes.join(u.select("node").distinct(), "node", "left_anti")
    return nodes


def first_by(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each group in the given order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")
