"""Trees of any size: interval labels, nearest marked ancestors and ancestor tests, in rounds by the logarithm of the depth.

Pointer doubling: every node knows an ancestor 2^k steps up and what lies on the way there; a round joins that table with
itself on the pointer, which doubles the way. Nodes whose pointer has left the tree take no part in further joins. Edges
are (child, parent), and a node has one parent at most; others raise ValueError, as cycles do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grafloom.scratch import discard, materialise

#: Rows that a task puts in order, about.
ROWS_A_TASK = 1_000_000


def is_forest(edges: DataFrame) -> bool:
    """Whether no node has several parents; repeated edges count once."""
    return edges.where("child <> parent").groupBy("child").agg((F.min("parent") != F.max("parent")).alias("several")).where("several").isEmpty()


def forest(edges: DataFrame) -> DataFrame:
    """(node, parent) of every node in the edges, roots with a null parent. Edges from a node to itself, or with a null, don't count."""
    if not is_forest(edges):
        raise ValueError("a node has several parents")
    e = edges.where("child is not null and parent is not null")
    up = e.groupBy(F.col("child").alias("node")).agg(F.min(F.when(F.col("child") != F.col("parent"), F.col("parent"))).alias("parent"))
    return materialise(e.select(F.col("parent").alias("node")).distinct().join(up, "node", "full").select("node", "parent"), "forest")


def _doubled(state: DataFrame, joined: dict[str, Column]) -> DataFrame:
    """The next round: `joined` gives the new columns from the own ones and those of the node at `jump`, prefixed by `up_`."""
    on_way = state.where("jump is not null")
    at = state.select(*[F.col(c).alias(f"up_{c}") for c in state.columns])
    out = on_way.join(at, F.col("jump") == F.col("up_node")).select("node", F.col("up_jump").alias("jump"), *[c.alias(n) for n, c in joined.items()])
    rest = state.where("jump is null")
    return materialise(out.unionByName(rest.select(*out.columns)), "doubled")


def _check(rounds: int, nodes: int) -> None:
    """No way in a tree is longer than it has nodes."""
    if rounds > nodes.bit_length():
        raise ValueError("the edges have a cycle")


def nearest(edges: DataFrame, marks: DataFrame, names: Sequence[str], most_depth: int = 1 << 30) -> DataFrame:
    """(node, and for each name `<name>` and `<name>_depth`) of every node in the edges or marks: the nearest node at or above it that is marked.

    marks is (node, ...) with a true column for each name. Raises RuntimeError if a node lies deeper than most_depth.
    """
    flags = marks.groupBy("node").agg(*[F.max(F.coalesce(F.col(n), F.lit(False))).alias(n) for n in names])
    state = forest(edges).join(flags, "node", "full")
    hit = lambda n: F.when(F.col(n), F.struct(F.col("node"), F.lit(0).cast("long").alias("steps")))
    state = materialise(state.select("node", F.col("parent").alias("jump"), F.when(F.col("parent").isNotNull(), 1).otherwise(0).cast("long").alias("way"), *[hit(n).alias(n) for n in names]), "nearest")
    rounds, nodes = 0, state.count()
    while not state.where("jump is not null").isEmpty():
        _check(rounds := rounds + 1, nodes)
        far = lambda n: F.coalesce(F.col(n), F.when(F.col(f"up_{n}").isNotNull(), F.struct(F.col(f"up_{n}.node").alias("node"), (F.col(f"up_{n}.steps") + F.col("way")).alias("steps"))))  # noqa: E731, B023
        before, state = state, _doubled(state, {"way": F.col("way") + F.col("up_way")} | {n: far(n) for n in names})
        discard(before)
    if not state.where(F.col("way") > most_depth).isEmpty():
        raise RuntimeError(f"paths longer than {most_depth}")
    return state.select("node", *[c for n in names for c in (F.col(f"{n}.node").alias(n), F.col(f"{n}.steps").alias(f"{n}_depth"))])


def _before(rows: DataFrame, group: str, order: str, size: str, rows_a_task: int) -> DataFrame:
    """rows with `before`: the sum of `size` over the group's earlier rows. Rows are put in order in ranges, so that a group of any size is spread over tasks."""
    n = max(1, -(-rows.count() // rows_a_task))
    # the range of a row is written, as ranges are cut by a sample
    ranged = materialise(rows.repartitionByRange(n, group, order).withColumn("__range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("__range").orderBy(F.col(group).asc_nulls_first(), order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__range").agg(F.sum(size).alias("__t"))  # a row a range
    earlier = totals.select("__range", F.coalesce(F.sum("__t").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__earlier"))
    out = ranged.withColumn("__in", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(F.broadcast(earlier), "__range").withColumn("__at", F.col("__in") + F.col("__earlier"))
    out = materialise(out.drop("__in", "__earlier", "__range"), "placed")
    start = out.groupBy(group).agg(F.min("__at").alias("__start"))
    own = start.withColumnRenamed(group, "__group")
    return out.join(own, out[group].eqNullSafe(F.col("__group"))).withColumn("before", F.col("__at") - F.col("__start")).drop("__at", "__start", "__group")


def intervals(edges: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """(node, pre, last, depth): numbers of a walk through the trees, parents before children and siblings in order, from 0.

    A node's descendants, itself included, are those whose `pre` lies between its `pre` and `last`, so that an
    ancestor test is one comparison and a subtree one range. Roots have depth 0; trees follow each other in order of their roots.
    """
    state = forest(edges).select("node", F.col("parent").alias("jump"), F.lit(1).cast("long").alias("size"), F.when(F.col("parent").isNotNull(), 1).otherwise(0).cast("long").alias("depth"))
    tables = [materialise(state, "sizes")]
    nodes = tables[0].count()
    # a round adds what nodes 2^k below have gathered
    while not (state := tables[-1]).where("jump is not null").isEmpty():
        _check(len(tables), nodes)
        gathered = state.where("jump is not null").groupBy(F.col("jump").alias("node")).agg(F.sum("size").alias("below"))
        up = _doubled(state, {"size": F.col("size"), "depth": F.col("depth") + F.col("up_depth")})
        tables.append(materialise(up.join(gathered, "node", "left").select("node", "jump", (F.col("size") + F.coalesce("below", F.lit(0))).alias("size"), "depth"), "sizes"))
        discard(up)
    whole = tables[-1].select("node", "size", "depth")
    placed = _before(tables[0].select("node", F.col("jump").alias("parent")).join(whole, "node"), "parent", "node", "size", rows_a_task)
    pre = materialise(placed.select("node", (F.col("before") + F.when(F.col("parent").isNull(), 0).otherwise(1)).alias("pre"), "size", "depth"), "pre")
    # a round adds what lies on the way from the ancestor 2^k above
    for jumps in tables[:-1]:
        above = jumps.where("jump is not null").select("node", "jump").join(pre.select(F.col("node").alias("jump"), F.col("pre").alias("up")), "jump").select("node", "up")
        before, pre = pre, materialise(pre.join(above, "node", "left").select("node", (F.col("pre") + F.coalesce("up", F.lit(0))).alias("pre"), "size", "depth"), "pre")
        discard(before)
    for table in tables:
        discard(table)
    return pre.select("node", "pre", (F.col("pre") + F.col("size") - 1).alias("last"), "depth")


def ancestor_tests(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (node, ancestor) with `verdict`: whether the ancestor is the node or above it; null if either isn't in the trees."""
    low = labels.select(F.col("node").alias("ancestor"), F.col("pre").alias("__low"), F.col("last").alias("__high"))
    at = labels.select("node", F.col("pre").alias("__at"))
    return pairs.join(at, "node", "left").join(low, "ancestor", "left").withColumn("verdict", F.col("__at").between(F.col("__low"), F.col("__high"))).drop("__at", "__low", "__high")


def subtree(labels: DataFrame, root) -> DataFrame:
    """The labels of the node `root` and all below it: one range of `pre`."""
    own = labels.where(F.col("node") == root).select(F.col("pre").alias("__low"), F.col("last").alias("__high")).first()
    return labels.where(F.col("pre").between(own["__low"], own["__high"])) if own else labels.limit(0)
