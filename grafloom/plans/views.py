"""The driver tables seen as a knowledge graph: suppliers are plants, parts compounds, orders trials, return flags sources, nations families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.operators import triples as T
from grafloom.scratch import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def node(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(a, b, source): a supplier has a part, says a return flag."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), F.col("l_returnflag").alias("source"))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(child, parent): suppliers in nations in regions."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    return n.select(node("n", "n_nationkey").alias("child"), node("r", "n_regionkey").alias("parent")).unionByName(s.select(node("s", "s_suppkey").alias("child"), node("n", "s_nationkey").alias("parent")))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s, p, o): supplier hasCompound part, order placedBy customer, customer and supplier inNation nation, nation inRegion region."""
    t = lambda n: table(spark, sf_dir, n)
    parts = [
        # numbers are a third as long as the names made of them
        t("lineitem").select("l_suppkey", "l_partkey").distinct().select(node("s", "l_suppkey").alias("s"), F.lit("hasCompound").alias("p"), node("p", "l_partkey").alias("o")),
        t("orders").select(node("o", "o_orderkey"), F.lit("placedBy"), node("c", "o_custkey")),
        t("supplier").select(node("s", "s_suppkey"), F.lit("inNation"), node("n", "s_nationkey")),
        t("customer").select(node("c", "c_custkey"), F.lit("inNation"), node("n", "c_nationkey")),
        t("nation").select(node("n", "n_nationkey"), F.lit("inRegion"), node("r", "n_regionkey")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out


def stored_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`edges`, written once: for queries that read them several times. A file holds one predicate."""
    return materialise(edges(spark, sf_dir), "edges")


#: The same as SQL.
EDGES_SQL = """
    SELECT DISTINCT 's' || l_suppkey AS s, 'hasCompound' AS p, 'p' || l_partkey AS o FROM lineitem
    UNION ALL SELECT 'o' || o_orderkey, 'placedBy', 'c' || o_custkey FROM orders
    UNION ALL SELECT 's' || s_suppkey, 'inNation', 'n' || s_nationkey FROM supplier
    UNION ALL SELECT 'c' || c_custkey, 'inNation', 'n' || c_nationkey FROM customer
    UNION ALL SELECT 'n' || n_nationkey, 'inRegion', 'r' || n_regionkey FROM nation"""
TREE_SQL = "SELECT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier"


def literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s, p, o): names, sizes and types of parts and suppliers as N-Triples tokens; even sizes are, wrongly, typed double."""
    xsd = "http://www.w3.org/2001/XMLSchema#"
    p, s = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    size = F.col("p_size").cast("string")
    a = T.unpivot(p, node("p", "p_partkey"), {"name": terms.nt_literal(F.col("p_name"), language="en"), "size": F.when(F.col("p_size") % 2 == 0, terms.nt_literal(size, xsd + "double")).otherwise(terms.nt_literal(size, xsd + "integer")), "brand": terms.nt_literal(F.col("p_brand"))})
    b = T.unpivot(s, node("s", "s_suppkey"), {"name": terms.nt_literal(F.col("s_name")), "nation": terms.iri(F.col("s_nationkey").cast("string"), "http://x/n")})
    return a.unionByName(b)


LITERALS_SQL = """
    SELECT 'p' || p_partkey AS s, 'name' AS p, '"' || p_name || '"@en' AS o FROM part
    UNION ALL SELECT 'p' || p_partkey, 'size', '"' || p_size || '"^^<http://www.w3.org/2001/XMLSchema#' || CASE WHEN p_size % 2 = 0 THEN 'double' ELSE 'integer' END || '>' FROM part
    UNION ALL SELECT 'p' || p_partkey, 'brand', '"' || p_brand || '"' FROM part
    UNION ALL SELECT 's' || s_suppkey, 'name', '"' || s_name || '"' FROM supplier
    UNION ALL SELECT 's' || s_suppkey, 'nation', '<http://x/n' || s_nationkey || '>' FROM supplier"""
