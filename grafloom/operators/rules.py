"""Rules over triples to a fixpoint, by semi-naive evaluation.

A round applies the rules to the facts that the round before found, and keeps what isn't known yet; it ends when nothing is.
Rules (kind, a, b) are axioms of the schema:

    sub         a triple of property a is one of b
    inverse     a triple of property a, turned round, is one of b, and the other way
    symmetric   a triple of property a, turned round, is one too (b is not looked at)
    domain      the subject of a triple of property a is of class b
    range       the object of a triple of property a is of class b
    subclass    a member of class a is one of b
    transitive  property a leads on over itself (b is not looked at)

Literals, tokens that begin with a quotation mark, are never subjects.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grafloom.scratch import materialise

KINDS = ("sub", "inverse", "symmetric", "domain", "range", "subclass", "transitive")


def _derived(delta: DataFrame, by_property: DataFrame, by_class: DataFrame, type_predicate: str) -> DataFrame:
    """What rules of one premise say of the facts."""
    node = ~F.col("o").startswith('"')
    made = F.transform("to", lambda x: F.when(x["how"] == "same", F.struct("s", x["b"].alias("p"), "o")).when((x["how"] == "turned") & node, F.struct(F.col("o").alias("s"), x["b"].alias("p"), F.col("s").alias("o"))).when(x["how"] == "subject", F.struct("s", F.lit(type_predicate).alias("p"), x["b"].alias("o"))).when((x["how"] == "object") & node, F.struct(F.col("o").alias("s"), F.lit(type_predicate).alias("p"), x["b"].alias("o"))))
    one = delta.join(by_property, "p").select(F.explode(F.filter(made, lambda x: x.isNotNull())).alias("x")).select("x.s", "x.p", "x.o")
    up = delta.where(F.col("p") == type_predicate).join(by_class, F.col("o") == F.col("a")).select("s", "p", F.explode("classes").alias("o"))
    return one.unionByName(up)


def fixpoint(t: DataFrame, rules: DataFrame, type_predicate: str = "<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>", most_rounds: int = 100) -> DataFrame:
    """(s, p, o, round) of the triples and all that follows from them, each once with the first round that finds it; given ones have round 0.

    Raises RuntimeError if `most_rounds` don't suffice, ValueError for an unknown kind of rule.
    """
    if not (odd := rules.where(~F.col("kind").isin(*KINDS)).limit(1)).isEmpty():
        raise ValueError(f"unknown rule {odd.first()['kind']}")
    turned = rules.where("kind in ('inverse', 'symmetric')")
    ways = [
        rules.where("kind = 'sub'").select("a", "b", F.lit("same").alias("how")), turned.select("a", F.when(F.col("kind") == "inverse", F.col("b")).otherwise(F.col("a")).alias("b"), F.lit("turned").alias("how")),
        turned.where("kind = 'inverse'").select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit("turned").alias("how")), rules.where("kind = 'domain'").select("a", "b", F.lit("subject").alias("how")), rules.where("kind = 'range'").select("a", "b", F.lit("object").alias("how")),
    ]
    every = ways[0]
    for x in ways[1:]:
        every = every.unionByName(x)
    spark = t.sparkSession
    # a row a property, so that a round reads its facts once
    by_property = materialise(every.groupBy(F.col("a").alias("p")).agg(F.collect_set(F.struct("b", "how")).alias("to")), "rules")
    by_class = materialise(rules.where("kind = 'subclass'").groupBy("a").agg(F.collect_set("b").alias("classes")), "rules")
    over = materialise(rules.where("kind = 'transitive'").select(F.col("a").alias("p")).distinct(), "rules")
    # only facts of properties that rules can lead to are ever compared with new ones
    heads = every.select(F.when(F.col("how").isin("same", "turned"), F.col("b")).otherwise(F.lit(type_predicate)).alias("p")).union(over).union(by_class.limit(1).select(F.lit(type_predicate).alias("p")))
    first = materialise(t.select("s", "p", "o").distinct(), "facts")
    known = [materialise(first.join(heads.distinct(), "p", "left_semi").select("s", "p", "o"), "heads")]
    # which properties a round can find follows from those of the round before; both are a schema's
    leads: dict[str, set[str]] = {}
    for a, b in every.select("a", F.when(F.col("how").isin("same", "turned"), F.col("b")).otherwise(F.lit(type_predicate))).union(over.select("p", "p")).union(by_class.limit(1).select(F.lit(type_predicate), F.lit(type_predicate))).distinct().collect():
        leads.setdefault(a, set()).add(b)
    named = spark.createDataFrame([(p,) for p in {*leads, *(b for x in leads.values() for b in x)}], "p string")
    now = {r["p"] for r in first.select("p").distinct().join(F.broadcast(named), "p", "left_semi").collect()}
    held = [now]
    found, delta, any_over = [], first, not over.isEmpty()
    steps = materialise(first.join(over, "p", "left_semi").select("s", "p", "o"), "steps") if any_over else None
    for n in range(1, most_rounds + 2):
        new = _derived(delta, by_property, by_class, type_predicate)
        if any_over:
            last = delta.join(over, "p", "left_semi").select("s", "p", "o")
            if n > 1:
                steps = steps.unionByName(last)
            onward = lambda a, b: a.select("s", "p", F.col("o").alias("m")).join(b.select(F.col("s").alias("m"), "p", "o"), ["p", "m"]).select("s", "p", "o")
            new = new.unionByName(onward(last, steps)).unionByName(onward(steps, last))
        now = {b for a in now for b in leads.get(a, ())}
        # facts of other properties can't equal the new ones
        before = [x.where(F.col("p").isin(*(now & of))) for x, of in zip(known, held, strict=True) if now & of]
        new = new.distinct()
        delta = materialise(new.join(reduce(DataFrame.unionByName, before), ["s", "p", "o"], "left_anti") if before else new, "facts")
        if delta.isEmpty():
            break
        if n > most_rounds:
            raise RuntimeError(f"rules lead on after {most_rounds} rounds")
        found.append(delta.withColumn("round", F.lit(n)))
        known.append(delta)
        held.append(now)
    out = first.withColumn("round", F.lit(0))
    for x in found:
        out = out.unionByName(x)
    return out
