"""Keys, canonical choices, merging and minting of entities."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.operators import triples as T
from grafloom.operators.graph import components
from grafloom.scratch import materialise


def best_label(labels: DataFrame) -> DataFrame:
    """(s, label, alternatives) of labels (s, v): the best by terms.label_score, and the others sorted."""
    g = labels.groupBy("s").agg(F.min(terms.label_score(F.col("v"))).alias("b"), F.array_sort(F.collect_set("v")).alias("all"))
    return g.select("s", F.col("b.v").alias("label"), F.array_except("all", F.array("b.v")).alias("alternatives"))


def label_triples(t: DataFrame, label: str, alternative: str) -> DataFrame:
    """One label for each subject; its other labels become alternatives."""
    score = terms.label_score(terms.literal_value(F.col("o")))
    best = t.where(F.col("p") == label).groupBy("s").agg(F.min(F.struct(score.alias("b"), "o"))["o"].alias("__best"))
    out = t.join(best, "s", "left")
    return out.select("s", F.when((F.col("p") == label) & (F.col("o") != F.col("__best")), alternative).otherwise(F.col("p")).alias("p"), "o").distinct()


def shortest(c: Column) -> Column:
    """Aggregate: the shortest value, of equally short ones the smallest."""
    return F.min(F.struct(F.length(c).alias("n"), c.alias("v")))["v"]


def first_label(df: DataFrame, *sources: str) -> DataFrame:
    """Adds `label` and `label_source`: the first column of `sources` that isn't missing."""
    value = F.coalesce(*[terms.nullify(F.col(c)) for c in sources])
    source = F.coalesce(*[F.when(terms.nullify(F.col(c)).isNotNull(), F.lit(c)) for c in sources])
    return df.withColumns({"label": value, "label_source": source})


def canonical(nodes: DataFrame, group: str, *order: Column, guard: str | None = None) -> DataFrame:
    """(node, keep) for nodes that merge: `keep` is the first of the group in the given order.

    With a guard column a node merges only if its value is null, equals the keeper's, or the keeper has none.
    """
    first = nodes.where(F.col(group).isNotNull()).groupBy(group).agg(F.min(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.col("node").alias("keep"), *([F.col(guard).alias("__guard")] if guard else []))).alias("first"))
    out = nodes.join(first, group).where(F.col("node") != F.col("first.keep"))
    if guard:
        out = out.where(F.col(guard).isNull() | F.col("first.__guard").isNull() | (F.col(guard) == F.col("first.__guard")))
    return out.select("node", F.col("first.keep").alias("keep"))


def conflicts(nodes: DataFrame, group: str, *order: Column, guard: str) -> DataFrame:
    """(node, keep) for nodes that stay apart because the guard's values differ."""
    free = canonical(nodes, group, *order)
    return free.join(canonical(nodes, group, *order, guard=guard), ["node", "keep"], "left_anti")


def merge(t: DataFrame, merged: DataFrame, label: str | None = None, alternative: str | None = None, single: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Nodes (node, keep) are redirected to their keepers, on both sides; the result is a set.

    A redirected label becomes an alternative. A redirected single-valued property goes if the keeper has one of its own.
    """
    # the merged nodes of a part are hashed, so that its triples needn't be sorted
    m = merged.select(F.col("node").alias("__node"), F.col("keep").alias("__keep")).hint("shuffle_hash")
    t = t.select("s", "p", "o").join(m, F.col("s") == F.col("__node"), "left")
    if single:
        own = t.where(F.col("p").isin(*single)).select(F.col("s").alias("__k"), F.col("p").alias("__p")).distinct()
        clash = (F.col("__keep") == F.col("__k")) & (F.col("p") == F.col("__p"))
        t = t.join(own, clash, "left_anti")
    p = F.when(F.col("__keep").isNotNull() & (F.col("p") == label), alternative).otherwise(F.col("p")) if label else F.col("p")
    t = t.select(F.coalesce("__keep", "s").alias("s"), p.alias("p"), "o")
    return t.join(m, F.col("o") == F.col("__node"), "left").select("s", "p", F.coalesce("__keep", "o").alias("o")).distinct()


def resolution_key(*keys: tuple[str, Column]) -> Column:
    """The first non-missing key, marked with its kind, so that keys of different kinds never meet."""
    return F.coalesce(*[F.when(terms.nullify(c).isNotNull(), F.concat(F.lit(kind + ":"), terms.nullify(c))) for kind, c in keys])


def _hooked(k: DataFrame, *by: str) -> DataFrame:
    """Edges (u, v) from each node of k to the smallest that shares its `by` columns: as many as rows, for groups of any size."""
    least = k.groupBy(*by).agg(F.min("node").alias("v"))
    return k.join(least, list(by)).where("node <> v").select(F.col("node").alias("u"), "v")


def _classes(nodes: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """nodes with the column `name`: the smallest node of each one's component."""
    found = components(links).select("node", F.col("root").alias(name))
    return nodes.join(found, "node", "left").withColumn(name, F.coalesce(name, "node"))


def resolve(keys: DataFrame, guards: DataFrame | None = None) -> DataFrame:
    """(node, entity, guard, contested) for the nodes of `keys` (node, kind, key): nodes that share a key of one kind, directly or through others, are one entity, named by its smallest node.

    `guards` (node, guard) are values that an entity may have one of, say its taxon. Where nodes that are linked have several,
    they stay apart: nodes without a guard that are linked among themselves go with the one guard that they meet; if they
    meet several they are an entity of their own, `contested`. The result doesn't depend on any order. Missing keys link nothing; a node
    of none is an entity; of several guards of a node the smallest counts. A key that many nodes share makes one edge a node.
    """
    value = terms.nullify(F.col("key"))
    nodes = keys.select("node").distinct()
    k = keys.where(value.isNotNull()).select("node", F.concat("kind", F.lit(":"), value).alias("k")).distinct()
    if guards is None:
        return _classes(nodes, _hooked(k, "k"), "entity").select("node", "entity", F.lit(None).cast("string").alias("guard"), F.lit(False).alias("contested"))
    own = guards.where("guard is not null").groupBy("node").agg(F.min("guard").alias("guard"))
    k, nodes = materialise(k.join(own, "node", "left"), "keys"), materialise(nodes.join(own, "node", "left"), "nodes")
    free = k.where("guard is null")
    block = materialise(_classes(nodes.where("guard is null").select("node"), _hooked(free, "k"), "block"), "blocks")
    # the free nodes of a key are all of one block
    of_key = free.join(block, "node").groupBy("k").agg(F.min("block").alias("block"))
    met = k.where("guard is not null").select("k", "guard").distinct().join(of_key, "k").groupBy("block").agg(F.min("guard").alias("least"), F.max("guard").alias("most"))
    joins = block.join(met, "block", "left").select("node", F.when(F.col("least") == F.col("most"), F.col("least")).alias("joined"), F.coalesce(F.col("least") != F.col("most"), F.lit(False)).alias("contested"))
    nodes = materialise(nodes.join(joins, "node", "left").select("node", F.coalesce("guard", "joined").alias("guard"), F.coalesce("contested", F.lit(False)).alias("contested")), "guarded")
    final = k.select("node", "k").join(nodes, "node").withColumn("side", F.when(F.col("guard").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("guard").cast("string"))))
    return _classes(nodes, _hooked(final, "k", "side"), "entity").select("node", "entity", "guard", "contested")


def mint(rows: DataFrame, key: Column, known: DataFrame, prefix: str) -> DataFrame:
    """(key, node, is_new) for each distinct non-missing key: the known node (key, node), or a new one prefix + safe key."""
    keys = rows.select(terms.nullify(key).alias("key")).where("key is not null").distinct()
    k = known.groupBy("key").agg(F.min("node").alias("node"))
    out = keys.join(k, "key", "left")
    return out.select("key", F.coalesce("node", F.concat(F.lit(prefix), terms.safe_key(F.col("key")))).alias("node"), F.col("node").isNull().alias("is_new"))


def resolve_plants(rows: DataFrame, by_id: DataFrame, by_binomial: DataFrame, plant_names: DataFrame) -> DataFrame:
    """rows (id, name) with `node` and `how`: by id, by binomial, minted if the binomial is a known plant name (binomial), else unresolved."""
    r = rows.withColumn("__b", terms.binomial(F.col("name")))
    r = r.join(by_id.groupBy("id").agg(F.min("node").alias("__i")), "id", "left")
    r = r.join(by_binomial.where("binomial <> ''").groupBy(F.col("binomial").alias("__b")).agg(F.min("node").alias("__n")), "__b", "left")
    r = r.join(plant_names.select(F.col("binomial").alias("__b")).where("__b <> ''").distinct().withColumn("__known", F.lit(True)), "__b", "left")
    new = F.when(F.col("__known"), F.concat(F.lit("Plant_"), terms.title_case(F.split("__b", " ")[0]), F.lit("_"), F.get(F.split("__b", " "), F.lit(1))))
    how = F.when(F.col("__i").isNotNull(), "id").when(F.col("__n").isNotNull(), "binomial").when(new.isNotNull(), "minted").otherwise("unresolved")
    return r.select("id", "name", F.coalesce("__i", "__n", new).alias("node"), how.alias("how"))


def entity_triples(rows: DataFrame, id_col: str, name_col: str, kind: str, ns: str, extra: Mapping[str, str] | None = None) -> DataFrame:
    """Type and label triples, and one for each extra predicate's column; a missing id falls back on the name, rows with neither are skipped."""
    name, key = terms.nullify(F.col(name_col)), F.coalesce(terms.nullify(F.col(id_col)), terms.nullify(F.col(name_col)))
    rows = rows.where(key.isNotNull())
    lit = lambda c: terms.nt_literal(terms.nullify(c))
    said = {"<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>": F.lit(f"<{ns}{kind}>"), "<http://www.w3.org/2000/01/rdf-schema#label>": lit(F.coalesce(name, key))}
    said |= {f"<{ns}{p}>": lit(F.col(c)) for p, c in (extra or {}).items()}
    return T.unpivot(rows, terms.iri(terms.safe_local(key), ns), said).distinct()


def link_triples(rows: DataFrame, a: str, b: str, predicate: str, ns: str) -> DataFrame:
    """An edge for each row in which both ids are there."""
    ids = [terms.nullify(F.col(c)) for c in (a, b)]
    rows = rows.where(ids[0].isNotNull() & ids[1].isNotNull())
    return rows.select(terms.iri(terms.safe_local(ids[0]), ns).alias("s"), F.lit(f"<{ns}{predicate}>").alias("p"), terms.iri(terms.safe_local(ids[1]), ns).alias("o")).distinct()


def sanitize_iris(t: DataFrame, ns: str) -> DataFrame:
    """Local parts of the namespace's IRIs with every character that isn't allowed replaced."""
    fix = lambda c: F.when(F.col(c).startswith("<" + ns), F.concat(F.lit("<" + ns), F.regexp_replace(F.substr(F.col(c), F.lit(len(ns) + 2)), r"[^A-Za-z0-9_.\->]", "_"))).otherwise(F.col(c))
    return t.select(fix("s").alias("s"), "p", fix("o").alias("o")).distinct()


def mint_trials(rows: DataFrame, plant: str, text: str) -> DataFrame:
    """rows with `trial`: the first NCT id in order, else a key of plant and text; the first text wins for a trial's `label`."""
    trial = F.coalesce(F.get(terms.nct_ids(F.col(text)), F.lit(0)), terms.stable_id(F.concat_ws("|", plant, text), 12))
    rows = rows.withColumn("trial", trial)
    first = rows.groupBy("trial").agg(F.min(text).alias("__t"))
    return rows.join(first, "trial").withColumn("label", terms.cut_label(F.col("__t"))).drop("__t")


def papers(rows: DataFrame, doi: str, title: str) -> DataFrame:
    """(doi_key, label, n): rows grouped to papers by their normalised DOI; the label is the smallest title, else the DOI."""
    key = terms.normalize_doi(F.col(doi), lower=True)
    g = rows.where(terms.is_doi(key)).groupBy(key.alias("doi_key")).agg(F.min(terms.nullify(F.col(title))).alias("t"), F.count("*").alias("n"))
    return g.select("doi_key", F.coalesce("t", "doi_key").alias("label"), "n")


def bioactivities(rows: DataFrame, columns: list[str], value: str) -> DataFrame:
    """rows with `node`, a key of all columns (missing ones empty), and the value as `number`, or as `text` if it isn't one."""
    key = terms.stable_id(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    number = F.col(value).try_cast("double")
    return rows.withColumns({"node": F.concat(F.lit("Bioactivity_"), key), "number": number, "text": F.when(number.isNull(), terms.nullify(F.col(value)))})
