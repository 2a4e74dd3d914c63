"""Tables of studies, diseases, targets and names as triples, and repairs of classes and properties."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.operators import entities, graph
from grafloom.operators import triples as T

RDFS, OWL, XSD = "http://www.w3.org/2000/01/rdf-schema#", "http://www.w3.org/2002/07/owl#", "http://www.w3.org/2001/XMLSchema#"
TYPE, LABEL, SUBCLASS = "<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>", f"<{RDFS}label>", f"<{RDFS}subClassOf>"


# ---- joins of several tables ----


def gated_targets(associations: DataFrame, activities: DataFrame, targets: DataFrame, genes: DataFrame) -> DataFrame:
    """(plant, gene) through plant-ingredient, ingredient-target and target-gene pairs, for genes that are known."""
    known = genes.select(F.lower(terms.strip(F.col("gene"))).alias("gene")).distinct()
    t = targets.select("target", F.lower(terms.strip(F.col("symbol"))).alias("gene")).where("gene <> ''").join(known, "gene", "left_semi")
    pairs = activities.select("ingredient", "target").distinct().join(t, "target").select("ingredient", "gene").distinct()
    return associations.select("plant", "ingredient").distinct().join(pairs, "ingredient").select("plant", "gene").distinct()


def many_to_many(aggregate: DataFrame, *sides: tuple[DataFrame, str]) -> DataFrame:
    """Left joins on normalised keys, each side's repeated rows once; rows multiply by the matches of every side, as an older generation had it."""
    out = aggregate
    for n, (side, key) in enumerate(sides):
        s = side.dropDuplicates().withColumn(f"__k{n}", terms.alnum_upper(F.col(key)))
        s = s.withColumnsRenamed({c: f"{c}_{n}" for c in side.columns})
        out = out.join(s, terms.alnum_upper(F.col(key)) == F.col(f"__k{n}"), "left").drop(f"__k{n}")
    return out


def with_fallback_name(rows: DataFrame, key: str, names: DataFrame, as_column: str) -> DataFrame:
    """rows with the name of the key from names (key, name), or the key itself; of several names the largest."""
    n = names.where(~terms.is_na(F.col("name"))).groupBy(F.col(key).alias("__k")).agg(F.max("name").alias("__n"))
    return rows.join(n, F.col(key) == F.col("__k"), "left").withColumn(as_column, F.coalesce("__n", key)).drop("__k", "__n")


# ---- tables as triples ----


def trial_triples(rows: DataFrame, ns: str) -> DataFrame:
    """Rows (plant, nct, title, phase, condition, associated_by) as trials with phases and conditions, linked to the plant by what the source column says.

    Only ids of the form NCT and eight digits count; an association of ingredients isn't one of the plant.
    """
    rows = rows.where(F.col("nct").rlike(r"^NCT\d{8}$"))
    node = terms.iri(F.concat(F.lit("ClinicalTrial_CT_"), "nct"), ns)
    p = lambda x: f"<{ns}{x}>"
    first = rows.groupBy("nct").agg(F.min(terms.nullify(F.col("title"))).alias("title"))
    about = T.unpivot(first, node, {TYPE: F.lit(p("ClinicalTrial")), LABEL: terms.nt_literal(F.coalesce(terms.cut_label(F.col("title")), "nct")), p("hasNCTId"): terms.nt_literal(F.col("nct"))})
    more = T.unpivot(rows, node, {p("hasPhase"): terms.nt_literal(terms.nullify(F.col("phase"))), p("hasCondition"): terms.nt_literal(terms.nullify(F.col("condition"))), p("sourceColumn"): terms.nt_literal(terms.nullify(F.col("associated_by")))})
    by_plant = F.lower("associated_by").rlike(r"of_?plant$|^plant$")
    link = rows.where("plant is not null").select(terms.iri(terms.safe_local(F.col("plant")), ns).alias("s"), F.when(F.coalesce(by_plant, F.lit(False)), p("hasClinicalStudy")).otherwise(p("hasIngredientClinicalStudy")).alias("p"), node.alias("o"))
    return T.triples(about, more, link)


def disease_nodes(rows: DataFrame) -> DataFrame:
    """(node, name, category) of rows (code, name, category): keyed by code, else by name; the smallest name wins, a category loses its number."""
    key = F.coalesce(terms.nullify(F.col("code")), terms.nullify(F.col("name")))
    g = rows.where(key.isNotNull()).groupBy(key.alias("key")).agg(F.min(terms.nullify(F.col("name"))).alias("name"), F.min(F.regexp_replace(terms.nullify(F.col("category")), r"^\d+\.\s*", "")).alias("category"))
    return g.select(F.concat(F.lit("Disease_ICD11_"), terms.safe_key(F.col("key"))).alias("node"), F.coalesce("name", "key").alias("name"), "category")


def exact_matches(names: DataFrame, known: DataFrame) -> DataFrame:
    """names (node, name) with the id of known (id, name) of an equal name in lower case; null where there is none."""
    k = known.groupBy(F.lower("name").alias("__n")).agg(F.min("id").alias("id"))
    return names.join(k, F.lower("name") == F.col("__n"), "left").drop("__n")


def descriptor_triples(rows: DataFrame, node: str, kinds: Mapping[str, str], ns: str) -> DataFrame:
    """Columns of numbers as typed literals; `kinds` has each column's XSD type."""
    return T.unpivot(rows, terms.iri(F.col(node), ns), {f"<{ns}{c}>": terms.nt_literal(F.col(c).cast("string"), XSD + k) for c, k in kinds.items()})


# ---- repairs ----


def consolidate_property(t: DataFrame, variants: Sequence[str], to: str) -> DataFrame:
    """Several predicates become one, wherever they stand: as predicates, and as subjects or objects of axioms."""
    names = t.sparkSession.createDataFrame([(v, to) for v in variants if v != to], "old string, new string")
    return T.remap(t, names, predicates=True)


def retire_class(t: DataFrame, old: str, new: str) -> DataFrame:
    """Instances move from the old class to the new; the old one's own triples go unless it has subclasses."""
    moved = t.select("s", "p", F.when((F.col("p") == TYPE) & (F.col("o") == old), new).otherwise(F.col("o")).alias("o")).distinct()
    children = t.where((F.col("p") == SUBCLASS) & (F.col("o") == old)).select(F.lit(old).alias("s")).distinct()
    own = moved.where(F.col("s") == old)
    return moved.where(F.col("s") != old).unionByName(own.join(children, "s", "left_semi"))


def retarget_type(t: DataFrame, old: str, new: str, where: Column | None = None) -> DataFrame:
    """Type triples of the old class (of subjects for which `where` holds) name the new one."""
    hit = (F.col("p") == TYPE) & (F.col("o") == old) & (F.lit(True) if where is None else where)
    return t.select("s", "p", F.when(hit, new).otherwise(F.col("o")).alias("o")).distinct()


def classify(nodes: DataFrame, classes: DataFrame, priority: Sequence[str], fallback: str = "Unknown", multiple: bool = False) -> DataFrame:
    """(node, class): all classes (node, class) of each node, or the first by priority; the fallback where there is none."""
    found = nodes.select("node").distinct().join(classes.select("node", "class").distinct(), "node", "left")
    if multiple:
        return found.select("node", F.coalesce("class", F.lit(fallback)).alias("class"))
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("class"))
    return found.groupBy("node").agg(F.min(F.when(rank > 0, F.struct(rank.alias("r"), "class")))["class"].alias("class")).select("node", F.coalesce("class", F.lit(fallback)).alias("class"))


def copy_subtree(t: DataFrame, root: str, prefix: str) -> DataFrame:
    """The triples of the root and all its subclasses, without `prefix` in their local names."""
    up = t.where(F.col("p") == SUBCLASS).select(F.col("o").alias("child"), F.col("s").alias("parent"))
    start = t.sparkSession.createDataFrame([(root,)], "node string")
    kept = graph.closure(up, start).select("node").union(start).distinct()
    clean = lambda c: F.when(F.col(c).startswith("<"), F.regexp_replace(c, rf"([#/]){prefix}([^#/>]*>)$", "$1$2")).otherwise(F.col(c))
    return t.join(kept, F.col("s") == F.col("node"), "left_semi").select(clean("s").alias("s"), "p", clean("o").alias("o")).distinct()


def slim_module(t: DataFrame, roots: list[str], up: int = 4, prefix: str = "") -> DataFrame:
    """The triples of the roots, of all their subclasses and of their superclasses up to so many levels, without `prefix` in local names.

    Superclass links that lead out of the module are left out.
    """
    links = t.where(F.col("p") == SUBCLASS)
    kept = graph.modules(links.select(F.col("s").alias("child"), F.col("o").alias("parent")), roots, up).select("node")
    inside = kept.select(F.col("node").alias("o")).withColumn("__in", F.lit(True))
    t = t.join(kept, F.col("s") == F.col("node"), "left_semi").join(inside, "o", "left").where((F.col("p") != SUBCLASS) | F.col("__in"))
    clean = lambda c: F.when(F.col(c).startswith("<"), F.regexp_replace(c, rf"([#/]){prefix}([^#/>]*>)$", "$1$2")).otherwise(F.col(c)) if prefix else F.col(c)
    return t.select(clean("s").alias("s"), "p", clean("o").alias("o")).distinct()


def synchronised_axioms(axioms: DataFrame, inverses: DataFrame) -> DataFrame:
    """(p, side, class) with what inverses (p, inverse) imply: a property's domain is its inverse's range."""
    pairs = inverses.select("p", "inverse").union(inverses.select("inverse", "p")).distinct()
    other = axioms.join(pairs, "p").select(F.col("inverse").alias("p"), F.when(F.col("side") == "domain", "range").otherwise("domain").alias("side"), "class")
    return axioms.select("p", "side", "class").unionByName(other).distinct()


def missing_labels(rows: DataFrame) -> DataFrame:
    """rows (node, label, genus, species) with missing labels made of genus and species."""
    made = terms.nullify(F.concat_ws(" ", terms.nullify(F.col("genus")), terms.nullify(F.col("species"))))
    return rows.withColumn("label", F.coalesce(terms.nullify(F.col("label")), made))


def apply_names(t: DataFrame, names: DataFrame, placeholder: str) -> DataFrame:
    """Labels replaced by names (node, title, iupac): the title unless it is a key or a number, else the IUPAC name; replaced nodes lose the flag."""
    title = terms.nullify(F.col("title"))
    good = title.isNotNull() & ~title.rlike(terms.INCHIKEY) & ~title.rlike(r"^(CID\s*)?\d+$")
    chosen = names.select("node", F.coalesce(F.when(good, title), terms.nullify(F.col("iupac"))).alias("name")).where("name is not null").groupBy("node").agg(F.min("name").alias("name"))
    rest = t.join(chosen, (F.col("s") == F.col("node")) & F.col("p").isin(LABEL, placeholder), "left_anti")
    there = chosen.join(t.select(F.col("s").alias("node")).distinct(), "node", "left_semi")
    return rest.select("s", "p", "o").unionByName(there.select(F.col("node").alias("s"), F.lit(LABEL).alias("p"), terms.nt_literal(F.col("name")).alias("o")))


def with_placeholders(labels: DataFrame, prefix: str = "Compound ") -> DataFrame:
    """labels (node, label, key) where missing labels become prefix and key, with `is_placeholder`."""
    missing = terms.is_na(F.col("label"))
    return labels.withColumns({"is_placeholder": missing, "label": F.when(missing, F.concat(F.lit(prefix), "key")).otherwise(terms.strip(F.col("label")))})


def flat_export(t: DataFrame, smiles: str, derived: str, label: str) -> DataFrame:
    """(smiles, plant): each compound's SMILES with the label, or else the local name, of each plant it comes from; 'N/A' without a plant."""
    text = lambda p, a, b: t.where(F.col("p") == p).select(F.col("s").alias(a), F.col("o").alias(b))
    out = text(smiles, "c", "x").join(text(derived, "c", "plant"), "c", "left").join(text(label, "plant", "l").groupBy("plant").agg(F.min("l").alias("l")), "plant", "left")
    return out.select(terms.literal_value(F.col("x")).alias("smiles"), F.coalesce(terms.literal_value(F.col("l")), terms.local_name(F.col("plant")), F.lit("N/A")).alias("plant")).distinct()


def schema_triples(spark: SparkSession, ns: str, classes: Mapping[str, str], object_properties: Mapping[str, tuple[Sequence[str], Sequence[str]]], data_properties: Mapping[str, tuple[Sequence[str], str]], inverses: Mapping[str, str] | None = None, subproperties: Mapping[str, str] | None = None) -> DataFrame:
    """A schema's triples: classes with labels, properties with domains and ranges (several classes are a union), inverses, sub-properties."""
    n, out, blanks = (lambda x: f"<{ns}{x}>"), [], iter(range(1 << 30))
    kind = lambda x: f"<{OWL}{x}>"

    def union(names: Sequence[str]) -> str:
        if len(names) == 1:
            return n(names[0])
        head, cells = f"_:u{next(blanks)}", [f"_:l{next(blanks)}" for _ in names]
        out.extend([(head, TYPE, kind("Class")), (head, kind("unionOf"), cells[0])])
        rdf = TYPE[1 : TYPE.index("#") + 1]
        for cell, name, rest in zip(cells, names, [*cells[1:], f"<{rdf}nil>"], strict=True):
            out.extend([(cell, f"<{rdf}first>", n(name)), (cell, f"<{rdf}rest>", rest)])
        return head

    for name, label in classes.items():
        out += [(n(name), TYPE, kind("Class")), (n(name), LABEL, f'"{label}"')]
    for name, (domain, reach) in object_properties.items():
        out += [(n(name), TYPE, kind("ObjectProperty")), (n(name), f"<{RDFS}domain>", union(domain)), (n(name), f"<{RDFS}range>", union(reach))]
    for name, (domain, datatype) in data_properties.items():
        out += [(n(name), TYPE, kind("DatatypeProperty")), (n(name), f"<{RDFS}domain>", union(domain)), (n(name), f"<{RDFS}range>", f"<{XSD}{datatype}>")]
    out += [(n(a), kind("inverseOf"), n(b)) for a, b in (inverses or {}).items()]
    out += [(n(a), f"<{RDFS}subPropertyOf>", n(b)) for a, b in (subproperties or {}).items()]
    return T.from_rows(spark, out)


def merge_by_key(t: DataFrame, keys: DataFrame, *order: Column) -> DataFrame:
    """Entities (node, key, ...) of an equal key become the first in order; the result is a set."""
    return entities.merge(t, entities.canonical(keys, "key", *order))
