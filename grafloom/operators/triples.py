"""Set algebra and rewriting of triples (s, p, o).

A triple frame has the raw N-Triples tokens s, p and o; the tokens are its identity. Frames that steer an
operator (drop lists, maps) are joined without hints: Spark broadcasts those it knows to be small.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from grafloom.functions import terms

SPO = ("s", "p", "o")


def triples(*frames: DataFrame) -> DataFrame:
    """Union of frames as a set."""
    out = frames[0].select(*SPO)
    for f in frames[1:]:
        out = out.unionByName(f.select(*SPO))
    return out.distinct()


def from_rows(spark: SparkSession, rows: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rows), "s string, p string, o string")


def with_terms(t: DataFrame) -> DataFrame:
    """Adds o_kind, lex, dt and lang, derived from the token o."""
    o = F.col("o")
    return t.withColumns({"o_kind": terms.term_kind(o), "lex": F.when(o.startswith('"'), terms.literal_value(o)), "dt": terms.literal_datatype(o), "lang": terms.literal_language(o)})


def unpivot(df: DataFrame, subject: Column, predicates: Mapping[str, Column]) -> DataFrame:
    """A triple for each predicate's non-null object token."""
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), o.alias("o")) for p, o in predicates.items()])
    return df.select(subject.alias("s"), F.explode(pairs).alias("x")).select("s", "x.p", "x.o").where("s is not null and o is not null")


def star(t: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per subject: for each column (predicate, how) the `min`, `max`, `set` (sorted) or `count` of its objects.

    One aggregation instead of a self-join for each predicate.
    """
    how = {"min": F.min, "max": F.max, "count": F.count, "set": lambda c: F.array_sort(F.collect_set(c))}
    wanted = sorted({p for p, _ in columns.values()})
    aggs = [how[h](F.when(F.col("p") == p, F.col("o"))).alias(name) for name, (p, h) in columns.items()]
    return t.where(F.col("p").isin(*wanted)).groupBy("s").agg(*aggs)


# ---- filters ----


def by_prefix(column: str, *prefixes: str) -> Column:
    out = F.lit(False)
    for x in prefixes:
        out |= F.col(column).startswith(x)
    return out


def drop(t: DataFrame, predicates: Iterable[str] = (), subjects: DataFrame | None = None, exact: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Without the given predicates, subjects (s), exact triples (s, p, o) and pairs (s, p)."""
    if predicates := list(predicates):
        t = t.where(~F.col("p").isin(*predicates))
    for frame, keys in ((subjects, ["s"]), (exact, ["s", "p", "o"]), (pairs, ["s", "p"])):
        if frame is not None:
            t = t.join(frame.select(*keys).distinct(), keys, "left_anti")
    return t


def drop_nodes(t: DataFrame, nodes: DataFrame) -> DataFrame:
    """Without triples that have a node of `nodes` (node) as subject or object."""
    n = nodes.select("node").distinct()
    return t.join(n, F.col("s") == F.col("node"), "left_anti").join(n, F.col("o") == F.col("node"), "left_anti")


def keep_existing(t: DataFrame, nodes: DataFrame, column: str = "s") -> DataFrame:
    """Only triples whose subject (or object) is a known node."""
    return t.join(nodes.select("node").distinct(), F.col(column) == F.col("node"), "left_semi")


def without_na(t: DataFrame, profile: str = "phase1") -> DataFrame:
    """Without triples whose literal counts as missing."""
    return t.where(~(F.col("o").startswith('"') & terms.is_na(terms.literal_value(F.col("o")), profile)))


# ---- rewriting ----


def remap(t: DataFrame, names: DataFrame, predicates: bool = False) -> DataFrame:
    """Subjects and objects (and predicates, if asked) replaced by the map (old, new); the result is a set."""
    names = names.select("old", "new").groupBy("old").agg(F.min("new").alias("new"))
    for c in ("s", "o", *(["p"] if predicates else [])):
        m = names.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
        t = t.join(m, F.col(c) == F.col("__old"), "left").withColumn(c, F.coalesce("__new", c)).drop("__old", "__new")
    return t.select(*SPO).distinct()


class Rules:
    """Rules in order; the first whose condition holds decides a triple's fate.

    A rule drops the triple, or replaces some of s, p and o. They become one chain of `when`, so any
    number of rules costs one pass; `action` names the deciding rule, for counts by rule.
    """

    def __init__(self):
        self.rules: list[tuple[str, Column, dict[str, Column] | None]] = []

    def drop(self, name: str, when: Column) -> Rules:
        self.rules.append((name, when, None))
        return self

    def replace(self, name: str, when: Column, **columns: Column) -> Rules:
        self.rules.append((name, when, columns))
        return self

    def marked(self, t: DataFrame) -> DataFrame:
        """The frame with `action`, and s, p and o as rewritten; dropped triples are still there, with `dropped` true."""
        action, gone = F.lit("kept"), F.lit(False)
        new = {c: F.col(c) for c in SPO}
        for name, when, columns in reversed(self.rules):
            when = F.coalesce(when, F.lit(False))
            action = F.when(when, F.lit(name)).otherwise(action)
            gone = F.when(when, F.lit(columns is None)).otherwise(gone)
            for c in SPO:
                new[c] = F.when(when, (columns or {}).get(c, F.col(c))).otherwise(new[c])
        return t.select(action.alias("action"), gone.alias("dropped"), *[new[c].alias(c) for c in SPO])

    def apply(self, t: DataFrame) -> DataFrame:
        return self.marked(t).where(~F.col("dropped")).select(*SPO)

    def observed(self, t: DataFrame, name: str) -> tuple[DataFrame, Observation]:
        """`apply`, and counts by deciding rule that the same pass takes: once an action has run over the result, `get` of the second has them; rules that never decided have 0."""
        marks = Observation(name)
        marked = self.marked(t)
        marked = marked.observe(marks, *[F.count_if(F.col("action") == a).alias(a) for a in dict.fromkeys([*[r[0] for r in self.rules], "kept"])])
        return marked.where(~F.col("dropped")).select(*SPO), marks

    def counts(self, t: DataFrame) -> DataFrame:
        return self.marked(t).groupBy("action").agg(F.count("*").alias("n"))


def phase1_rules(ns: str, none_pathway: str, chem_prefixes: Iterable[str], plant_prefixes: Iterable[str], chem_types: Iterable[str], plant_types: Iterable[str]) -> Rules:
    """The repair rules of a first pass over an exported graph, without those that need other tables.

    Compounds lose trials, computed weights, plant types, old labels and keys posing as names; missing
    literals go; heuristic chemical types become literals.
    """
    p = lambda x: f"<{ns}{x}>"
    label, kind = "<http://www.w3.org/2000/01/rdf-schema#label>", "<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>"
    chem, plant = by_prefix("s", *chem_prefixes), by_prefix("s", *plant_prefixes)
    lit, value = F.col("o").startswith('"'), terms.literal_value(F.col("o"))
    is_type, chem_types = F.col("p") == kind, list(chem_types)
    return (
        Rules()
        .drop("none_pathway", (F.col("s") == none_pathway) | (F.col("o") == none_pathway))
        .drop("molecular_weight", F.col("p") == p("hasMolecularWeight"))
        .drop("compound_trial", (F.col("p") == p("hasClinicalStudy")) & chem)
        .drop("na_literal", lit & terms.is_na(value, "phase1"))
        .drop("key_as_common_name", (F.col("p") == p("hasCommonName")) & lit & value.rlike(terms.INCHIKEY))
        .drop("old_compound_label", chem & lit & (F.col("p") == label))
        .drop("compound_plant_type", is_type & chem & F.col("o").isin(*plant_types))
        .replace("heuristic_type", is_type & chem & F.col("o").isin(*chem_types) & (F.col("o") != p("ChemicalConcept")), p=F.lit(p("heuristicPhytochemicalClass")), o=terms.nt_literal(terms.local_name(F.col("o"))))
        .drop("plant_chemical_type", is_type & plant & F.col("o").isin(*chem_types))
        .replace("targets_pathway", F.col("p") == p("targetsPathway"), p=F.lit(p("targetsProtein")))
    )


def split_three(t: DataFrame, dropped: DataFrame, moved: DataFrame, moved_predicates: Iterable[str] = ()) -> DataFrame:
    """`part` for every triple: drop, if a node of `dropped` is in it; else module, for moved nodes or predicates; else core."""
    d, m = dropped.select("node").distinct(), moved.select("node").distinct()
    for flag, frame in (("d", d), ("m", m)):
        for c in ("s", "o"):
            marked = frame.select(F.col("node").alias(f"__{flag}{c}"))
            t = t.join(marked, F.col(c) == F.col(f"__{flag}{c}"), "left")
    part = F.when(F.col("__ds").isNotNull() | F.col("__do").isNotNull(), "drop").when(F.col("__ms").isNotNull() | F.col("__mo").isNotNull() | F.col("p").isin(*moved_predicates or [""]), "module").otherwise("core")
    return t.select(*SPO, part.alias("part"))


def replace_values(t: DataFrame, fixes: DataFrame) -> DataFrame:
    """Triples of the fixes' (s, p) are replaced by the fixes; the result is a set."""
    return triples(drop(t, pairs=fixes), fixes)


def fill_missing(t: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates whose (s, p) has no triple yet, one for each (s, p): the smallest object."""
    first = candidates.groupBy("s", "p").agg(F.min("o").alias("o"))
    return first.join(t.select("s", "p").distinct(), ["s", "p"], "left_anti").select(*SPO)


def retype(t: DataFrame, bad: DataFrame, kind: str, old: str, new: str, edge: str, new_edge: str, source_edges: Iterable[str] = ()) -> DataFrame:
    """Nodes of `bad` (node) change from class `old` to `new`; edges to them are renamed, and per-source edges to them go."""
    b = bad.select(F.col("node").alias("__n")).distinct()
    t = t.join(b, F.col("s") == F.col("__n"), "left").withColumnRenamed("__n", "__s").join(b, F.col("o") == F.col("__n"), "left")
    t = t.where(~(F.col("__n").isNotNull() & F.col("p").isin(*list(source_edges) or [""])))
    o = F.when(F.col("__s").isNotNull() & (F.col("p") == kind) & (F.col("o") == old), new).otherwise(F.col("o"))
    return t.select("s", F.when(F.col("__n").isNotNull() & (F.col("p") == edge), new_edge).otherwise(F.col("p")).alias("p"), o.alias("o"))


def as_mechanisms(t: DataFrame, actions: DataFrame, ns: str, edge: str = "hasTherapeuticEffect", new_edge: str = "hasMechanismOfAction", kind: str = "MechanismOfAction") -> DataFrame:
    """Nodes of `actions` (node) are typed as mechanisms, and the edges of effects that lead to them renamed."""
    p = lambda x: f"<{ns}{x}>"
    type_ = "<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>"
    for c in ("s", "o"):
        t = t.join(actions.select(F.col("node").alias(f"__{c}")).distinct(), F.col(c) == F.col(f"__{c}"), "left")
    o = F.when(F.col("__s").isNotNull() & (F.col("p") == type_), p(kind)).otherwise(F.col("o"))
    return t.select("s", F.when(F.col("__o").isNotNull() & (F.col("p") == p(edge)), p(new_edge)).otherwise(F.col("p")).alias("p"), o.alias("o")).distinct()


def with_taxon_links(t: DataFrame, taxon: str) -> DataFrame:
    """The triples and, for each numeric taxon id, an exact match with the taxonomy's class."""
    number = terms.literal_value(F.col("o"))
    found = t.where((F.col("p") == taxon) & F.col("o").startswith('"') & number.rlike(r"^\d+$"))
    return triples(t, found.select("s", F.lit("<http://www.w3.org/2004/02/skos/core#exactMatch>").alias("p"), terms.iri(F.concat(F.lit("NCBITaxon_"), number), "http://purl.obolibrary.org/obo/").alias("o")))


def redeclared(t: DataFrame, properties: DataFrame) -> DataFrame:
    """Without the domains and ranges of `properties` (node), which a new schema declares again."""
    rdfs = "http://www.w3.org/2000/01/rdf-schema#"
    both = F.explode(F.array(F.lit(f"<{rdfs}domain>"), F.lit(f"<{rdfs}range>")))
    return drop(t, pairs=properties.select(F.col("node").alias("s"), both.alias("p")))
