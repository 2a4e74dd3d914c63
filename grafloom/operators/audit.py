"""Profiles, conflicts and release checks of triples."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.operators.triples import with_terms
from grafloom.scratch import parts_for


def predicate_counts(t: DataFrame) -> DataFrame:
    return t.groupBy("p").agg(F.count("*").alias("n"))


def type_combinations(types: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """(combo, n): how many subjects have which classes (s, class), joined by | in order."""
    t = types.where(~F.col("class").isin(*ignore or [""]))
    return t.groupBy("s").agg(F.array_join(F.array_sort(F.collect_set("class")), "|").alias("combo")).groupBy("combo").agg(F.count("*").alias("n"))


def subject_stats(t: DataFrame) -> DataFrame:
    """For each predicate: triples, distinct subjects, most triples of a subject, and objects by kind."""
    kind = terms.term_kind(F.col("o"))
    per = t.groupBy("p", "s").agg(F.count("*").alias("n"), *[F.count_if(kind == k).alias(k) for k in ("iri", "bnode", "lit")])
    return per.groupBy("p").agg(F.sum("n").alias("triples"), F.count("*").alias("subjects"), F.max("n").alias("most"), *[F.sum(k).alias(k) for k in ("iri", "bnode", "lit")])


def several_values(t: DataFrame, predicate: str) -> DataFrame:
    """(s, n) of subjects with more than one value of the predicate."""
    return t.where(F.col("p") == predicate).groupBy("s").agg(F.countDistinct("o").alias("n")).where("n > 1")


def predicate_sets(t: DataFrame, types: DataFrame) -> DataFrame:
    """(combo, predicates, n): which predicates the subjects of a class combination have."""
    combo = types.groupBy("s").agg(F.array_join(F.array_sort(F.collect_set("class")), "|").alias("combo"))
    own = t.groupBy("s").agg(F.array_join(F.array_sort(F.collect_set("p")), "|").alias("predicates"))
    return own.join(combo, "s", "left").groupBy(F.coalesce("combo", F.lit("")).alias("combo"), "predicates").agg(F.count("*").alias("n"))


def literal_profile(t: DataFrame, profile: str = "phase1") -> DataFrame:
    """For each predicate with literals: how many, missing ones, InChIKeys, and by datatype."""
    x = with_terms(t).where("o_kind = 'lit'")
    return x.groupBy("p", F.coalesce("dt", F.lit("plain")).alias("dt")).agg(F.count("*").alias("n"), F.count_if(terms.is_na(F.col("lex"), profile)).alias("na"), F.count_if(F.col("lex").rlike(terms.INCHIKEY)).alias("inchikeys"))


def conflicts(rows: DataFrame, keys: list[str], value: str, tolerance: float | None = None) -> DataFrame:
    """Keys with more than one distinct value; for numbers, whose values lie further apart than the tolerance."""
    if tolerance is None:
        return rows.groupBy(*keys).agg(F.countDistinct(value).alias("n_values")).where("n_values > 1")
    g = rows.groupBy(*keys).agg(F.countDistinct(value).alias("n_values"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    return g.where(F.col("hi") - F.col("lo") > tolerance).drop("lo", "hi")


def mass_mismatches(rows: DataFrame, formula: str, mass: str, tolerance: float = 2.0) -> DataFrame:
    x = rows.withColumn("formula_mass", terms.formula_mass(F.col(formula)))
    return x.where(F.abs(F.col("formula_mass") - F.col(mass)) > tolerance)


def duplicate_labels(labels: DataFrame) -> DataFrame:
    """One row: how many labels (v) repeat another one."""
    return labels.groupBy("v").agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.greatest(F.col("c") - 1, F.lit(0))), F.lit(0)).alias("duplicates"))


def datatype_mismatches(t: DataFrame, ranges: DataFrame) -> DataFrame:
    """(p, declared, actual, n, example): literals whose datatype isn't the declared one (p, dt); plain literals are strings."""
    x = with_terms(t).where("o_kind = 'lit'").join(ranges.select("p", F.col("dt").alias("declared")), "p")
    actual = F.coalesce("dt", F.lit("http://www.w3.org/2001/XMLSchema#string"))
    return x.where(actual != F.col("declared")).groupBy("p", "declared", actual.alias("actual")).agg(F.count("*").alias("n"), F.min("s").alias("example"))


def domain_range_violations(t: DataFrame, axioms: DataFrame, types: DataFrame, groups: DataFrame) -> DataFrame:
    """(p, side, n, example) of nodes whose classes are disjoint from what an axiom asks for.

    axioms (p, side, classes): a union, one of which must hold. groups (class, grp, sub): classes of different
    groups, or of one group and different non-null subs, are disjoint; a class without a group fits anything.
    Nodes without a grouped class pass.
    """
    tags = types.join(groups, "class").groupBy(F.col("s").alias("__node")).agg(F.collect_set(F.struct("grp", "sub")).alias("tags"))
    alt = axioms.select("p", "side", F.explode("classes").alias("class")).join(groups, "class", "left")
    ax = alt.groupBy("p", "side").agg(F.max(F.col("grp").isNull()).alias("any"), F.collect_set(F.struct("grp", "sub")).alias("alternatives"))
    x = t.join(ax, "p").withColumn("__node", F.when(F.col("side") == "domain", F.col("s")).otherwise(F.col("o"))).join(tags, "__node")
    fits = F.exists("alternatives", lambda a: F.forall("tags", lambda g: (g["grp"] == a["grp"]) & (a["sub"].isNull() | g["sub"].isNull() | (g["sub"] == a["sub"]))))
    return x.where(~F.col("any") & ~fits).groupBy("p", "side").agg(F.count("*").alias("n"), F.min("__node").alias("example"))


def invalid_iris(t: DataFrame) -> DataFrame:
    """(problem, n, example) over the IRIs in any place."""
    tokens = t.select(F.explode(F.array("s", "p", "o")).alias("x")).where("x like '<%>'").select(F.substr("x", F.lit(2), F.length("x") - 2).alias("iri"))
    return tokens.withColumn("problem", terms.iri_problem(F.col("iri"))).where("problem is not null").groupBy("problem").agg(F.count("*").alias("n"), F.min("iri").alias("example"))


def release_check(t: DataFrame, expected: DataFrame) -> DataFrame:
    """expected (s, p, o, present) with `ok`: whether the triple is there, or not, as expected."""
    there = t.select("s", "p", "o").distinct().withColumn("__there", F.lit(True))
    return expected.join(there, ["s", "p", "o"], "left").select("s", "p", "o", "present", (F.coalesce("__there", F.lit(False)) == F.col("present")).alias("ok"))


def stratified_sample(rows: DataFrame, stratum: str, order: str, *ties: Column, head: int = 20, every: int = 613, most: int = 80) -> DataFrame:
    """The first `head` rows of each stratum in order, then every `every`-th row over all, up to `most` of a stratum.

    `order` is a numeric column, `ties` break its ties. A row's place over all rows is its place in a range of
    the order plus the rows of earlier ranges; ranges are cut at approximate quantiles, so none is counted in one task.
    """
    n = parts_for(rows)
    cuts = sorted(set(rows.approxQuantile(order, [i / n for i in range(1, n)], 0.5 / n)))
    part = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: c < F.col(order))) if cuts else F.lit(0)
    own = Window.partitionBy(stratum).orderBy(order, *ties)
    ranked = rows.withColumn("__part", part).withColumn("__in", F.row_number().over(Window.partitionBy("__part").orderBy(order, *ties)))
    sizes = ranked.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    placed = ranked.join(F.broadcast(before), "__part").withColumn("__place", F.col("__before") + F.col("__in"))
    # a bare limit on the rank is applied before the exchange, so that a frequent stratum isn't gathered
    first = placed.withColumn("__own", F.row_number().over(own)).where(F.col("__own") <= head).drop("__own")
    chosen = first.unionByName(placed.where(F.col("__place") % every == 0)).dropDuplicates(["__place"])
    return chosen.withColumn("__k", F.row_number().over(own)).where(F.col("__k") <= most).drop("__part", "__in", "__before", "__place", "__k")


def _kept(strata: list[str], order: list[str], k: int):
    """Arrow batches to the k first rows of each stratum, in memory of a few times what is kept."""

    def cut(batches: list[pa.RecordBatch]) -> pa.Table:
        t = pa.Table.from_batches(batches)
        t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in [*strata, *order]]))
        if not strata:
            return t.slice(0, k)
        place = t.select(strata).to_pandas().groupby(strata, dropna=False, sort=False).cumcount().to_numpy()
        return t.filter(pa.array(place < k))

    def do(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, most = [], 0, 4 * k
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows > most:
                held = cut(held).to_batches()
                rows = sum(x.num_rows for x in held)
                most = max(4 * k, 2 * rows)
        if held:
            yield from cut(held).to_batches()

    return do


def bottom_k(rows: DataFrame, k: int, strata: list[str], key: list[Column], seed: int = 0, by: Column | None = None) -> DataFrame:
    """A uniform sample of k rows of each stratum (all, if fewer): those of the smallest hashes of the key, ties by the key itself.

    Samples merge: every task keeps its k smallest of a stratum while it reads, groups of tasks keep the k smallest of theirs,
    and a last step those of all, so that one pass makes it and no task holds more than a few samples. Rows of an equal key have an equal
    hash; the result doesn't depend on partitions. `by` takes the place of the hash. Null strata are strata too.
    """
    ties = [f"__k{i}" for i in range(len(key))]
    x = rows.withColumn("__h", F.xxhash64(*key, F.lit(seed)) if by is None else by).withColumns(dict(zip(ties, key, strict=True)))
    keep = _kept(strata, ["__h", *ties], k)
    x = x.mapInArrow(keep, x.schema)
    fan = 32  # samples of a stratum that meet in the middle step, for a thousand tasks; each bounded by k
    x = x.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(fan)))
    x = x.repartition(fan * 4, *strata, "__part").drop("__part")
    x = x.mapInArrow(keep, x.schema)
    x = (x.repartition(fan, *strata) if strata else x.coalesce(1)).mapInArrow(keep, x.schema)
    return x.drop("__h", *ties)


def object_types(t: DataFrame, types: DataFrame, most: int = 50_000, top: int = 6, seed: int = 0, by: Column | None = None) -> DataFrame:
    """(p, combo, n, example): for each predicate the commonest class combinations of its objects, in a sample of `most` of its triples with a node as object.

    Objects without a class have the combination ''. The sample is `bottom_k`'s, so it is the same for any partitioning.
    """
    nodes = bottom_k(t.where(~F.col("o").startswith('"')).select("s", "p", "o"), most, ["p"], [F.col("s"), F.col("o")], seed, by)
    combo = types.groupBy(F.col("s").alias("o")).agg(F.array_join(F.array_sort(F.collect_set("class")), "|").alias("combo"))
    n = nodes.join(combo, "o", "left").groupBy("p", F.coalesce("combo", F.lit("")).alias("combo")).agg(F.count("*").alias("n"), F.min("o").alias("example"))
    rank = F.row_number().over(Window.partitionBy("p").orderBy(F.desc("n"), "combo"))
    return n.withColumn("__n", rank).where(F.col("__n") <= top).drop("__n")


#: Precision of profiles: 2^14 registers for distinct counts, so that one in a thousand is off by more than 2.7 percent; items that
#: are tracked for frequent values, whose counts are too large by a part in so many of the triples at most; and the error of ranks of lengths.
REGISTERS, TRACKED, WITHIN_DISTINCT, WITHIN_RANK = 14, 4096, 0.027, 0.0133


def profile(t: DataFrame, na: str = "phase1") -> DataFrame:
    """A mergeable profile of triples, a row a predicate, from one aggregation: what a reader yields is counted in the stage that reads it.

    Exact counts (`triples`, objects by kind, missing values, InChIKeys) beside sketches of distinct subjects and objects, of the subjects
    with most triples, of datatypes and of literals' lengths. Profiles of parts are made one by `merge_profiles`; `profile_figures` reads them.
    """
    x = with_terms(t)
    lit = F.col("o_kind") == "lit"
    tracked = lambda c: F.call_function("approx_top_k_accumulate", c, F.lit(TRACKED))
    return x.groupBy("p").agg(
        F.count("*").alias("triples"), *[F.count_if(F.col("o_kind") == k).alias(k) for k in ("iri", "bnode", "lit")], F.count_if(lit & terms.is_na(F.col("lex"), na)).alias("na"), F.count_if(lit & F.col("lex").rlike(terms.INCHIKEY)).alias("inchikeys"),
        F.hll_sketch_agg("s", F.lit(REGISTERS)).alias("subjects"), F.hll_sketch_agg("o", F.lit(REGISTERS)).alias("objects"), tracked(F.col("s")).alias("frequent"), tracked(F.when(lit, F.coalesce("dt", F.lit("plain")))).alias("datatypes"),
        F.kll_sketch_agg_bigint(F.when(lit, F.length("lex").cast("long"))).alias("lengths"),
    )


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all triples that these were made of."""
    x = profiles[0]
    for more in profiles[1:]:
        x = x.unionByName(more)
    exact = [F.sum(c).alias(c) for c in ("triples", "iri", "bnode", "lit", "na", "inchikeys")]
    merged = lambda c: F.call_function("approx_top_k_combine", F.col(c), F.lit(TRACKED)).alias(c)
    return x.groupBy("p").agg(*exact, *[F.hll_union_agg(c).alias(c) for c in ("subjects", "objects")], merged("frequent"), merged("datatypes"), F.kll_merge_agg_bigint("lengths").alias("lengths"))


def profile_figures(profile: DataFrame, top: int = 5) -> DataFrame:
    """A profile with numbers in place of sketches: distinct `subjects` and `objects`, `frequent` and `datatypes` as arrays of (item, count), and the median and largest literal `length`."""
    of = lambda c: F.call_function("approx_top_k_estimate", F.col(c), F.lit(top)).alias(c)
    length = lambda q: F.when(F.col("lit") > 0, F.kll_sketch_get_quantile_bigint("lengths", F.lit(q)))
    return profile.select("p", "triples", "iri", "bnode", "lit", "na", "inchikeys", F.hll_sketch_estimate("subjects").alias("subjects"), F.hll_sketch_estimate("objects").alias("objects"), of("frequent"), of("datatypes"), length(0.5).alias("median_length"), length(1.0).alias("largest_length"))


def used_properties(t: DataFrame) -> DataFrame:
    """(p, as_object, as_data): how often a predicate has a node or a literal as its object."""
    lit = F.col("o").startswith('"')
    return t.groupBy("p").agg(F.count_if(~lit).alias("as_object"), F.count_if(lit).alias("as_data"))


def class_counts(types: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, n) of distinct instances for every declared class, unused ones too."""
    n = types.groupBy("class").agg(F.countDistinct("s").alias("n"))
    return classes.select("class").distinct().join(n, "class", "left").select("class", F.coalesce("n", F.lit(0)).alias("n"))


def release_report(t: DataFrame, expected: DataFrame, axioms: DataFrame, types: DataFrame, groups: DataFrame, ranges: DataFrame) -> DataFrame:
    """(item, n): the triples, and for each check of a release what it found; all but the first are 0 if the release is good."""
    whole = lambda name, df, n=F.count("*"): df.agg(F.lit(name).alias("item"), F.coalesce(n, F.lit(0)).cast("long").alias("n"))
    wrong = release_check(t, expected).where("not ok")
    out = whole("triples", t)
    for part in (
        whole("expected missing", wrong.where("present")), whole("forbidden present", wrong.where("not present")),
        whole("domain or range", domain_range_violations(t, axioms, types, groups), F.sum("n")), whole("datatype", datatype_mismatches(t, ranges), F.sum("n")), whole("invalid IRI", invalid_iris(t), F.sum("n")),
    ):
        out = out.unionByName(part)
    return out
