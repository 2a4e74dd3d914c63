"""Evidence: provenance sets, plausibility, fallback joins, gap filling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grafloom.functions import terms


def occurrences(facts: DataFrame) -> DataFrame:
    """(a, b, sources, n_sources) of facts (a, b, source)."""
    return facts.groupBy("a", "b").agg(F.array_sort(F.collect_set("source")).alias("sources")).withColumn("n_sources", F.size("sources").cast("long"))


def unreplicated(found: DataFrame, families: DataFrame, source: str, least: int = 4, outside: int = 3) -> DataFrame:
    """Occurrences (a, b, sources) of one source only that stand alone in their family.

    The compound b must be in `least` plants, `outside` of them in other families (plants of no
    known family count as others), and only this plant of the family (a, family) has it.
    """
    x = found.join(families.select("a", "family"), "a", "left")
    sole = (F.size("sources") == 1) & (F.get("sources", F.lit(0)) == source) & F.col("family").isNotNull()
    per = x.groupBy("b", "family").agg(F.count("*").alias("nf"), F.max(F.when(sole, F.col("a"))).alias("a"))
    # an array of at most a plant a family
    per = per.groupBy("b").agg(F.sum("nf").alias("n"), F.collect_list(F.when(F.col("nf") == 1, F.col("a"))).alias("alone"))
    return per.where((F.col("n") >= least) & (F.col("n") - 1 >= outside)).select(F.explode("alone").alias("a"), "b")


def evidence_union(rows: DataFrame, keys: list[str], flags: Mapping[str, Column], only: str) -> DataFrame:
    """The keys with the sorted set of evidence kinds that hold in any row, and whether `only` is the single one."""
    kinds = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in flags.items()]))
    g = rows.select(*keys, F.explode(kinds).alias("kind")).groupBy(*keys).agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
    return g.withColumn("only", (F.size("kinds") == 1) & (F.get("kinds", F.lit(0)) == only))


def fallback_join(rows: DataFrame, keys: list[Column], table: DataFrame, key: str, value: str) -> DataFrame:
    """rows with `value` and `rank`, by the first of the keys, in order, that the table (key, value) has; the smallest value of a key counts.

    A left join a key: rows are neither multiplied nor gathered again.
    """
    one = table.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.min(value).alias("__value")).where("__value is not null")
    columns, out = [F.col(f"`{c}`") for c in rows.columns], rows.withColumns({f"__k{i}": k for i, k in enumerate(keys)})
    for i in range(len(keys)):
        out = out.join(one.withColumnsRenamed({"__key": f"__t{i}", "__value": f"__v{i}"}), F.col(f"__k{i}") == F.col(f"__t{i}"), "left")
    rank = F.coalesce(*[F.when(F.col(f"__v{i}").isNotNull(), i) for i in range(len(keys))])
    return out.select(*columns, F.coalesce(*[F.col(f"__v{i}") for i in range(len(keys))]).alias(value), rank.alias("rank"))


def name_keys(c: Column) -> list[Column]:
    """Keys of a name from the whole to the genus: all of it, its first two words, its first."""
    w = F.split(terms.normalize_text(c), " ")
    return [terms.normalize_text(c), F.when(F.size(w) >= 2, F.concat_ws(" ", F.slice(w, 1, 2))), F.get(w, F.lit(0))]


def two_pass_join(rows: DataFrame, table: DataFrame, first: tuple[str, str], second: tuple[str, str], fanout: str = "all") -> DataFrame:
    """rows joined to the table by the first pair of columns (left, right), those without a match by the second.

    `fanout` first: only the smallest match (by the table's columns) of each key.
    """
    out = None
    left = rows
    for n, (a, b) in enumerate((first, second), 1):
        t = table.select(F.col(b).alias("__k"), F.struct(*table.columns).alias("match")).where("__k is not null")
        if fanout == "first":
            t = t.groupBy("__k").agg(F.min("match").alias("match"))
        hit = left.join(t, F.col(a) == F.col("__k")).select(*rows.columns, "match", F.lit(n).alias("pass"))
        out = hit if out is None else out.unionByName(hit)
        left = left.join(t.select("__k").distinct(), F.col(a) == F.col("__k"), "left_anti")
    return out


def unique_hits(table: DataFrame, key: Column, value: str) -> DataFrame:
    """(key, value) of keys that have exactly one value."""
    g = table.where(key.isNotNull()).groupBy(key.alias("key")).agg(F.min(value).alias(value), F.max(value).alias("__max"))
    return g.where(F.col(value) == F.col("__max")).select("key", value)


def todo(keys: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Keys not done yet."""
    return keys.select(*on).distinct().join(done.select(*on).distinct(), on, "left_anti")


def gap_fill(rows: DataFrame, column: str, key: str, layers: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """Null values of `column` filled by the first layer (name, frame(key, value)) that has one; `<column>_source` names it, or is 'own'."""
    out, choices = rows, [(F.lit("own"), F.col(column))]
    for n, (name, frame) in enumerate(layers):
        out = out.join(frame.groupBy(key).agg(F.min("value").alias(f"__v{n}")), key, "left")
        choices.append((F.lit(name), F.col(f"__v{n}")))
    value = F.coalesce(*[v for _, v in choices])
    source = F.coalesce(*[F.when(v.isNotNull(), n) for n, v in choices])
    return out.withColumns({f"{column}_source": source, column: value}).drop(*[f"__v{n}" for n in range(len(choices) - 1)])


def layered_names(keys: DataFrame, key: str, layers: list[tuple[str, DataFrame]]) -> DataFrame:
    """For each key the chosen name and its source, by order of the layers (key, name), and all names in that order, each once whatever its case."""
    union = None
    for rank, (source, frame) in enumerate(layers):
        part = frame.select(F.col(key), F.lit(rank).alias("rank"), F.lit(source).alias("source"), terms.nullify(F.col("name")).alias("name")).where("name is not null")
        union = part if union is None else union.unionByName(part)
    once = union.groupBy(key, F.lower("name").alias("__l")).agg(F.min(F.struct("rank", "name", "source")).alias("x"))
    g = once.groupBy(key).agg(F.array_sort(F.collect_list("x")).alias("x"))
    out = keys.select(key).distinct().join(g, key, "left")
    return out.select(key, F.get("x", F.lit(0))["name"].alias("name"), F.get("x", F.lit(0))["source"].alias("source"), F.transform("x", lambda v: v["name"]).alias("names"))


def guarded_links(links: DataFrame, facts: DataFrame, on: list[str]) -> DataFrame:
    """Links whose pair is a known fact."""
    return links.join(facts.select(*on).distinct(), on, "left_semi")


def capped_lists(rows: DataFrame, key: str, order: list[Column], value: Column, most: int = 50) -> DataFrame:
    """(key, items, n): the first `most` values of each key in order, and how many there are.

    Ranks are cut before rows meet in a list, so no list is longer than `most`.
    """
    from pyspark.sql import Window

    n = rows.groupBy(key).agg(F.count("*").alias("n"))
    top = rows.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("__r") <= most)
    items = top.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__r", value.alias("v")))), lambda x: x["v"]).alias("items"))
    return items.join(n, key)


def typo_matches(names: DataFrame, known: DataFrame) -> DataFrame:
    """(name, match) of binomials whose genus is one letter off a known one with the same epithet.

    Blocked by the epithet and the genus with at most one letter left out: two genera of distance one share such a form, so
    a common epithet makes no pairs of genera that are unlike.
    """
    genus, epithet = lambda c: F.split(c, " ")[0], lambda c: F.get(F.split(c, " "), F.lit(1))

    def keyed(df: DataFrame, name: str, g: str) -> DataFrame:
        rows = df.select(F.col("name").alias(name), genus(F.col("name")).alias(g), epithet(F.col("name")).alias("e")).where("e is not null")
        gone = F.transform(F.sequence(F.lit(1), F.length(g)), lambda i: F.concat(F.substr(F.col(g), F.lit(1), i - 1), F.substr(F.col(g), i + 1)))
        return rows.where(F.length(g) > 0).select("*", F.explode(F.array_distinct(F.concat(F.array(g), gone))).alias("v"))

    pairs = keyed(names, "name", "g").join(keyed(known, "match", "g2"), ["e", "v"])
    return pairs.where(F.levenshtein("g", "g2") == 1).select("name", "match").distinct()


def coverage(rows: DataFrame, group: str, has: Column) -> DataFrame:
    """(group, n, n_with, share) of rows for which `has` holds."""
    g = rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(has).alias("n_with"))
    return g.withColumn("share", F.round(F.col("n_with") / F.col("n"), 6))


def decide(*cases: tuple[str, Column], otherwise: str) -> Column:
    """The first case that holds; null conditions don't."""
    out = F.lit(otherwise)
    for name, when in reversed(cases):
        out = F.when(F.coalesce(when, F.lit(False)), F.lit(name)).otherwise(out)
    return out


# What makes a label doubtful, and what makes it junk where nothing else is known.
DOUBTFUL = r"(?i)strain|engineered|unidentified|unknown|\[|\+"
JUNK_LABEL = r"(?i)\bunknown\b|\bsp\.\s*[A-Z0-9]|strain|\[|\d{3,}"


def plant_status(rows: DataFrame, names: DataFrame, genera: DataFrame, junk: DataFrame, classes: DataFrame) -> DataFrame:
    """rows (node, label, is_plant) with `keep` and `status`, or why a node goes. A node without a label gets its local name, spaced out, as one.

    In order: a known plant's binomial (names: name), a known plant's genus (genera: genus) unless tagged as junk (junk: node),
    the lineage's verdict `is_plant`, a junk name, what the node was classified as (classes: node, status), else unverified.
    """
    spelled = F.translate(F.regexp_replace(F.regexp_replace("node", r"^<.*[#/]|>$", ""), "^(Plant|Organism)_", ""), "_", " ")
    rows = rows.withColumn("label", F.coalesce(F.nullif("label", F.lit("")), spelled))
    two = terms.binomial(F.col("label"))
    flag = lambda df, key, name: df.select(F.col(key).alias(f"__{name}")).distinct()
    x = rows.withColumn("__two", two).withColumn("__first", F.split("__two", " ")[0])
    x = x.join(flag(names, "name", "n"), F.col("__two") == F.col("__n"), "left").join(flag(genera, "genus", "g"), F.col("__first") == F.col("__g"), "left")
    x = x.join(flag(junk, "node", "j"), F.col("node") == F.col("__j"), "left")
    x = x.join(classes.groupBy(F.col("node").alias("__c")).agg(F.max("status").alias("__status")), F.col("node") == F.col("__c"), "left")
    doubtful, is_junk = F.col("label").rlike(DOUBTFUL), F.col("__j").isNotNull()
    status = decide(
        ("ncbi_plant_name", F.col("__n").isNotNull() & (F.col("__two") != "") & ~doubtful),
        ("ncbi_plant_genus", F.col("__g").isNotNull() & (F.col("__two") != "") & ~is_junk & ~doubtful),
        ("ncbi_viridiplantae", F.col("is_plant")),
        ("ncbi_lineage_not_viridiplantae", ~F.col("is_plant")),
        ("junk_name", doubtful | is_junk | F.col("label").rlike(JUNK_LABEL)),
        ("classification_nonplant", F.col("__status") == "nonplant"),
        ("ncbi_viridiplantae_by_name", F.col("__status") == "plant"),
        otherwise="unverified",
    )
    gone = F.col("status").isin("ncbi_lineage_not_viridiplantae", "junk_name", "classification_nonplant")
    return x.select(*rows.columns, status.alias("status")).withColumn("keep", ~gone)


# Ranks of a species or below, and kinds of matches that are trusted.
SPECIES_RANKS = ("SPECIES", "SUBSPECIES", "VARIETY", "FORM", "INFRASPECIFIC_NAME", "INFRASUBSPECIFIC_NAME")
MATCH_TYPES = ("EXACT", "FUZZY")


def match_level(rank: Column, match: Column, key: Column) -> Column:
    """What a taxonomy's match is worth: species, rejected_coarse (a key, but of a higher rank or kind) or unmatched."""
    good = F.upper(rank).isin(*SPECIES_RANKS) & F.upper(match).isin(*MATCH_TYPES)
    return F.when(F.coalesce(good, F.lit(False)), "species").when(key.isNotNull(), "rejected_coarse").otherwise("unmatched")


# Markers anywhere in a name; words for parts of plants that head a drug's name; words for animals, for strains; and the reasons given.
NON_PLANT_MARKERS = ("unknown", "unclassified", "unidentified", "fungus", "fungal", "fungi", "yeast", "mushroom")
PART_NAMES = tuple(
    """herba herbae radix radices radicis rhizoma rhizomata rhizomatis semen semina seminis fructus flos flores floris folium folia folii cortex
    corticis lignum caulis ramulus ramuli ramus cacumen pericarpium stamen stigma bulbus tuber spica oleum resina gummi thallus stipes arillus
    pollen receptaculum sclerotium succus exocarpium endocarpium mesocarpium plumula calyx vinum gemma pericarpii concha""".split()
)
ANIMAL_WORDS = tuple(
    """fish shark scallop mollusk mollusc sponge snail slug urchin jellyfish anemone tunicate ascidian bryozoan octopus squid mussel oyster clam
    crab shrimp lobster starfish whelk abalone propolis venom gorgonian nudibranch lanternshark mackerel mahi cuttlefish barnacle tunicates""".split()
)
STRAIN_WORDS = tuple(
    """recombinant engineered strain mutant overexpressed overexpressing transformant transgenic nrrl atcc endophytic endophyte knockout plasmid
    clone isolate unknown unclassified unidentified bacterium bacteria""".split()
)
JUNK_REASONS = {
    "empty": "empty",
    "marker": "non-plant/unknown marker ('{}')",
    "digits": "contains digits (strain/catalog id)",
    "brackets": "contains brackets/parens (strain designation)",
    "phrase": "Latin drug phrase (seu/et)",
    "part": "pharmacognosy part-name ('{}')",
    "animal": "non-plant common-name token",
    "strain": "microbial strain / unknown marker",
}


def junk_reason(name: Column) -> Column:
    """Why a name is junk, or null."""
    n = F.coalesce(terms.squeeze(name), F.lit(""))
    low = F.lower(n)
    w = F.split(low, " ")
    why = JUNK_REASONS
    out = F.when(low == "", why["empty"])
    for m in NON_PLANT_MARKERS:
        out = out.when(low.contains(m), why["marker"].format(m))
    any_of = lambda words: F.arrays_overlap(w, F.array(*map(F.lit, words)))
    return (
        out.when(n.rlike(r"\p{Nd}"), why["digits"])
        .when(n.rlike(r"[\[\]()]"), why["brackets"])
        .when(F.concat(F.lit(" "), low, F.lit(" ")).rlike(" seu | et "), why["phrase"])
        .when(F.get(w, F.lit(0)).isin(*PART_NAMES), F.format_string(why["part"].replace("{}", "%s"), F.get(w, F.lit(0))))
        .when(any_of(ANIMAL_WORDS), why["animal"])
        .when(any_of(STRAIN_WORDS), why["strain"])
    )
