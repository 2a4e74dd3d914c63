"""Names, uses and compounds mentioned in titles and abstracts; all as expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grafloom.functions import terms

# MeSH headings, in lower case, and words that show an article is about plants.
PLANT_HEADINGS = ("plants", "plants, medicinal", "plant extracts", "phytotherapy", "pharmacognosy", "ethnopharmacology", "herbalism", "herbal medicine")
PLANT_WORDS = r"plant|leaf|leaves|root|rhizome|seed|fruit|bark|flower|herb|herbal|botanical|phytochem\w*|polyphenol\w*|essential oil\w*|extract\w*|infusion|decoction"
# Endings of Latin epithets, and words that begin sentences or name other things, and so aren't genera.
EPITHET_ENDINGS = (
    "us|a|um|is|ae|ii|i|ensis|ense|ica|icus|icum|iana|ianus|ianum|atum|atus|folia|folium|officinalis|sativa|indica|japonica|chinensis|vulgaris|"
    "arvensis|montana|alba|nigra|rubra|lutea|glabra|cordata|lanceolata"
)
NOT_GENERA = tuple(
    """The This That These Those A An In On Of For With Without Although While Because Since If No Yes Multiple Spontaneous Randomized Double Open
    Prospective Retrospective Comparative Efficacy Effects Effect Intervention Feeding Findings Study Trial Cohort Participants Patients Children
    Adults Women Men Case Report Review Meta Analysis Method Methods Materials Results Discussion Conclusion Conclusions Retinal Ganglion Cells
    Cell Brain Salamander Mouse Mice Rat Rats Human Humans Clinical Subthreshold Threshold Neural Neuron Cortex Protein Enzyme Chromatography
    Extraction""".split()
)
# A binomial with an optional rank below the species, and the forms in which ranks are written.
BINOMIAL = r"\b([A-Z][a-z]+)(?:\s*[×x]\s*)?\s([a-z\-]{3,})(?:\s+(?:subsp\.|ssp\.|var\.|f\.|forma)\s+([a-z\-]{3,}))?\b"
RANKS = ((r"var\.", "var."), (r"subsp\.|ssp\.", "subsp."), (r" f\. | forma ", "f."))
# Names of compounds that are looked for, words that only look like compounds, and the shapes of compounds' names.
COMPOUND_NAMES = (
    "curcumin", "demethoxycurcumin", "bisdemethoxycurcumin", "eugenol", "rosmarinic acid", "caffeic acid", "allicin", "quercetin", "kaempferol",
    "luteolin", "beta-sitosterol", "withaferin A", "berberine", "epigallocatechin gallate", "EGCG", "rutin", "gallic acid", "ellagic acid",
    "apigenin", "naringenin", "hesperidin", "saponin", "alkaloid", "flavonoid", "terpenoid",
)
NOT_COMPOUNDS = ("protein", "chain", "certain", "margin", "origin", "skin", "insulin", "stain", "basin", "main", "grain", "begin", "kin", "within", "asin", "login", "admin")
ACID = r"\b([a-z][a-z\-]{3,})\s+acid\b"
COMPOUND_SHAPES = (
    r"\b[a-z0-9\-]+(?:glucoside|rhamnoside|rutinoside|arabinoside)\b",
    r"\b[a-z0-9\-]+-o-[a-z0-9\-]+(?:glucoside|rhamnoside|rutinoside)\b",
    r"\b[a-z][a-z0-9\-]{5,}(?:ic|ol|one|ine|ose|etin|enin)\b",
)


def _strings(c: Column) -> Column:
    return F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull())


def plant_context(title: Column, abstract: Column, mesh: Column) -> Column:
    """Whether an article is about plants by a MeSH heading or a whole word of its title or abstract."""
    text = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit("")))
    return F.exists(_strings(mesh), lambda m: F.lower(m).isin(*PLANT_HEADINGS)) | text.rlike(rf"(?iuU)\b({PLANT_WORDS})\b")


def _latin(epithet: Column) -> Column:
    return epithet.rlike(rf"({EPITHET_ENDINGS})$")


def botanical_names(text: Column, mesh: Column | None = None) -> Column:
    """Distinct binomials whose epithet has a Latin ending, with a variety, subspecies or form, and MeSH headings of that shape; sorted."""
    groups = [F.regexp_extract_all(text, F.lit(BINOMIAL), F.lit(i)) for i in range(4)]
    found = F.filter(F.arrays_zip(*[g.alias(f"g{i}") for i, g in enumerate(groups)]), lambda m: ~m["g1"].isin(*NOT_GENERA) & _latin(m["g2"]))

    def whole(m: Column) -> Column:
        rank = F.lit("")
        for rx, written in reversed(RANKS):
            rank = F.when(m["g0"].rlike(rx), F.concat(F.lit(f" {written} "), m["g3"])).otherwise(rank)
        return F.concat_ws(" ", m["g1"], F.concat(m["g2"], F.when(m["g3"] == "", "").otherwise(rank)))

    names = F.transform(found, whole)
    if mesh is not None:
        parts = F.transform(_strings(mesh), lambda m: F.split(terms.squeeze(m), " "))
        parts = F.filter(parts, lambda w: (F.size(w) >= 2) & F.get(w, F.lit(0)).rlike(r"^\p{Lu}") & _latin(F.get(w, F.lit(1))) & ~F.get(w, F.lit(0)).isin(*NOT_GENERA))
        names = F.concat(names, F.transform(parts, lambda w: F.concat_ws(" ", F.get(w, F.lit(0)), F.get(w, F.lit(1)))))
    return F.array_sort(F.array_distinct(names))


def validated_names(articles: DataFrame, checked: DataFrame) -> DataFrame:
    """Articles (pmid, title, abstract, mesh) with `species`: the sorted accepted names of their candidates, by a look-up table (name, kingdom, canonical).

    A candidate counts if its kingdom is Plantae; a look-up without an accepted name keeps the candidate's own.
    """
    text = F.concat_ws(" ", "title", "abstract")
    names = articles.select("pmid", F.explode(botanical_names(text, F.col("mesh"))).alias("name"))
    good = checked.where("kingdom = 'Plantae'").groupBy("name").agg(F.min(terms.strip(F.replace(F.col("canonical"), F.lit("  "), F.lit(" ")))).alias("canonical"))
    found = names.join(good, "name").groupBy("pmid").agg(F.array_sort(F.collect_set(F.coalesce(F.nullif("canonical", F.lit("")), "name"))).alias("species"))
    return articles.join(found, "pmid", "left").withColumn("species", F.coalesce("species", F.array().cast("array<string>")))


# Indications and the plain words, between bars, that show them.
INDICATIONS = {
    "analgesic": "analgesic|pain|painkiller|antinociceptive",
    "anti-inflammatory": "anti-inflammatory|antiinflammatory|inflammation|antiinflamm",
    "antimicrobial": "antimicrobial|antibacterial|antifungal|antiviral|antiparasitic|antimalarial|anthelmintic",
    "antidiabetic": "antidiabetic|diabetes|hypoglycemic|hypoglycaemic",
    "antihypertensive": "antihypertensive|hypertension|blood pressure",
    "gastroprotective": "gastroprotective|ulcer|gastric|stomach ache|antidiarrheal|diarrhea|diarrhoea|constipation",
    "hepatoprotective": "hepatoprotective|liver|hepatitis",
    "neuroprotective": "neuroprotective|memory|neurodegenerative|anxiolytic|antidepressant|sedative",
    "wound healing": "wound|cicatrizing|cicatrisation|burns|cuts",
    "respiratory": "cough|cold|asthma|bronchitis",
    "antioxidant": "antioxidant|oxidative stress",
    "anticancer": "anticancer|antitumor|antitumour|chemopreventive",
    "antipyretic": "antipyretic|fever",
    "diuretic": "diuretic",
    "antiulcer": "antiulcer|ulcer",
    "antidiarrheal": "antidiarrheal|diarrhea|diarrhoea",
    "anti-obesity": "anti-obesity|antiobesity|obesity|weight loss",
    "antispasmodic": "antispasmodic|spasm|colic",
    "antimalarial": "antimalarial|malaria",
}
# Phrases that announce a traditional use.
#: What the phrases begin with.
USE_BEGINNINGS = ("traditional", "used in ", "in ayurveda", "in traditional chinese", "in chinese", "in tcm", "ethnomedicin", "ethnopharmacolog")
USE_PHRASES = r"(?i)(?:traditionall?y used(?: in [^,;.]+)? to\s+[^.;:]+|used in (?:folk|traditional) medicine(?: to)?\s+[^.;:]+|in ayurveda|in (?:traditional )?chinese medicine|in tcm|ethnomedicin[a-z]*|ethnopharmacolog[a-z]*)"


def _any_of(text: Column, words: list[str]) -> Column:
    """Whether the text contains one of the words; those that contain another aren't looked for."""
    least = [w for w in words if not any(x != w and x in w for x in words)]
    return reduce(lambda a, b: a | b, [text.contains(w) for w in least])


def traditional_uses(text: Column, most: int = 5, length: int = 120) -> Column:
    """Up to `most` entries, sorted: phrases that announce a use, each of at most `length` characters, and one list of the indications that the text names."""

    def uses(text: Column, low: Column) -> Column:
        # expressions are slow on long texts: they begin where the first phrase may, and plain words are looked for as such
        first = F.least(*[F.nullif(F.instr(low, F.lit(x)), F.lit(0)) for x in USE_BEGINNINGS])
        rest = F.when(F.length(low) == F.length(text), F.substring(text, F.coalesce(first, F.length(text) + 1), F.length(text))).otherwise(text)  # some letters become two
        phrases = F.transform(F.regexp_extract_all(rest, F.lit(USE_PHRASES), F.lit(0)), lambda x: F.substring(terms.squeeze(x), 1, length))
        labels = F.concat_ws("; ", *[F.when(_any_of(low, rx.split("|")), F.lit(label)) for label, rx in sorted(INDICATIONS.items())])
        listed = F.array_remove(F.array(labels), "")
        return F.slice(F.array_sort(F.array_distinct(F.concat(phrases, listed))), 1, most)

    # a text is made lower once
    return F.get(F.transform(F.array(F.struct(text.alias("text"), F.lower(text).alias("low"))), lambda d: uses(d["text"], d["low"])), F.lit(0))


def compounds(text: Column, chemicals: Column | None = None) -> Column:
    """Distinct names of compounds, sorted: those of the list, acids, glycosides and words with their endings, and registered substances."""
    low, none = F.lower(text), F.array().cast("array<string>")
    listed = F.array_compact(F.array(*[F.when(low.rlike(rf"\b\Q{n.lower()}\E\b"), F.lit(n)) for n in COMPOUND_NAMES]))
    acids = F.filter(F.regexp_extract_all(low, F.lit(ACID), F.lit(1)), lambda x: ~x.isin(*NOT_COMPOUNDS))
    words = F.flatten(F.array(*[F.regexp_extract_all(low, F.lit(rx), F.lit(0)) for rx in COMPOUND_SHAPES]))
    found = F.concat(listed, F.transform(acids, lambda x: F.concat(x, F.lit(" acid"))), F.filter(words, lambda x: ~x.isin(*NOT_COMPOUNDS)))
    if chemicals is not None:
        found = F.concat(found, F.filter(F.transform(F.coalesce(chemicals, none), lambda x: F.lower(terms.strip(x))), lambda x: x != ""))
    return F.array_sort(F.array_distinct(found))


# Letters and endings that hint at a language of a vernacular name.
LANGUAGE_HINTS = {"ja": r"[぀-ヿ]", "zh": r"[一-鿿]", "ko": r"[가-힯]", "ru": r"[Ѐ-ӿ]", "ar": r"[؀-ۿ]", "hi": r"[ऀ-ॿ]", "de": r"[äöüß]", "es": r"[ñ¿¡]|\b(de|del|la)\b", "fr": r"[çœ]|\b(des|du|le)\b"}


def vernacular_language(name: Column) -> Column:
    out = F.lit("en")
    for language, rx in reversed(LANGUAGE_HINTS.items()):
        out = F.when(F.lower(name).rlike(rx), language).otherwise(out)
    return out


def vernacular_names(text: Column) -> Column:
    """Names after 'common names:', 'commonly known as', 'also called' or in a caption's brackets, split at commas, 'and' and 'or'."""
    lists = F.regexp_extract_all(text, F.lit(r"(?i)(?:common names?|vernacular names?)\s*:\s*([^.;\n]+)"), F.lit(1))
    known = F.regexp_extract_all(text, F.lit(r"(?i)(?:commonly|also|locally)\s+(?:known as|called|named)\s+(?:the\s+)?([^.;()\n]+)"), F.lit(1))
    parts = F.flatten(F.transform(F.concat(lists, known), lambda x: F.split(x, r"\s*,\s*(?:and\s+|or\s+)?|\s+and\s+|\s+or\s+")))
    clean = F.transform(parts, lambda x: terms.without_language_tag(F.regexp_replace(terms.squeeze(x), r"^[\"'“‘]|[\"'”’]$", "")))
    return F.array_distinct(F.filter(clean, lambda x: x.rlike(r"\p{L}{2}") & (F.length(x) <= 60)))


def pick_name(properties: Column, label: Column, aliases: Column, scientific: Column) -> Column:
    """The first registered common name, else the label, else the first alias that isn't the scientific name."""
    other = F.filter(F.concat(F.coalesce(properties, F.array().cast("array<string>")), F.array(label), F.coalesce(aliases, F.array().cast("array<string>"))), lambda x: terms.strip(x) != "")
    return F.get(F.filter(other, lambda x: F.lower(x) != F.lower(scientific)), F.lit(0))


def mine(articles: DataFrame) -> DataFrame:
    """Article rows to (pmid, doi, year, journal, title, plant, compound, uses): one a plant and compound, of articles about plants."""
    text = F.concat_ws(" ", "title", "abstract")
    rows = articles.where(plant_context(F.col("title"), F.col("abstract"), F.col("mesh")))
    rows = rows.select("pmid", "doi", "year", "journal", "title", botanical_names(text, F.col("mesh")).alias("plants"), compounds(text, F.col("chemicals")).alias("compounds"), F.array_join(traditional_uses(text), " | ").alias("uses"))
    rows = rows.select("*", F.explode("plants").alias("plant")).select("*", F.explode_outer("compounds").alias("compound"))
    return rows.select("pmid", "doi", "year", "journal", "title", "plant", "compound", "uses").distinct()


def funnel(articles: DataFrame) -> DataFrame:
    """One row of counts: articles, those about plants, with plants, with compounds, with uses."""
    text = F.concat_ws(" ", "title", "abstract")
    about = plant_context(F.col("title"), F.col("abstract"), F.col("mesh"))
    return articles.agg(F.count("*").alias("articles"), F.count_if(about).alias("about_plants"), F.count_if(about & (F.size(botanical_names(text, F.col("mesh"))) > 0)).alias("with_plants"), F.count_if(about & (F.size(compounds(text, F.col("chemicals"))) > 0)).alias("with_compounds"), F.count_if(about & (F.size(traditional_uses(text)) > 0)).alias("with_uses"))
