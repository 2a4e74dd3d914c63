"""Expressions over RDF terms, names and identifiers. All are Column -> Column and stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that count as missing, by the source they come from (compared in lower case, trimmed).
NA_PROFILES = {
    "phase1": ("", "n.a.", "na", "nan", "none", "null", "n/a", "not available"),
    "phase2": ("", "n.a.", "na", "nan", "none", "null"),
    "edges": ("", "n.a.", "na", "nan", "none"),
    "sdf_fill": ("", "n.a.", "nan", "none", "null"),
    "sdf": ("", "nan", "none", "null"),
}
# Standard atomic masses of the elements that formulas use.
ATOMIC_MASS = {
    "C": 12.011, "H": 1.008, "N": 14.007, "O": 15.999, "S": 32.06, "P": 30.974, "Cl": 35.45, "Br": 79.904, "F": 18.998, "I": 126.904, "Na": 22.99,
    "K": 39.098, "Si": 28.085, "B": 10.81, "Se": 78.971, "Mg": 24.305, "Ca": 40.078, "Fe": 55.845, "Zn": 65.38, "Cu": 63.546, "Co": 58.933,
    "As": 74.922, "Hg": 200.59, "Al": 26.982, "Li": 6.94, "Mn": 54.938, "Sn": 118.71, "Pt": 195.08, "Ge": 72.63, "Te": 127.6, "Bi": 208.98,
    "Ba": 137.33, "Sr": 87.62,
}

INCHIKEY = r"^[A-Z]{14}-[A-Z]{10}-[A-Z]$"
DOI = r"^10\.\d{4,9}/\S+$"


def strip(c: Column) -> Column:
    """Without Unicode white space at either end; Spark's trim takes spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_text(c: Column) -> Column:
    return F.lower(squeeze(c))


def is_na(c: Column, profile: str = "phase2") -> Column:
    """True for null and for the profile's tokens."""
    return c.isNull() | F.lower(strip(c)).isin(*NA_PROFILES[profile])


def nullify(c: Column, profile: str = "phase2") -> Column:
    return F.when(~is_na(c, profile), strip(c))


# ---- N-Triples terms ----


def literal_value(token: Column) -> Column:
    """The raw text of a literal token, up to its last quote; other tokens as they are."""
    return F.when(token.startswith('"'), F.regexp_extract(token, r'(?s)^"(.*)"', 1)).otherwise(token)


def literal_datatype(token: Column) -> Column:
    return F.nullif(F.regexp_extract(token, r'(?s)^".*"\^\^<([^>]*)>$', 1), F.lit(""))


def literal_language(token: Column) -> Column:
    return F.nullif(F.regexp_extract(token, r'(?s)^".*"@([A-Za-z0-9-]+)$', 1), F.lit(""))


def term_kind(token: Column) -> Column:
    return F.when(token.startswith("<"), "iri").when(token.startswith("_:"), "bnode").when(token.startswith('"'), "lit")


def unescape(c: Column) -> Column:
    """One pass over the escapes backslash, quote, n, r, t."""
    pieces = F.regexp_extract_all(c, F.lit(r"(?s)\\.|[^\\]+|\\$"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda x: F.when(x == r"\n", "\n").when(x == r"\r", "\r").when(x == r"\t", "\t").when(x.startswith("\\") & (F.length(x) > 1), F.substring(x, 2, 1)).otherwise(x)), "")


def escape(c: Column, carriage_return: str = "escape") -> Column:
    """Literal text with backslash, quote and newline escaped; carriage returns are escaped, dropped or kept."""
    c = F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    return F.replace(c, F.lit("\r"), F.lit({"escape": "\\r", "drop": "", "keep": "\r"}[carriage_return]))


def nt_literal(c: Column, datatype: str | None = None, language: str | None = None, carriage_return: str = "escape") -> Column:
    end = f"^^<{datatype}>" if datatype else f"@{language}" if language else ""
    return F.concat(F.lit('"'), escape(c, carriage_return), F.lit('"' + end))


def iri(c: Column, namespace: str = "") -> Column:
    return F.concat(F.lit("<" + namespace), c, F.lit(">"))


def local_name(token: Column) -> Column:
    """What follows the last # or / of an IRI, without brackets."""
    return F.regexp_extract(F.regexp_replace(token, r"^<|>$", ""), r"([^#/]*)$", 1)


def compact(token: Column, prefixes: dict[str, str]) -> Column:
    """prefix:local for the first namespace that an IRI starts with; else the IRI without brackets."""
    bare, out = F.regexp_replace(token, r"^<|>$", ""), None
    for prefix, namespace in prefixes.items():
        value = F.concat(F.lit(prefix + ":"), F.substr(bare, F.lit(len(namespace) + 1)))
        out = F.when(bare.startswith(namespace), value) if out is None else out.when(bare.startswith(namespace), value)
    return bare if out is None else out.otherwise(bare)


def namespace(uri: str) -> str:
    return uri if uri.endswith(("#", "/")) else uri + "#"


# Fixed value: what may not stand in an IRI after its authority, of the characters and ranges that RFC 3987 allows.
BAD_IN_IRI = r"(%(?![0-9A-Fa-f]{2})|[^A-Za-z0-9\-._~!$&'()*+,;=:@/%?#\x{A0}-\x{D7FF}\x{F900}-\x{FDCF}\x{FDF0}-\x{FFEF}\x{10000}-\x{EFFFD}])"


def with_namespace_end(c: Column) -> Column:
    """`namespace` of a column."""
    return F.when(c.rlike("[#/]$"), c).otherwise(F.concat(c, F.lit("#")))


def iri_problem(c: Column) -> Column:
    """Why a bare IRI is invalid, or null: checked are the scheme, then path, query and fragment after any authority."""
    rest = F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.\-]*:", ""), r"^//[^/?#]*", "")
    odd = F.regexp_extract(rest, BAD_IN_IRI, 1)
    return F.when(~c.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), "no scheme").when(odd != "", F.concat(F.lit("char "), odd)).when(F.length(F.regexp_replace(rest, "[^#]", "")) > 1, "two #")


def percent_encode(c: Column, safe: str = r"[A-Za-z0-9._~:/()-]") -> Column:
    """Each character outside `safe` as the %XX of its UTF-8 bytes."""
    chars = F.split(c, "")
    coded = F.transform(chars, lambda x: F.when(x.rlike(f"^{safe}$") | (x == ""), x).otherwise(F.regexp_replace(F.hex(F.encode(x, "UTF-8")), "(..)", "%$1")))
    return F.array_join(coded, "")


# ---- names ----


def binomial(c: Column) -> Column:
    """First two words of lower-cased letters and hyphens; empty if there are fewer (builds)."""
    return _two(F.regexp_replace(F.lower(c), r"[^a-z\- ]", ""), 2)


def binomial_web(c: Column) -> Column:
    """As binomial, hyphens dropped and one word allowed (publishing)."""
    return _two(F.regexp_replace(F.lower(c), r"[^a-z ]", ""), 1)


def binomial_loose(c: Column) -> Column:
    """As binomial, one word allowed (target import)."""
    return _two(F.regexp_replace(F.lower(c), r"[^a-z\- ]", ""), 1)


def binomial_unicode(c: Column) -> Column:
    """First two words of letters of any script, lower-cased (structure files)."""
    return _two(F.lower(F.regexp_replace(c, r"[^\p{L}\- ]", " ")), 1)


def binomial_author(c: Column) -> Column:
    """'Genus epithet' of a name whose third word, if any, begins an author: not lower case, no hybrid sign; else null."""
    w = F.split(squeeze(c), " ")
    plain = F.get(w, F.lit(0)).rlike(r"^[A-Z][a-z-]+$") & F.get(w, F.lit(1)).rlike(r"^[a-z-]+$") & ~F.coalesce(F.get(w, F.lit(1)).isin("x", "sp"), F.lit(False))
    return F.when(plain & (F.get(w, F.lit(2)).isNull() | ~F.get(w, F.lit(2)).rlike(r"^[a-z]")), F.concat_ws(" ", F.slice(w, 1, 2)))


def _two(c: Column, least: int) -> Column:
    w = F.filter(F.split(c, " +"), lambda x: x != "")
    return F.when(F.size(w) >= least, F.concat_ws(" ", F.slice(w, 1, 2))).otherwise("")


def alnum_upper(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), r"[^A-Z0-9]", "")


def title_case(c: Column) -> Column:
    """Upper case after any non-letter, lower case elsewhere; initcap knows only spaces."""
    pieces = F.regexp_extract_all(c, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))), "")


def safe_identifier(c: Column) -> Column:
    """Non-word characters, and the place before a leading digit, as underscores."""
    return F.regexp_replace(c, r"(?U)\W|^(?=\d)", "_")


def safe_local(c: Column, most: int = 200) -> Column:
    """As safe for a local name: runs of other characters as one underscore, cut; 'unknown' if nothing is left."""
    out = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9_]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(out, 1, most), F.lit("")), F.lit("unknown"))


def safe_key(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9_]", "_")


def words_of_predicate(c: Column) -> Column:
    """camelCase as lower-case words."""
    return F.lower(F.regexp_replace(local_name(c), r"([a-z0-9])([A-Z])", "$1 $2"))


def clean_infraspecific(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?i)\s+(var\.|subsp\.|ssp\.|f\.|cv\.).*$", ""))


def without_language_tag(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s*\[[^\]]*\]\s*$", ""))


def label_score(c: Column) -> Column:
    """Orders labels, best first: two words of which the first begins upper case and the second is lower case; no var. or subsp.; short; then by text."""
    w = F.split(squeeze(c), " ")
    first, second = F.get(w, F.lit(0)), F.get(w, F.lit(1))
    formed = second.isNotNull() & F.substring(first, 1, 1).rlike(r"^\p{Lu}") & (second == F.lower(second)) & second.rlike(r"\p{L}")
    return F.struct((~F.coalesce(formed, F.lit(False))).cast("int").alias("malformed"), (c.contains("var.") | c.contains("subsp.")).cast("int").alias("infra"), F.length(c).alias("n"), c.alias("v"))


# Names of elements, nutrients and broad classes that aren't compounds.
ELEMENTS_AND_NUTRIENTS = tuple(
    """ALUMINUM ALUMINIUM IRON CALCIUM MAGNESIUM POTASSIUM SODIUM ZINC COPPER MANGANESE PHOSPHORUS SULFUR SELENIUM BORON CHROMIUM COBALT
    NICKEL LEAD CADMIUM MERCURY ARSENIC SILICON STRONTIUM BARIUM IODINE FLUORINE CHLORINE LITHIUM MOLYBDENUM TIN TITANIUM VANADIUM SILVER GOLD
    PLATINUM RUBIDIUM BROMINE CESIUM ASH WATER FAT FIBER PROTEIN CARBOHYDRATES KILOCALORIES CALORIES ENERGY SUGARS STARCH MUCILAGE GUM RESIN
    TANNIN TANNINS ALKALOIDS FLAVONOIDS SAPONINS ESSENTIAL-OIL EO OIL PECTIN CELLULOSE LIGNIN PHYTOSTEROLS GLYCOSIDES STEROLS TERPENES
    POLYPHENOLS ALPHA-GLUCAN BETA-GLUCAN NITROGEN AMINO-ACIDS FATTY-ACIDS""".split()
)


def constituent_kind(name: Column) -> Column:
    """element_or_nutrient_class, enzyme, compound_class or null, tested in this order; every final S may be missing from the list."""
    u = F.regexp_replace(F.replace(F.upper(name), F.lit(" "), F.lit("-")), r"[^A-Z0-9-]", "")
    listed = u.isin(*ELEMENTS_AND_NUTRIENTS) | F.regexp_replace(u, "S+$", "").isin(*ELEMENTS_AND_NUTRIENTS)
    return F.when(listed, "element_or_nutrient_class").when(u.rlike("ASES?$"), "enzyme").when(u.rlike("-(COMPOUNDS|DERIVATIVES?)$"), "compound_class")


# ---- identifiers ----


def is_inchikey(c: Column) -> Column:
    return c.rlike(INCHIKEY)


def inchikey_local(c: Column) -> Column:
    return F.when(is_inchikey(c), F.concat(F.lit("Chemical_ik_"), F.translate(c, "-", "_")))


def normalize_doi(c: Column, lower: bool = False) -> Column:
    """A DOI without resolver, `doi:` and closing punctuation."""
    out = F.regexp_replace(strip(c), r"(?i)^(https?://(dx\.)?doi\.org/|doi:\s*)", "")
    out = F.regexp_replace(out, r"[).,;\]]+$", "")
    return F.lower(out) if lower else out


def is_doi(c: Column) -> Column:
    return c.rlike(DOI)


def extract_doi(c: Column) -> Column:
    return F.nullif(normalize_doi(F.regexp_extract(c, r"(10\.\d{4,9}/\S+)", 1)), F.lit(""))


def split_multi(c: Column) -> Column:
    """Distinct trimmed parts, in order, split at || | ;; ; // , and line ends."""
    parts = F.transform(F.split(c, r"\|\||\||;;|;|//|,|\n|\r"), strip)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def nct_ids(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"NCT\d{8}"), F.lit(0))))


def stable_id(c: Column, digits: int = 16) -> Column:
    return F.substring(F.sha1(c), 1, digits)


def stable_number(c: Column) -> Column:
    """The first 15 hexadecimal digits of the SHA-1 as a number."""
    return F.conv(F.substring(F.sha1(c), 1, 15), 16, 10).cast("long")


def djb2_shard(c: Column) -> Column:
    """djb2 with xor over code points, low 8 bits: of 256 shards."""
    return F.aggregate(F.filter(F.split(c, ""), lambda x: x != ""), F.lit(5), lambda h, x: (h * 33).bitwiseXOR(F.ascii(x)).bitwiseAND(F.lit(255)))


def formula_mass(c: Column) -> Column:
    """Mass of a formula such as C2H6O; null if it isn't made of elements and counts only, or an element is unknown."""
    parts = F.regexp_extract_all(c, F.lit(r"[A-Z][a-z]?\d*"), F.lit(0))
    masses = F.create_map(*[F.lit(x) for kv in ATOMIC_MASS.items() for x in kv])
    one = lambda x: F.try_element_at(masses, F.regexp_extract(x, r"^[A-Z][a-z]?", 0)) * F.coalesce(F.regexp_extract(x, r"(\d*)$", 1).try_cast("double"), F.lit(1.0))
    return F.when(c.rlike(r"^([A-Z][a-z]?\d*)+\z"), F.aggregate(parts, F.lit(0.0), lambda a, x: a + one(x)))


def valid_pmid(c: Column, least: int = 5_000_000) -> Column:
    return c.rlike(r"^\d+$") & (c.try_cast("long") >= least)


def cut_label(c: Column, most: int = 120) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("…"))).otherwise(c)


def is_citation(c: Column) -> Column:
    """Not empty, no pointer to a file or an aggregate, and more than a person's initial and name."""
    # Phrases that stand in the place of a citation.
    pointer = r"(?i)see species file|personal files|aggregate of all these|^\s*J\.?[A-Za-z .&]*\.?\s*$"
    return (strip(c) != "") & ~c.rlike(pointer)


def year_windows(first: int, last: int, step: int = 1) -> list[tuple[int, int]]:
    """(from, to) years that cover first to last."""
    return [(y, min(y + step - 1, last)) for y in range(first, last + 1, step)]


def xref_iri(source: Column, key: Column, patterns: dict[str, str]) -> Column:
    """The IRI of a cross-reference by its source's pattern, in which {} stands for the key; null for other sources."""
    out = F.lit(None).cast("string")
    for name, pattern in patterns.items():
        before, _, after = pattern.partition("{}")
        out = F.when(source == name, F.concat(F.lit("<" + before), key, F.lit(after + ">"))).otherwise(out)
    return out
