"""Vernacular names in prose: candidates with their places and rules, found field by field, and the best of each plant.

A small state machine runs over the words and marks of a field; what it collects is judged against the plant's own name. How
often a candidate recurs in all fields of its plant is counted by Spark, and decides where a rule alone doesn't.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.scratch import materialise

# Words that never occur in a common name, and those that are taken off its front.
NEVER = frozenset(
    "and or but of in on to for with from by at is are was were which who whose this that these those it its a an the widespread common commonly widely locally native endemic cultivated grown growing grows found member members family families genus genera"
    " species subspecies variety one two three several many most some source used using defining iconic icon known called named referred perennial annual biennial flowering deciduous evergreen tropical temperate wild important popular famous well very also"
    " often usually sometimes typically generally distributed occurs occurring".split()
)
LEADING = frozenset("this the a an its their".split())
# Words that hint at an English name.
ENGLISH = tuple(
    "bark lily tree root wort grass flower fruit apple bean pepper ginger wood leaf berry nut vine weed bush palm rose oak pine sage mint lotus bamboo cherry plum fig gum reed fern moss rush sea white black red yellow common wild false climbing creeping spiny hairy"
    " giant dwarf sacred holy water swamp mountain chinese japanese indian african american stinking sweet bitter milk snake resurrection pretty devil spider umbrella custard thorn spurge nettle".split()
)
# The source and the fields whose first sentences may begin with the name itself, and what shows a citation.
NARRATIVE_SOURCE, NARRATIVE_FIELDS = "KSP", frozenset(("snippet", "general", "summary", "description"))
CITATION = re.compile(r"[A-Z]\.\s*[A-Z]?\.?\s*[,)]|&|\b(?:1[6-9]|20)\d{2}\b|\beds?\.|\bpp?\.|\bvol\.|\bno\.", re.I)
#: Rules by trust, and whether a name must recur: never, if it is one word, always.
RULES = {"caption": (5, "never"), "explicit": (4, "never"), "vernacular": (4, "never"), "this": (3, "one word"), "lead": (2, "always")}
#: Letters of a name in prose, and words of it, at most.
MOST_LETTERS, MOST_WORDS = 41, 4

_TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|['’-])*|\d+|\S")
_WORD = re.compile(r"[a-z]['’a-z-]*", re.I)


def accepted(name: str, own: set[str]) -> str | None:
    """The candidate in lower case without its leading determiners, if it may be a common name of a plant with the `own` Latin words."""
    words = [w for w in name.lower().strip(" -'’\"“”").split()]
    while words and words[0] in LEADING:
        words = words[1:]
    whole = " ".join(words)
    fits = 0 < len(words) <= MOST_WORDS and not NEVER.intersection(words) and not own.intersection(words)
    return whole if fits and re.fullmatch(r"[a-z][a-z'’ -]+[a-z]", whole) else None


def own_words(scientific: str | None) -> set[str]:
    return {w for w in re.split(r"[^a-z]+", (scientific or "").lower()) if len(w) > 2}


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences: up to a full stop or the like and the space behind it."""
    cuts = [0, *(m.end() for m in re.finditer(r"(?<=[.!?])\s+", text)), len(text)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if text[a:b].strip()]


def _run(tokens: list[re.Match], at: int, joined: bool) -> int:
    """The end of the run of words from `at` on; `joined`: and / or end it too."""
    while at < len(tokens) and _WORD.fullmatch(tokens[at][0]) and not (joined and tokens[at][0].lower() in ("and", "or")):
        at += 1
    return at


def scan(text: str, narrative: bool) -> Iterator[tuple[int, int, str]]:
    """(start, end, rule) of what may be a name, in the order of the text.

    "known as", "called as" and "referred to as", with an adverb between, announce one, and "vernacular name(s)", with a
    colon or without. In narrative fields the first two sentences may begin with it: "This name," or "Name,".
    """
    tokens = list(_TOKEN.finditer(text))
    low = [t[0].lower() for t in tokens]
    for i, word in enumerate(low):
        at = None
        if word in ("known", "called") or (word == "referred" and low[i + 1 : i + 2] == ["to"]):
            at = i + (2 if word == "referred" else 1)
            at += low[at : at + 1] and low[at] in ("variously", "locally", "commonly") or 0
            at = at + 1 if low[at : at + 1] == ["as"] else None
            rule = "explicit"
        elif word == "vernacular" and low[i + 1 : i + 2] and low[i + 1] in ("name", "names"):
            at, rule = i + 2, "vernacular"
            at += low[at : at + 1] == [":"]
        if at is None:
            continue
        if rule == "explicit" and low[at : at + 1] and low[at] in ("the", "a", "an"):
            at += 1
        end = _run(tokens, at, rule == "explicit")
        # a run that a figure or an unknown mark ends isn't a name, unless the rule takes what comes before it
        closed = rule == "vernacular" or end == len(tokens) or low[end] in (".", ",", ";", ":", "(", ")", '"', "“", "”", "and", "or")
        if end > at and closed:
            start, stop = tokens[at].start(), tokens[end - 1].end()
            if stop - start <= MOST_LETTERS and not CITATION.search(text[tokens[i].start() : tokens[end].end() if end < len(tokens) else stop]):
                yield start, stop, rule
    if not narrative:
        return
    for a, b in sentences(text)[:2]:
        inside = [t for t in tokens if a <= t.start() < b]
        if not inside or CITATION.search(text[a:b]):
            continue
        first = 1 if inside[0][0].lower() == "this" else 0
        end = _run(inside, first, False)
        if end == first or end >= len(inside) or inside[end][0] != ",":
            continue
        start, stop, words = inside[first].start(), inside[end - 1].end(), inside[first:end]
        if first and stop - start <= MOST_LETTERS:
            yield start, stop, "this"
        if inside[0][0][0].isupper() and end <= MOST_WORDS and not any(w[0][0].isupper() for w in inside[1:end]) and len(words[0][0]) > 1:
            yield inside[0].start(), stop, "lead"


def caption_name(caption: str, scientific: str) -> tuple[int, int] | None:
    """The place of what a caption that begins with the plant's name has in its first brackets."""
    squeezed, binomial = " ".join(caption.lower().split()), " ".join(scientific.lower().split()[:2])
    m = re.search(r"\(([^)]+)\)", caption)
    return (m.start(1), m.end(1)) if m and binomial and squeezed.startswith(binomial) and m[1].strip().lower() not in ("illustration", "specimen") else None


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, out = b.column("row"), []
        for key, source, field, text, scientific in zip(keys.to_pylist(), *[b.column(c).to_pylist() for c in ("source", "field", "text", "scientific")], strict=True):
            own = own_words(scientific)
            if field == "caption":
                place = caption_name(text, scientific or "")
                found = [(*place, "caption")] if place else []
            else:
                found = scan(text, source == NARRATIVE_SOURCE and field in NARRATIVE_FIELDS)
            for start, end, rule in found:
                if name := accepted(text[start:end], own):
                    sentence = next((text[a:c].strip() for a, c in sentences(text) if a <= start < c), "")
                    out.append((key, name, rule, start, end, sentence[:200]))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["row", "name", "rule", "start", "end", "evidence"])


def candidates(fields: DataFrame, plants: DataFrame) -> DataFrame:
    """(id, source, field, name, rule, start, end, evidence) of all candidates in fields (id, source, field, text) of plants (id, scientific).

    A field named caption is a picture's. Places count characters of the field's text, squeezed to single spaces.
    """
    rows = fields.where("text is not null").select("id", "source", "field", terms.squeeze(F.col("text")).alias("text"))
    rows = rows.join(plants.groupBy("id").agg(F.min("scientific").alias("scientific")), "id").withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows, "fields")
    found = rows.select("row", "source", "field", "text", "scientific").mapInArrow(_scanned, "row bigint, name string, rule string, start int, end int, evidence string")
    return found.join(rows.select("row", "id", "source", "field"), "row").drop("row")


def best_names(fields: DataFrame, plants: DataFrame) -> DataFrame:
    """(id, name, source, field, rule, occurrences, evidence): the best candidate of each plant, if any holds.

    Captions come first, then announced names, then first words; within a rule the name that occurs most often in the plant's fields
    does. First words must occur twice, after "This" only if they are one word. Ties go to the narrative source, then by source, field and place.
    """
    found = materialise(candidates(fields, plants), "candidates")
    word = F.concat(F.lit(r"(?iU)\b\Q"), "name", F.lit(r"\E\b"))
    counted = found.select("id", "name").distinct().join(fields.where("text is not null and field <> 'caption'").select("id", terms.squeeze(F.col("text")).alias("text")), "id")
    counted = counted.groupBy("id", "name").agg(F.sum(F.regexp_count("text", word)).alias("occurrences"))
    trust = F.create_map(*[F.lit(x) for rule, (rank, _) in RULES.items() for x in (rule, rank)])
    recur = F.create_map(*[F.lit(x) for rule, (_, how) in RULES.items() for x in (rule, how)])
    rows = found.join(counted, ["id", "name"], "left").withColumn("occurrences", F.coalesce("occurrences", F.lit(0)))
    rows = rows.where((F.col("occurrences") >= 2) | (recur[F.col("rule")] == "never") | ((recur[F.col("rule")] == "one word") & F.col("name").contains(" ")))
    order = Window.partitionBy("id").orderBy(trust[F.col("rule")].desc(), F.desc("occurrences"), F.col("source") != NARRATIVE_SOURCE, "source", "field", "start", "name")
    best = rows.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= 1)
    return best.select("id", "name", "source", "field", "rule", "occurrences", "evidence")


def snippet_list(snippet: Column) -> Column:
    """What follows "Common name(s):" to the end, tags taken out; null if there is no such list."""
    plain = terms.squeeze(F.regexp_replace(snippet, "<[^>]+>", " "))
    return F.nullif(F.rtrim(F.trim(F.regexp_extract(plain, r"(?i)common names?\s*:\s*(.+)$", 1)), F.lit(".")), F.lit(""))


def snippet_name(snippet: Column) -> Column:
    """The first name of a snippet's list, unless it is a family's or a single letter."""
    first = terms.normalize_text(F.split(snippet_list(snippet), "[,;]")[0])
    return F.when((F.length(first) > 1) & ~first.endswith("aceae"), first)


def english_hint(name: Column) -> Column:
    """en if a word of the name is a common one in English names, else und."""
    words = F.split(F.translate(terms.normalize_text(name), "-", " "), " ")
    return F.when(F.arrays_overlap(words, F.array(*map(F.lit, ENGLISH))), "en").otherwise("und")
