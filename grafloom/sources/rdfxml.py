"""RDF/XML in and out."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Mapping
from urllib.parse import quote
from xml.etree import ElementTree

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.scratch import parts_for

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XML = "http://www.w3.org/XML/1998/namespace"
TRIPLES = "s string, p string, o string"


def _escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r")


def _resolve(ref: str, base: str) -> str:
    if ":" in ref.split("/", 1)[0].split("#", 1)[0]:
        return ref
    return base.split("#", 1)[0] + ref if ref.startswith("#") or not ref else base.rsplit("/", 1)[0] + "/" + ref


class _Reader:
    """Triples of one document; blank nodes are numbered within `scope`, those without a name behind `own`."""

    def __init__(self, scope: str, base: str = "", own: str = ""):
        self.scope, self.base, self.own, self.n, self.out, self.unread = scope, base, own, 0, [], 0

    def blank(self, name: str | None = None) -> str:
        if name is None:
            self.n += 1
            name = f"g{self.own}{self.n}"
        return f"_:{self.scope}{name}"

    def iri(self, ref: str) -> str:
        return f"<{_resolve(ref, self.base)}>"

    @staticmethod
    def name(tag: str) -> str:
        return tag[1:].replace("}", "", 1) if tag.startswith("{") else tag

    def subject(self, e) -> str:
        if (about := e.get(f"{{{RDF}}}about")) is not None:
            return self.iri(about)
        if (own := e.get(f"{{{RDF}}}ID")) is not None:
            return self.iri("#" + own)
        return self.blank(e.get(f"{{{RDF}}}nodeID"))

    def node(self, e) -> str:
        s = self.subject(e)
        if self.name(e.tag) != RDF + "Description":
            self.out.append((s, f"<{RDF}type>", f"<{self.name(e.tag)}>"))
        for key, value in e.attrib.items():
            if key.startswith("{") and not key.startswith((f"{{{RDF}}}", f"{{{XML}}}")):
                self.out.append((s, f"<{self.name(key)}>", f'"{_escape(value)}"'))
            elif key == f"{{{RDF}}}type":
                self.out.append((s, f"<{RDF}type>", self.iri(value)))
        for p in e:
            self.property(s, p, e.get(f"{{{XML}}}lang"))
        return s

    def property(self, s: str, e, language: str | None) -> None:
        p, language = f"<{self.name(e.tag)}>", e.get(f"{{{XML}}}lang", language)
        if (r := e.get(f"{{{RDF}}}resource")) is not None:
            o = self.iri(r)
        elif (b := e.get(f"{{{RDF}}}nodeID")) is not None:
            o = self.blank(b)
        elif e.get(f"{{{RDF}}}parseType") == "Collection":
            o, last = f"<{RDF}nil>", None
            for child in e:
                cell = self.blank()
                o = cell if last is None else o
                if last is not None:
                    self.out.append((last, f"<{RDF}rest>", cell))
                self.out.append((cell, f"<{RDF}first>", self.node(child)))
                last = cell
            if last is not None:
                self.out.append((last, f"<{RDF}rest>", f"<{RDF}nil>"))
        elif e.get(f"{{{RDF}}}parseType") == "Resource":
            o = self.blank()
            for child in e:
                self.property(o, child, language)
        elif e.get(f"{{{RDF}}}parseType") == "Literal":
            self.unread += 1
            return
        elif len(e):
            o = self.node(e[0])
        else:
            kind = e.get(f"{{{RDF}}}datatype")
            o = f'"{_escape(e.text or "")}"' + (f"^^<{kind}>" if kind else f"@{language}" if language else "")
        self.out.append((s, p, o))


def parse(document: bytes, scope: str = "b", base: str = "", own: str = "") -> Iterator[list[tuple[str, str, str]]]:
    """Triples by top-level element, each forgotten once read. Ill-formed XML raises ElementTree.ParseError."""
    reader, depth, root = _Reader(scope, base, own), 0, None
    for event, e in ElementTree.iterparse(io.BytesIO(document), events=("start", "end")):
        if event == "start":
            if depth == 0:
                root = e
                reader.base = e.get(f"{{{XML}}}base", base)
            depth += 1
        else:
            depth -= 1
            if depth == 1:
                reader.node(e)
                yield reader.out
                reader.out = []
                root.clear()


def read(spark: SparkSession, path: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """(s, p, o) of RDF/XML files, one task a file; predicates of `drop` (bare IRIs) are left out. Blank nodes are scoped by file."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"], strict=True):
                scope = "b" + format(abs(hash_text(file)), "x") + "_"
                held: list[tuple[str, str, str]] = []
                for found in parse(content, scope):
                    held += found
                    if len(held) > 20_000:
                        yield pd.DataFrame(held, columns=["s", "p", "o"])
                        held = []
                yield pd.DataFrame(held, columns=["s", "p", "o"])

    out = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(convert, TRIPLES)
    return out.where(~F.col("p").isin(*[f"<{d}>" for d in drop])) if drop else out


def hash_text(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode())


#: Bytes that are read at a time beyond a range, to finish what begins in it.
MARGIN = 1 << 20
#: A start, end or empty tag: `<` stands in none of its values, `>` may. What begins a stretch without tags, and what ends it.
_TAG = re.compile(rb"<(/?)[^\s/>!?][^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>")
#: Bytes of a file that are parsed if no root goes on in it.
PROLOG = 64 << 20
_OPAQUE = ((b"<!--", b"-->"), (b"<![CDATA[", b"]]>"), (b"<?", b"?>"))


class _Range:
    """The bytes of a file from `first` to `end`, and those behind for as long as a tag, stretch or element goes on."""

    def __init__(self, store, path: str, first: int, end: int):
        self.file, self.first, self.size = store.open_input_file(path), first, max(0, end - first)
        self.data = self.file.read_at(self.size + MARGIN, first)

    def grow(self) -> bool:
        more = self.file.read_at(MARGIN, self.first + len(self.data))
        self.data += more
        return bool(more)

    def find(self, text: bytes, at: int) -> int:
        while (place := self.data.find(text, at)) < 0 and self.grow():
            at = max(at, len(self.data) - MARGIN - len(text))
        return place

    def tags(self) -> Iterator[tuple[int, int, int, bool]]:
        """(place, end, change of depth, whether it is a comment or the like) from the first `<` on."""
        at = 0
        while (place := self.find(b"<", at)) >= 0:
            close = next((end for begin, end in _OPAQUE if self.data.startswith(begin, place)), None)
            if close:
                stop = self.find(close, place)
                at = len(self.data) if stop < 0 else stop + len(close)
                yield place, at, 0, True
                continue
            m = _TAG.match(self.data, place)
            if m is None and len(self.data) - place <= MARGIN and self.grow():
                m = _TAG.match(self.data, place)
            at = m.end() if m else place + 1
            if m:
                yield place, at, -1 if m[1] else 0 if self.data[at - 2 : at - 1] == b"/" else 1, False

    def summary(self) -> tuple[int, int]:
        """The change of depth over the range, and where a comment or the like that begins in it ends, if that is behind it."""
        depth, behind = 0, self.first + self.size
        for place, end, change, opaque in self.tags():
            if place >= self.size:
                break
            depth += change
            if opaque and end > self.size:
                behind = self.first + end
        return depth, behind

    def elements(self, depth: int) -> bytes:
        """The top-level elements that begin in the range, which begins at the given depth."""
        first = last = None
        for place, end, change, opaque in self.tags():
            if opaque:
                continue
            if place >= self.size and (first is None or depth == 1):
                break
            if change < 0:
                depth -= 1
            else:
                first = place if depth == 1 and first is None else first
                depth += change
            if depth == 1 and first is not None:
                last = end
            if depth == 0:
                break
        return b"" if first is None else self.data[first:last]


    leads = False

    def content(self, depth: int) -> tuple[bytes, bool]:
        """All bytes from the first top-level element that begins in the range up to the first that begins behind it, and whether the file's end is among them.

        The range that `leads`, behind the root's tag, has all its bytes from there on.
        """
        first = 0 if self.leads else None
        for place, end, change, opaque in self.tags():
            if opaque:
                continue
            if change >= 0 and depth == 1:
                if place >= self.size:
                    return (b"" if first is None else self.data[first:place]), False
                first = place if first is None else first
            elif place >= self.size and first is None:
                return b"", False
            depth += change
            if depth <= 0:
                # behind the root there may be comments and space, whose end is looked for
                while self.grow() and not self.data[end:].strip():
                    pass
                return (b"" if first is None else self.data[first:]), True
        return (b"" if first is None else self.data[first:]), True


def _store(path: str):
    return fs.FileSystem.from_uri(quote(re.sub(r"^file:/+", "file:///", path), safe="/:@"))


def _dealt(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema).repartition(max(1, len(rows)))


_WORK = "file string, n int, first long, end long, depth long, head binary, close binary"


def _planned(spark: SparkSession, path: str, piece_bytes: int) -> tuple[list[tuple], list[str]]:
    """The ranges of the files (_WORK), with the depth that each begins at; and files whose first tag doesn't open a root that goes on."""
    files = [r[0] for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    plan, rootless = [], []
    for file in files:
        store, at = _store(file)
        size = store.get_file_info(at).size
        head = _Range(store, at, 0, size)
        root = next((end for place, end, change, opaque in head.tags() if not opaque and not head.data.startswith(b"<!", place)), 0)
        text = head.data[:root]
        close = b"</" + re.search(rb"<([^\s>/!?]+)[^<]*>$", text)[1] + b">" if root else b""
        if not root or text[-2:-1] == b"/" or root == size:
            rootless.append(file)
        plan += [[file, n, a, min(a + piece_bytes, size), text, close] for n, a in enumerate(range(root, size, piece_bytes)) if root]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(file, n, *_Range(*_store(file), first, end).summary()) for file, n, first, end in b.itertuples(index=False)]
            yield pd.DataFrame(found, columns=["file", "n", "depth", "behind"])

    known, again = {}, plan
    while again:
        ranges = _dealt(spark, [(f, n, a, b) for f, n, a, b, _, _ in again], "file string, n int, first long, end long")
        known |= {(r["file"], r["n"]): (r["depth"], r["behind"]) for r in ranges.mapInPandas(sums, "file string, n int, depth long, behind long").collect()}
        again, behind = [], {}
        for p in plan:
            file, n, first, end = p[:4]
            start = min(max(first, behind.get(file, 0)), end)
            if start != first:
                p[2] = start
                again.append(p)
            behind[file] = max(behind.get(file, 0), known[file, n][1]) if start == first else max(behind[file], end)

    work, depth = [], {}
    for file, n, first, end, text, close in plan:
        work.append((file, n, first, end, depth.get(file, 1), bytearray(text), bytearray(close)))
        depth[file] = depth.get(file, 1) + known[file, n][0]
    return work, rootless


def read_split(spark: SparkSession, path: str, piece_bytes: int = 64 << 20) -> DataFrame:
    """As read, for files of any size and nesting: byte ranges are read side by side, each giving the top-level elements that begin in it.

    A first pass sums the depth over each range; a range that turns out to begin inside a comment is summed again from its end. The
    sums, one row a range, give every range its depth. Named blank nodes are those of the file, others are told apart by range.
    """
    work, _ = _planned(spark, path, piece_bytes)

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, n, first, end, at, text, close in b.itertuples(index=False):
                body = _Range(*_store(file), first, end).elements(at)
                held: list[tuple[str, str, str]] = []
                for found in parse(bytes(text) + body + bytes(close), "b" + format(hash_text(file), "x") + "_", own=f"{n}_") if body else ():
                    held += found
                    if len(held) > 20_000:
                        yield pd.DataFrame(held, columns=["s", "p", "o"])
                        held = []
                yield pd.DataFrame(held, columns=["s", "p", "o"])

    if not work:
        return spark.createDataFrame([], TRIPLES)
    return _dealt(spark, work, _WORK).mapInPandas(convert, TRIPLES)


def well_formed(spark: SparkSession, path: str, piece_bytes: int = 64 << 20) -> DataFrame:
    """(path, triples, error) of each file, of any size; error is null if the XML is well-formed.

    Files are read by ranges of bytes, as by read_split: every range is parsed with the root's tag before it, and, if it doesn't hold
    the file's end, with the closing one behind it. All bytes are in one range's share; Spark passes over files without any; of several errors that of the first range counts.
    """

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for file, n, first, end, at, text, close in b.itertuples(index=False):
                part, count = _Range(*_store(file), first, end), 0
                part.leads = n == 0
                body, last = part.content(at)
                try:
                    for found in parse(bytes(text) + body + (b"" if last else bytes(close))) if body else ():
                        count += len(found)
                    rows.append((file, n, count, None))
                except ElementTree.ParseError as e:
                    rows.append((file, n, count, f"{e} (bytes {first} to {end})"))
            yield pd.DataFrame(rows, columns=["path", "n", "triples", "error"])

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for file in b["file"]:
                store, at = _store(file)
                with store.open_input_file(at) as source:
                    content = source.read_at(PROLOG, 0)  # no root, or one that is a single tag
                try:
                    rows.append((file, 0, sum(len(x) for x in parse(content)), None))
                except ElementTree.ParseError as e:
                    rows.append((file, 0, 0, str(e)))
            yield pd.DataFrame(rows, columns=["path", "n", "triples", "error"])

    work, rootless = _planned(spark, path, piece_bytes)
    kind = "path string, n int, triples long, error string"
    found = spark.createDataFrame([], kind)
    if rootless:
        found = found.unionByName(_dealt(spark, [(f,) for f in rootless], "file string").mapInPandas(whole, kind))
    if work := [w for w in work if w[0] not in set(rootless)]:
        found = found.unionByName(_dealt(spark, work, _WORK).mapInPandas(check, kind))
    first = F.min(F.when(F.col("error").isNotNull(), F.struct("n", "error")))["error"]
    return found.groupBy("path").agg(F.sum("triples").alias("triples"), first.alias("error"))


def _xml(c: Column) -> Column:
    c = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def lines(t: DataFrame, prefixes: Mapping[str, str]) -> DataFrame:
    """(about, line) of distinct triples, for an rdf:Description a subject. Predicates must be in one of the namespaces; others are left out."""
    p = terms.compact(F.col("p"), dict(prefixes))
    o = F.col("o")
    iri, value = F.regexp_replace(o, "^<|>$", ""), _xml(terms.unescape(terms.literal_value(o)))
    kind = F.coalesce(F.concat(F.lit(' rdf:datatype="'), _xml(terms.literal_datatype(o)), F.lit('"')), F.concat(F.lit(' xml:lang="'), terms.literal_language(o), F.lit('"')), F.lit(""))
    body = (
        F.when(o.startswith("<"), F.concat(F.lit(' rdf:resource="'), _xml(iri), F.lit('"/>')))
        .when(o.startswith("_:"), F.concat(F.lit(' rdf:nodeID="'), F.substr(o, F.lit(3)), F.lit('"/>')))
        .otherwise(F.concat(kind, F.lit(">"), value, F.lit("</"), p, F.lit(">")))
    )
    about = F.when(F.col("s").startswith("_:"), F.concat(F.lit('rdf:nodeID="'), F.substr("s", F.lit(3)))).otherwise(F.concat(F.lit('rdf:about="'), _xml(F.regexp_replace("s", "^<|>$", ""))))
    return t.where(p.rlike(r"^[A-Za-z_][\w.-]*:[A-Za-z_][\w.-]*$")).select(F.concat(about, F.lit('"')).alias("about"), F.concat(F.lit("    <"), p, body).alias("line")).distinct()


def _in_elements(head: str | None):
    """Lines sorted by subject, with each subject's in an element, and the task's in a document if there is a head; only the last subject is held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        if head:
            yield pd.DataFrame({"value": [head]})
        for b in batches:
            out = []
            for about, line in b[["about", "line"]].itertuples(index=False):
                if about != last:
                    out += ([] if last is None else ["  </rdf:Description>"]) + [f"  <rdf:Description {about}>"]
                    last = about
                out.append(line)
            yield pd.DataFrame({"value": out}, dtype=object)
        yield pd.DataFrame({"value": ([] if last is None else ["  </rdf:Description>"]) + (["</rdf:RDF>"] if head else [])}, dtype=object)

    return run


def write(t: DataFrame, path: str, prefixes: Mapping[str, str], whole_parts: bool = False) -> None:
    """A folder whose parts, read in order of their names, are one RDF/XML document (`whole_parts`: each part is one): head, elements by subject, end.

    The lines of a subject with very many triples may be dealt to several tasks, which then write an element each.
    """
    prefixes = {"rdf": RDF} | dict(prefixes)
    spark = t.sparkSession
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<rdf:RDF' + "".join(f'\n  xmlns:{k}="{v}"' for k, v in prefixes.items()) + ">"
    end = lambda text: spark.createDataFrame([(text,)], "value string").coalesce(1)
    n = parts_for(t)
    body = lines(t, prefixes).repartitionByRange(n, "about", "line").sortWithinPartitions("about", "line").mapInPandas(_in_elements(head if whole_parts else None), "value string")
    out = body if whole_parts else end(head).unionByName(body).unionByName(end("</rdf:RDF>"))
    out.write.mode("overwrite").text(path)
