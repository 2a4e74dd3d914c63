"""Turtle in and out: the part of the language that schemas and fragments are written in."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.functions import terms
from grafloom.scratch import parts_for
from grafloom.sources.rdfxml import RDF, TRIPLES, _escape, _resolve, hash_text

XSD = "http://www.w3.org/2001/XMLSchema#"
_TOKEN = re.compile(
    r"""\s+|\#[^\n]*
    |(?P<iri><[^<>"{}|^`\\\s]*>)
    |(?P<long>\"\"\"(?:[^"\\]|\\.|"(?!""))*\"\"\"|'''(?:[^'\\]|\\.|'(?!''))*''')
    |(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<at>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<number>[+-]?(?:\d+\.\d*(?:[eE][+-]?\d+)|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+))
    |(?P<blank>_:[\w.-]*\w)
    |(?P<name>[\w.-]*:(?:[\w:%-]|\.(?=[\w:%-]))*|\w+)
    |(?P<mark>\^\^|[.;,\[\]()])""",
    re.VERBOSE | re.DOTALL,
)
#: Escapes in texts.
_ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def _plain(raw: str) -> str:
    return re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _ESCAPES.get(m[1], m[1]), raw, flags=re.DOTALL)


class _Reader:
    def __init__(self, document: str, scope: str):
        self.tokens, self.scope, self.base, self.prefixes, self.n, self.out = self._cut(document), scope, "", {}, 0, []
        self.kind, self.value = next(self.tokens)

    @staticmethod
    def _cut(document: str) -> Iterator[tuple[str | None, str]]:
        at = 0
        while at < len(document):
            m = _TOKEN.match(document, at)
            if m is None:
                raise ValueError(f"not Turtle at {document[at : at + 40]!r}")
            at = m.end()
            if m.lastgroup:
                yield m.lastgroup, m[0]
        yield None, ""

    def next(self) -> str:
        was = self.value
        self.kind, self.value = next(self.tokens, (None, ""))
        return was

    def expect(self, mark: str) -> None:
        if self.next() != mark:
            raise ValueError(f"{mark!r} expected before {self.value!r}")

    def fresh(self) -> str:
        self.n += 1
        return f"_:{self.scope}g{self.n}"

    def iri(self) -> str:
        kind, value = self.kind, self.next()
        if kind == "iri":
            return f"<{_resolve(_plain(value[1:-1]), self.base) if self.base else _plain(value[1:-1])}>"
        prefix, colon, local = value.partition(":")
        if kind != "name" or not colon or prefix not in self.prefixes:
            raise ValueError(f"no IRI: {value!r}")
        return f"<{self.prefixes[prefix]}{local}>"

    def node(self) -> str:
        """A subject or object; what nested brackets say is put out."""
        if self.value == "[":
            self.next()
            s = self.fresh()
            if self.value != "]":
                self.facts(s)
            self.expect("]")
            return s
        if self.value == "(":
            self.next()
            cells = []
            while self.value != ")":
                cells.append((self.fresh(), self.node()))
            self.next()
            for i, (cell, value) in enumerate(cells):
                rest = cells[i + 1][0] if i + 1 < len(cells) else f"<{RDF}nil>"
                self.out += [(cell, f"<{RDF}first>", value), (cell, f"<{RDF}rest>", rest)]
            return cells[0][0] if cells else f"<{RDF}nil>"
        if self.kind == "blank":
            return f"_:{self.scope}{self.next()[2:]}"
        if self.kind in ("text", "long"):
            cut = 3 if self.kind == "long" else 1
            text = f'"{_escape(_plain(self.next()[cut:-cut]))}"'
            if self.kind == "at":
                return text + self.next()
            if self.value == "^^":
                self.next()
                return f"{text}^^{self.iri()}"
            return text
        if self.kind == "number":
            kind = "double" if "e" in self.value.lower() else "decimal" if "." in self.value else "integer"
            return f'"{self.next()}"^^<{XSD}{kind}>'
        if self.value in ("true", "false"):
            return f'"{self.next()}"^^<{XSD}boolean>'
        return self.iri()

    def facts(self, s: str) -> None:
        while True:
            if self.kind == "name" and self.value == "a":
                self.next()
                p = f"<{RDF}type>"
            else:
                p = self.iri()
            self.out.append((s, p, self.node()))
            while self.value == ",":
                self.next()
                self.out.append((s, p, self.node()))
            while self.value == ";":
                self.next()
                if self.value in (".", "]", ";"):
                    continue
                break
            else:
                return

    def statements(self) -> Iterator[list[tuple[str, str, str]]]:
        while self.kind is not None:
            word = self.value.lower()
            if word in ("@prefix", "prefix", "@base", "base"):
                self.next()
                if word.endswith("prefix"):
                    name = self.next()[:-1]
                    self.prefixes[name] = self.iri()[1:-1]
                else:
                    self.base = self.iri()[1:-1]
                if word[0] == "@":
                    self.expect(".")
                continue
            bracket = self.value == "["
            s = self.node()
            if not (bracket and self.value == "."):
                self.facts(s)
            self.expect(".")
            yield self.out
            self.out = []


def parse(document: str, scope: str = "b") -> Iterator[list[tuple[str, str, str]]]:
    """Triples by statement: prefixes, bases, `a`, lists of predicates and objects, nested nodes, collections, all literals. Raises ValueError on anything else."""
    return _Reader(document, scope).statements()


def read(spark: SparkSession, path: str) -> DataFrame:
    """(s, p, o) of Turtle files, one task a file, as prefixes hold for the rest of a file. Blank nodes are scoped by file."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"], strict=True):
                held: list[tuple[str, str, str]] = []
                for found in parse(bytes(content).decode(), "b" + format(hash_text(file), "x") + "_"):
                    held += found
                    if len(held) > 20_000:
                        yield pd.DataFrame(held, columns=["s", "p", "o"])
                        held = []
                yield pd.DataFrame(held, columns=["s", "p", "o"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(convert, TRIPLES)


def write(t: DataFrame, path: str, prefixes: Mapping[str, str]) -> None:
    """A folder whose parts are Turtle documents: the prefixes, then a triple a line, sorted, with names cut by the prefixes where they may be."""
    safe = r"^[A-Za-z_][\w-]*:[A-Za-z_][\w-]*$"
    short = lambda c: F.when(F.col(c).startswith("<") & terms.compact(F.col(c), dict(prefixes)).rlike(safe), terms.compact(F.col(c), dict(prefixes))).otherwise(F.col(c))
    head = [f"@prefix {k}: <{v}> ." for k, v in prefixes.items()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": head}, dtype=object)
        yield from batches

    n = parts_for(t)
    lines = t.select(F.concat_ws(" ", short("s"), short("p"), short("o"), F.lit(".")).alias("value")).distinct()
    lines.repartitionByRange(n, "value").sortWithinPartitions("value").mapInPandas(run, "value string").write.mode("overwrite").text(path)
