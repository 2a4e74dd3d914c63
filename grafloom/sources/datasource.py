"""Record files as data sources of Spark: `spark.read.format("sdf")` and `"obo"` after `register(spark)`.

A file is cut into ranges of bytes, one a partition; a record belongs to the range that it begins in, so files of any size are read side by
side. The option `pieceBytes` is a range's size; where that would make more than `MOST_PIECES` of them, ranges grow up to `PIECE_BYTES`, so tasks stay few. With the option `pushFilters` the reader takes filters on columns and passes over records before they become rows; a frame that
was loaded so is for one use. Paths may be files, folders or patterns like part-*, in any store that pyarrow knows.

    spark.read.format("sdf").option("tags", "id,name").load(path)         # a string column for each tag
    spark.read.format("obo").load(path)                                     # id, name, parents; obsolete terms left out
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds

PIECE_BYTES = 32 << 20
#: Ranges of a load, unless they would be larger than `PIECE_BYTES` then.
MOST_PIECES = 200
#: Bytes that are read at once, behind a range too, until its last record ends.
STEP, LEAST_STEP = 1 << 20, 1 << 14


def _open(path: str):
    return fs.FileSystem.from_uri(quote(re.sub(r"^file:/+", "file:///", path if re.match(r"\w+:/", path) else f"file://{path}"), safe="/:@"))


def files(path: str) -> list[tuple[str, int]]:
    """(file, bytes) of a file, of all data files in a folder and below it, or of those that a pattern in the last place fits."""
    head, _, last = path.rstrip("/").rpartition("/")
    pattern = last if re.search(r"[*?\[]", last) else None
    store, at = _open(head if pattern else path)
    info = store.get_file_info(at)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(at, recursive=True))
    scheme = re.match(r"\w+:/+[^/]*(?=/)", path) if not path.startswith("file:") and re.match(r"\w+:/", path) else None
    names = [(x.path, x.size) for x in found if x.type == fs.FileType.File and x.size and not re.match(r"[_.]", x.base_name) and (pattern is None or fnmatch.fnmatch(x.base_name, pattern))]
    return sorted(((scheme[0] + "/" if scheme else "file://") + name.lstrip("/") if scheme else f"file://{name}", size) for name, size in names)


@dataclass
class Piece(ds.InputPartition):
    file: str
    first: int
    end: int


def records(file: str, first: int, end: int, delimiter: bytes) -> Iterator[str]:
    """The records, between delimiters (one character, once or several times), that begin in the range."""
    store, at = _open(file)
    with store.open_input_file(at) as source:
        # delimiters are of one character: where a run of it begins they are told apart as from the file's start
        start = first
        while start and (back := source.read_at(min(64, start), max(0, start - 64))):
            run = len(back) - len(back.rstrip(delimiter[:1]))
            start -= run
            if run < len(back):
                break
        held, at, place, wanted = b"", 0, start, first == 0
        while True:
            # a short range asks for little more than itself
            more = source.read_at(min(STEP, max(end - place, LEAST_STEP)), place)
            place += len(more)
            held, at = held[at:] + more, 0
            while (cut := held.find(delimiter, at)) >= 0:
                if wanted:
                    yield held[at:cut].decode("utf-8", "replace")
                at = cut + len(delimiter)
                begin = place - len(held) + at
                wanted = begin >= first
                if begin >= end:
                    return
            if not more:
                if wanted and at < len(held):
                    yield held[at:].decode("utf-8", "replace")
                return
            if not wanted:
                at = max(at, len(held) - len(delimiter) + 1)


_TESTS: dict[type, Callable] = {
    ds.EqualTo: lambda f, x: x is not None and x == f.value, ds.In: lambda f, x: x is not None and x in f.value, ds.IsNotNull: lambda f, x: x is not None, ds.IsNull: lambda f, x: x is None,
    ds.StringStartsWith: lambda f, x: x is not None and x.startswith(f.value), ds.StringEndsWith: lambda f, x: x is not None and x.endswith(f.value), ds.StringContains: lambda f, x: x is not None and f.value in x,
}


class RecordReader(ds.DataSourceReader):
    def __init__(self, source: RecordSource):
        self.path, self.piece, self.delimiter, self.parse = source.options["path"], int(source.options.get("pieceBytes", PIECE_BYTES)), source.delimiter, source.parser()
        self.columns, self.filters = [c.split()[0] for c in source.columns()], []

    def partitions(self) -> list[Piece]:
        found = files(self.path)
        piece = max(self.piece, min(PIECE_BYTES, -(-sum(size for _, size in found) // MOST_PIECES)))
        return [Piece(file, a, min(a + piece, size)) for file, size in found for a in range(0, size, piece)]

    def read(self, partition: Piece) -> Iterator[tuple]:
        for record in records(partition.file, partition.first, partition.end, self.delimiter):
            row = self.parse(record)
            if row is not None and all(_TESTS[type(f)](f, row[i]) for i, f in self.filters):
                yield row


class FilteringReader(RecordReader):
    """A reader that takes filters. Spark 4.1 keeps them with the loaded frame, so a query that filters one frame in two ways would get those of
    one for both: such a frame is for one use."""

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in self.columns and not (isinstance(f, ds.In) and None in f.value):
                self.filters.append((self.columns.index(f.attribute[0]), f))
            else:
                yield f


class RecordSource(ds.DataSource):
    delimiter = b"\n"

    def columns(self) -> list[str]:
        """Each column's name and type."""
        raise NotImplementedError

    def parser(self) -> Callable[[str], tuple | None]:
        """A record as a row, or None to leave it out."""
        raise NotImplementedError

    def schema(self) -> str:
        return ", ".join(self.columns())

    def reader(self, schema) -> RecordReader:
        return (FilteringReader if self.options.get("pushFilters") == "true" else RecordReader)(self)


class SdfSource(RecordSource):
    """Records of molecules: the values of the option `tags`, lines of a value joined by a space, missing ones null."""

    delimiter = b"$$$$"

    @classmethod
    def name(cls) -> str:
        return "sdf"

    def columns(self) -> list[str]:
        return [f"{t} string" for t in self.options["tags"].split(",")]

    def parser(self):
        wanted = self.options["tags"].split(",")

        def parse(record: str) -> tuple | None:
            if not record.strip():
                return None
            values: dict[str, list[str]] = {}
            tag = None
            for line in record.splitlines():
                if m := re.match(r">\s*<([^>]+)>", line):
                    tag = values.setdefault(m[1], []) if m[1] not in values else None
                elif tag is not None:
                    if line.strip():
                        tag.append(line.strip())
                    else:
                        tag = None
            return tuple(" ".join(values.get(t, ())) or None for t in wanted)

        return parse


class OboSource(RecordSource):
    """Terms of an ontology that aren't obsolete."""

    delimiter = b"\n\n"

    @classmethod
    def name(cls) -> str:
        return "obo"

    def columns(self) -> list[str]:
        return ["id string", "name string", "parents array<string>"]

    def parser(self):
        def parse(record: str) -> tuple | None:
            if "[Term]" not in record:
                return None
            said: dict[str, list[str]] = {}
            for line in record.splitlines():
                tag, colon, value = line.partition(":")
                if colon:
                    said.setdefault(tag, []).append(value.strip())
            if "true" in said.get("is_obsolete", ()) or not said.get("id", [""])[0]:
                return None
            return said["id"][0], said.get("name", [""])[0], [x.split()[0] for x in said.get("is_a", ()) if x]

        return parse


def register(spark: SparkSession) -> None:
    """Makes the formats known to the session, and allows that filters are pushed to those that are asked to take them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (SdfSource, OboSource):
        spark.dataSource.register(source)
