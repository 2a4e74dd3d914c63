"""Benchmark decontamination: which benchmark items lie, whole or nearly, inside which documents.

Size-partitioned containment search by MinHash. Of an item's n distinct word shingles a document must
hold at least ceil(t n) to reach containment t, so it must hold one of any n - ceil(t n) + 1: the item's
sketch is that many of its smallest shingle hashes (its bottom-k MinHash). Items are partitioned by
the words of a shingle and by that needed number, in powers of two. A document is looked up only in the
partitions whose least needed number its own shingles reach: short documents pass over the partitions
of long items. Each hit is verified by exact containment of shingles as words, so no item is missed and
none is reported by chance.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grafloom.llm.common import bare, fresh, materialise

#: Runs of letters and digits, compared in lower case.
TOKEN = re.compile(r"[^\W_]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Characters of items that are searched for at once; a larger benchmark takes more passes over the documents. An index
#: holds 12 bytes a sketched hash, one for about thirty characters, and the items' texts compressed: about a byte a character, so
#: 32 MB in the driver and in each worker. A benchmark of 100 MB takes four passes.
BLOCK_CHARS = 32_000_000
#: Items whose shingles a worker keeps for the next verification.
KEPT_ITEMS = 256


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def shingles(found: list[str], width: int) -> set[tuple[str, ...]]:
    """Of fewer words than the width: the whole sequence; of none: none."""
    w = min(width, len(found))
    return {tuple(found[i : i + w]) for i in range(len(found) - w + 1)} if w else set()


def hashes(found: list[str], width: int) -> np.ndarray:
    """A hash for each run of `width` words."""
    n = len(found) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(w) for w in found], dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        out = out * MULTIPLIER + h[j : j + n]
    return out ^ (out >> np.uint64(31))


def _needed(n: int, threshold: float) -> int:
    return max(1, ceil(threshold * n - 1e-9))


class Partition:
    """Sketches of the items of one shingle width and one class of needed shingles, as two parallel arrays sorted by hash."""

    def __init__(self, width: int, entries: list[tuple[int, np.ndarray, int]]):
        self.width, self.least = width, min(need for _, _, need in entries)
        owner = np.concatenate([np.full(len(sketch), item, dtype=np.int32) for item, sketch, _ in entries])
        keys = np.concatenate([sketch for _, sketch, _ in entries])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Items one of whose sketch hashes is among the hashes h."""
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        found = np.unique(h[self.keys[at] == h])
        if not len(found):
            return np.zeros(0, np.int32)
        low, high = np.searchsorted(self.keys, found, "left"), np.searchsorted(self.keys, found, "right")
        return np.unique(np.concatenate([self.owner[i:j] for i, j in zip(low, high, strict=True)]))


class Index:
    """The partitions of a block of items, and the items' texts, compressed, for verification."""

    def __init__(self, items: Iterable[tuple[int, str]], width: int, threshold: float):
        self.width, self.threshold, self.items, by = width, threshold, [], {}
        for key, text in items:
            found = tokens(text)
            if not (want := shingles(found, width)):
                continue
            w, need = min(width, len(found)), _needed(len(want), threshold)
            sketch = np.sort(np.array([hashes(list(s), w)[0] for s in want], dtype=np.uint64))[: len(want) - need + 1]
            by.setdefault((w, need.bit_length()), []).append((len(self.items), np.unique(sketch), need))
            self.items.append((key, zlib.compress(text.encode(), 1)))
        self.partitions = [Partition(w, entries) for (w, _), entries in sorted(by.items())]
        self.kept: dict[int, set] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"kept": {}}

    def _want(self, item: int) -> tuple[set[tuple[str, ...]], int, np.ndarray]:
        """An item's shingles, their width, and their hashes in order."""
        if item not in self.kept:
            if len(self.kept) >= KEPT_ITEMS:
                self.kept.clear()
            want = shingles(tokens(zlib.decompress(self.items[item][1]).decode()), self.width)
            w = len(next(iter(want)))
            self.kept[item] = want, w, np.sort(np.array([hashes(list(s), w)[0] for s in want], dtype=np.uint64))
        return self.kept[item]

    def search(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, shared shingles, the item's shingles) for each item whose containment reaches the threshold."""
        found = tokens(text)
        if not found:
            return []
        mine, out, hits = {}, [], set()
        for p in self.partitions:
            if len(found) - p.width + 1 < p.least:
                continue
            if p.width not in mine:
                mine[p.width] = hashes(found, p.width)
            hits.update(p.hits(mine[p.width]).tolist())
        for i in sorted(hits):
            want, w, theirs = self._want(i)
            # words are compared only where a hash is the item's
            at = np.flatnonzero(theirs[np.minimum(np.searchsorted(theirs, mine[w]), len(theirs) - 1)] == mine[w])
            if len(at) < (need := _needed(len(want), self.threshold)):
                continue
            if (shared := len(want & {tuple(found[j : j + w]) for j in at.tolist()})) >= need:
                out.append((self.items[i][0], shared, len(want)))
        return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for r in bare(benchmark, item_col, text_col).where(f"`{item_col}` is not null and `{text_col}` is not null").distinct().toLocalIterator():
        block.append((r[0], r[1]))
        size += len(r[1])
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def _searcher(shared, found: T.StructType):
    """A function of a text that gives the block's items in it."""

    @F.pandas_udf(T.ArrayType(found))
    def search(text: pd.Series) -> pd.Series:
        index = shared.value
        return pd.Series([[dict(zip(found.names, x, strict=True)) for x in index.search(t)] for t in text], dtype=object)

    return search


def contained(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 5, threshold: float = 0.8, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item, `n_shared`, `n_item`, `containment`) for each document and item at `threshold` or more.

    Items are taken in blocks of about `block_chars` characters, each broadcast and searched for in one
    pass over the documents; of more than one block the findings are written out before the next is
    sent, so memory is bounded for any benchmark. Whole texts of any length are searched. Null or wordless documents
    and items match nothing; an item of fewer words than `width` is one shingle; items of an equal id
    and different text count on their own; repeated documents are all returned; a null document id
    is returned as null; empty tables give no rows. Further columns are not looked at.
    """
    rows = bare(docs, id_col, text_col).toDF("doc", "text").where("text is not null")
    item_type = bare(benchmark, item_col).schema[0].dataType
    found = T.StructType([T.StructField("item", item_type), T.StructField("n_shared", T.LongType()), T.StructField("n_item", T.LongType())])
    blocks, out = _blocks(benchmark, item_col, item_text_col, block_chars), []
    block, after = next(blocks, []), None
    while block is not None:
        shared = docs.sparkSession.sparkContext.broadcast(Index(block, width, threshold))
        hits = rows.select("doc", F.explode(_searcher(shared, found)("text")).alias("x")).select("doc", "x.*")
        after = next(blocks, None)
        if out or after is not None:
            hits = materialise(hits, "items")
            shared.destroy()
        out.append(hits)
        block = after
    out = reduce(DataFrame.unionByName, out)
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "n_shared", "n_item", F.round(F.col("n_shared") / F.col("n_item"), 6).alias("containment"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The input's rows and columns without documents that contain an item, found by `contained` and dropped by id: rows that
    share a found id go together, rows with a null id stay (`without_items` judges each row by its own text)."""
    (name,) = fresh(docs, "gone")
    gone = contained(docs, benchmark, id_col, **kw).select(F.col(f"`{id_col}`").alias(name)).distinct()
    return docs.join(gone, F.col(f"`{id_col}`") == F.col(name), "left_anti")


def without_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text", width: int = 5, threshold: float = 0.8, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The input's rows and columns without documents that contain an item, each judged by its own text: ids, also null ones, of documents and items aren't looked at.

    Null, empty and wordless documents stay; repeated rows are judged alike; an empty benchmark drops nothing. Blocks
    beyond the first two are judged after the rows that are left were written out.
    """
    items = bare(benchmark, item_text_col).select(F.lit(0).alias("item"), F.col(f"`{item_text_col}`").alias("text"))
    found = T.StructType([T.StructField(n, T.LongType()) for n in ("item", "n_shared", "n_item")])
    for n, block in enumerate(_blocks(items, "item", "text", block_chars)):
        if n > 1:
            docs = materialise(docs, "clean")
        shared = docs.sparkSession.sparkContext.broadcast(Index(block, width, threshold))
        docs = docs.where(F.size(_searcher(shared, found)(F.col(f"`{text_col}`"))) == 0)
    return docs
