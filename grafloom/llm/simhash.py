"""SimHash near-duplicates: fingerprints, links at a few differing bits, connected classes.

Links are found by deletion variants. A fingerprint is cut into so few segments that, of two
fingerprints within the allowed distance, one segment differs by at most one bit; each segment
is indexed once for each of its bits with that bit masked, and equal keys make candidates.
Dense classes would fill index buckets with pairs, so links are contracted first: a star on the
unmasked segments (each fingerprint against its bucket's smallest and largest) gives classes, and the full
index then compares only members of different classes. No link between classes can be missed:
both ends share a bucket, and at least one of them is outside the bucket's most frequent class.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grafloom.llm.common import bare, discard, fresh, materialise

BITS = 64
#: Shingles whose bits are counted at once.
CHUNK = 1 << 15


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """SimHash over the text's word shingles, repeats included; a bit is set if over half the hashes have it. No words: 0."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    n = max(1, len(found) - width + 1)
    joined, at = b" ".join(found), 0
    ends, total = [], -1
    for w in found:
        total += len(w) + 1
        ends.append(total)
    last = ends[width - 1 :] if len(found) >= width else [len(joined)]
    starts = [0] + [e + 1 for e in ends[: n - 1]]
    set_bits, hashed = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        h = np.array([hashed(joined[a:b], seed) for a, b in zip(starts[at : at + CHUNK], last[at : at + CHUNK], strict=True)], dtype="<u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * set_bits > n, bitorder="little").tobytes(), "little")


@F.pandas_udf(T.LongType())
def _fingerprints(text: pd.Series, width: pd.Series, seed: pd.Series) -> pd.Series:
    if not len(text):
        return pd.Series([], dtype="int64")
    w, s = int(width.iloc[0]), int(seed.iloc[0])
    return pd.Series(np.array([fingerprint(t, w, s) for t in text], dtype=np.uint64).view(np.int64))


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the fewest segments of which one has at most one of the differing bits."""
    n = distance // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _keys(fp: Column, distance: int, wildcard: bool) -> Column:
    out = []
    for i, (first, bits) in enumerate(segments(distance)):
        part = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1))
        # segment, wildcard position and value in one long; a segment has at most 32 bits as distance >= 2
        out += [part.bitwiseAND(F.lit(~(1 << j))) + F.lit((i * BITS + j) << 33) for j in range(bits)] if wildcard else [part + F.lit(i << 33)]
    return F.array(*out)


def _near(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _once(distance: int) -> Column:
    """Holds for one of the keys that the near fingerprints fp and fp_ share: of their first segment with at most one differing bit, that bit's, else the first."""
    x, at = F.col("fp").bitwiseXOR(F.col("fp_")), F.shiftright("k", 33)
    out, before = F.lit(False), F.lit(True)
    for i, (first, bits) in enumerate(segments(distance)):
        part = F.shiftrightunsigned(x, first).bitwiseAND(F.lit((1 << bits) - 1))
        out |= before & (F.shiftright(at, 6) == i) & ((part != 0) | (at % BITS == 0))
        before &= F.bit_count(part) > 1
    return out


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node of its component.

    Alternating large-star and small-star steps; each is joins on node keys with sums before the
    exchange, written to the shared folder, until a step changes nothing.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    e = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    was = state(e)
    while was[0]:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        before, e = (e, was), materialise(small.select("x.u", "x.v").where("u <> v").distinct(), "edges")
        discard(before[0])
        was, before = state(e), before[1]
        if was == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def classes(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, root) for a table of distinct fingerprints fp: equal roots are linked, directly or through others."""
    if distance < 2:
        raise ValueError("distance must be 2 at least")
    star = prints.select("fp", F.explode(_keys(F.col("fp"), distance, False)).alias("k"))
    centre = star.groupBy("k").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("k", F.explode(F.array("lo", "hi")).alias("c"))
    near = star.join(centre, "k").where((F.col("fp") != F.col("c")) & _near("fp", "c", distance))
    first = connected(near.select(F.col("fp").alias("u"), F.col("c").alias("v")))
    first = materialise(prints.join(first, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("c")), "classes")

    bucket, own = Window.partitionBy("k"), Window.partitionBy("k", "c")
    index = first.select("fp", "c", F.explode(_keys(F.col("fp"), distance, True)).alias("k"))
    index = index.select("*", F.min("c").over(bucket).alias("lo"), F.max("c").over(bucket).alias("hi")).where("lo < hi")
    index = index.select("k", "fp", "c", F.count("*").over(own).alias("n")).select("k", "fp", "c", F.max(F.struct("n", "c")).over(bucket)["c"].alias("most"))
    index = materialise(index, "variants")
    rest = index.where("c <> most").select("k", F.col("fp").alias("fp_"), F.col("c").alias("c_"))
    links = rest.join(index, "k").where((F.col("c") != F.col("c_")) & _near("fp", "fp_", distance) & _once(distance)).select(F.col("c_").alias("u"), F.col("c").alias("v"))
    merged = connected(links)
    return first.join(merged, F.col("c") == F.col("node"), "left").select("fp", F.coalesce("root", "c").alias("root"))


def _linked(docs: DataFrame, id_col: str, text_col: str, distance: int, width: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every row, and (fp, root, component_id) of every fingerprint."""
    rows = bare(docs, id_col, text_col).toDF("id", "text")
    rows = materialise(rows.select("id", _fingerprints("text", F.lit(width), F.lit(seed)).alias("fp")), "fingerprints")
    prints = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    found = materialise(classes(prints.select("fp"), distance).join(prints, "fp"), "found")
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows, found.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """One row per input row: the id (as it is), `fingerprint` (16 hex digits) and `component_id`, the smallest id of its class.

    Null or wordless text has fingerprint zero and links like any other; rows with a null id take part,
    and a class of null ids only has a null component_id; repeated rows are all returned; an empty
    table gives no rows; further columns are not looked at.
    """
    rows, found = _linked(docs, id_col, text_col, distance, width, seed)
    return rows.join(found, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """One row of each class, with all the input's columns: that of the smallest id; of equal ids, of the smallest fingerprint.

    Rows are judged by their own text: an id that repeats with texts of different classes may stay more than
    once, and of rows with an equal id and fingerprint the one that is smallest as JSON stays. Null ids
    come last. Null or wordless texts have fingerprint zero and are one class; texts are read whole; an empty table gives no rows.
    """
    rows, found = _linked(docs, id_col, text_col, distance, width, seed)
    name_id, name_fp, name_row = fresh(docs, "id", "fp", "row")
    placed = rows.join(found.select("fp", "root"), "fp")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "fp")
    stays = materialise(placed.groupBy("root").agg(F.min(order).alias("x")).select(F.col("x.id").alias(name_id), F.col("x.fp").alias(name_fp)), "kept")
    again = materialise(rows.groupBy("id").count().where("count > 1").select(F.col("id").alias(name_id)), "repeated")

    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    same = key.eqNullSafe(F.col(name_id))
    if again.isEmpty():
        return docs.join(stays, same, "left_semi")
    # ids that occur once need no second look at the text
    once = docs.join(again, same, "left_anti").join(stays, same, "left_semi")
    more = docs.join(again, same, "left_semi").withColumn(name_fp, _fingerprints(text, F.lit(width), F.lit(seed)))
    both = stays.withColumnRenamed(name_fp, name_row)
    more = more.join(both, same & (F.col(name_fp) == F.col(name_row)), "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = more.groupBy(key.alias(name_id), name_fp).agg(F.min_by(whole, F.to_json(whole)).alias(name_row)).select(f"{name_row}.*")
    return once.unionByName(one)
