"""Substring search in names by an index of trigrams.

The index is two tables of files. Names are dealt to chunks by their hash and numbered within them; postings have a row for each trigram
and chunk: how many names of the chunk have it, and their numbers in order, which Parquet packs as differences. Both are in
folders by chunk or by hash of the trigram, so a query opens the files of its own trigrams and, of the names, only those
of chunks where all of them meet. Within a chunk the numbers are intersected from the rarest trigram on; what is left is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Names in a chunk, about, and folders of postings.
CHUNK_NAMES, BUCKETS = 50_000, 64
#: Numbers of names that a task holds while it makes postings.
MOST_HELD = 2_000_000


def _trigrams(text: str) -> list[str]:
    return sorted({text[i : i + 3] for i in range(len(text) - 2)})


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, no, name) to (gram, chunk, nos): names that come one after another share lists, which end with the chunk or when there is much in them."""
    codes, nos, held, at = [], [], 0, None

    def flush() -> pa.RecordBatch:
        code = np.concatenate(codes)
        order = np.argsort(code, kind="stable")
        code, no = code[order], np.repeat(np.array(nos, np.int32), [len(x) for x in codes])[order]
        begins = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        own = code[begins]
        letters = np.stack([own >> np.uint64(42), own >> np.uint64(21) & np.uint64(0x1FFFFF), own & np.uint64(0x1FFFFF)], axis=1).astype("<u4").tobytes().decode("utf-32-le")
        grams = [letters[i : i + 3] for i in range(0, len(letters), 3)]
        lists = pa.ListArray.from_arrays(pa.array(np.r_[begins, len(code)].astype(np.int32)), pa.array(no))
        return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(np.full(len(grams), at, np.int32)), lists], names=["gram", "chunk", "nos"])

    for b in batches:
        for chunk, no, name in zip(*[b.column(c).to_pylist() for c in ("chunk", "no", "name")], strict=True):
            if codes and (chunk != at or held > MOST_HELD):
                yield flush()
                codes, nos, held = [], [], 0
            x = np.frombuffer(name.encode("utf-32-le"), "<u4").astype(np.uint64)
            own = pd.unique(x[:-2] << np.uint64(42) | x[1:-1] << np.uint64(21) | x[2:])  # 21 bits a letter
            codes.append(own)
            nos.append(no)
            held, at = held + len(own), chunk
    if codes:
        yield flush()


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(gram.cast("binary")), F.lit(buckets)).cast("int")


def build(names: DataFrame, path: str, chunk_names: int = CHUNK_NAMES, buckets: int = BUCKETS) -> None:
    """Writes the index of names (id, name, ...) to the folder. Further columns are kept; null names are left out, equal rows are all there."""
    spark = names.sparkSession
    rows = names.where("name is not null")
    chunks = max(1, -(-rows.count() // chunk_names))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "name"), F.lit(chunks)).cast("int"))
    rows = rows.withColumn("no", F.row_number().over(Window.partitionBy("chunk").orderBy("name", "id")) - 1)
    rows.sortWithinPartitions("chunk", "no").write.partitionBy("chunk").parquet(f"{path}/names")
    # what was written is read: ties of equal rows are numbered once
    letters = spark.read.schema(rows.schema).parquet(f"{path}/names").where(F.length(F.lower("name")) > 2).select("chunk", "no", F.lower("name").alias("name"))
    have = letters.mapInArrow(_postings, "gram string, chunk int, nos array<int>")
    # at most a chunk's names in a list
    postings = have.groupBy("gram", "chunk").agg(F.array_sort(F.flatten(F.collect_list("nos"))).alias("nos")).select("gram", "chunk", F.size("nos").alias("n"), "nos", _bucket(F.col("gram"), buckets).alias("bucket"))
    writer = postings.repartition("bucket").sortWithinPartitions("bucket", "gram", "chunk").write.partitionBy("bucket")
    # differences of numbers in order, bit-packed
    writer.option("parquet.enable.dictionary", "false").option("parquet.writer.version", "PARQUET_2_0").parquet(f"{path}/postings")


def _buckets_of(spark: SparkSession, grams: list[str], buckets: int) -> list[int]:
    found = spark.createDataFrame([(g,) for g in grams], "gram string").select(_bucket(F.col("gram"), buckets))
    return sorted({r[0] for r in found.collect()})


def candidates(spark: SparkSession, path: str, query: str, buckets: int = BUCKETS) -> DataFrame:
    """The indexed rows whose lower-cased name contains the lower-cased query, with the columns they were given.

    A query of fewer than three characters has no trigram and reads all names.
    """
    q, whole = query.lower(), spark.read.parquet(f"{path}/names")
    grams = _trigrams(q)
    holds = F.lower("name").contains(q)
    if not grams:
        return whole.where(holds).drop("chunk", "no")
    postings = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(_buckets_of(spark, grams, buckets)) & F.col("gram").isin(grams))
    per = postings.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("n", "nos"))).alias("lists")).where(F.size("lists") == len(grams))
    rest = F.slice("lists", 2, len(grams))
    nos = F.aggregate(rest, F.get("lists", 0)["nos"], lambda left, x: F.array_intersect(left, x["nos"]))
    hits = per.select("chunk", nos.alias("nos")).where(F.size("nos") > 0)
    chunks = [r["chunk"] for r in hits.select("chunk").collect()]  # numbers of chunks, not of names
    at = hits.select("chunk", F.explode("nos").alias("no"))
    return whole.where(F.col("chunk").isin(chunks)).join(at, ["chunk", "no"], "left_semi").where(holds).drop("chunk", "no")
