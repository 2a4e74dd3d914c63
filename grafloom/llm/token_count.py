"""Token counts through a digest cache.

Counts are stored by (digest of the text, digest of the tokenizer file). A call joins its texts'
digests to the cache, encodes one text for each digest that is missing, and appends the counts.

Texts don't move for that: a slim table gives each missing digest one place (partition and row of the
scan), and the tasks of a second scan read the places of their partition and encode just these rows,
checking their digests. Places that a scan no longer has, as when its partitions are cut anew, are made
up for by a join that fetches the texts of the digests still missing.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grafloom.llm.common import bare, materialise, scratch_path

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"
#: Texts are encoded in groups of at most so many characters, or one by one if longer.
GROUP_CHARS = 1 << 18
#: Partitions of the scan whose missing places share a folder, so that a wide scan doesn't make a file for each.
PARTS_A_FILE = 16
#: Digests of 32 bytes that are broadcast at most, when texts have to be found again.
MOST_BROADCAST = 1_000_000


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer's version: kind of file and SHA-256 of its bytes."""
    with open(path, "rb") as f:
        return os.path.splitext(path)[1] + ":" + hashlib.sha256(f.read()).hexdigest()


@lru_cache(maxsize=4)
def _counter(path: str):
    """texts -> token counts, without begin, end or added special tokens, truncation or padding."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]
    raise ValueError(f"no tokenizer library for {path}")


def count_tokens(texts, path: str) -> list[int]:
    count, out, group, size = _counter(path), [], [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= GROUP_CHARS:
            out += count(group)
            group, size = [], 0
    return out + (count(group) if group else [])


def local_tokenizer(path: str, digest: str) -> str:
    """The tokenizer's file on this machine: `path`, or the copy that the driver sent."""
    for p in (path, SparkFiles.get(os.path.basename(path))):
        if os.path.exists(p) and _digest_here(p) == digest:
            return p
    raise FileNotFoundError(f"no {path} of digest {digest}")


_digest_here = lru_cache(maxsize=4)(tokenizer_digest)


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The cache's rows; none if nothing was written there yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def _save(counted: DataFrame, version: str, cache: str) -> None:
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)


def _encode_places(rows: DataFrame, misses: DataFrame, tokenizer: str, digest: str) -> DataFrame:
    """(digest, n_tokens) of the misses (digest, part, row) whose place in a new scan of `rows` holds a text of that digest."""
    folder = scratch_path(rows.sparkSession, "places")
    misses.select("part", (F.col("part") - F.col("part") % PARTS_A_FILE).alias("p"), "row", "digest").repartitionByRange("part", "row").sortWithinPartitions("part", "row").write.partitionBy("p").parquet(folder)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, at = fs.FileSystem.from_uri(folder)
        files = [x.path for x in store.get_file_info(fs.FileSelector(f"{at}/p={part - part % PARTS_A_FILE}", allow_not_found=True)) if x.path.endswith(".parquet")]
        if not files:
            return
        wanted = pa.concat_tables([pq.read_table(f, filesystem=store, partitioning=None, columns=["row", "digest"], filters=[("part", "=", part)]) for f in files]).sort_by("row")
        if not wanted.num_rows:
            return
        places, digests, first = wanted["row"].to_numpy(), wanted["digest"].to_pylist(), 0
        tokenizer_here = local_tokenizer(tokenizer, digest)
        for b in batches:
            low, high = np.searchsorted(places, [first, first + b.num_rows])
            texts = b.column(0).take(pa.array(places[low:high] - first)).to_pylist()
            first += b.num_rows
            same = [(d, t) for d, t in zip(digests[low:high], texts, strict=True) if hashlib.sha256(t.encode()).digest() == d]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in same], pa.binary()), pa.array(count_tokens([t for _, t in same], tokenizer_here), pa.int64())], names=["digest", "n_tokens"])

    return rows.select("text").mapInArrow(encode, "digest binary, n_tokens long")


def token_counts(docs: DataFrame, path: str, cache: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """One row per input row: the id (as it is), `n_bytes`, `n_tokens` and `over_limit` (more tokens than `limit`).

    A null text counts as the empty text: no bytes, no tokens. Texts of any length are encoded whole. Repeated rows
    and null ids are all returned, an empty table gives no rows, further columns are not looked at. `cache` is a folder
    that all executors share; two calls may append to it at once, as equal rows are merged on reading.
    `path` is the tokenizer's file; executors that don't have it there get it from the driver.
    """
    spark, version = docs.sparkSession, tokenizer_digest(path)
    rows = bare(docs, id_col, text_col).toDF("id", "text").select("id", F.coalesce("text", F.lit("")).alias("text"))
    sha = F.unhex(F.sha2("text", 256)).alias("digest")
    counts = lambda: read_cache(spark, cache).where(F.col("tokenizer") == version).select("digest", "n_tokens").distinct()

    spark.sparkContext.addFile(path)
    place = F.monotonically_increasing_id()  # 33 bits of row below the partition
    slim = rows.select(sha, place.alias("place")).groupBy("digest").agg(F.min("place").alias("place"))
    misses = slim.join(counts().select("digest"), "digest", "left_anti")
    misses = materialise(misses.select("digest", F.shiftright("place", 33).cast("int").alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("row")), "misses")
    if not misses.isEmpty():
        _save(_encode_places(rows, misses, path, version), version, cache)
        left = misses.join(counts().select("digest"), "digest", "left_anti").select("digest")
        if not left.isEmpty():
            counter = F.pandas_udf(lambda text: pd.Series(count_tokens(text, local_tokenizer(path, version)), dtype="int64"), T.LongType())
            # few digests find their texts without moving any; each task then sends one text a digest
            left = F.broadcast(left) if left.count() <= MOST_BROADCAST else left
            fetched = rows.select(sha, "text").join(left, "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text"))
            _save(fetched.select("digest", counter("text").alias("n_tokens")), version, cache)

    out = rows.select("id", sha, F.octet_length("text").cast("long").alias("n_bytes")).join(counts(), "digest")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
