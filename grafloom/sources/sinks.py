"""Sinks: reports, shards of JSON, indexes, slices. All writing is distributed; the driver writes a line or two at most."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grafloom.functions import terms


def write_report(df: DataFrame, path: str, about: Sequence[str] = (), sep: str = "\t") -> None:
    """Delimited text with a header, in the folder `path`; lines `about` it, marked by #, in `path`.about."""
    df.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)
    if about:
        df.sparkSession.createDataFrame([(f"# {x}",) for x in about], "value string").coalesce(1).write.mode("overwrite").text(path + ".about")


#: Entries of a JSON object in one file, about; shards of more have several files.
MOST_ENTRIES = 1_000_000


def shard_lines(df: DataFrame, key: str, value: Column, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """(shard, part, value): for each part of a shard of the key the lines of one JSON object from keys to values, a key a line, in order of the keys.

    A shard has one part for each most_entries keys, dealt by the keys' hashes, so that no task sorts a whole shard. No line holds more than an
    entry; long lists must be capped before (evidence.capped_lists).
    """
    entry = df.select(terms.djb2_shard(F.col(key)).cast("int").alias("shard"), F.col(key).alias("k"), F.to_json(F.struct(value.alias("v"))).alias("j"))
    entry = entry.withColumn("j", F.concat(F.to_json(F.array("k")).substr(F.lit(2), F.length(F.to_json(F.array("k"))) - 2), F.lit(":"), F.regexp_extract("j", r'(?s)^\{"v":(.*)\}$', 1)))
    # a row for each of the 256 shards
    parts = df.groupBy(terms.djb2_shard(F.col(key)).cast("int").alias("shard")).agg(F.ceil(F.count("*") / most_entries).cast("int").alias("parts"))
    entry = entry.join(F.broadcast(parts), "shard").withColumn("part", F.pmod(F.xxhash64("k"), "parts").cast("int"))
    order = Window.partitionBy("shard", "part").orderBy("k")
    first, last = F.lag("k").over(order).isNull(), F.lead("k").over(order).isNull()
    return entry.select("shard", "part", F.concat(F.when(first, "{").otherwise(","), "j", F.when(last, "}").otherwise("")).alias("value"))


def write_shards(df: DataFrame, path: str, key: str, value: Column, most_entries: int = MOST_ENTRIES) -> None:
    """Folders shard=N/part=M, a file with a JSON object each, for `formats.read_shards`. Keys must not be null or repeat."""
    shard_lines(df, key, value, most_entries).write.mode("overwrite").partitionBy("shard", "part").text(path)


def write_index(df: DataFrame, path: str, *order) -> None:
    """JSON Lines in order."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def json_ld(df: DataFrame, id_column: str, kind: str, context: dict[str, str]) -> DataFrame:
    """(value): a JSON-LD object for each row."""
    ctx = F.struct(*[F.lit(v).alias(k) for k, v in context.items()])
    rest = [F.col(c) for c in df.columns if c != id_column]
    return df.select(F.to_json(F.struct(ctx.alias("@context"), F.col(id_column).alias("@id"), F.lit(kind).alias("@type"), *rest)).alias("value"))


def write_version(df: DataFrame, root: str) -> str:
    """Writes a new version beside the earlier ones, and returns its path; a reader takes the largest."""
    path = f"{root.rstrip('/')}/v{time.time_ns()}"
    df.write.parquet(path)
    return path


def newest_version(spark, root: str) -> str | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(p):
        return None
    done = [str(s.getPath()) for s in store.listStatus(p) if store.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return max(done, default=None)


def split_removed(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): both halves, so that what goes can be written for audit."""
    keep = F.coalesce(keep, F.lit(False))
    return df.where(keep), df.where(~keep)
