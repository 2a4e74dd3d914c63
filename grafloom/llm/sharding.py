"""Contiguous shards of near-equal byte size, by global prefix sums.

Rows are sorted by id over range partitions. Each partition sums its sizes as it goes; the partitions'
totals, one row each, are turned into offsets, and a row's shard is where the middle of its bytes
falls among equal targets. Rows move once, in the sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grafloom.llm.common import fresh, materialise
from grafloom.scratch import parts_for

#: Bytes that a row counts besides its text.
ROW_BYTES = 16


def _running(size: str, before: str, row: str):
    """A function that fills the columns `before` and `row`, the bytes and rows of the partition up to a row, in the order they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = rows = 0
        for b in batches:
            sizes = b.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(sizes)
            made = {before: pa.array(ends - sizes, pa.int64()), row: pa.array(rows + np.arange(len(sizes)), pa.int64())}
            yield pa.RecordBatch.from_arrays([made.get(n, b.column(n)) for n in b.schema.names], schema=b.schema)
            if len(sizes):
                total, rows = int(ends[-1]), rows + len(sizes)

    return run


def assign(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, if not given) of every row with `size`, `text_crc32`, `shard` and `slot`.

    `size` is the text's UTF-8 bytes (null: none) plus 16; `text_crc32` that of the bytes, unsigned
    (null: of none, 0). Shards hold consecutive ids, null ids first; a shard's bytes differ from an
    equal part by less than the largest row; `slot` counts a shard's rows from 0 in order. Ties of ids
    go by CRC, size and place in the input, so that repeated rows can be cut anywhere. Columns of the
    input named like the four are replaced. Texts may be of any length. An empty table gives no rows.
    """
    made = ("size", "text_crc32", "shard", "slot")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    id_, size, crc, place, part, before, row, bytes_, rows_, whole, of, first = fresh(docs, "id", "size", "crc", "place", "part", "before", "row", "bytes", "rows", "whole", "of", "first")
    raw = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{id_col}`").alias(id_), (F.octet_length(raw) + F.lit(ROW_BYTES)).cast("long").alias(size), F.crc32(raw).alias(crc), F.monotonically_increasing_id().alias(place))
    n = parts_for(rows)
    order = [id_, crc, size, place]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).drop(place, id_)
    rows = rows.withColumns({part: F.spark_partition_id(), before: F.lit(0).cast("long"), row: F.lit(0).cast("long")})
    rows = materialise(rows.mapInArrow(_running(size, before, row), T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])), "sorted")

    # one row a partition, so a broadcast of it is bounded by the partitions
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(part).agg(F.sum(size).alias("b"), F.count("*").alias("r"))
    parts = parts.select(part, F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias(bytes_), F.coalesce(F.sum("r").over(earlier), F.lit(0)).alias(rows_), F.sum("b").over(Window.partitionBy()).alias(whole))
    middle = f"(`{bytes_}` + `{before}`) * 2 + `{size}`"
    shard = F.least(F.expr(f"cast({middle} as decimal(20,0)) * cast({n_shards} as decimal(20,0)) div (cast(`{whole}` as decimal(20,0)) * 2)").cast("int"), F.lit(n_shards - 1))
    placed = rows.join(F.broadcast(parts), part).withColumn(of, shard).withColumn(row, F.col(rows_) + F.col(row))
    begins = placed.groupBy(F.col(of).alias(id_)).agg(F.min(row).alias(first))  # a row a shard
    placed = placed.join(F.broadcast(begins), F.col(of) == F.col(id_))
    return placed.select(*[F.col(f"`{c}`") for c in keep], F.col(size).alias("size"), F.col(crc).alias("text_crc32"), F.col(of).alias("shard"), (F.col(row) - F.col(first)).cast("long").alias("slot"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """Writes a folder shard=N for each shard; its files hold consecutive slots, in order. A shard is written by as many tasks as its rows need."""
    n = parts_for(assigned)
    assigned.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
