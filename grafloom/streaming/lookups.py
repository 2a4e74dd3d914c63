"""Incremental look-ups: a stream of JSON Lines merged into a keyed table, each key once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def merge_stream(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, key: str) -> StreamingQuery:
    """Appends to the Parquet folder `target` those rows of new files in `source` whose key isn't there yet.

    Of several rows of a key in one batch the smallest is taken. A batch that is run again after a
    failure finds its keys in place, so it adds nothing twice. Ends when the files at hand are read.
    """

    def put(batch: DataFrame, _: int) -> None:
        s = batch.sparkSession
        columns = [c for c in batch.columns if c != key]
        first = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*columns)).alias("x")).select(key, "x.*")
        p = s._jvm.org.apache.hadoop.fs.Path(target)
        if p.getFileSystem(s._jsc.hadoopConfiguration()).exists(p):
            first = first.join(s.read.schema(batch.schema).parquet(target).select(key), key, "left_anti")
        first.select(*batch.columns).write.mode("append").parquet(target)

    rows = spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(source)
    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
