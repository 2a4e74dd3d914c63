"""Exact duplicates by distributed MSD radix partitioning.

Documents are split by successive bytes of their normalised text, the first bytes first, until every group is a single
document or its texts have ended; texts of a group that ended are equal, so no digest decides. A digit is a string of
bytes, of WIDTH bytes at first and GROWTH times as many in each further round, with the end of the text as a digit of its own: the number
of rounds grows with the logarithm of the longest text that is shared. Each round counts the digits within the groups
(sums by task before the exchange, so a hot group sends one row a task), and only documents whose digit is not
alone go on, with what is left of their text: single documents leave in the first round, where their text isn't moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grafloom.llm.common import ascii_lower, bare, materialise, scratch_path

WIDTH, GROWTH = 64, 8
#: Shared first digits, of at most WIDTH bytes each, up to which they are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 500_000


def _split(rest: Column, width: int) -> dict[str, Column]:
    """The next digit of the text that is left, and whether the text ends in it."""
    return {"digit": F.substring(rest, 1, width), "ended": F.length(rest) <= width}


def _tail(rest: Column, width: int) -> Column:
    return F.substring(rest, F.lit(width + 1), F.length(rest))


def _written(rows: DataFrame, name: str) -> DataFrame:
    """rows in the shared folder, documents that are done apart from those that go on."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.partitionBy("done").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """One row per input row: the id, `keep_id`, `group_size`, `kept` and `text_sha256`.

    Texts are equal if they are the same bytes after lower-casing A-Z; a null text counts as empty, and texts of any length are compared
    whole. Of equal texts the row with the largest id stays, a null id before none; of rows that repeat an id and
    its text one stays. `text_sha256` is of the normalised text and decides nothing. An empty table gives no rows;
    further columns are not looked at.
    """
    text = ascii_lower(F.coalesce("text", F.lit("")))
    rows = bare(docs, id_col, text_col).toDF("id", "text").select("id", text.cast("binary").alias("rest"))
    heads = rows.select(*[c.alias(n) for n, c in _split(F.col("rest"), width).items()]).groupBy("digit", "ended").count().where("count > 1")
    heads = materialise(heads.select("digit", "ended", F.monotonically_increasing_id().alias("g")), "heads")
    shared = F.broadcast(heads) if heads.count() <= most_broadcast else heads
    found = rows.withColumns(_split(F.col("rest"), width)).join(shared, ["digit", "ended"], "left")
    alone = F.col("g").isNull()
    found = found.select(
        F.monotonically_increasing_id().alias("rid"), "id", F.sha2("rest", 256).alias("text_sha256"), "g", F.when(~alone, _tail(F.col("rest"), width)).alias("rest"),
        F.lit(1).cast("long").alias("group_size"), F.col("id").alias("keep_id"), alone.alias("kept"), alone.alias("done"),
    )
    found = _written(found, "radix")
    out = found.where("done")
    while not (left := found.where("not done")).isEmpty():
        width *= GROWTH
        left = left.select("rid", "id", "text_sha256", "g", "rest").withColumns(_split(F.col("rest"), width))
        counts = left.groupBy("g", "digit", "ended").agg(F.count("*").alias("n"), F.max(F.struct("id", "rid")).alias("best")).where("n > 1")
        counts = materialise(counts.withColumn("next", F.monotonically_increasing_id()), "digits")
        found = left.join(counts, ["g", "digit", "ended"], "left")
        alone = F.col("n").isNull()
        done = alone | F.col("ended")
        found = found.select(
            "rid", "id", "text_sha256", F.col("next").alias("g"), F.when(~done, _tail(F.col("rest"), width)).alias("rest"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
            (alone | (F.col("rid") == F.col("best.rid"))).alias("kept"), done.alias("done"),
        )
        found = _written(found, "radix")
        out = out.unionByName(found.where("done"))
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`group`'s rows of the documents that stay: one of each group of equal texts."""
    return group(docs, id_col, text_col).where("kept")
