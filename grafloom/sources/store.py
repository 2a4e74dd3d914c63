"""A store of triples for edits in place.

Triples are in folders by the hash of their subject. An edit appends a small delta: triples that come, triples that go, and subjects whose
earlier triples all go. Reading merges the deltas into the buckets that they touch; other buckets are read as they are.
`compact` writes touched buckets anew, as a new generation, and leaves the files of the others alone. An edit, or a generation, counts
from when its marker file is there, so one that broke off is never seen. One writer at a time; any number of readers.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPO = ["s", "p", "o"]
SCHEMA = "s string, p string, o string, op string, bucket int"


def _by_bucket(rows: DataFrame) -> DataFrame:
    """The rows dealt by bucket; Spark cuts large buckets into several tasks, and so files."""
    return rows.hint("rebalance", "bucket")


class TripleStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- files ----

    def _store(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _markers(self, kind: str) -> list[dict]:
        """The markers of a kind, in order; each is one small file."""
        store, at = self._store(f"{self.root}/{kind}-done")
        if not store.exists(at):
            return []
        found = [str(x.getPath()) for x in store.listStatus(at)]
        rows = self.spark.read.text(found).collect() if found else []
        return sorted((json.loads(r[0]) for r in rows if r[0]), key=lambda x: x["seq"])

    def _mark(self, kind: str, **what) -> None:
        store, at = self._store(f"{self.root}/{kind}-done/{what['seq']:012d}.json")
        out = store.create(at, False)  # fails if another writer was faster
        out.write(bytearray(json.dumps(what).encode()))
        out.close()

    # ---- writing ----

    @classmethod
    def create(cls, t: DataFrame, root: str, buckets: int = 64) -> TripleStore:
        """A new store of the triples, as a set, in so many buckets."""
        store = cls(t.sparkSession, root)
        rows = t.select(*SPO).distinct().withColumn("bucket", store._bucket(F.col("s"), buckets))
        _by_bucket(rows).write.partitionBy("bucket").parquet(f"{store.root}/base/gen=0")
        store._mark("base", seq=0, buckets=list(range(buckets)), of=buckets)
        return store

    @staticmethod
    def _bucket(s: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(s), F.lit(buckets)).cast("int")

    def edit(self, add: DataFrame | None = None, remove: DataFrame | None = None, drop_subjects: DataFrame | None = None) -> None:
        """Triples (s, p, o) to add or to remove, and subjects (s) whose triples go. Within one edit what is added stays."""
        of = self._markers("base")[0]["of"]
        parts = []
        for rows, op in ((add, "add"), (remove, "remove"), (drop_subjects, "drop")):
            if rows is not None:
                null = F.lit(None).cast("string")
                parts.append(rows.select("s", *[null.alias(c) if op == "drop" else F.col(c) for c in ("p", "o")], F.lit(op).alias("op")))
        if not parts:
            return
        rows = parts[0]
        for x in parts[1:]:
            rows = rows.unionByName(x)
        seq = max([0, *(x["seq"] for x in self._markers("delta"))]) + 1
        path = f"{self.root}/delta/seq={seq}"
        _by_bucket(rows.distinct().withColumn("bucket", self._bucket(F.col("s"), of))).write.mode("overwrite").partitionBy("bucket").parquet(path)
        touched = [r["bucket"] for r in self.spark.read.schema(SCHEMA).parquet(path).select("bucket").distinct().collect()]
        self._mark("delta", seq=seq, buckets=touched, drops=drop_subjects is not None)

    def replace_subjects(self, rows: DataFrame) -> None:
        """The rows' subjects have just these triples from now on."""
        self.edit(add=rows, drop_subjects=rows.select("s").distinct())

    def remove_nodes(self, nodes: DataFrame) -> None:
        """All triples with one of the nodes (node) as subject or object go. Those that refer to a node are looked for in all buckets."""
        gone = nodes.select(F.col("node").alias("s")).distinct()
        # of triples that came, also those that went since: to remove them again changes nothing, and nothing is merged
        referring = self._rows(*self._state()).where("op = 'add'").join(gone.withColumnRenamed("s", "o"), "o", "left_semi").select(*SPO)
        self.edit(remove=referring, drop_subjects=gone)

    # ---- reading ----

    def _state(self) -> tuple[dict[int, int], dict[int, list[int]]]:
        """Each bucket's generation, and the deltas since then that touch it."""
        gen: dict[int, int] = {}
        for x in self._markers("base"):
            gen |= dict.fromkeys(x["buckets"], x["seq"])
        since: dict[int, list[int]] = {}
        for x in self._markers("delta"):
            for b in x["buckets"]:
                if x["seq"] > gen[b]:
                    since.setdefault(b, []).append(x["seq"])
        return gen, since

    def _base(self, gen: dict[int, int], buckets: list[int]) -> DataFrame:
        out = self.spark.createDataFrame([], "s string, p string, o string, bucket int")
        for g in sorted({gen[b] for b in buckets}):
            own = [b for b in buckets if gen[b] == g]
            store, at = self._store(f"{self.root}/base/gen={g}")
            if store.exists(at):
                whole = self.spark.read.schema("s string, p string, o string, bucket int").parquet(f"{self.root}/base/gen={g}")
                out = out.unionByName(whole.where(F.col("bucket").isin(own)))
        return out

    def _rows(self, gen: dict[int, int], since: dict[int, list[int]], buckets: list[int] | None = None) -> DataFrame:
        """(s, p, o, bucket, at, op): the base of the buckets, all if not given, and the deltas since then, in order of `at`."""
        rows = self._base(gen, list(gen) if buckets is None else buckets).withColumn("at", F.lit(0).cast("long")).withColumn("op", F.lit("add"))
        for seq in sorted({x for xs in since.values() for x in xs}):
            own = [b for b, xs in since.items() if seq in xs]
            delta = self.spark.read.schema(SCHEMA).parquet(f"{self.root}/delta/seq={seq}").where(F.col("bucket").isin(own))
            # of one edit, what is added comes last
            rows = rows.unionByName(delta.withColumn("at", (F.lit(2 * seq) + (F.col("op") == "add").cast("int")).cast("long")))
        return rows

    def _merged(self, gen: dict[int, int], since: dict[int, list[int]]) -> DataFrame:
        """(s, p, o, bucket) of the touched buckets: the last word on a triple counts."""
        rows = self._rows(gen, since, sorted(since))
        drops, words = rows.where("op = 'drop'").groupBy("s").agg(F.max("at").alias("dropped")), rows.where("op <> 'drop'")
        seen = {x for xs in since.values() for x in xs}
        if any(x.get("drops", True) for x in self._markers("delta") if x["seq"] in seen):
            words = words.join(drops, "s", "left").where(F.col("dropped").isNull() | (F.col("at") > F.col("dropped")))
        # a number, unlike a pair with the word itself, is aggregated without a sort; odd ones add, and so does the base
        last = words.groupBy(*SPO, "bucket").agg(F.max("at").alias("at"))
        return last.where("at = 0 or at % 2 = 1").select(*SPO, "bucket")

    def read(self, subjects: list[str] | None = None) -> DataFrame:
        """(s, p, o) as they stand; of certain subjects only, if given, which opens their buckets alone."""
        gen, since = self._state()
        if subjects is not None:
            of = self._markers("base")[0]["of"]
            asked = self.spark.createDataFrame([(x,) for x in subjects], "s string")
            own = {r[0] for r in asked.select(self._bucket(F.col("s"), of)).collect()}
            gen, since = {b: g for b, g in gen.items() if b in own}, {b: x for b, x in since.items() if b in own}
        out = self._base(gen, [b for b in gen if b not in since])
        if since:
            out = out.unionByName(self._merged(gen, since))
        return (out if subjects is None else out.where(F.col("s").isin(subjects))).select(*SPO)

    def compact(self) -> list[int]:
        """Writes the buckets that deltas touch anew and returns them; all else stays as it is on disk."""
        gen, since = self._state()
        if not since:
            return []
        seq = max(x for xs in since.values() for x in xs)
        _by_bucket(self._merged(gen, since)).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/base/gen={seq}")
        self._mark("base", seq=seq, buckets=sorted(since))
        return sorted(since)
