"""A resumable pipeline: stages in order, each a checkpoint in Parquet, with a manifest of what was done."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Stage:
    """`make` gets the previous stage's frame (None at first); `view` is what is counted, if not all of it."""

    name: str
    make: Callable[[DataFrame | None], DataFrame]
    view: Callable[[DataFrame], DataFrame] | None = None


def select(stages: list[Stage], only: list[str] | None = None, first: str | None = None, last: str | None = None) -> list[str]:
    """The names to run, in order; unknown names raise ValueError."""
    names = [s.name for s in stages]
    if unknown := {*(only or []), *filter(None, (first, last))} - {*names}:
        raise ValueError(f"no such stage: {', '.join(sorted(unknown))}")
    if only:
        return [n for n in names if n in only]
    return names[names.index(first) if first else 0 : names.index(last) + 1 if last else None]


class Pipeline:
    """Runs stages into a folder on any store Spark reaches; a stage that is done is read, not made again."""

    def __init__(self, spark: SparkSession, folder: str, stages: list[Stage]):
        self.spark, self.folder, self.stages = spark, folder.rstrip("/"), stages

    def _path(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def manifest(self) -> dict[str, dict]:
        p, store = self._path("manifest.jsonl")
        if not store.exists(p):
            return {}
        rows = self.spark.read.text(f"{self.folder}/manifest.jsonl").collect()
        return {x["stage"]: x for x in sorted((json.loads(r[0]) for r in rows), key=lambda x: x["at"])}

    def _note(self, stage: str, **facts) -> None:
        row = json.dumps({"stage": stage, "at": time.time(), **facts})
        self.spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("append").text(f"{self.folder}/manifest.jsonl")

    def run(self, only: list[str] | None = None, first: str | None = None, last: str | None = None, force: bool = False) -> DataFrame | None:
        """The last stage's frame. A failure is noted and raised; the next run goes on from there."""
        wanted, done, df = select(self.stages, only, first, last), self.manifest(), None
        for stage in self.stages:
            p, store = self._path(stage.name)
            ready = done.get(stage.name, {}).get("status") == "done" and store.exists(p)
            if stage.name in wanted and (force or only or not ready):
                began = time.time()
                try:
                    stage.make(df).write.mode("overwrite").parquet(f"{self.folder}/{stage.name}")
                except Exception as e:
                    self._note(stage.name, status="failed", error=str(e)[:500])
                    raise
                df = self.spark.read.parquet(f"{self.folder}/{stage.name}")
                self._note(stage.name, status="done", rows=df.count(), seconds=round(time.time() - began, 3))
            elif ready:
                df = self.spark.read.parquet(f"{self.folder}/{stage.name}")
            if stage.name == wanted[-1]:
                break
        return df


def count_stages(spark: SparkSession, stages: list[Stage]) -> DataFrame:
    """(stage, rows) of the stages, as one lazy frame."""
    from pyspark.sql import functions as F

    out, df = None, None
    for s in stages:
        df = s.make(df)
        n = (s.view(df) if s.view else df).agg(F.count("*").alias("rows")).select(F.lit(s.name).alias("stage"), "rows")
        out = n if out is None else out.unionByName(n)
    return out
