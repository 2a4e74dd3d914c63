"""Databases, look-up services and staged files. Credentials come from the environment or the caller; nothing here is fetched unless a fetcher is given."""

from __future__ import annotations

import os
import shutil
import time
import urllib.request
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc(spark: SparkSession, query: str, url: str | None = None, **options) -> DataFrame:
    """Rows of a query that the database runs. The URL, user and password default to GRAFLOOM_DB_URL, _USER and _PASSWORD."""
    url = url or os.environ.get("GRAFLOOM_DB_URL")
    if not url:
        raise ValueError("give a JDBC URL or set GRAFLOOM_DB_URL")
    given = {"user": os.environ.get("GRAFLOOM_DB_USER"), "password": os.environ.get("GRAFLOOM_DB_PASSWORD")} | options
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**{k: v for k, v in given.items() if v is not None}).load()


def sql(spark: SparkSession, tables: dict[str, DataFrame], text: str) -> DataFrame:
    """Spark SQL over the named frames: what a database ran before."""
    return spark.sql(text, **tables)


class LookupTable:
    """A service seen as a cached table (key, value): known keys are joined, unknown ones fetched in batches and appended.

    `fetch` gets a list of keys and returns a dict; a null value is known to be empty, and asked for again after `keep_empty` seconds, if given. A
    batch that fails is tried `tries` times, with growing pauses. A key that stays without an answer, as its batch failed or the answer
    left it out, is recorded and asked for again by the next `fill`, until `most_rounds` of them had no answer: then it is dead. At most `rate` batches
    a second are sent by all workers together, if given. Without a fetcher unknown keys stay null.
    """

    SCHEMA = "key string, value string, answered boolean, at double"

    def __init__(self, spark: SparkSession, path: str, fetch: Callable[[list[str]], dict[str, str | None]] | None = None, batch: int = 150, workers: int = 4, tries: int = 3, pause: float = 0.5, most_rounds: int = 5, keep_empty: float | None = None, rate: float | None = None):
        self.spark, self.path, self.fetch, self.batch, self.workers, self.tries, self.pause = spark, path, fetch, batch, workers, tries, pause
        self.most_rounds, self.keep_empty, self.rate = most_rounds, keep_empty, rate

    def _rows(self) -> DataFrame:
        """A row a key: its answer, if there is one, the newest time, and how many rounds had none."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        there = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)
        rows = self.spark.read.schema(self.SCHEMA).parquet(self.path) if there else self.spark.createDataFrame([], self.SCHEMA)
        answered = F.coalesce("answered", F.lit(True))  # caches of before have no such column
        last = F.max_by(F.struct("value", "at"), F.when(answered, F.struct(F.coalesce("at", F.lit(0.0)), F.col("value").isNotNull(), "value")))
        return rows.groupBy("key").agg(last.alias("x"), F.max(answered).alias("answered"), F.count_if(~answered).alias("rounds")).select("key", "x.value", "x.at", "answered", "rounds")

    def known(self) -> DataFrame:
        return self._rows().where("answered").select("key", "value")

    def dead(self) -> DataFrame:
        """(key, rounds) of keys that aren't asked for any more."""
        return self._rows().where(~F.col("answered") & (F.col("rounds") >= self.most_rounds)).select("key", "rounds")

    def todo(self, keys: DataFrame) -> DataFrame:
        rows = self._rows()
        old = F.lit(False) if self.keep_empty is None else F.col("value").isNull() & (F.coalesce("at", F.lit(0.0)) <= time.time() - self.keep_empty)
        settled = rows.where((F.col("answered") & ~old) | (~F.col("answered") & (F.col("rounds") >= self.most_rounds)))
        return keys.select(F.col(keys.columns[0]).alias("key")).where("key is not null").distinct().join(settled.select("key"), "key", "left_anti")

    def fill(self, keys: DataFrame) -> None:
        """Asks once for what isn't known yet; every key that was asked for leaves a row. The number of workers bounds the load on the service."""
        if self.fetch is None:
            return
        fetch, size, tries, pause = self.fetch, self.batch, self.tries, self.pause
        every = self.workers / self.rate if self.rate else 0.0

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for at in range(0, len(b), size):
                    found: dict[str, str | None] = {}
                    part = b["key"].iloc[at : at + size].tolist()
                    for n in range(tries):
                        began = time.time()
                        try:
                            found = fetch(part)
                        except OSError:
                            time.sleep(pause * 2**n)
                        else:
                            n = tries
                        time.sleep(max(0.0, every - (time.time() - began)))
                        if n == tries:
                            break
                    more = [k for k in found if k not in set(part)]
                    yield pd.DataFrame([(k, found.get(k), k in found, time.time()) for k in [*part, *more]], columns=["key", "value", "answered", "at"])

        self.todo(keys).repartition(self.workers).mapInPandas(run, self.SCHEMA).write.mode("append").parquet(self.path)

    def join(self, rows: DataFrame, column: str, as_column: str = "value") -> DataFrame:
        found = self.known().select(F.col("key").alias("__key"), F.col("value").alias(as_column))
        return rows.join(found, F.col(column) == F.col("__key"), "left").drop("__key")


def first_existing(folders: Iterable[str], *names: str, required: bool = True) -> str | None:
    """The first of the names that is in one of the folders, which are paths or URIs of any store."""
    folders = [str(f).rstrip("/") for f in folders]
    for n in names:
        for f in folders:
            if _there(f"{f}/{n}"):
                return f"{f}/{n}"
    if required:
        raise FileNotFoundError(f"none of {', '.join(names)} in {', '.join(folders)}")
    return None


def _target(path: str):
    """The store and path of a URI, or of a plain path on the driver's disk."""
    return fs.FileSystem.from_uri(path if "://" in path else str(Path(path).absolute()))


def _copy_new(source, target: str) -> str:
    """Copies an open source into `target` under another name first; a broken copy leaves nothing under its name."""
    store, at = _target(target)
    with store.open_output_stream(at + ".part") as out:
        shutil.copyfileobj(source, out)
    store.move(at + ".part", at)
    return target


def _there(target: str) -> bool:
    store, at = _target(target)
    return store.get_file_info(at).type != fs.FileType.NotFound


def stage_file(url: str, target: str) -> str:
    """Downloads into `target` unless it is there. On a cluster `target` is a URI in a store that all executors share."""
    if not _there(target):
        with urllib.request.urlopen(url) as source:  # noqa: S310
            _copy_new(source, target)
    return target


def unzip_member(archive: str, member: str, folder: str) -> str:
    """One member of a ZIP archive, extracted into the folder (a path, or a URI of a shared store) unless it is there."""
    target = f"{folder.rstrip('/')}/{Path(member).name}"
    if not _there(target):
        store, at = _target(archive)
        with store.open_input_file(at) as f, zipfile.ZipFile(f) as z, z.open(member) as source:
            _copy_new(source, target)
    return target


def read_config(path: str) -> dict:
    """A YAML or JSON configuration."""
    text = Path(path).read_text()
    if path.endswith(".json"):
        import json

        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs the package PyYAML; a JSON file needs nothing") from e
    return yaml.safe_load(text)
