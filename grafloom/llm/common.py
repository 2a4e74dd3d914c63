"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.scratch import discard, materialise, scratch_path, shared_dir

__all__ = ["LOWER", "UPPER", "WORD", "ascii_lower", "bare", "discard", "fresh", "load", "materialise", "scratch_path", "shared_dir", "words"]

#: Words everywhere in this subpackage: runs of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def bare(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that further columns of the input, whatever their names, can't clash."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be none of df's columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
