"""N-Triples in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = r"^(<[^>]*>|_:\S+) (<[^>]*>) (.*) \.\s*$"


def paths(spec: str | list[str]) -> list[str]:
    """Comma-separated paths as a list."""
    return [x.strip() for x in spec.split(",") if x.strip()] if isinstance(spec, str) else list(spec)


def read_lines(spark: SparkSession, spec: str | list[str]) -> DataFrame:
    """Lines of plain or gzipped files; blank ones and comments are left out."""
    return spark.read.text(paths(spec)).where("trim(value) <> '' and value not like '#%'")


def read(spark: SparkSession, spec: str | list[str]) -> DataFrame:
    """(s, p, o) of well-formed files: the line is cut at its first two spaces and its final dot."""
    parts = F.split(F.regexp_replace("value", r"\s*\.\s*$", ""), " ", 3)
    return read_lines(spark, spec).select(F.get(parts, F.lit(0)).alias("s"), F.get(parts, F.lit(1)).alias("p"), F.get(parts, F.lit(2)).alias("o"))


def read_strict(spark: SparkSession, spec: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(triples, rejects): lines that match the grammar of a triple, and the others (value)."""
    lines = read_lines(spark, spec)
    good = F.col("value").rlike(LINE)
    return lines.where(good).select(*[F.regexp_extract("value", LINE, i).alias(c) for i, c in enumerate("spo", 1)]), lines.where(~good)


def lines(t: DataFrame) -> DataFrame:
    return t.select(F.concat_ws(" ", "s", "p", "o", F.lit(".")).alias("value"))


def write(t: DataFrame, path: str, compression: str = "none") -> None:
    """The distinct triples in the order of their lines, over range partitions."""
    lines(t).distinct().sort("value").write.mode("overwrite").option("compression", compression).text(path)
