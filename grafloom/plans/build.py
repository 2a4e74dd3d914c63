"""A graph built from a declared configuration: sources, entities, links."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.operators import entities
from grafloom.operators import triples as T
from grafloom.sources import external, formats, ntriples


def rows_for(spark: SparkSession, config: Mapping, key: str, tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """The rows of a key from every source that has it: a given frame, a query, a file. All columns as strings, missing ones null."""
    found = []
    if key in tables:
        found.append(tables[key])
    if (query := config.get("queries", {}).get(key)) and config.get("database"):
        found.append(external.jdbc(spark, query, **config["database"]))
    if spec := config.get("files", {}).get(key):
        found.append(formats.read_rows(spark, spec["path"], spec.get("sep"), spec.get("columns"), spec.get("rename")))
    out = None
    for df in found:
        df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def build(spark: SparkSession, config: Mapping, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The triples of a configuration, as a set.

    entities: {key: {class, id, name, extra}}; links: {key: {from, to, predicate}}; schema: an N-Triples path.
    """
    ns, parts = config["namespace"], []
    ns = ns if ns.endswith(("#", "/")) else ns + "#"
    if schema := config.get("schema"):
        parts.append(ntriples.read(spark, schema))
    for key, e in config.get("entities", {}).items():
        if (rows := rows_for(spark, config, key, tables or {})) is not None:
            parts.append(entities.entity_triples(rows, e["id"], e["name"], e["class"], ns, e.get("extra")))
    for key, link in config.get("links", {}).items():
        if (rows := rows_for(spark, config, key, tables or {})) is not None:
            parts.append(entities.link_triples(rows, link["from"], link["to"], link["predicate"], ns))
    return T.triples(*parts) if parts else T.from_rows(spark, [])


def build_and_export(spark: SparkSession, config_path: str, out: str, tables: Mapping[str, DataFrame] | None = None) -> dict:
    """Builds from a file, writes N-Triples, and returns what was written."""
    t = build(spark, external.read_config(config_path), tables)
    ntriples.write(t, out)
    return {"triples": ntriples.read(spark, out).count(), "out_path": out, "format": "nt"}


def main(args: list[str]) -> None:
    """python -m grafloom.plans.build CONFIG OUT"""
    import json

    spark = SparkSession.builder.appName("grafloom-build").getOrCreate()
    print(json.dumps(build_and_export(spark, args[0], args[1])))


if __name__ == "__main__":
    import sys

    main(sys.argv[1:])
