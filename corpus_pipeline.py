"""A corpus pipeline of five stages over the table documents.

Each stage is (spark, docs, sf_dir) -> DataFrame; its rows are written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grafloom.llm import decontaminate, langid, mixing, sharding, simhash
from grafloom.llm.common import discard, load, materialise
from grafloom.llm.queries import N_SHARDS, TARGET_WEIGHTS

#: Documents whose calibrated probability of the predicted language is below this are rejected: those of no language known, as short ones of a known language seldom score so low.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that have a language: letters, and a prediction that is not a mere guess.

    Null, empty and letterless texts go. Texts of any length are read whole; repeated rows are judged alike; an empty
    table gives no rows; null ids are judged as others, only not learned from.
    """
    model = langid.train(docs.where(~langid.held_out()))
    judged = langid.identify(docs, model)
    return judged.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies: that of the smallest id, of equal ids that of the smallest fingerprint.

    Rows are judged by their own whole text, so an id with two texts may stay twice; exact repeats stay once; null ids
    come last. Null and wordless texts are one class. An empty table gives no rows.
    """
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain an item of the benchmark.

    Each row is judged by its own whole text, also with a null id; null and wordless documents stay, null and wordless
    items match nothing; repeated rows are judged alike; an empty table on either side drops nothing.
    """
    return decontaminate.without_items(docs, load(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thins the domains to the target weights: documents of no copy go; others stay once, as repeats would undo the second stage.

    Whole texts are judged; null or wordless ones by the statistics that are left. Rows of an equal id and text share
    their fate, null ids are thinned by their texts. Without labels, or documents, nothing is dropped.
    """
    return mixing.thin(docs, mixing.label_domains(load(spark, sf_dir, "labels")), TARGET_WEIGHTS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds size, text_crc32, shard and slot to all rows; null texts have size 16, null ids come first, repeated rows have a slot each."""
    return sharding.assign(docs, N_SHARDS)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixture", mixture), ("sharding", shard)]

#: Learned models, fingerprints and fitted rates have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        before, docs = docs, materialise(stage(spark, docs, sf_dir), name)
        if n:
            discard(before)
    return docs
