"""Stages over the documents table; each reads what its predecessor kept.

toxicity drops documents that the classifier rejects, near_duplicates keeps one document of each
SimHash group (three-word shingles, three bits), decontamination drops documents that contain a benchmark item, mixing takes each
document as often as the curriculum does, in the order of training, and sharding adds curve, shard and
slot. Rows with nulls pass by the rules of each operator's module. SQL cannot express the first two
stages, so there is no oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.llm import containment, curriculum, hilbert, simhash, toxicity
from bayline.llm.common import given, prepare, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHARDS = 24


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model of the documents it gets."""
    prepare(spark)
    labels = given(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels, F.lit(True))
    return toxicity.scored(docs, model).filter(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within the radius of ``op6``."""
    prepare(spark)
    return simhash.near_dedup(docs.select(*COLUMNS)).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    items = given(spark, sf_dir, "benchmark")
    return containment.decontaminated(docs.select(*COLUMNS), items)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, in the order of training."""
    prepare(spark)
    return curriculum.arranged(curriculum.allocate(docs.select(*COLUMNS))).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with curve, shard and slot."""
    prepare(spark)
    return hilbert.shards(docs.select(*COLUMNS), SHARDS, ["source", "lang", "n_chars"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each result written to the shared scratch folder and read again."""
    docs = given(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
