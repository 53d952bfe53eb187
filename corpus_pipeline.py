"""Corpus pipeline: the stages that turn ``documents`` into training shards.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes as Parquet in the shared folder
and reads again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm.common import read_table, written
from panelforge.llm.decontaminate import drop_contaminated
from panelforge.llm.mixing import mixture
from panelforge.llm.near_dedup import drop_near_duplicates
from panelforge.llm.sharding import shard
from panelforge.llm.toxicity import drop_toxic

SHARDS = 40
#: Documents at a similarity of at least so many per cent are near duplicates (op2's 85 binds that query alone).
NEAR_PERCENT = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id stays."""
    return drop_near_duplicates(docs, NEAR_PERCENT, 5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and the parts of documents, as the mix takes them."""
    return mixture(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard and the place in it."""
    return shard(docs, SHARDS)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]
#: The learned score, the sketches and the alignments have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
