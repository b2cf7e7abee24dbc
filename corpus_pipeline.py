"""From raw documents to a mixed and sharded training corpus, each stage one operator of shroud.llm.

Every stage takes all rows that its predecessor kept and returns the columns of ``documents`` (the
last one adds the placement); ``run`` writes each result as Parquet to the shared folder and reads
it back, so a lost executor costs a part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shroud.llm import decontaminate, mixing, neardup, rules, sharding
from shroud.llm.common import Scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled thresholds keep."""
    return rules.judge(docs, table(spark, sf_dir, "labels")).filter("r_kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return neardup.one_of_each(docs, shingle=5, threshold=0.8)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark")).filter("not contaminated").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: blocks left out, taken once or taken again."""
    return mixing.taken_rows(mixing.mix(docs), docs.columns)


def shard_placement(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard."""
    return sharding.place(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mixing", source_mixing),
    ("sharding", shard_placement),
]

#: Near duplicates, edit verification and the hashes of mixing and placement have no DuckDB form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs, last = Scratch(spark), table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
        if last is not None:
            scratch.drop(last)
        last = docs
    return docs
