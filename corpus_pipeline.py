"""A training corpus from raw documents: five stages, each written as Parquet and read by the next.

All stages take whole texts of any length. A null text counts as empty, a null id as an id of its own, a null source as
one source; further columns are kept by all stages but the last; an empty table gives an empty table. What each
stage makes of such rows, of ties and of repeated rows is said with the stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deskmart.llm import bag_minhash, feistel_shards, mixing, qda, string_tiling
from deskmart.session import new_folder
from verification.scratch import ensure_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant does not reject. Empty texts are scored as texts without words; equal
    texts stay or go together; a score at the threshold stays."""
    return qda.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the least doc_id, null first. Texts without words are one group;
    of repeated rows one stays."""
    return bag_minhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold most of a benchmark item. Empty texts stay; items of fewer than five words match nothing;
    a coverage at the limit counts as held."""
    return string_tiling.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; documents of small sources more often, up to the limit. Empty texts cost no tokens
    and are shown as often as their source; repeated rows are shown each."""
    return mixing.mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix, repeated rows included; rows of equal id and text are numbered as one run."""
    return feistel_shards.assign_shards(docs, 16)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("sharding", sharding),
]

# A trained classifier and random signatures cannot be expressed in SQL
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` taken through all stages."""
    ensure_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
