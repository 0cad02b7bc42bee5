"""From raw documents to token files: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeprofile.llm import language_fusion, pivotal_mix, popcount_simhash, repair_tokens, spaced_seeds
from lakeprofile.llm.common import table
from lakeprofile.session import work_path


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return language_fusion.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link."""
    return popcount_simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return spaced_seeds.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return pivotal_mix.mix(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Position, length and checksum of every document in the token files."""
    path = work_path(spark, "pipeline-tokens")
    repair_tokens.write_tokens(docs, path)
    return repair_tokens.read_tokens(spark, path)


STAGES = [
    ("language_id", identify_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

#: Trained models, 64-bit digests and tokens are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
