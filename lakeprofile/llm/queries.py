"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from . import (
    best_fit_packing, conversation_repair, language_fusion, length_histogram, line_rules, merkle_manifest, nbsvm, pii, pivotal_mix, popcount_simhash, repair_tokens, secrets,
    spaced_seeds,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data and the terms that give it away, in ``documents``."""
    return pii.digest(pii.find_personal_data(table(spark, folder, "documents")))


def op2_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of the line rules on ``documents``."""
    return line_rules.measure_lines(table(spark, folder, "documents")).select(*line_rules.COLUMNS)


def op3_nbsvm(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of ``documents``, learned from ``labels``."""
    return nbsvm.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_popcount_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of ``documents``."""
    return popcount_simhash.digest(popcount_simhash.near_duplicates(table(spark, folder, "documents")))


def op5_repair_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` written as token files and read back."""
    path = work_path(spark, "tokens")
    repair_tokens.write_tokens(table(spark, folder, "documents"), path)
    return repair_tokens.read_tokens(spark, path)


def op6_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Verified overlaps of ``documents`` with ``benchmark``."""
    return spaced_seeds.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("_key")


def op7_length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Exact histogram of the encoded lengths of ``documents``, with sums for every context limit."""
    return length_histogram.length_histogram(table(spark, folder, "documents"))


def op8_pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken from each of ``documents`` by the mix."""
    return pivotal_mix.digest(pivotal_mix.drawn(table(spark, folder, "documents")))


def op9_language_fusion(spark: SparkSession, folder: str) -> DataFrame:
    """Language of ``documents`` and of ``pages``, as one corpus; a page counts as document ``-1 - page_id``."""
    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    languages, model = language_fusion.train(language_fusion.labelled(docs))
    no_page = F.lit(None).cast("long").alias("page_id")
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), no_page)
    page = F.struct((-1 - F.col("page_id")).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"))
    rows = language_fusion.from_documents(docs, own).unionByName(language_fusion.from_pages(pages, page))
    found = language_fusion.identify(rows, languages, model)
    return found.select("key.doc_id", "key.page_id", "language", "posterior", "kept")


def op10_secret_linking(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets and linked parts of credentials in ``documents``."""
    return secrets.digest(secrets.find_secrets(table(spark, folder, "documents")))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Merkle leaf, roots and proof of ``documents``, and which rows of a damaged copy still verify."""
    return merkle_manifest.digest(table(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of damaged ``conversations``."""
    return conversation_repair.digest(table(spark, folder, "conversations"))


def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` packed into sequences of 4096 tokens, read back from the files."""
    path = work_path(spark, "packed")
    best_fit_packing.pack(table(spark, folder, "documents"), path)
    return best_fit_packing.digest(best_fit_packing.read_pieces(spark, path))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_pii, op2_line_rules, op3_nbsvm, op4_popcount_simhash, op5_repair_tokens, op6_spaced_seeds, op7_length_histogram,
        op8_pivotal_mix, op9_language_fusion, op10_secret_linking,
        op11_merkle_manifest, op12_conversation_repair, op13_best_fit_packing,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run

#: Texts with positions, digests, models, draws and tokens have no plain SQL; those are tested against brute force.
ORACLES: dict[str, str] = {"op2_line_rules": line_rules.oracle(), "op11_merkle_manifest": merkle_manifest.oracle()}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
