"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from threadsift.llm import (
    alignment,
    decontaminate,
    html_text,
    jaccard,
    language,
    licenses,
    line_dedup,
    manifest,
    oracles,
    packing,
    quality,
    substring_dedup,
    suffix_dedup,
    topk,
)
from threadsift.llm.common import table
from threadsift.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(job: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: job(configure(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return job

    return register


@query("op1_quality_scores")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.scores(documents, quality.fit_on_learning_part(documents, table(spark, sf_dir, "labels")))


@query("op2_top_k", oracles.TOP_K)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query("op3_decontamination", decontaminate.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_main_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query("op5_jaccard_join", oracles.JACCARD)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents"))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


@query("op8_substring_dedup", oracles.SUBSTRINGS)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.document_paths())


@query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query("op11_tokenizer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(table(spark, sf_dir, "documents"))


@query("op12_merkle_manifest", manifest.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.digests(table(spark, sf_dir, "documents"))


@query("op13_line_dedup", line_dedup.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
