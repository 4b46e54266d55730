"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the docs of the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from threadsift.llm import decontaminate, jaccard, packing, quality, suffix_dedup
from threadsift.llm.common import table
from threadsift.session import configure, shared_folder


def few_rows_at_once(spark: SparkSession) -> None:
    """Python workers of all stages take small batches, also while a stage's result is written: they share
    an executor's memory with its heap. Changes no rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    few_rows_at_once(spark)
    model = quality.fit_on_learning_part(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the first."""
    few_rows_at_once(spark)
    return jaccard.representatives(docs)


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier in the corpus; n_chars follows the text."""
    few_rows_at_once(spark)
    return suffix_dedup.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    few_rows_at_once(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their ids."""
    few_rows_at_once(spark)
    return packing.pieces(docs, keep_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_bytes),
    ("benchmark decontamination", decontamination),
    ("packing", packed),
]

#: SQL cannot express compression or tokenization; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's rows are written to the shared folder."""
    configure(spark)
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
