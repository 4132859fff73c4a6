"""Corpus preparation: five stages over ``documents``, each on all that the one
before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``; the last returns the packed pieces. Nulls, empty and
very long texts, ties, repeated rows, empty tables and extra columns have the
results that the stages' operators define.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import decontam, packing, quality, simhash, substrings
from candlewick.session import checkpoint_root
from candlewick.sources.tables import load


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbour vote does not reject."""
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest doc_id."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated 35-word windows."""
    return substrings.drop_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontam.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in 2,048-token sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: No stage but the decontamination can be stated in SQL; the tests compare the
#: stages with brute force.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that pass all stages. A stage's table is
    removed once the next one is written; the last one stays, as the result reads it."""
    docs, before = load(spark, sf_dir, "documents"), None
    root = f"{checkpoint_root(spark)}/pipeline/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _remove(spark, before)
        before = path
    return docs
