"""From raw documents to packed training sequences: language ID, quality rules, near-dedup, decontamination, packing.

Every stage takes a table with the columns of ``documents``, which may hold nulls anywhere, texts of any length, repeated rows
and further columns of any names, and may be empty; an empty table gives an empty one.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stintlake.llm import decontaminate, language_id, packing, quality, simhash
from stintlake.llm.common import bpe_path, table
from stintlake.session import staging_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Null and empty texts and those without a letter go; repeats share a fate."""
    return language_id.keep_identified(docs)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. Null and empty texts go, as too short; repeats share a fate."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the smallest id.

    Null and empty texts are near copies of one another. Of rows with one id one stays; rows without an id all stay.
    """
    return simhash.keep_one(docs, shingle=3, radius=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts stay; repeats share a fate."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their token ids. A null or empty text is its closing id alone."""
    return packing.pack(docs, bpe_path(), length=2048)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", with_language),
    ("quality_rules", of_quality),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Models, hashes and a tokenizer are beyond SQL; ``tests/llm/test_pipeline.py`` holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder and read again by the next.

    What a stage has written is removed when the next one is; the last one's files are what is returned. A table without
    documents gives no pieces.
    """
    folder = os.path.join(staging_dir(spark), f"corpus-{uuid.uuid4().hex}")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{number}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            old = spark._jvm.org.apache.hadoop.fs.Path(before)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        before = path
    return docs
