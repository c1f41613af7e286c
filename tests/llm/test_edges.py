"""Every operator on awkward and on empty tables: a result for each row, and no other."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stintlake.llm import chat, decontaminate, html_blocks, language_id, packing, quality, seekable_warc, simhash, token_counts, toxicity
from stintlake.llm.common import bpe_path, piece_path


def _items(docs):
    return docs.sparkSession.createDataFrame(
        [(1, "the lazy dog are here to stay"), (2, None), (None, "the quick brown fox and the lazy"), (3, "")], "item_id long, text string"
    )


def _labels(docs):
    return docs.sparkSession.createDataFrame([(1, 1), (3, 0), (4, None), (None, 1), (5, 0), (8, 1), (99, 1), (1, 0)], "doc_id long, toxic int")


def _pages(docs):
    return docs.select("*", F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))


ROW_FOR_ROW = {
    "warc": lambda d: seekable_warc.round_trip(_pages(d)).withColumnRenamed("page_id", "doc_id"),
    "html": lambda d: html_blocks.extract(_pages(d)).withColumnRenamed("page_id", "doc_id"),
    "language": language_id.identify,
    "decontaminate": lambda d: decontaminate.contamination(d, _items(d)),
    "quality": quality.judge,
    "simhash": simhash.near_duplicates,
    "toxicity": lambda d: toxicity.toxicity(d, _labels(d)),
    "tokens": lambda d: token_counts.token_counts(d, piece_path()),
    "chat": lambda d: chat.digests(
        chat.formatted(chat.canonical(d.selectExpr("doc_id", "text AS prompt", "lang AS response"), "doc_id"))
    ).withColumnRenamed("id", "doc_id"),
}


@pytest.mark.parametrize("name", ROW_FOR_ROW)
def test_a_row_for_every_row(messy, nothing, name):
    found = ROW_FOR_ROW[name](messy)
    assert Counter(r.doc_id for r in found.select("doc_id").collect()) == Counter(r.doc_id for r in messy.select("doc_id").collect())
    assert found.schema == ROW_FOR_ROW[name](nothing).schema
    assert ROW_FOR_ROW[name](nothing).collect() == []


def test_packing_covers_every_row(messy, nothing):
    pieces = packing.pack(messy, bpe_path(), length=512).collect()
    assert sum(p.length for p in pieces if p.start == 0 and p.doc_tokens == 1) == 2  # null and empty texts
    assert sum(p.start == 0 for p in pieces) == messy.count()
    assert packing.pack(nothing, bpe_path()).collect() == []


def test_pipeline_stages(spark, messy, nothing, tmp_path):
    folder = str(tmp_path)
    _items(messy).write.parquet(os.path.join(folder, "benchmark.parquet"))
    docs = messy.select(nothing.columns)
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs, nothing, messy):
            kept = stage(spark, frame, folder)
            assert kept.count() <= 10_000
            if name != "packing":
                assert kept.columns == frame.columns


def test_short_items_and_empty_benchmark(spark, messy):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(messy, none).collect())
    short = spark.createDataFrame([(1, "the"), (2, "12345 ***")], "item_id long, text string")
    met = {r.doc_id: r.item_ids for r in decontaminate.contamination(messy, short).collect() if r.contaminated}
    assert met == {6: [2]}


def test_labels_without_both_kinds(spark, messy):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity(messy, labels).collect())
