"""References of the quality rules: junk with a label of its own makes none, and vouches for nobody."""

import random

from pyspark.sql import functions as F

from stintlake.llm import quality, queries
from tests.compare import connect, difference

DOCS = "doc_id long, text string, lang string"
SF = "/root/testdata/sf0.01"


def _prose(chance, n=400):
    return " ".join(chance.choices(quality.COMMON_WORDS["en"].split(), k=n // 4) + chance.choices("house river stone cloud garden market".split(), k=n - n // 4))


def _symbols(chance):
    return " ".join("".join(chance.choices("abcdef", k=3)) + "###$$$" for _ in range(300))


def test_junk_with_a_label_of_its_own(spark):
    chance = random.Random(5)
    clean = [(i, f"{_prose(chance)} w{i}", "en") for i in range(60)]
    junk = [(100 + i, _symbols(chance), "en") for i in range(3)]
    for others in (0, 4, 10, 28):  # up to a third of all
        own = [(200 + i, _symbols(chance), "zz") for i in range(others)]
        judged = quality.judge(spark.createDataFrame(clean + junk + own, DOCS)).collect()
        assert {r.doc_id for r in judged if r.kept} == {i for i, *_ in clean}, others


def test_rare_languages_vouch_for_their_own_documents_only(spark):
    """Prose without common words passes under its own label, and not as English, whatever the number of its kind."""
    chance = random.Random(6)
    strange = lambda: " ".join("".join(chance.choices("aeioukltnsh", k=6)) for _ in range(400))
    rows = [(i, f"{_prose(chance)} w{i}", "en") for i in range(4000)] + [(5000 + i, strange(), "fi") for i in range(12)] + [(6000 + i, strange(), "en") for i in range(3)]
    rows += [(7000, strange(), "qx"), (7001, _prose(chance), "qx"), (7002, _prose(chance), None), (7003, _symbols(chance), None)]
    kept = {r.doc_id for r in quality.judge(spark.createDataFrame(rows, DOCS).repartition(8)).where("kept and doc_id >= 5000").collect()}
    assert kept == {5000 + i for i in range(12)} | {7000, 7001, 7002}


def test_sql_says_the_same_of_rare_labels(spark, tmp_path):
    """The query's SQL on a table with rare, junk and missing labels."""
    chance = random.Random(7)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 90 == 0, "rare").when(F.col("doc_id") % 70 == 3, "few").when(F.col("doc_id") % 41 != 0, F.col("lang")))
    odd = [(100_000 + i, _symbols(chance), "zz") for i in range(11)] + [(200_000 + i, _prose(chance), "yy") for i in range(2)]
    docs.unionByName(spark.createDataFrame(odd, DOCS)).coalesce(1).write.parquet(f"{tmp_path}/d")
    con = connect(SF)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    judged = quality.judge(spark.read.parquet(f"{tmp_path}/d")).drop("class_distance", "word_distance")
    assert difference(judged, con, queries.ORACLES["op6_quality_rules"]) is None


def test_what_is_caught(spark):
    """Of the labelled documents: nearly all good ones stay, most bad ones past the guards go."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.judge(docs).join(labels, "doc_id").where("class_distance is not null or base_failed and n_words >= 60").groupBy("quality").agg(F.avg(F.col("kept").cast("int")))
    share = {r[0]: r[1] for r in rows.collect()}
    assert share[1] > 0.97 and share[0] < 0.35
