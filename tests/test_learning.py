"""Learning data in buckets, and a model that is saved, loaded and asked."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stintlake.catalog.roles import role
from stintlake.operators import features as X
from stintlake.operators import mldata as M
from stintlake.plans import lap_dataset, learning_store, tyre_model
from stintlake.sources import sinks as W
from stintlake.sources.bucketed import read_bucketed, write_bucketed

SF = "/root/testdata/sf0.001"
COLUMNS = ["LapTime", "TyreLife", "Position"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_spare_the_exchange(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 97).alias("car"), F.col("id").alias("lap"), (F.col("id") * 0.5).alias("v"))
    path = f"{tmp_path}/t"
    write_bucketed(df, path, ["car"], ["lap"], buckets=4)
    back = read_bucketed(spark, path)
    assert back.exceptAll(df).count() == 0 and back.count() == 5000
    summed = back.groupBy("car").agg(F.sum("v"))
    joined = back.join(read_bucketed(spark, path).select("car", F.col("lap").alias("other")), "car")
    for done in (summed, joined.hint("merge")):
        assert "Exchange hashpartitioning" not in _plan(done)


def test_stored_data_is_what_was_prepared(spark, tmp_path):
    entry.queries()
    prepared = lap_dataset.prepare(X.compound_strategy(role(spark, SF, "targeted")))
    learning_store.save(prepared, str(tmp_path), buckets=4)
    stored = learning_store.load(spark, str(tmp_path))
    assert (stored.features, stored.scaled, stored.length) == (prepared.features, prepared.scaled, 10)
    sequences = prepared.sequences().withColumn("X", F.col("X").cast("string"))
    kept = []
    for split in learning_store.SPLITS:
        want = prepared.rows.where(F.col("split") == split).drop("split")
        assert stored.rows(split).exceptAll(want).count() == 0 and stored.rows(split).count() == want.count()
        assert "Exchange hashpartitioning" not in _plan(stored.made_sequences(split))
        kept.append(stored.sequences(split).withColumn("X", F.col("X").cast("string")))
    everything = kept[0].unionByName(kept[1]).unionByName(kept[2])
    assert everything.count() == sequences.count() and everything.exceptAll(sequences).count() == 0
    raw = M.frequency_encode(M.split_years(X.compound_strategy(role(spark, SF, "targeted")))).where("split = 'test'")
    again = stored.applied(raw).select("GlobalLapID", *COLUMNS[:2])
    assert again.exceptAll(stored.rows("test").select("GlobalLapID", *COLUMNS[:2])).count() == 0


@pytest.fixture(scope="module")
def heads(spark, tmp_path_factory):
    entry.queries()
    rows = M.split_years(role(spark, SF, "targeted"))
    model = tyre_model.train_heads(rows.where("split = 'train'"), COLUMNS, iterations=50)
    path = str(tmp_path_factory.mktemp("model") / "m")
    model.save(path)
    return rows, model, path


def test_saved_pipeline_says_the_same(spark, heads):
    rows, model, path = heads
    a, b = (tyre_model.score_heads(m, rows).select("GlobalLapID", F.round("prob", 9).alias("p"), "type_pred") for m in (model, PipelineModel.load(path)))
    assert a.count() == rows.count() and a.exceptAll(b).count() == 0
    # a compound and a car that were never seen, and rows without values, are scored too
    odd = rows.limit(5).withColumns({"Compound": F.lit("NEW"), "Driver": F.lit(None).cast("string"), "LapTime": F.lit(None).cast("double")})
    assert tyre_model.score_heads(PipelineModel.load(path), odd).where("prob between 0 and 1").count() == 5


def test_requests_read_their_seasons_only(spark, heads, tmp_path):
    rows, model, path = heads
    every = role(spark, SF, "targeted")
    W.write_consolidated(every, f"{tmp_path}/laps")
    laps = spark.read.parquet(f"{tmp_path}/laps")
    asked = [(1, 2024, "D6", None), (2, 2024, None, "NATION_5"), (3, 2023, "D5", "NATION_3"), (4, 2024, "D6", "nowhere"), (5, 2030, None, None), (6, 2024, "D6", None), (7, None, "D6", None)]
    requests = spark.createDataFrame(asked, "request_id int, Year int, Driver string, Location string")
    found = tyre_model.score_requests(PipelineModel.load(path), laps, requests)
    assert "dynamicpruning" in _plan(found)
    whole = {r.GlobalLapID: r for r in tyre_model.score_heads(model, every).collect()}
    got = {(r.request_id, r.GlobalLapID): (round(r.prob, 9), r.type_pred) for r in found.collect()}
    want = {
        (i, k): (round(r.prob, 9), r.type_pred)
        for i, year, driver, place in asked
        for k, r in whole.items()
        if year == r.Year and (driver is None or driver == r.Driver) and (place is None or place == r.Location)
    }
    assert got == want and {i for i, _ in want} >= {1, 2, 6}
