"""A small side is broadcast by its bytes; the rows are the same beyond the threshold."""

from pyspark.sql import functions as F

from stintlake.functions.joins import join_small


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_broadcast_only_below_the_threshold(spark):
    left = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = join_small(left, right, ["k"])
    assert "BroadcastHashJoin" in _plan(small)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16")
    try:
        large = join_small(left, right, ["k"])
        assert "BroadcastHashJoin" not in _plan(large)
        assert small.count() == 1000 and small.exceptAll(large).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
