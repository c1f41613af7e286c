"""Tables written in buckets of a key, so that windows and joins on it need no exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LAYOUT = "by array<string>, sort array<string>, buckets int"


def _list(names: list[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def write_bucketed(df: DataFrame, path: str, by: list[str], sort: list[str], buckets: int = 64) -> None:
    """Rows in ``buckets`` buckets of ``by``, sorted by ``by`` and ``sort`` in each file, with the layout beside them.

    Rows of a bucket meet by the shuffle AQE plans; a key that holds a large part of the rows is spread over several tasks
    and files of its bucket.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = df.hint("rebalance", *by)
    writer = rows.write.format("parquet").mode("overwrite").option("path", f"{path}/rows").bucketBy(buckets, *by)
    writer.sortBy(*by, *sort).saveAsTable(name)
    spark = df.sparkSession
    spark.sql(f"DROP TABLE {name}")  # the files stay; readers make a table of their own
    spark.createDataFrame([(by, sort, buckets)], LAYOUT).coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The rows under ``path`` as a table whose buckets the planner knows."""
    layout = spark.read.schema(LAYOUT).parquet(f"{path}/layout").first()
    columns = spark.read.parquet(f"{path}/rows")._jdf.schema().toDDL()
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_list(layout['by'])}) "
        f"SORTED BY ({_list([*layout['by'], *layout['sort']])}) INTO {layout['buckets']} BUCKETS LOCATION '{path}/rows'"
    )
    return spark.table(name)
