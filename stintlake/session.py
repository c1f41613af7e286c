"""Session settings and the shared staging folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Static: only a new session can have it. Without it every column expression built
# in Python looks up its place in the source, which takes longer than small queries.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(name: str = "stintlake", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on in a session somebody else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_RUN: dict[str, str] = {}  # folder of the run that is open, by application


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[str]:
    """A job whose staged tables are removed at its end.

    Everything staged inside goes to a folder of the run. What the job returns
    must have been written or collected before the block ends. Outside of such a
    block staged tables stay until the application's owner removes them.
    """
    app = spark.sparkContext.applicationId
    if app in _RUN:
        raise RuntimeError("a run is open already")
    _RUN[app] = os.path.join(staging_dir(spark), f"run-{uuid.uuid4().hex}")
    try:
        yield _RUN[app]
    finally:
        _drop(spark, _RUN.pop(app))


def staging_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or that of the open run in it.

    Only a local session may go without the setting; it gets a folder of its own.
    """
    if spark.sparkContext.applicationId in _RUN:
        return _RUN[spark.sparkContext.applicationId]
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if shared:
        return shared
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="stintlake-"))
    return context.getCheckpointDir()


def stage(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table that outlives lost executors and, unlike a
    checkpointed RDD, still prunes columns and pushes filters down. ``options`` go to
    the Parquet writer.
    """
    spark = df.sparkSession
    path = os.path.join(staging_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
