"""CSV files in one folder per group of key values, on a local file system.

Spark's own writer starts a ``chmod`` process for every new folder and file there unless Hadoop's native library is installed,
which takes far longer than the files. Here Spark deals, sorts, formats and parses the rows, and its tasks write and read the
files themselves.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_ROWS = 10_000
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
_BLANK = "".join(map(chr, range(33)))


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as the operating system names it; none if Spark would put it into another store."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(hadoop_path).toUri().getPath() if store.getUri().getScheme() == "file" else None


def escaped(name: str) -> str:
    """A key's name or value as Spark writes it into the name of a folder."""
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", name)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _runs(batch: pa.RecordBatch, n_keys: int) -> Iterator[tuple[int, int]]:
    """Start and end of neighbouring rows with equal keys."""
    changed = np.zeros(max(batch.num_rows - 1, 0), bool)
    for column in batch.columns[:n_keys] if len(changed) else []:
        changed |= pc.not_equal(column.slice(0, len(changed)), column.slice(1)).to_numpy(zero_copy_only=False)
    bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
    return zip(bounds, bounds[1:]) if batch.num_rows else iter(())


def _merge(source: str, target: str) -> None:
    """Move all under ``source`` to ``target``; folders that both have are merged."""
    for entry in list(os.scandir(source)):
        goal = os.path.join(target, entry.name)
        if entry.is_dir() and os.path.isdir(goal):
            _merge(entry.path, goal)
        else:
            os.rename(entry.path, goal)


def write_folder_csv(df: DataFrame, path: str, keys: list[str], max_rows: int) -> None:
    """Replace ``path`` by a folder per group of ``keys`` with the group's other columns as CSV files of ``max_rows`` at most.

    Rows of a group should be in few tasks. A task's files lie in a folder of the attempt until all tasks are done; then those
    of the attempts that counted are moved to their places, so that a lost or repeated attempt leaves nothing behind.
    """
    spark, rest = df.sparkSession, df.drop(*keys)
    if nested := [f.name for f in rest.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]:
        raise ValueError(f"CSV has no place for nested columns: {nested}")
    names = [F.lit(name).alias(f"c{i}") for i, name in enumerate(rest.columns)]
    header = spark.range(1).select(F.to_csv(F.struct(*names))).first()[0].encode() + b"\n"
    heads, job = [escaped(k) for k in keys], uuid.uuid4().hex
    work = f"{path}/_temporary/{job}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        top, part = f"{work}/{task.taskAttemptId()}", f"part-{task.partitionId():05d}-{job}"
        out, group, folder, number, room = None, None, "", 0, 0
        for batch in batches:
            lines = batch.column(len(keys))
            for start, end in _runs(batch, len(keys)):
                values = tuple(batch.column(i)[start].as_py() for i in range(len(keys)))
                if values != group:
                    folder = "/".join([top, *(f"{h}={escaped(v)}" for h, v in zip(heads, values))])
                    os.makedirs(folder, exist_ok=True)
                    group, number, room = values, 0, 0
                while start < end:
                    if not room:
                        if out:
                            out.close()
                        out = open(f"{folder}/{part}.c{number:03d}.csv", "wb")
                        out.write(header)
                        number, room = number + 1, max_rows
                    taken = min(room, end - start)
                    out.write(b"\n".join(lines.slice(start, taken).to_pylist()) + b"\n")
                    start, room = start + taken, room - taken
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"attempt": [str(task.taskAttemptId())]})

    values = [F.col(_quoted(k)).cast("string") for k in keys]
    named = [F.when(v != "", v).otherwise(NO_VALUE).alias(f"k{i}") for i, v in enumerate(values)]
    line = F.coalesce(F.to_csv(F.struct(*map(_quoted, rest.columns))), F.lit("")).cast("binary").alias("line")
    rows = df.select(*named, line).sortWithinPartitions(*(f"k{i}" for i in range(len(keys))))
    os.makedirs(work)
    try:
        attempts = [r.attempt for r in rows.mapInArrow(run, "attempt string").collect()]
        for entry in list(os.scandir(path)):
            if entry.name != "_temporary":
                shutil.rmtree(entry.path) if entry.is_dir() else os.unlink(entry.path)
        for attempt in attempts:
            _merge(f"{work}/{attempt}", path)
    finally:
        shutil.rmtree(f"{path}/_temporary")
    open(f"{path}/_SUCCESS", "wb").close()


def _unescaped(name: str) -> str | None:
    return None if name == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files under folders, without those that Spark's readers pass over."""
    found = []
    for batch in batches:
        for top in batch.column(0).to_pylist():
            for folder, below, names in os.walk(top):
                below[:] = [n for n in below if "=" in n]
                found += [f"{folder}/{n}" for n in names if n[0] not in "_."]
                if len(found) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_pydict({"file": found})
                    found = []
    yield pa.RecordBatch.from_pydict({"file": pa.array(found, pa.string())})


def read_folder_csv(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """The rows under ``path`` as ``write_folder_csv`` leaves them; ``schema`` holds the files' columns in order and ``keys``.

    Tasks list the folders and read the files, as Spark's discovery of partitions takes time on the driver that grows with
    the square of their number. Spark parses the lines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            columns = [*zip(*groups)] if groups else [()] * len(keys)
            counted = [pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(c)), counts), pa.array(c, pa.string())) for c in columns]
            arrays = [*(c.cast(pa.string()) for c in counted), pa.array(lines, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=[*(f"k{i}" for i in range(len(keys))), "line"])

        groups, counts, lines = [], [], []
        for batch in batches:
            for name in batch.column(0).to_pylist():
                group = tuple(_unescaped(x.split("=", 1)[1]) for x in name.split("/")[-1 - len(keys) : -1])
                with open(name, encoding="utf-8", errors="replace") as file:
                    filled = (line[:-1] if line[-1] == "\n" else line for line in file if line.strip(_BLANK))
                    next(filled, None)  # the header
                    while more := list(islice(filled, BATCH_ROWS)):
                        groups.append(group)
                        counts.append(len(more))
                        lines += more
                        if len(lines) >= BATCH_ROWS:
                            yield packed()
                            groups, counts, lines = [], [], []
        yield packed()

    fields = T.StructType.fromDDL(schema)
    inside = T.StructType([f for f in fields if f.name not in keys])
    tasks = 4 * spark.sparkContext.defaultParallelism
    tops = [(e.path,) for e in os.scandir(path) if e.is_dir() and "=" in e.name]
    files = spark.createDataFrame(tops, "folder string").repartition(tasks).mapInArrow(_files, "file string").repartition(tasks)
    rows = files.mapInArrow(run, ", ".join([*(f"k{i} string" for i in range(len(keys))), "line string"]))
    rows = rows.withColumn("row", F.from_csv("line", inside.toDDL()))
    columns = {k: F.col(f"k{i}").cast(fields[k].dataType) for i, k in enumerate(keys)}
    return rows.select(*(columns.get(f.name, F.col("row")[f.name]).alias(f.name) for f in fields))
