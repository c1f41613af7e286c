"""An index of Parquet files out of their footers: sizes, columns, missing values and ranges, before any row is read."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOOTER = (
    "source string, path string, file string, length long, n_rows long, row_groups int, types map<string,string>, "
    "nulls map<string,long>, low map<string,double>, high map<string,double>, reason string"
)


def opened(path: str):
    """The file at ``path`` for reads at any place; nothing is read yet. ``ValueError`` for stores that are not known."""
    import pyarrow as pa
    import pyarrow.fs as fs

    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(path[len("file:") :].replace("//", "/", 1) if parts.scheme else path)
    try:
        store, inside = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as unknown:
        raise ValueError(f"no store for {path}") from unknown
    return store.open_input_file(inside)


def known_store(path: str) -> bool:
    """Whether files below ``path`` can be read in parts by ``opened``."""
    return urlsplit(path).scheme in ("", "file", "s3", "s3a", "gs", "gcs")


def _footer(path: str) -> tuple:
    """What the last bytes of a file say; the reason, and nothing else, where they are no footer."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    try:
        with opened(path) as file:
            meta = pq.read_metadata(file)
            types = {f.name: str(f.type) for f in meta.schema.to_arrow_schema()}
            nulls: dict[str, int | None] = dict.fromkeys(types, 0)
            low: dict[str, float] = {}
            high: dict[str, float] = {}
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for c in range(group.num_columns):
                    column = group.column(c)
                    name, stats = column.path_in_schema, column.statistics
                    if name not in nulls:  # a part of a nested column
                        continue
                    known = stats is not None and stats.has_null_count and nulls[name] is not None
                    nulls[name] = nulls[name] + stats.null_count if known else None
                    if stats is not None and stats.has_min_max and isinstance(stats.min, (int, float)):
                        low[name] = min(low.get(name, float(stats.min)), float(stats.min))
                        high[name] = max(high.get(name, float(stats.max)), float(stats.max))
    except (OSError, pa.ArrowException):  # cut off, no such format, gone or not allowed
        return None, None, None, None, None, None, "unreadable"
    reason = None if meta.num_rows else "empty"
    return meta.num_rows, meta.num_row_groups, types, nulls, low, high, reason


def footers(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per file of ``files`` (``source, path, file, length``) with what its footer says.

    Tasks read the end of each file and nothing else. ``nulls`` is null for a column without counts; ``low`` and ``high``
    hold the numeric columns with ranges. ``reason`` is ``unreadable`` without a footer, ``empty`` without rows. ``file`` is
    the key: the full path as Spark writes it in a row's metadata.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(*row, *_footer(unquote(row[2]))) for row in batch.itertuples(index=False, name=None)]
            names = [c.split()[0] for c in FOOTER.split(", ")]
            table = pd.DataFrame(found, columns=names, dtype=object)
            yield table.astype({"n_rows": "Int64", "row_groups": "Int32", "length": "Int64"})

    # many small reads that wait for a store: more tasks than the listing's bytes would give
    spread = files.select("source", "path", "file", "length").repartition(tasks or files.sparkSession.sparkContext.defaultParallelism * 4)
    return spread.mapInPandas(read, FOOTER)


def missing_pct(columns: list[str]) -> Column:
    """Missing cells in percent over ``columns``, a column that a file lacks being missing in every row; null if not counted."""
    cells = [
        F.when(F.map_contains_key("types", F.lit(c)), F.element_at("nulls", F.lit(c))).otherwise(F.col("n_rows")) for c in columns
    ]
    return F.try_divide(sum(cells, F.lit(0).cast("long")) * 100.0, F.col("n_rows") * len(columns))


def may_hold(column: str, low, high) -> Column:
    """Whether a file may hold a value of ``column`` between ``low`` and ``high``, by its range."""
    least, most = F.element_at("low", F.lit(column)), F.element_at("high", F.lit(column))
    return F.coalesce((least <= high) & (most >= low), F.map_contains_key("types", F.lit(column)))
