"""Run registered queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _kind(dtype) -> str:
    return {"i": "int", "u": "int", "f": "float", "b": "bool", "M": "time"}.get(dtype.kind, "object")


def _plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, (np.generic,)):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    return v


def canonical(pdf: pd.DataFrame) -> list[str]:
    pdf = pdf[sorted(pdf.columns)]
    return sorted(repr(tuple(_plain(v) for v in row)) for row in pdf.itertuples(index=False, name=None))


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    got = pd.DataFrame([r.asDict() for r in spark_df.collect()], columns=spark_df.columns)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    rows = rel.fetchall()
    want = pd.DataFrame(rows, columns=names)
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    spark_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    duck_types = {d[0]: str(d[1]).lower() for d in rel.description}
    bad = [
        (c, spark_types[c], duck_types[c])
        for c in names
        if not _compatible(spark_types[c], duck_types[c])
    ]
    if bad:
        return f"types {bad}"
    a, b = canonical(got), canonical(want)
    if a != b:
        sa, sb = set(a), set(b)
        return f"{len(sa - sb)} rows differ; spark {sorted(sa - sb)[:2]} sql {sorted(sb - sa)[:2]}"
    return None if len(got) else "EMPTY"


def _compatible(s: str, d: str) -> bool:
    exact = {
        "int": ("integer", "int32"),
        "bigint": ("bigint", "int64"),
        "double": ("double",),
        "float": ("float",),
        "string": ("varchar", "string"),
        "boolean": ("boolean", "bool"),
        "timestamp": ("timestamp",),
        "timestamp_ntz": ("timestamp",),
        "date": ("date",),
        "smallint": ("smallint",),
    }
    if s in exact:
        return any(d.startswith(x) for x in exact[s]) and not (s == "int" and d == "bigint")
    return True


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from stintlake.session import build_session

    from stintlake.functions.ordered import SplitPolicy, set_default_policy

    sf = argv[0]
    if "--tight" in argv:
        # cut every group above this size, to run the cut paths on small data
        at = argv.index("--tight")
        set_default_policy(SplitPolicy(max_rows=int(argv[at + 1]), sample_every=1))
        argv = argv[:at] + argv[at + 2 :]
    wanted = argv[1:]
    spark = build_session(
        "compare",
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                diff = difference(df, con, oracles[name])
            else:
                n = len(df.collect())
                diff = None if n else "EMPTY"
        except Exception as e:  # noqa: BLE001
            diff = "ERROR " + str(e)[:600]
        mark = "ok " if diff is None else "BAD"
        bad += diff is not None
        print(f"{mark} {name} {time.time() - t:.1f}s {'' if name in oracles else '(rows only)'} {diff or ''}", flush=True)
    print("bad:", bad, "of", len(queries))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
