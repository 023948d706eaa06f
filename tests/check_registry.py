"""Run registered queries against their SQL twins: ``python tests/check_registry.py [sf] [name ...]``."""

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, every cell as text, rows sorted."""

    def cell(v):
        if v is None or (not isinstance(v, (list, dict, np.ndarray)) and pd.isna(v)):
            return "<null>"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (int, np.integer)):
            return str(int(v))
        if isinstance(v, (float, np.floating)):
            return f"{float(v):.6f}"
        return str(v)

    frame = frame[sorted(frame.columns)].map(cell)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def kind(dtype: str) -> str:
    name = str(dtype).lower()
    for group, names in {
        "int": ("int", "bigint", "long", "integer"), "float": ("double", "float"), "text": ("string", "varchar"), "bool": ("boolean",),
    }.items():
        if name in names:
            return {"int": name.replace("integer", "int").replace("long", "bigint")}.get(group, group)
    return name


def compare(spark, con, name, q, sf_dir) -> str:
    df = q.build(spark, sf_dir)
    rows = df.collect()
    if q.sql is None:
        return f"rows only ({len(rows)})"
    got = pd.DataFrame([r.asDict() for r in rows], columns=df.columns, dtype=object)
    result = con.sql(q.sql)
    types = {c: kind(t) for c, t in zip(result.columns, result.types)}
    want = pd.DataFrame(result.fetchall(), columns=result.columns, dtype=object)
    if sorted(got.columns) != sorted(want.columns):
        return f"COLUMNS {sorted(got.columns)} vs {sorted(want.columns)}"
    spark_types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    odd = {c: (spark_types[c], types[c]) for c in types if spark_types[c] != types[c]}
    if odd:
        return f"TYPES {odd}"
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return f"ROWS {len(a)} vs {len(b)}"
    if not a.equals(b):
        bad = (a != b).any(axis=1)
        return f"VALUES {bad.sum()} of {len(a)} rows\n{a[bad].head(3).to_string(max_colwidth=90)}\n{b[bad].head(3).to_string(max_colwidth=90)}"
    return f"ok ({len(a)})"


def main():
    from broadsheet import build_session
    from broadsheet.registry import QUERIES

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("0") else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "check", master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, q in QUERIES.items():
        if args and name not in args:
            continue
        begin = time.time()
        try:
            outcome = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # noqa: BLE001
            outcome = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        failed += not outcome.startswith(("ok", "rows"))
        print(f"{name:28} {time.time() - begin:6.1f}s  {outcome}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
