"""Run catalog queries and their SQL side by side: ``python tests/compare.py folder [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{folder}/{file}'")
    return con


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order, values as comparable text."""
    frame = frame[sorted(frame.columns)]
    text = pd.DataFrame({c: frame[c].map(_text) for c in frame.columns})
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def _text(value: object) -> str:
    if value is None or value is pd.NA or value is pd.NaT or value != value:
        return "null"
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value)).lower()
    if isinstance(value, float) or type(value).__name__.startswith("float"):
        return repr(float(value) + 0.0)
    if isinstance(value, int) or type(value).__name__.startswith(("int", "uint")):
        return repr(int(value))
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return str(value)


def compare(spark, con, folder: str, name: str, query, sql: str) -> str:
    """Empty if equal, else the first differences."""
    ours = query(spark, folder).toPandas()
    theirs = con.execute(sql).fetch_df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for column in ours.columns:  # integers with nulls come as floats from either side
        kinds = {ours[column].dtype.kind, theirs[column].dtype.kind}
        if kinds == {"i", "f"}:
            ours[column] = ours[column].astype("float64")
            theirs[column] = theirs[column].astype("float64")
    a, b = normalised(ours), normalised(theirs)
    differing = (a != b).any(axis=1)
    if differing.any():
        return f"{differing.sum()} rows differ\n{a[differing].head(3)}\n{b[differing].head(3)}"
    return ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tripwright.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session("compare"), connect(folder)
    sqls, failed = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.monotonic()
        try:
            problem = compare(spark, con, folder, name, query, sqls[name])
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.monotonic() - started:.1f}s {problem}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
