"""Run every registered query and its SQL twin side by side: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return value if isinstance(value, (int, float, bool, str)) else str(value)


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    listed = [tuple(_cell(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(listed, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else "") for v in r))


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} vs {len(sql_frame)}"
    left, right = rows(spark_frame), rows(sql_frame)
    for a, b in zip(left, right):
        if a != b:
            return f"first difference\n  spark {a}\n  sql   {b}"
    kinds = [
        (c, str(spark_frame[c].dtype), str(sql_frame[c].dtype))
        for c in spark_frame.columns
        if len(spark_frame) and not spark_frame[c].isna().any() and str(spark_frame[c].dtype) != str(sql_frame[c].dtype)
        and "datetime" not in str(sql_frame[c].dtype)
    ]
    return f"types {kinds}" if kinds else None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tidewatch.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = local_session(cores="8")
    connection = connect(folder)
    twins = oracle_sql()
    bad = []
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            frame = run(spark, folder).toPandas()
            took = time.time() - started
            problem = None
            sql_took = 0.0
            if name in twins:
                started = time.time()
                sql_frame = connection.execute(twins[name]).df()
                sql_took = time.time() - started
                problem = differences(frame, sql_frame)
        except Exception as error:  # noqa: BLE001
            took, sql_took, frame, problem = time.time() - started, 0.0, [], f"{type(error).__name__}: {str(error)[:600]}"
        status = "ok" if problem is None else "DIFF"
        print(f"{status:5} {name:28} rows={len(frame):7} spark={took:6.2f}s sql={sql_took:6.2f}s {'' if name in twins else '(no sql)'}", flush=True)
        if problem:
            print("     ", problem, flush=True)
            bad.append(name)
    print("bad:", bad)


if __name__ == "__main__":
    main()
