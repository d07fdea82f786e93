"""Run registered queries against their SQL equivalents in DuckDB and compare all rows.

Usage: python tests/compare.py FOLDER [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A DuckDB connection with the tables as views."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    """Comparable form of a cell; floats keep nine significant digits."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    """Multiset of rows with columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    expected, actual = rows_of(names, result.fetchall()), rows_of(spark_df.columns, spark_df.collect())
    if expected == actual:
        return None
    return (f"rows {sum(actual.values())} vs {sum(expected.values())}; only spark {list((actual - expected).items())[:3]}; "
            f"only sql {list((expected - actual).items())[:3]}")


def main(folder: str, names: list[str]) -> int:
    from paysift.plans import load_all
    from tests.sparks import session

    spark, con, bad = session(), connect(folder), []
    registry = load_all()
    for name, query in registry.items():
        if names and not any(name == n or query.build.__module__.endswith("." + n) for n in names):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            problem = compare(df, con, query.sql) if query.sql else (None if len(df.collect()) else "no rows")
            size = ""
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - start
        print(f"{'ok  ' if problem is None else 'FAIL'} {took:6.2f}s {'sql ' if query.sql else 'rows'} {name} {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return len(bad)


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
