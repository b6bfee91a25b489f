"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as registry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A DuckDB connection with a view for each given table."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value: object) -> object:
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, pd.Timestamp):
        return str(value.date()) if value == value.normalize() else str(value)
    if hasattr(value, "item"):
        return _cell(value.item())
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, in an order of their own."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """None when the query and its SQL agree, else what differs."""
    df = registry.queries()[name](spark, sf_dir)
    got = [tuple(row) for row in df.collect()]
    relation = con.sql(registry.oracle_sql()[name])
    wanted, columns = relation.fetchall(), relation.columns
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    if len(got) != len(wanted):
        return f"{len(got)} rows, not {len(wanted)}"
    pairs = zip(canonical(df.columns, got), canonical(columns, wanted))
    different = [(a, b) for a, b in pairs if a != b]
    return f"{len(different)} rows differ, such as {different[0]}" if different else None


def main() -> None:
    from conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(registry.queries())
    spark, con = make_session(), connect(sf_dir)
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)


if __name__ == "__main__":
    main()
