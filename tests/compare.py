"""Spark result against DuckDB result: names, types, rows in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    return str(t)


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_cell(v) for v in row) for row in zip(*columns))


def assert_same(spark_table: pa.Table, duck_table: pa.Table) -> None:
    assert sorted(spark_table.column_names) == sorted(duck_table.column_names)
    kinds = {f.name: _kind(f.type) for f in spark_table.schema}
    assert kinds == {f.name: _kind(f.type) for f in duck_table.schema}
    left, right = rows_of(spark_table), rows_of(duck_table)
    assert len(left) == len(right), f"{len(left)} rows, expected {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    assert not different, f"{len(different)} rows differ, first: {different[0]}"
