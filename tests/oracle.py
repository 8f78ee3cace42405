"""Holds a query's rows against its DuckDB SQL, without regard to order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

SF = "/root/testdata/sf0.001"


def tables(sf_dir: str = SF) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value: object) -> str:
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, float):
        return f"{value:.5g}"
    return str(int(value)) if isinstance(value, int) and not isinstance(value, bool) else str(value)


def same(df, sql: str, sf_dir: str = SF) -> None:
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
    relation = tables(sf_dir).sql(sql)
    assert sorted(relation.columns) == names
    want = sorted(tuple(plain(v) for v in r) for r in relation.select(*[f'"{n}"' for n in names]).fetchall())
    assert got == want
