"""Rows of a query against the same rows from DuckDB."""

from __future__ import annotations

import math
import os

import duckdb


def _plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, float):
        return float(f"{x:.6g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(_plain, x))
    if hasattr(x, "tolist"):
        return _plain(x.tolist())
    return str(x) if not isinstance(x, (int, bool, str)) else x


def rows(table, names):
    at = [table.column_names.index(n) for n in names]
    columns = [table.column(i).to_pylist() for i in at]
    return sorted((tuple(map(_plain, r)) for r in zip(*columns, strict=True)), key=repr)


def same(df, sql: str, sf: str) -> None:
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    reader = con.sql(sql).arrow()
    want = reader.read_all() if hasattr(reader, "read_all") else reader
    got = df.toArrow()
    assert sorted(got.column_names) == sorted(want.column_names)
    names = sorted(got.column_names)
    a, b = rows(got, names), rows(want, names)
    assert len(a) == len(b)
    close = lambda x, y: x == y or (isinstance(x, float) and isinstance(y, (int, float)) and math.isclose(x, y, rel_tol=1e-4, abs_tol=1e-9))
    assert all(len(x) == len(y) and all(map(close, x, y)) for x, y in zip(a, b, strict=True)), [p for p in zip(a, b, strict=True) if p[0] != p[1]][:3]
