"""Runs catalogue queries next to their checking SQL and compares types and values."""

from __future__ import annotations

import pathlib

import duckdb


def engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted((tuple(r[n] for n in names) for r in table.to_pylist()), key=repr)


def differences(query, sql: str, spark, con, sf_dir: str) -> list[str]:
    got = query(spark, sf_dir).toArrow()
    want = con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} / {sorted(want.column_names)}"]
    out = []
    for name in got.column_names:
        a, b = str(got.schema.field(name).type), str(want.schema.field(name).type)
        if a.replace("large_", "") != b.replace("large_", ""):
            out.append(f"type of {name}: {a} / {b}")
    left, right = _rows(got), _rows(want)
    if len(left) != len(right):
        out.append(f"rows {len(left)} / {len(right)}")
    elif not left:
        out.append("no rows")
    bad = [(x, y) for x, y in zip(left, right) if x != y]
    if bad:
        out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out
