"""Compare a Spark query with its SQL in DuckDB the way the driver does: rows, columns and values, in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        source = path if os.path.isfile(path) else f"{path}/*.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat() if hasattr(value, "tzinfo") else value.isoformat()
    if hasattr(value, "as_tuple"):
        return f"{float(value):.9g}"
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, query, sql: str) -> None:
    got = query(spark, sf_dir)
    con = duck(sf_dir)
    ran = con.execute(sql)
    names = [d[0] for d in ran.description]
    want = ran.fetchall()
    assert sorted(got.columns) == sorted(names), (sorted(got.columns), sorted(names))
    mine, theirs = rows_of(got.columns, got.collect()), rows_of(names, want)
    assert len(mine) == len(theirs), (len(mine), len(theirs))
    differ = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    assert not differ, (len(differ), differ[:3])
