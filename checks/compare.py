"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import SparkSession

from .oracles import oracle_sql
from .queries import queries


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(repr, r))
    )


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf: str) -> str:
    """Empty when both engines agree, else what differs first."""
    frame = queries()[name](spark, sf)
    ours = _sorted_rows(frame.collect(), frame.columns)
    result = con.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    theirs = _sorted_rows(result.fetchall(), names)
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} / {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows, first {wrong[0]}"
    kinds = [(a, b) for a, b in zip(ours[0], theirs[0]) if type(a) is not type(b)] if ours else []
    return f"types {kinds}" if kinds else ""
