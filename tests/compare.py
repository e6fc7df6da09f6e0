"""Order-insensitive comparison of a Spark result with the SQL engine's."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value)


def bag(rows, names) -> Counter:
    """Rows as a multiset, columns in name order."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list:
    result = con.sql(sql)
    assert sorted(df.columns) == sorted(result.columns), (df.columns, result.columns)
    ours, theirs = bag(df.collect(), df.columns), bag(result.fetchall(), result.columns)
    return [list((ours - theirs).items())[:3], list((theirs - ours).items())[:3], sum(ours.values())]
