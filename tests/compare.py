"""Results of a query beside those of its DuckDB SQL."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from datetime import date, datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession


def plain(x: object) -> object:
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, bool):
        return x
    if hasattr(x, "as_tuple"):  # decimals
        return float(f"{float(x):.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, dict):
        return tuple(plain(v) for v in x.values())
    if isinstance(x, (datetime, date)):
        return str(x)
    return x


def rows_of(df: DataFrame) -> Counter:
    cols = sorted(df.columns)
    return Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark: SparkSession, query: Callable, sql: str | None, sf_dir: str) -> str:
    df = query(spark, sf_dir)
    ours = rows_of(df)
    n = sum(ours.values())
    if sql is None:
        return f"rows only: {n}"
    found = duck(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"DIFF columns {sorted(df.columns)} {sorted(names)}"
    at = [names.index(c) for c in sorted(names)]
    theirs = Counter(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    if ours != theirs:
        return f"DIFF {n} rows, {sum(theirs.values())} expected; only here {list((ours - theirs).elements())[:3]}, only there {list((theirs - ours).elements())[:3]}"[:1500]
    return f"same: {n}"
