"""Runs a query on Spark and its SQL on DuckDB over the same tables and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "hugeint": "int", "float": "float", "double": "float", "string": "text", "varchar": "text", "boolean": "bool", "date": "date", "timestamp": "time", "timestamp_ntz": "time"}


def cell(x) -> str:
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float | decimal.Decimal):
        return f"{float(x) + 0.0:.6f}"
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x)


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if os.path.exists(path := f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, kinds, counts or rows; empty if nothing."""
    names = sorted(df.columns)
    found = con.execute(sql)
    theirs = {d[0]: str(d[1]).lower() for d in found.description}
    rows = found.fetchall()
    out = []
    if names != sorted(theirs):
        return [f"columns {names} and {sorted(theirs)}"]
    kinds = dict(df.dtypes)
    for n in names:
        a, b = KINDS.get(kinds[n], kinds[n]), KINDS.get(theirs[n], theirs[n])
        if a != b:
            out.append(f"type of {n}: {kinds[n]} and {theirs[n]}")
    place = [list(theirs).index(n) for n in names]
    mine = Counter(tuple(cell(r[n]) for n in names) for r in df.collect())
    other = Counter(tuple(cell(r[p]) for p in place) for r in rows)
    if mine != other:
        out.append(f"{sum(mine.values())} and {sum(other.values())} rows; only here {list((mine - other).items())[:3]}, only there {list((other - mine).items())[:3]} of {names}")
    return out
