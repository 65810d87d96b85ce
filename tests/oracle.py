"""Comparison of a query with its SQL in DuckDB: schema, row count, and values without regard to order."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings bitext opus_scored eval_sample "
    "source_plan pair_plan lang_plan qe_models eval_items"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return "nan" if math.isnan(value) else float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    return str(value)


def exact_part(value):
    """What rows are ordered by: floats only to the digits that rounding errors can't touch."""
    if isinstance(value, tuple):
        return tuple(map(exact_part, value))
    if isinstance(value, float) and not value.is_integer():
        return "", round(value, 2)
    return repr(value), 0.0


def close(a, b) -> bool:
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(map(close, a, b))
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-7)
    return type(a) is type(b) and a == b


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [tuple(plain(r[i]) for i in order) for r in data]


def compare(df, con, sql: str) -> str:
    """Empty if both agree, else what differs."""
    result = con.execute(sql)
    names, data = [c[0] for c in result.description], result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    ours, theirs = rows(df.columns, df.collect()), rows(names, data)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}; only here {[r for r in ours if r not in set(theirs)][:3]}, only there {[r for r in theirs if r not in set(ours)][:3]}"
    # Whole columns first: keys order the rows, and only then values that may differ in their last digits.
    exact = [k for k in range(len(names)) if all(not isinstance(r[k], float) or r[k].is_integer() for r in ours + theirs)]
    key = lambda r: (tuple(repr(r[k]) for k in exact), repr(tuple(map(exact_part, r))))
    for a, b in zip(sorted(ours, key=key), sorted(theirs, key=key)):
        if not close(a, b):
            return f"{len(ours)} rows; {a} against {b}"
    return ""
