"""Order-insensitive comparison of a Spark result with DuckDB on the same tables."""

import math
import os
from decimal import Decimal

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in sorted(os.listdir(sf_dir)):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql, allow_empty=False):
    """Empty if both agree; else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    actual = _rows(df.columns, df.collect())
    if not expected and not allow_empty:
        return "the oracle is empty"
    if actual == expected:
        return ""
    seen, wanted = set(actual), set(expected)
    missing = [r for r in expected if r not in seen][:3]
    extra = [r for r in actual if r not in wanted][:3]
    return f"{len(actual)} rows != {len(expected)}; missing {missing}; extra {extra}"
