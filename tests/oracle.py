"""Side-by-side comparison of a query with its DuckDB text."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


_KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE",
}


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, types or rows; empty when equal."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for f in df.schema.fields:
        want = _KIND.get(f.dataType.simpleString(), f.dataType.simpleString())
        if kinds[f.name] != want:
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} / {kinds[f.name]}")
    order = sorted(names)
    got = Counter(tuple(_cell(r[c]) for c in order) for r in df.collect())
    at = [names.index(c) for c in order]
    exp = Counter(tuple(_cell(r[i]) for i in at) for r in expected)
    if got != exp:
        problems.append(
            f"rows {sum(got.values())} / {sum(exp.values())}; only Spark {list((got - exp).items())[:3]}; "
            f"only SQL {list((exp - got).items())[:3]}"
        )
    return problems
