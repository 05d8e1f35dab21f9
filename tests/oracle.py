"""Compare a Spark result with DuckDB's answer to the same question, value by value."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str([_plain(r[i]) for i in order]) for r in rows)


def compare(df, con, sql) -> list[str]:
    """Differences, none if the two agree."""
    spark_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = [str(d[1]) for d in cur.description]
    duck_rows = cur.fetchall()
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
    }
    wanted = dict(zip(names, types))
    for name, kind in df.dtypes:
        if kinds.get(kind, kind) != wanted[name]:
            out.append(f"type of {name}: {kind} against {wanted[name]}")
    if len(spark_rows) != len(duck_rows):
        out.append(f"{len(spark_rows)} rows against {len(duck_rows)}")
    if not duck_rows:
        out.append("no rows to compare")
    mine, theirs = _rows(df.columns, spark_rows), _rows(names, duck_rows)
    if mine != theirs:
        a, b = set(mine) - set(theirs), set(theirs) - set(mine)
        out.append(f"{len(a)} rows differ: {sorted(a)[:2]} against {sorted(b)[:2]} in {sorted(names)}")
    return out
