"""Run a query on Spark and its SQL on DuckDB; report the first difference."""

from __future__ import annotations

import math
import pathlib

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

# Type names of the two engines that hold the same values.
SAME_TYPE = {
    "timestamp_ntz": "TIMESTAMP",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if pathlib.Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    return str(v)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a description."""
    cols = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} vs {sorted(rel.columns)}"
    other = dict(zip(rel.columns, map(str, rel.types)))
    off = {c: (types[c], other[c]) for c in cols if SAME_TYPE.get(types[c]) != other[c]}
    if off:
        return f"types {off}"
    left = sorted(tuple(_plain(v) for v in r) for r in df.select(*cols).collect())
    right = sorted(tuple(_plain(v) for v in r) for r in rel.project(", ".join(f'"{c}"' for c in cols)).fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)} of {len(left)} rows differ, e.g. {bad[0]}"
    return None if left else "no rows"
