"""Comparing queries with their oracles, row by row and regardless of order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """What tells the two results apart; empty if nothing does."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    expected = _rows(names, result.fetchall())
    actual = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if expected == actual:
        return []
    ours, theirs = set(actual) - set(expected), set(expected) - set(actual)
    return [
        f"{len(actual)} rows against {len(expected)}",
        *[f"only Spark:  {r}" for r in sorted(ours, key=repr)[:3]],
        *[f"only oracle: {r}" for r in sorted(theirs, key=repr)[:3]],
    ]
