"""Compare a query with its SQL twin: names, row count, value types and values."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value + 0.0))
    return (type(value).__name__, str(value))


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty if both sides agree exactly."""
    answer = con.sql(sql)
    names = list(answer.columns)
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    order = sorted(names)
    ours = sorted(tuple(_plain(r[c]) for c in order) for r in spark_df.collect())
    place = [names.index(c) for c in order]
    theirs = sorted(tuple(_plain(r[i]) for i in place) for r in answer.fetchall())
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}; first: {ours[:2]} / {theirs[:2]}"]
    found = [f"{dict(zip(order, a))} against {dict(zip(order, b))}" for a, b in zip(ours, theirs) if a != b]
    return ([f"{len(found)} rows differ"] + found[:3]) if found else ([] if ours else ["both sides are empty"])
