"""Compare registered queries with their SQL forms, row by row."""

from __future__ import annotations

import math
import time
from pathlib import Path

import duckdb

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in NAMES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    picked = [tuple(_plain(r[k]) for k in order) for r in rows]
    return sorted(picked, key=repr)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """``None`` when both sides agree, else a short account of the difference."""
    start = time.time()
    df = query(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    left, right = _rows(df.columns, ours), _rows(names, theirs)
    if left != right:
        odd = [(a, b) for a, b in zip(left, right) if a != b][:2]
        return f"rows {len(left)} / {len(right)}; {sorted(names)}; first differences {odd}"
    types = lambda rows: [{type(v).__name__ for v in col if v is not None} for col in zip(*rows)]
    if types(left) != types(right):
        return f"types {types(left)} / {types(right)}"
    if not left:
        return "no rows"
    difference.seconds = spent
    return None
