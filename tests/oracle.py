"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def expected(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    q = con.execute(sql)
    names = [d[0] for d in q.description]
    cols = sorted(names)
    return cols, Counter(tuple(plain(r[names.index(c)]) for c in cols) for r in q.fetchall())


def assert_same(df, sql: str, sf_dir: str) -> None:
    cols, want = expected(sql, sf_dir)
    assert sorted(df.columns) == cols
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    assert got == want
