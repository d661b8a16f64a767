"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, list | tuple):
        return tuple(cell(x) for x in v)
    return v


def spark_rows(df) -> list[str]:
    cols = sorted(df.columns)
    return sorted(repr(tuple(cell(r[c]) for c in cols)) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[str]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted(repr(tuple(cell(r[i]) for i in order)) for r in cur.fetchall())


def assert_same(df, con, sql: str) -> None:
    names, want = duck_rows(con, sql)
    assert sorted(df.columns) == names
    got = spark_rows(df)
    extra, lost = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
    assert got == want, f"{len(got)} vs {len(want)} rows\nonly spark {extra}\nonly sql {lost}"
