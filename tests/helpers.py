"""Literal series for tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from hourloom.config import KEY, TS

START = datetime(2024, 1, 1)


def at(hours: float, start: datetime = START) -> datetime:
    return start + timedelta(hours=hours)


def series(spark, rows, columns, key="a"):
    """``rows`` of (hour offset or datetime, values...)."""
    data = [(key, r[0] if isinstance(r[0], datetime) else at(r[0]), *r[1:]) for r in rows]
    schema = f"{KEY} string, {TS} timestamp_ntz, " + ", ".join(c if " " in c else f"{c} double" for c in columns)
    return spark.createDataFrame(data, schema)


def column(df, name, key=None):
    """Values of a column in time order."""
    rows = df.filter(df[KEY] == key) if key else df
    return [r[name] for r in rows.orderBy(KEY, TS).collect()]


def same(a, b):
    """Two frames hold the same rows, doubles compared with a tolerance."""
    names = sorted(a.columns)
    assert names == sorted(b.columns)
    left = sorted((tuple(r) for r in a.select(*names).collect()), key=repr_key)
    right = sorted((tuple(r) for r in b.select(*names).collect()), key=repr_key)
    assert len(left) == len(right)
    for x, y in zip(left, right, strict=True):
        for n, u, v in zip(names, x, y, strict=True):
            if isinstance(u, float) and isinstance(v, float):
                assert abs(u - v) <= 1e-7 * max(1.0, abs(u)), (n, x, y)
            else:
                assert u == v, (n, x, y)


def repr_key(row):
    return tuple(str(v) for v in row if not isinstance(v, float))
