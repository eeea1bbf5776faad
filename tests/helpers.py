"""Small fixtures: visit rows written as (user, visit time, channel, converting)."""

from __future__ import annotations

from datetime import datetime

DAY = "2024-01-20"
COLUMNS = (
    "user_guid string, attribution_visit_start_time timestamp, conversion_visit_timestamp timestamp, "
    "touchpoint string, converting_visit int, conversion_type string, conversion_window int"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text if len(text) > 10 else f"{text} 00:00:00")


def visits(spark, rows, conversion=f"{DAY} 12:00:00", kind="Trial", window=30):
    data = [(u, at(t), at(conversion), c, f, kind, window) for u, t, c, f in rows]
    return spark.createDataFrame(data, COLUMNS)


def by(df, key, *values):
    rows = {}
    for row in df.collect():
        rows[tuple(row[k] for k in key) if isinstance(key, list) else row[key]] = tuple(row[v] for v in values)
    return rows


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)

    def rows(df):
        return sorted(
            (tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.select(*columns).collect()),
            key=repr,
        )

    left, right = rows(a), rows(b)
    assert len(left) == len(right)
    assert left == right
