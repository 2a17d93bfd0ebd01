"""Small fixtures."""

from __future__ import annotations

import datetime as dt


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def frame(spark, schema: str, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]
