"""Small helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round float outputs, since the order of summation is free on a cluster."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def scores(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 4, "mae", "rmse"), 6, "wape")


SCORE_SQL = """CAST(count(pred - actual_kwh) AS BIGINT) AS n, round(avg(abs(pred - actual_kwh)), 4) AS mae,
  round(sqrt(avg((pred - actual_kwh) * (pred - actual_kwh))), 4) AS rmse,
  round(sum(abs(pred - actual_kwh)) / nullif(sum(CASE WHEN pred IS NOT NULL THEN abs(actual_kwh) END), 0) * 100, 6) AS wape"""
