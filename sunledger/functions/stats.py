"""Aggregate expressions for forecast errors. Rows where actual or prediction is NULL do not count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col, error


def error_metrics(actual: str | Column, pred: str | Column) -> list[Column]:
    """n, MAE, RMSE and WAPE (ratio of sums, in percent); an empty sample gives n = 0 and NULLs."""
    e = error(actual, pred)
    base = F.when(e.isNotNull(), F.abs(col(actual)))
    return [
        F.count(e).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.try_divide(F.sum(F.abs(e)), F.sum(base)) * 100).alias("wape"),
    ]


def stable_sum(value: str | Column) -> Column:
    """Sum rounded to a millionth: the order in which a cluster adds partial sums does not show."""
    return F.round(F.sum(col(value)), 6)


def stable_mean(value: str | Column) -> Column:
    """Mean from a stable sum; NULL for an empty sample."""
    return F.try_divide(stable_sum(value), F.count(col(value)))


def bias_metrics(actual: str | Column, pred: str | Column) -> list[Column]:
    """ME, MPE, MAPE and MSE; rows with actual = 0 do not enter the percentages."""
    e = error(actual, pred)
    share = F.try_divide(e, col(actual))
    return [
        F.count(e).alias("n"),
        F.avg(e).alias("me"),
        (F.avg(share) * 100).alias("mpe"),
        (F.avg(F.abs(share)) * 100).alias("mape"),
        F.avg(e * e).alias("mse"),
    ]


def improvement_pct(base: str | Column, model: str | Column) -> Column:
    """Gain over a baseline error: (base - model) / base * 100."""
    return F.try_divide(col(base) - col(model), col(base)) * 100
