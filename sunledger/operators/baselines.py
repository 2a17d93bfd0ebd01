"""Simple reference forecasts, season climatology and walk-forward folds.

Frames run over calendar indexes (months, days), never over row positions, so missing periods cannot
shift a forecast. Rows per partition are calendar periods of one site, after aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.columns import col, month_index, season


def persistence(keys: Sequence[str], month: str, value: str) -> Column:
    """Value of the previous calendar month; NULL if that month is absent."""
    return _shifted(keys, month, value, 1)


def same_month_last_year(keys: Sequence[str], month: str, value: str) -> Column:
    """Value twelve calendar months earlier; NULL if that month is absent."""
    return _shifted(keys, month, value, 12)


def _shifted(keys: Sequence[str], month: str, value: str, back: int) -> Column:
    frame = Window.partitionBy(*keys).orderBy(month_index(month)).rangeBetween(-back, -back)
    return F.max(value).over(frame)


def seasonal_mean(keys: Sequence[str], month: str, value: str, history_start: str | None = None) -> Column:
    """Mean of the same calendar month in earlier years, else the mean of all history before the month.

    ``history_start`` limits the fallback mean to months from that date on.
    """
    idx = month_index(month)
    same = Window.partitionBy(*keys, F.month(month)).orderBy(idx).rangeBetween(Window.unboundedPreceding, -1)
    past = Window.partitionBy(*keys).orderBy(idx).rangeBetween(Window.unboundedPreceding, -1)
    counted = col(value)
    if history_start is not None:
        counted = F.when(col(month) >= F.lit(history_start).cast("date"), counted)
    return F.coalesce(F.avg(value).over(same), F.avg(counted).over(past))


def monthly_baselines(
    df: DataFrame, keys: Sequence[str], month: str, value: str, history_start: str | None = None
) -> DataFrame:
    """Persistence, same month last year and seasonal mean in one exchange on ``keys``."""
    return df.select(
        *[c for c in df.columns],
        persistence(keys, month, value).alias("persistence"),
        same_month_last_year(keys, month, value).alias("last_year"),
        seasonal_mean(keys, month, value, history_start).alias("seasonal_mean"),
    )


def history_before(df: DataFrame, keys: Sequence[str], period: Column, value: str, digits: int = 6) -> DataFrame:
    """Per row, size and mean of all earlier periods: the training history of a fold that tests this row.

    Sums are rounded to ``digits``, the precision of the data, so that the order of addition does not show.
    """
    past = Window.partitionBy(*keys).orderBy(period).rangeBetween(Window.unboundedPreceding, -1)
    return df.select(
        *df.columns,
        F.count(value).over(past).alias("train_rows"),
        F.try_divide(F.round(F.sum(value).over(past), digits), F.count(value).over(past)).alias("train_mean"),
    )


def fold_climatology(
    df: DataFrame, keys: Sequence[str], day: str, value: str, fold: Column, digits: int = 6
) -> DataFrame:
    """Season mean from rows of earlier folds only.

    Rows are summed per (keys, season, fold) first, so the expanding frame holds one row per fold.
    Returns (keys, season, fold, clim, train_days).
    """
    per_fold = df.groupBy(*keys, season(day).alias("season"), fold.alias("fold")).agg(
        F.sum(value).alias("_s"), F.count(value).alias("_n")
    )
    past = Window.partitionBy(*keys, "season").orderBy("fold").rangeBetween(Window.unboundedPreceding, -1)
    total = F.sum("_n").over(past)
    return per_fold.select(
        *keys,
        "season",
        "fold",
        F.try_divide(F.round(F.sum("_s").over(past), digits), total).alias("clim"),
        F.coalesce(total, F.lit(0)).alias("train_days"),
    )


def season_climatology(keys: Sequence[str], day: str, value: str, fold: Column, digits: int = 6) -> Column:
    """The same mean as a column of daily rows: one exchange, no join. Days of one site are few."""
    past = Window.partitionBy(*keys, season(day)).orderBy(fold).rangeBetween(Window.unboundedPreceding, -1)
    return F.try_divide(F.round(F.sum(value).over(past), digits), F.count(value).over(past))


def walk_forward_folds(df: DataFrame, keys: Sequence[str], day: str, step_days: int, min_folds: int) -> DataFrame:
    """Expanding folds of ``step_days``: train on everything before the test block.

    Returns (keys, fold, test_start, test_end, train_rows, test_rows) for folds with at least ``min_folds``
    blocks of calendar time before them. The block origin is the first day of each key.
    """
    blocks = (
        df.withColumn("_first", F.min(day).over(Window.partitionBy(*keys)))
        .groupBy(*keys, "_first", F.floor(F.datediff(day, "_first") / F.lit(step_days)).cast("bigint").alias("fold"))
        .agg(F.count("*").alias("test_rows"))
    )
    past = Window.partitionBy(*keys).orderBy("fold").rangeBetween(Window.unboundedPreceding, -1)
    start = F.date_add("_first", (F.col("fold") * step_days).cast("int"))
    return (
        blocks.withColumn("train_rows", F.sum("test_rows").over(past))
        .where(F.col("fold") >= min_folds)
        .select(
            *keys,
            "fold",
            start.alias("test_start"),
            F.date_add(start, step_days - 1).alias("test_end"),
            F.coalesce("train_rows", F.lit(0)).alias("train_rows"),
            "test_rows",
        )
    )


def purge_boundary(df: DataFrame, issue: Column, target: Column, fold_of) -> DataFrame:
    """Drop rows whose target lies in a later fold than their issue time."""
    return df.where(fold_of(issue) == fold_of(target))


def daily_persistence(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Yesterday's total as the D+1 forecast; NULL if yesterday is absent."""
    index = F.datediff(day, F.lit("1970-01-01").cast("date"))
    frame = Window.partitionBy(*keys).orderBy(index).rangeBetween(-1, -1)
    return df.select(*df.columns, F.max(value).over(frame).alias("persistence"))
