"""Walk-forward models trained on Spark tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.session import materialize


def walk_forward_line(
    df: DataFrame, keys: Sequence[str], fold: str, x: str, y: str, penalty: float = 0.0
) -> DataFrame:
    """One line per (keys, fold) fitted on all earlier folds; ``penalty`` > 0 is ridge on the slope.

    Sums are made per (keys, fold) first and added up over earlier folds, so all folds are trained in one
    job and no row is copied per fold.
    """
    ok = F.col(x).isNotNull() & F.col(y).isNotNull()
    xv, yv = F.when(ok, F.col(x)), F.when(ok, F.col(y))
    # Values are centred on the key's own means before they are multiplied, so that no large sums cancel. Any centre
    # gives the same line, so that the means see later folds does not matter.
    centre = df.groupBy(*keys).agg(F.avg(xv).alias("_cx"), F.avg(yv).alias("_cy"))
    per_fold = df.join(centre, list(keys)).groupBy(*keys, fold, "_cx", "_cy").agg(
        F.count(xv).alias("_n"),
        F.sum(xv - F.col("_cx")).alias("_x"),
        F.sum(yv - F.col("_cy")).alias("_y"),
        F.sum((xv - F.col("_cx")) * (xv - F.col("_cx"))).alias("_xx"),
        F.sum((xv - F.col("_cx")) * (yv - F.col("_cy"))).alias("_xy"),
    )
    past = Window.partitionBy(*keys).orderBy(fold).rangeBetween(Window.unboundedPreceding, -1)
    s = {c: F.sum(c).over(past) for c in ("_n", "_x", "_y", "_xx", "_xy")}
    sums = per_fold.select(*keys, fold, "_cx", "_cy", *[v.alias(k) for k, v in s.items()])
    sxx = F.col("_xx") - F.try_divide(F.col("_x") * F.col("_x"), F.col("_n"))
    sxy = F.col("_xy") - F.try_divide(F.col("_x") * F.col("_y"), F.col("_n"))
    fit = sums.withColumns({"train_rows": F.col("_n"), "slope": F.try_divide(sxy, sxx + penalty)})
    level = F.col("_cy") + F.try_divide("_y", "_n") - F.col("slope") * (F.col("_cx") + F.try_divide("_x", "_n"))
    return fit.select(*keys, fold, "train_rows", "slope", level.alias("intercept"))


def score_line(df: DataFrame, model: DataFrame, keys: Sequence[str], fold: str, x: str, min_train: int) -> DataFrame:
    """Out-of-fold prediction of each row by the line of its own fold."""
    fit = model.where(F.col("train_rows") >= min_train)
    return df.join(fit, [*keys, fold], "left").withColumn("pred", F.col("slope") * F.col(x) + F.col("intercept"))


def walk_forward_ridge(
    df: DataFrame, keys: Sequence[str], fold: str, features: Sequence[str], y: str, penalty: float
) -> DataFrame:
    """Ridge with several features: X'X and X'y per (keys, fold) by Spark, one small solve per key.

    The grouped solve gets one row of sums per fold, never data rows.
    """
    names = ["_one", *features]
    work = df.dropna(subset=[*features, y]).withColumn("_one", F.lit(1.0))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = work.groupBy(*keys, fold).agg(
        F.array(*[F.sum(F.col(a) * F.col(b)) for a, b in pairs]).alias("_xx"),
        F.array(*[F.sum(F.col(a) * F.col(y)) for a in names]).alias("_xy"),
    )
    p = len(names)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sums.schema.fields if f.name in (*keys, fold))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(fold)
        xx, xy, out = np.zeros((p, p)), np.zeros(p), []
        ridge = np.diag([0.0] + [penalty] * (p - 1))
        upper = np.triu_indices(p)
        for row in pdf.itertuples(index=False):
            coef = None
            if xx[0, 0] >= p:
                coef = np.linalg.lstsq(xx + ridge, xy, rcond=None)[0].tolist()
            out.append((float(xx[0, 0]), coef))
            step = np.zeros((p, p))
            step[upper] = np.asarray(row[pdf.columns.get_loc("_xx")], dtype=float)
            xx += step + np.triu(step, 1).T
            xy += np.asarray(row[pdf.columns.get_loc("_xy")], dtype=float)
        res = pdf[[*keys, fold]].copy()
        res["train_rows"] = [int(n) for n, _ in out]
        res["coef"] = [c for _, c in out]
        return res

    return sums.groupBy(*keys).applyInPandas(solve, f"{fields}, train_rows bigint, coef array<double>")


def score_ridge(df: DataFrame, model: DataFrame, keys: Sequence[str], fold: str, features: Sequence[str]) -> DataFrame:
    terms: Column = F.col("coef")[0]
    for i, f in enumerate(features, 1):
        terms = terms + F.col("coef")[i] * F.col(f)
    return df.join(model, [*keys, fold], "left").withColumn("pred", terms).drop("coef")


def _features(categorical: Sequence[str], numeric: Sequence[str]) -> list:
    index = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep", stringOrderType="alphabetAsc") for c in categorical]
    vec = VectorAssembler(inputCols=[f"{c}_ix" for c in categorical] + list(numeric), outputCol="features", handleInvalid="error")
    return [*index, vec]


def boosted_trees(label: str, rounds: int = 15, seed: int = 42) -> GBTRegressor:
    """Boosted-tree candidate."""
    return GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=4, seed=seed, predictionCol="pred")


def huber_line(label: str) -> LinearRegression:
    """Robust-loss candidate: linear model with Huber loss."""
    return LinearRegression(labelCol=label, loss="huber", epsilon=1.35, maxIter=50, predictionCol="pred")


def calendar_folds(df: DataFrame, time: str, numeric: Sequence[str], label: str, starts: Sequence[str]) -> DataFrame:
    """One row per fold: ``fold_start``, ``fold_end``, and of the rows before the start how many can be learned from (``train_rows``,
    ``train_from``, ``train_to``) and how many lack a feature or the label (``train_incomplete``).

    ``starts`` are calendar dates in order; a fold ends where the next one starts, the last one with the table.
    """
    ends = [*starts[1:], "9999-12-31"]
    bounds = F.array(*[F.struct(F.lit(a).cast("date").alias("a"), F.lit(b).cast("date").alias("b")) for a, b in zip(starts, ends)])
    # A row is needed by each later fold, so the counts are made per time first.
    whole = _complete([*numeric, label])
    per_time = df.groupBy(time).agg(F.count_if(whole).alias("_w"), F.count_if(~whole).alias("_i"))
    rows = per_time.withColumn("_f", F.explode(bounds))
    past = F.col(time) < F.col("_f.a")
    return rows.groupBy(F.col("_f.a").alias("fold_start"), F.col("_f.b").alias("fold_end")).agg(
        F.sum(F.when(past, F.col("_w")).otherwise(0)).alias("train_rows"),
        F.min(F.when(past & (F.col("_w") > 0), F.col(time))).alias("train_from"),
        F.max(F.when(past & (F.col("_w") > 0), F.col(time))).alias("train_to"),
        F.sum(F.when(past, F.col("_i")).otherwise(0)).alias("train_incomplete"),
    )


def _complete(cols: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


def walk_forward_learner(
    df: DataFrame, time: str, categorical: Sequence[str], numeric: Sequence[str], label: str, starts: Sequence[str], learner
) -> DataFrame:
    """Out-of-fold predictions of a Spark learner, pooled over sites: one fit per fold on the rows before its start.

    Every row of a fold comes back with ``fold_start`` and ``pred``. Rows without a feature are neither learned from nor dropped:
    their ``pred`` is NULL, as in a fold with nothing to learn from. ``starts`` are a few calendar dates, one job each.
    ``df`` is written once, as each fold reads it several times.
    """
    df, out = materialize(df, "learner-rows"), None
    whole, usable = _complete([*numeric, *categorical, label]), _complete([*numeric, *categorical])
    for a, b in zip(starts, [*starts[1:], "9999-12-31"]):
        start, end = F.lit(a).cast("date"), F.lit(b).cast("date")
        train, test = df.where((F.col(time) < start) & whole), df.where((F.col(time) >= start) & (F.col(time) < end))
        missing = test.where(~usable).withColumn("pred", F.lit(None).cast("double"))
        if train.isEmpty():
            fold = test.withColumn("pred", F.lit(None).cast("double"))
        else:
            scored = Pipeline(stages=[*_features(categorical, numeric), learner]).fit(train).transform(test.where(usable))
            fold = scored.select(*df.columns, "pred").unionByName(missing)
        fold = fold.withColumn("fold_start", start)
        out = fold if out is None else out.unionByName(fold)
    return out
