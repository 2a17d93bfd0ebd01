"""Correlation, collinearity and lineage of candidate features.

The data are touched once per table of sums; only the p x p matrix reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.operators.scans import edge_index
from sunledger.session import materialize, small_table


def _corr(a: Column, b: Column) -> Column:
    """Pearson's r of two columns that are NULL in the same rows; NULL where one of them is constant."""
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.when(spread > 0, F.covar_pop(a, b) / spread)


def _pair_rows(one: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("r"))
            for i, (x, y) in enumerate(pairs)
        ]
    )
    return one.select(F.explode(rows).alias("p")).select("p.*")


def pearson_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long table (x, y, n, r) over all pairs after pairwise NULL removal, from one aggregate."""
    pairs = list(combinations(features, 2))
    aggs = []
    for i, (x, y) in enumerate(pairs):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        a, b = F.when(both, F.col(x)).cast("double"), F.when(both, F.col(y)).cast("double")
        aggs += [_corr(a, b).alias(f"r{i}"), F.count_if(both).alias(f"n{i}")]
    return _pair_rows(df.agg(*aggs), pairs)


def pairwise_ranks(df: DataFrame, features: Sequence[str], splits: int | None = None) -> DataFrame:
    """One row per input row with a value: for each two features x and y a column ``_k_<x>_<y>``, the row's average rank in x among the
    rows that have both x and y; NULL where one of the two is NULL.

    The columns are unpivoted and cut by range, all features at once. A cut point is an interval of its own, so a value that
    holds many rows is one: its rank follows from counts, and its rows are never ordered. All other rows are ordered within
    their interval, which holds about one ``splits``-th of the rows. By default an interval is made for every quarter million rows.
    """
    p = len(features)
    wide = df.select(F.monotonically_increasing_id().alias("_row"), *[F.col(f).cast("double").alias(f) for f in features])
    # Written, as the row numbers bring the ranks of a row together again.
    wide = materialize(wide, "rank-rows")
    if splits is None:
        splits = min(1 << 16, max(16, 1 << (wide.count() >> 18).bit_length()))
    levels = [i / splits for i in range(1, splits)]
    edges = wide.agg(F.array(*[F.percentile_approx(f, levels, max(10_000, 8 * splits)) for f in features]).alias("e")).scalar()

    # An interval lies before the cut point that ends it: 2 i for values below cut point i, 2 i + 1 for that point. Searched once a value, so written.
    below = wide.withColumn("_edges", edges).select("*", *[edge_index(F.get("_edges", F.lit(i)), F.col(f), splits).alias(f"_b{i}") for i, f in enumerate(features)])
    at_point = [F.coalesce(F.get(F.get("_edges", F.lit(i)), F.col(f"_b{i}")) == F.col(f), F.lit(False)) for i, f in enumerate(features)]
    placed = below.select("_row", *features, *[(2 * F.col(f"_b{i}") + at.cast("int")).alias(f"_b{i}") for i, at in enumerate(at_point)])
    placed = materialize(placed, "rank-cells")
    there = F.array(*[F.col(f).isNotNull() for f in features])
    cells = F.array(*[F.struct(F.lit(i).alias("_f"), F.col(f).alias("_v"), F.col(f"_b{i}").alias("_cell")) for i, f in enumerate(features)])
    long = placed.select("_row", there.alias("_has"), F.explode(cells).alias("c")).select("_row", "_has", "c.*").where(F.col("_v").isNotNull())
    has = [F.col("_has")[j].cast("bigint") for j in range(p)]

    upto = Window.partitionBy("_f").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    counts = long.groupBy("_f", "_cell").agg(*[F.sum(has[j]).alias(f"_c{j}") for j in range(p)])
    starts = counts.select(
        "_f",
        "_cell",
        F.array(*[F.col(f"_c{j}") for j in range(p)]).alias("_count"),
        F.array(*[F.sum(f"_c{j}").over(upto) - F.col(f"_c{j}") for j in range(p)]).alias("_start"),
    )
    # At most 2 * splits rows for each feature.
    starts = materialize(starts, "rank-starts")

    # One number a pair of columns, as arrays cannot be kept in a hash aggregate.
    sides = [(i, j) for i in range(p) for j in range(p) if i != j]
    names = {(i, j): f"_k_{features[i]}_{features[j]}" for i, j in sides}
    points = placed.where(F.coalesce(*features).isNotNull())
    for i in range(p):
        at = starts.where((F.col("_f") == i) & (F.col("_cell") % 2 == 1)).select(F.col("_cell").alias(f"_b{i}"), F.struct("_start", "_count").alias(f"_s{i}"))
        points = points.join(F.broadcast(at), f"_b{i}", "left")
    both = lambda i, j: F.col(features[i]).isNotNull() & F.col(features[j]).isNotNull()
    points = points.select("_row", *[F.when(both(i, j), F.col(f"_s{i}._start")[j] + (F.col(f"_s{i}._count")[j] + 1) / 2.0).alias(names[i, j]) for i, j in sides])

    # Tasks in number as the intervals, so that none holds more rows on larger tables; left to itself Spark joins partitions by their packed size.
    within = Window.partitionBy("_f", "_cell").orderBy("_v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ties = Window.partitionBy("_f", "_cell", "_v")
    inner = long.where("_cell % 2 = 0").repartition(splits, "_f", "_cell").select(
        "_row", "_f", "_has", "_cell",
        *[F.sum(has[j]).over(within).alias(f"_u{j}") for j in range(p)],
        *[F.sum(has[j]).over(ties).alias(f"_t{j}") for j in range(p)],
    ).join(F.broadcast(starts), ["_f", "_cell"])
    rank = [F.when(F.col("_has")[j], F.col("_start")[j] + (F.col(f"_u{j}") - F.col(f"_t{j}")) + (F.col(f"_t{j}") + 1) / 2.0) for j in range(p)]
    inner = inner.select("_row", *[F.when(F.col("_f") == i, rank[j]).alias(names[i, j]) for i, j in sides])
    # Spread before the aggregate, which finds nothing to fold on the side of the intervals and would hold all rows of a task there.
    return points.unionByName(inner).repartition(splits, "_row").groupBy("_row").agg(*[F.max(n).alias(n) for n in names.values()])


def spearman_table(df: DataFrame, features: Sequence[str], splits: int | None = None) -> DataFrame:
    """Rank correlation as a long table (x, y, n, r): a pair's rows are those without a NULL in either of the two, ranks are average
    ranks among these rows. A pair of which one side is constant or has no row has a NULL r."""
    ranked = pairwise_ranks(df, features, splits)
    pairs = list(combinations(features, 2))
    aggs = []
    for i, (x, y) in enumerate(pairs):
        a, b = F.col(f"_k_{x}_{y}"), F.col(f"_k_{y}_{x}")
        aggs += [_corr(a, b).alias(f"r{i}"), F.count_if(a.isNotNull() & b.isNotNull()).alias(f"n{i}")]
    return _pair_rows(ranked.agg(*aggs), pairs)


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> np.ndarray:
    """p x p Pearson matrix on complete rows; p(p-1)/2 numbers reach the driver."""
    rows = pearson_table(df.dropna(subset=list(features)), features).collect()
    at = {f: i for i, f in enumerate(features)}
    m = np.eye(len(features))
    for r in rows:
        m[at[r["x"]], at[r["y"]]] = m[at[r["y"]], at[r["x"]]] = np.nan if r["r"] is None else r["r"]
    return m


def vif_values(matrix: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """Variance inflation 1 / (1 - R^2 on the other features).

    Only a feature that the others explain wholly gets infinity; what is independent of it keeps its value. A constant
    feature has no correlation: it gets NaN and does not count among the others.
    """
    out = np.full(len(matrix), np.nan)
    varying = [i for i in range(len(matrix)) if not np.isnan(np.delete(matrix[i], i)).all()] if len(matrix) > 1 else list(range(len(matrix)))
    for i in varying:
        others = [j for j in varying if j != i]
        r = matrix[others, i]
        left = 1 - float(r @ np.linalg.pinv(matrix[np.ix_(others, others)], rcond=tolerance, hermitian=True) @ r)
        out[i] = np.inf if left <= tolerance else 1 / left
    return out


def vif_table(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """VIF per feature, from training rows only; NULL for a constant feature."""
    values = vif_values(correlation_matrix(train, features))
    rows = [(f, None if np.isnan(v) else float(v)) for f, v in zip(features, values)]
    return small_table(train.sparkSession, rows, "feature string, vif double")


def prune_steps(matrix: np.ndarray, features: Sequence[str], max_vif: float | None, max_r: float | None) -> list[tuple]:
    """Drop constant features, then the highest VIF until all are within the limit, then the later name of each correlated pair."""
    left = list(range(len(features)))
    steps: list[tuple] = []
    if max_vif is not None or max_r is not None:
        for i in [i for i in left if len(left) > 1 and np.isnan(np.delete(matrix[i], i)).all()]:
            steps.append((features[i], "dropped", len(steps) + 1, "constant", None))
            left.remove(i)
    while max_vif is not None and len(left) > 1:
        v = vif_values(matrix[np.ix_(left, left)])
        worst = max(range(len(left)), key=lambda i: (v[i], features[left[i]]))
        if v[worst] <= max_vif:
            break
        steps.append((features[left[worst]], "dropped", len(steps) + 1, "vif", float(v[worst])))
        left.pop(worst)
    if max_r is not None:
        for i, j in combinations(sorted(left, key=lambda k: features[k]), 2):
            if i in left and j in left and abs(matrix[i, j]) > max_r:
                steps.append((features[j], "dropped", len(steps) + 1, "pair", float(abs(matrix[i, j]))))
                left.remove(j)
    return steps + [(features[i], "kept", 0, "", None) for i in left]


def collinearity_prune(
    train: DataFrame, features: Sequence[str], policies: Sequence[tuple[str, float | None, float | None]]
) -> DataFrame:
    """Kept and dropped features per policy (name, VIF limit, pair limit) with step and reason."""
    m = correlation_matrix(train, features)
    rows = [(name, *s) for name, v, r in policies for s in prune_steps(m, features, v, r)]
    return small_table(
        train.sparkSession, rows, "policy string, feature string, decision string, step bigint, reason string, value double"
    )


def lineage_coverage(stages: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of variables and rows per (adopted, live-reproducible) combination."""
    return stages.groupBy(*by).agg(
        F.count("*").alias("n_variables"),
        F.sum("n_raw").alias("n_raw"),
        F.sum("n_used").alias("n_used"),
        F.array_join(F.array_sort(F.collect_set("variable")), ",").alias("variables"),
    )
