"""Gradient boosting with Huber loss on binned features, for many expanding folds at once.

Each tree level is one aggregate: rows are counted and their pseudo-residuals summed by (fold, node, feature, bin), with partial sums before the shuffle, and
the best cut of each node is found on those few rows. Quantiles (bins, the Huber width, medians of leaves) come from mergeable sketches. Only models reach
the driver: cuts, widths, splits and leaf values of each fold. Sums are decimals, so a model does not depend on the order in which a cluster adds.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.session import materialize, small_table

EXACT = "decimal(28,6)"
SKETCH = 10_000  # accuracy of percentile sketches: exact up to about as many rows, relative rank error 1/10,000 beyond


@dataclass
class Tree:
    """Nodes 1 .. 2**depth - 1 in heap order: feature (-1: all rows go left) and threshold; values of the leaves 2**depth and up; the Huber width."""

    feature: list[int]
    cut: list[int]
    threshold: list[float]
    width: float
    value: list[float] = field(default_factory=list)


@dataclass
class HuberBooster:
    """One model per fold start: ``base`` and ``trees``; a fold without training rows has none."""

    features: list[str]
    depth: int
    rate: float
    base: dict[dt.date, float]
    trees: dict[dt.date, list[Tree]]
    train_rows: dict[dt.date, int]


def last_months(df: DataFrame, time: str, n: int) -> list[dt.date]:
    """The first days of the last ``n`` months of the table, in order; none for an empty table."""
    last = df.agg(F.trunc(F.max(time), "month").alias("m")).first()["m"]
    if last is None:
        return []
    months = last.year * 12 + last.month - 1
    return [dt.date((months - k) // 12, (months - k) % 12 + 1, 1) for k in range(n - 1, -1, -1)]


def _dates(starts: Sequence[dt.date]) -> Column:
    return F.array(*[F.lit(s) for s in starts]) if starts else F.array().cast("array<date>")


def _features(names: Sequence[str]) -> Column:
    """NaN is absent, as NULL is."""
    return F.array(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in names])


def _quantile(x: Column | str, p: float | list[float]) -> Column:
    return F.percentile_approx(x, p, SKETCH)


def _descend(depth: int, step) -> Column:
    """The node that a row comes to after ``depth`` steps; ``step(node)`` says whether it goes right."""
    return reduce(lambda node, _: 2 * node + F.when(step(node), 1).otherwise(0), range(depth), F.lit(1))


def fit_huber_booster(
    df: DataFrame, time: str, features: Sequence[str], label: str, starts: Sequence[dt.date],
    rounds: int = 50, depth: int = 3, rate: float = 0.1, bins: int = 32, alpha: float = 0.9, min_leaf: int = 1,
) -> HuberBooster:
    """For each fold start a booster learned from the rows before it.

    A round fits a tree to the pseudo-residuals of the Huber loss, whose width is the ``alpha`` quantile of the absolute residuals. A split
    maximises the drop of squared error among ``bins`` quantile bins of a feature; ties go to the first feature, then the lowest cut. A leaf's
    value is the median of its residuals, moved by the mean of what lies around it, clipped to the width. Rows without the label or the time are not learned from;
    an absent feature lies below all others. Each fold has predictions of its own, so a row is copied for each later fold.
    """
    names, n_nodes = list(features), 1 << depth
    rows = df.where(F.col(label).isNotNull()).select(_features(names).alias("x"), F.col(label).cast("double").alias("y"), F.explode(F.filter(_dates(starts), lambda s: F.col(time) < s)).alias("fold"))
    probabilities = [k / bins for k in range(1, bins)]
    cut_lists = F.array(*[F.array_sort(F.array_distinct(_quantile(F.col("x")[i], probabilities))) for i in range(len(names))])
    fitted = rows.groupBy("fold").agg(F.count("*").alias("n"), _quantile("y", 0.5).alias("base"), cut_lists.alias("cuts")).collect()
    model = HuberBooster(names, depth, rate, {r["fold"]: r["base"] for r in fitted}, {r["fold"]: [] for r in fitted}, {r["fold"]: r["n"] for r in fitted})
    if not fitted:
        return model
    cuts = {r["fold"]: [c or [] for c in r["cuts"]] for r in fitted}
    spark = df.sparkSession
    table = small_table(spark, [(f, model.base[f], c) for f, c in cuts.items()], "fold date, pred double, cuts array<array<double>>")
    below = F.transform("x", lambda v, i: F.size(F.filter(F.col("cuts")[i], lambda c: c < v)))
    binned = F.transform("x", lambda v, i: F.when(v.isNull(), -1).otherwise(below[i]))
    state = materialize(rows.join(table, "fold").select("fold", "y", binned.alias("bin"), "pred"), "boosting")

    for _ in range(rounds):
        residual = state.withColumn("r", F.col("y") - F.col("pred"))
        widths = {r["fold"]: r["w"] for r in residual.groupBy("fold").agg(_quantile(F.abs("r"), alpha).alias("w")).collect()}
        trees = {f: Tree([-1] * n_nodes, [-1] * n_nodes, [math.inf] * n_nodes, widths[f]) for f in widths}

        def placed(level: int) -> DataFrame:
            """Rows with the Huber width and the node that they come to by the splits so far."""
            known = small_table(spark, [(f, widths[f], t.feature, t.cut) for f, t in trees.items()], "fold date, w double, feature array<int>, cut array<int>")
            right = lambda node: (F.col("feature")[node] >= 0) & (F.get("bin", F.col("feature")[node]) > F.col("cut")[node])
            return residual.join(known, "fold").withColumn("node", _descend(level, right)).drop("feature", "cut")

        for level in range(depth):
            pulled = F.greatest(F.least("r", "w"), -F.col("w")).cast(EXACT).alias("g")
            cells = placed(level).select("fold", "node", pulled, F.posexplode("bin").alias("feature", "bin"))
            sums = cells.groupBy("fold", "node", "feature", "bin").agg(F.count("*").alias("n"), F.sum("g").alias("g"))
            cell = Window.partitionBy("fold", "node", "feature")
            upto = cell.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
            sums = sums.select("fold", "node", "feature", "bin", *[F.sum(c).over(upto).cast("double").alias(f"l{c}") for c in "ng"], *[F.sum(c).over(cell).cast("double").alias(f"a{c}") for c in "ng"])
            rn, rg = F.col("an") - F.col("ln"), F.col("ag") - F.col("lg")
            gain = F.col("lg") * F.col("lg") / F.col("ln") + F.try_divide(rg * rg, rn) - F.col("ag") * F.col("ag") / F.col("an")
            split = sums.where((F.col("ln") >= min_leaf) & (rn >= min_leaf)).withColumn("gain", gain).where("gain > 0")
            best = split.groupBy("fold", "node").agg(F.min_by(F.struct("feature", "bin"), F.struct(-F.col("gain"), "feature", "bin")).alias("s"))
            for r in best.collect():
                tree, node, (feature, cut) = trees[r["fold"]], r["node"], r["s"]
                tree.feature[node], tree.cut[node] = feature, cut
                tree.threshold[node] = cuts[r["fold"]][feature][cut] if cut >= 0 else -math.inf

        leaves = placed(depth)
        medians = leaves.groupBy("fold", "node").agg(_quantile("r", 0.5).alias("m"))
        off = F.col("r") - F.col("m")
        moved = F.greatest(F.least(off, F.col("w")), -F.col("w")).cast(EXACT)
        values = leaves.join(medians, ["fold", "node"]).groupBy("fold", "node").agg((F.max("m") + F.sum(moved).cast("double") / F.count("*")).alias("v"))
        for tree in trees.values():
            tree.value = [0.0] * n_nodes
        for r in values.collect():
            trees[r["fold"]].value[r["node"] - n_nodes] = r["v"]
        for f, t in trees.items():
            model.trees[f].append(t)
        added = small_table(spark, [(f, t.value) for f, t in trees.items()], "fold date, value array<double>")
        step = rate * F.col("value")[F.col("node") - n_nodes]
        state = materialize(leaves.join(added, "fold").select("fold", "y", "bin", (F.col("pred") + step).alias("pred")), "boosting")
    return model


def score_huber_booster(df: DataFrame, model: HuberBooster, time: str, starts: Sequence[dt.date]) -> DataFrame:
    """The rows of all folds with ``fold_start``, ``train_rows`` and ``pred`` by the model of their fold; a fold ends where the next one starts.

    ``pred`` is NULL in a fold without training rows. Rows before the first start belong to no fold.
    """
    fold = F.coalesce(F.lit(None).cast("date"), *[F.when(F.col(time) >= s, F.lit(s)) for s in sorted(starts, reverse=True)])
    records = [(f, model.train_rows[f], model.base[f], [(t.feature, t.threshold, t.value) for t in trees]) for f, trees in model.trees.items()]
    schema = "fold_start date, train_rows bigint, _base double, _trees array<struct<feature: array<int>, threshold: array<double>, value: array<double>>>"
    known = small_table(df.sparkSession, [(f, n, b, [dict(zip(("feature", "threshold", "value"), t)) for t in trees]) for f, n, b, trees in records], schema)
    rows = df.withColumn("fold_start", fold).where(F.col("fold_start").isNotNull()).withColumn("_x", _features(model.features)).join(known, "fold_start", "left")

    def value(tree: Column) -> Column:
        right = lambda node: F.coalesce((tree["feature"][node] >= 0) & (F.get("_x", tree["feature"][node]) > tree["threshold"][node]), F.lit(False))
        return tree["value"][_descend(model.depth, right) - (1 << model.depth)]

    # The trees of a fold are few hundred numbers; the sum runs in their order.
    pred = F.aggregate("_trees", F.col("_base"), lambda p, t: p + model.rate * value(t))
    out = rows.withColumn("pred", F.when(F.col("_base").isNotNull(), pred)).fillna({"train_rows": 0})
    return out.select(*df.columns, "fold_start", "train_rows", "pred")


def booster_sql(rows: str, features: Sequence[str], rounds: int, depth: int, rate: float, bins: int, alpha: float, min_leaf: int) -> str:
    """CTEs that state the same booster over ``rows`` (k, fold, y, features); the last is ``pred{rounds}`` (k, fold, pred) over ``held``.

    ``held`` (k, fold, features) are the rows to score. Learned and scored rows go down the trees together.
    """
    xs = ", ".join(features)
    quantile = lambda x, p: f"list_sort(list({x}))[CAST(ceil(CAST({p} AS DOUBLE) * count({x})) AS BIGINT)]"
    ctes = [
        f"tr AS MATERIALIZED ({rows})",
        f"lx AS MATERIALIZED (SELECT k, fold, list_position([{', '.join(repr(f) for f in features)}], name) - 1 AS f, x FROM (UNPIVOT tr ON {xs} INTO NAME name VALUE x))",
        f"cu AS MATERIALIZED (SELECT DISTINCT fold, f, v[CAST(ceil(i / CAST({bins} AS DOUBLE) * len(v)) AS BIGINT)] AS c FROM (SELECT fold, f, list_sort(list(x)) AS v FROM lx GROUP BY fold, f), range(1, {bins}) AS q(i))",
        "al AS MATERIALIZED (SELECT k, fold, true AS learn, y, " + xs + " FROM tr UNION ALL SELECT k, fold, false, NULL, " + xs + " FROM held)",
        f"ax AS MATERIALIZED (SELECT b.k, b.fold, b.learn, b.f, CASE WHEN any_value(b.x) IS NULL THEN -1 ELSE count(*) FILTER (cu.c < b.x) END AS bin FROM (SELECT k, fold, learn, unnest(range({len(features)})) AS f, unnest([{xs}]) AS x FROM al) b LEFT JOIN cu ON cu.fold = b.fold AND cu.f = b.f GROUP BY ALL)",
        f"s0 AS MATERIALIZED (SELECT k, fold, learn, y, b.base AS pred FROM al JOIN (SELECT fold, {quantile('y', 0.5)} AS base FROM tr GROUP BY fold) b USING (fold))",
    ]
    for t in range(rounds):
        ctes.append(f"w{t} AS MATERIALIZED (SELECT fold, {quantile('abs(y - pred)', alpha)} AS w FROM s{t} WHERE learn GROUP BY fold)")
        ctes.append(f"n{t}_0 AS MATERIALIZED (SELECT s.*, y - pred AS r, w, CAST(1 AS BIGINT) AS node FROM s{t} s JOIN w{t} USING (fold))")
        for d in range(depth):
            n = f"n{t}_{d}"
            ctes.append(f"h{t}_{d} AS (SELECT {n}.fold, node, f, bin, count(*) AS n, sum(CAST(greatest(least(r, w), -w) AS DECIMAL(28,6))) AS g FROM {n} JOIN ax USING (k, fold, learn) WHERE {n}.learn GROUP BY ALL)")
            ctes.append(
                f"c{t}_{d} AS (SELECT fold, node, f, bin, CAST(sum(n) OVER o AS DOUBLE) AS ln, CAST(sum(g) OVER o AS DOUBLE) AS lg, CAST(sum(n) OVER a AS DOUBLE) AS an, CAST(sum(g) OVER a AS DOUBLE) AS ag "
                f"FROM h{t}_{d} WINDOW o AS (PARTITION BY fold, node, f ORDER BY bin ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY fold, node, f))"
            )
            ctes.append(
                f"b{t}_{d} AS MATERIALIZED (SELECT DISTINCT ON (fold, node) fold, node, f, bin AS cut FROM (SELECT *, lg * lg / ln + (ag - lg) * (ag - lg) / nullif(an - ln, 0) - ag * ag / an AS gain FROM c{t}_{d} "
                f"WHERE ln >= {min_leaf} AND an - ln >= {min_leaf}) WHERE gain > 0 ORDER BY fold, node, gain DESC, f, bin)"
            )
            ctes.append(
                f"n{t}_{d + 1} AS MATERIALIZED (SELECT n.* EXCLUDE (node), 2 * n.node + CASE WHEN ax.bin > b.cut THEN 1 ELSE 0 END AS node FROM {n} n LEFT JOIN b{t}_{d} b ON b.fold = n.fold AND b.node = n.node "
                f"LEFT JOIN ax ON ax.k = n.k AND ax.fold = n.fold AND ax.learn = n.learn AND ax.f = b.f)"
            )
        last = f"n{t}_{depth}"
        ctes.append(f"m{t} AS (SELECT fold, node, {quantile('r', 0.5)} AS m FROM {last} WHERE learn GROUP BY ALL)")
        ctes.append(f"v{t} AS MATERIALIZED (SELECT fold, node, max(m) + CAST(sum(CAST(greatest(least(r - m, w), -w) AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS v FROM {last} JOIN m{t} USING (fold, node) WHERE learn GROUP BY ALL)")
        ctes.append(f"s{t + 1} AS MATERIALIZED (SELECT k, fold, learn, y, pred + {rate} * coalesce(v, 0) AS pred FROM {last} LEFT JOIN v{t} USING (fold, node))")
    ctes.append(f"pred{rounds} AS (SELECT k, fold, pred FROM s{rounds} WHERE NOT learn)")
    return ",\n".join(ctes)
