"""Queries on feature diagnosis and walk-forward models."""

from __future__ import annotations

from pyspark.sql import functions as F

from sunledger.functions import columns as C
from sunledger.operators import boosting, features, models
from sunledger.plans.common import rounded
from sunledger.plans.registry import query
from sunledger.plans.views import OOF_MODELS, Tables
from sunledger.session import materialize, small_table

NAMES = ["quantity", "price", "discount", "tax"]


@query(
    "pearson_table",
    "A18",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, CAST(count(*) AS BIGINT) AS n, round(corr({a}, {b}), 6) AS r FROM features"
        for i, a in enumerate(NAMES)
        for b in NAMES[i + 1 :]
    ),
)
def _(t: Tables):
    return rounded(features.pearson_table(t.features, NAMES), 6, "r")


@query(
    "spearman_table",
    "A19",
    "WITH k AS (SELECT "
    + ", ".join(
        f"rank() OVER (ORDER BY {n}) + (count(*) OVER (PARTITION BY {n}) - 1) / 2.0 AS {n}_k" for n in NAMES
    )
    + " FROM features) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, CAST(count(*) AS BIGINT) AS n, round(corr({a}_k, {b}_k), 6) AS r FROM k"
        for i, a in enumerate(NAMES)
        for b in NAMES[i + 1 :]
    ),
)
def _(t: Tables):
    return rounded(features.spearman_table(t.features, NAMES), 6, "r")


@query(
    "spearman_with_gaps",
    "A19",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS x, '{b}' AS y, CAST(count(*) AS BIGINT) AS n, round(corr(ka, kb), 6) AS r FROM (
          SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ka, rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS kb
          FROM oof WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""
        for i, a in enumerate(["actual_kwh", *OOF_MODELS])
        for b in OOF_MODELS[i:]
    ),
)
def _(t: Tables):
    # Forecasts are NULL where history is short, for each model in other months.
    return rounded(features.spearman_table(t.oof, ["actual_kwh", *OOF_MODELS]), 6, "r")


@query(
    "vif_table",
    "A20",
    """WITH c AS (SELECT corr(quantity, price) AS a, corr(quantity, discount) AS b, corr(price, discount) AS c FROM features WHERE day < DATE '2000-01-01'),
       d AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM c)
       SELECT 'quantity' AS feature, round((1 - c * c) / det, 6) AS vif FROM d UNION ALL SELECT 'price', round((1 - b * b) / det, 6) FROM d
       UNION ALL SELECT 'discount', round((1 - a * a) / det, 6) FROM d""",
)
def _(t: Tables):
    train = t.features.where("day < DATE '2000-01-01'")
    return rounded(features.vif_table(train, ["quantity", "price", "discount"]), 6, "vif")


WIDE = ["discount", "net", "price", "quantity", "tax"]


def wide_features(t: Tables):
    return t.features.withColumn("net", F.col("price") * (1 - F.col("discount"))).where("day < DATE '2000-01-01'")


@query("collinearity_prune", "A21")
def _(t: Tables):
    policies = [("none", None, None), ("vif10_r0.8", 10.0, 0.8), ("vif5_r0.7", 5.0, 0.7)]
    return rounded(features.collinearity_prune(wide_features(t), WIDE, policies), 6, "value")


@query(
    "correlated_pairs",
    "A21",
    "WITH w AS (SELECT *, price * (1 - discount) AS net FROM features WHERE day < DATE '2000-01-01'), p AS ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS kept, '{b}' AS dropped, corr({a}, {b}) AS r FROM w" for i, a in enumerate(WIDE) for b in WIDE[i + 1 :]
    )
    + ") SELECT kept, dropped, round(r, 6) AS r FROM p WHERE abs(r) > 0.7",
)
def _(t: Tables):
    out = features.pearson_table(wide_features(t), WIDE).where(F.abs("r") > 0.7)
    return out.select(F.col("x").alias("kept"), F.col("y").alias("dropped"), F.round("r", 6).alias("r"))


@query(
    "feature_lineage",
    "A22",
    """WITH v AS (SELECT unit AS variable, CAST(count(*) AS BIGINT) AS n_raw, CAST(count(*) FILTER (TRY_CAST(raw AS DOUBLE) BETWEEN 0 AND 240) AS BIGINT) AS n_used,
         count(*) FILTER (TRY_CAST(raw AS DOUBLE) BETWEEN 0 AND 240) >= 0.93 * count(*) AS adopted,
         bool_or(ts >= TIMESTAMP '2024-01-22 00:00:00' AND TRY_CAST(raw AS DOUBLE) IS NOT NULL) AS live_reproducible FROM readings_raw GROUP BY 1)
       SELECT adopted, live_reproducible, CAST(count(*) AS BIGINT) AS n_variables, CAST(sum(n_raw) AS BIGINT) AS n_raw, CAST(sum(n_used) AS BIGINT) AS n_used,
         string_agg(variable, ',' ORDER BY variable) AS variables FROM v GROUP BY 1, 2""",
)
def _(t: Tables):
    v = C.parsed_value("raw")
    used = F.count_if(v.between(0, 240))
    live = (F.col("ts") >= F.lit("2024-01-22 00:00:00").cast("timestamp_ntz")) & v.isNotNull()
    stages = t.readings_raw.groupBy(F.col("unit").alias("variable")).agg(
        F.count("*").alias("n_raw"),
        used.alias("n_used"),
        (used >= 0.93 * F.count("*")).alias("adopted"),
        F.bool_or(live).alias("live_reproducible"),
    )
    return features.lineage_coverage(stages, ["adopted", "live_reproducible"])


# --- models ------------------------------------------------------------------------------------

LINE_SQL = """d AS (SELECT site, month, CAST(year(month) * 12 + month(month) - 1 AS BIGINT) AS fold, actual_kwh, n_days AS x FROM site_month),
  g AS (SELECT a.site, a.fold, count(*) AS n, avg(h.x) AS mx, avg(h.actual_kwh) AS my,
          regr_sxx(h.actual_kwh, h.x) AS sxx, regr_sxy(h.actual_kwh, h.x) AS sxy
        FROM d a JOIN d h ON h.site = a.site AND h.fold < a.fold GROUP BY 1, 2 HAVING count(*) >= 12)"""


def monthly_x(t: Tables):
    return t.site_month.select(
        "site", "month", C.month_index("month").cast("bigint").alias("fold"), "actual_kwh", F.col("n_days").cast("double").alias("x")
    )


def line(t: Tables, penalty: float):
    rows = monthly_x(t)
    fit = models.walk_forward_line(rows, ["site"], "fold", "x", "actual_kwh", penalty)
    out = models.score_line(rows, fit, ["site"], "fold", "x", 12).where(F.col("pred").isNotNull())
    return rounded(out.select("site", "month", "train_rows", "slope", "pred"), 1, "slope", "pred")


def line_sql(penalty: float) -> str:
    slope = f"sxy / nullif(sxx + {penalty}, 0)"
    return f"""WITH {LINE_SQL} SELECT d.site, d.month, CAST(n AS BIGINT) AS train_rows, round({slope}, 1) AS slope,
        round({slope} * d.x + my - {slope} * mx, 1) AS pred FROM d JOIN g USING (site, fold) WHERE {slope} IS NOT NULL"""


@query("linear_regression_oof", "M1", line_sql(0.0))
def _(t: Tables):
    return line(t, 0.0)


@query("ridge_oof", "M2", line_sql(10.0))
def _(t: Tables):
    return line(t, 10.0)


@query("ridge_oof_two_features", "M2")
def _(t: Tables):
    rows = monthly_x(t).withColumn("moy", F.cos(F.lit(6.283185307179586 / 12) * F.month("month")))
    fit = models.walk_forward_ridge(rows, ["site"], "fold", ["x", "moy"], "actual_kwh", 1.0)
    out = models.score_ridge(rows, fit, ["site"], "fold", ["x", "moy"])
    return rounded(out.where("train_rows >= 12").select("site", "month", "train_rows", "pred"), 2, "pred")


LEARNER_FEATURES = ["persistence", "last_year", "seasonal_mean", "n_days", "moy"]
FOLD_STARTS = ["1999-01-01", "1999-07-01", "2000-01-01", "2000-07-01"]


def learner_rows(t: Tables):
    rows = t.oof_with_days.where("site IS NOT NULL AND month IS NOT NULL")
    return rows.withColumn("moy", F.month("month").cast("double"))


def learner_oof(t: Tables, learner, name: str):
    """Out-of-fold rows; the scores of a trained learner cannot be stated in SQL, the folds are (``learner_folds``)."""
    rows = learner_rows(t).select("site", "month", "actual_kwh", *LEARNER_FEATURES)
    out = models.walk_forward_learner(rows, "month", ["site"], LEARNER_FEATURES, "actual_kwh", FOLD_STARTS, learner)
    return rounded(out.select("site", "month", "fold_start", "actual_kwh", "pred"), 2, "pred").withColumn("model", F.lit(name))


@query("boosted_tree_candidate", "M3")
def _(t: Tables):
    return learner_oof(t, models.boosted_trees("actual_kwh"), "boosted_trees")


@query("huber_candidate", "M4")
def _(t: Tables):
    return learner_oof(t, models.huber_line("actual_kwh"), "huber_line")


@query(
    "learner_folds",
    "M3 M4",
    """WITH r AS (SELECT month, persistence IS NOT NULL AND last_year IS NOT NULL AND seasonal_mean IS NOT NULL AND actual_kwh IS NOT NULL AS w FROM oof),
       f AS (SELECT * FROM (VALUES (DATE '1999-01-01', DATE '1999-07-01'), (DATE '1999-07-01', DATE '2000-01-01'), (DATE '2000-01-01', DATE '2000-07-01'),
         (DATE '2000-07-01', DATE '9999-12-31')) AS v(fold_start, fold_end))
       SELECT fold_start, fold_end, CAST(count(*) FILTER (month < fold_start AND w) AS BIGINT) AS train_rows, min(month) FILTER (month < fold_start AND w) AS train_from,
         max(month) FILTER (month < fold_start AND w) AS train_to, CAST(count(*) FILTER (month < fold_start AND NOT w) AS BIGINT) AS train_incomplete
       FROM f, r GROUP BY 1, 2""",
)
def _(t: Tables):
    return models.calendar_folds(learner_rows(t), "month", LEARNER_FEATURES, "actual_kwh", FOLD_STARTS)


BOOSTER = {"rounds": 4, "depth": 2, "rate": 0.3, "bins": 8, "alpha": 0.9, "min_leaf": 5}
N_FOLDS = 14
AS_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LEARNER_FEATURES)


def booster_query_sql(result: str, **other) -> str:
    ctes = boosting.booster_sql(f"SELECT k, fold, y, {', '.join(LEARNER_FEATURES)} FROM r JOIN f ON month < fold", LEARNER_FEATURES, **(BOOSTER | other))
    return f"""WITH r AS MATERIALIZED (SELECT site || month AS k, site, month, y, {AS_DOUBLES} FROM (SELECT o.*, actual_kwh AS y, n_days, month(month) AS moy FROM oof o JOIN (SELECT site, month, n_days FROM site_month) d USING (site, month))),
      f AS (SELECT CAST(unnest(generate_series(max(month) - INTERVAL {N_FOLDS - 1} MONTH, max(month), INTERVAL 1 MONTH)) AS DATE) AS fold FROM r),
      held AS (SELECT k, fold, {', '.join(LEARNER_FEATURES)} FROM r JOIN f ON month = fold), {ctes} {result}"""


def fitted_booster(t: Tables, **other):
    rows = materialize(learner_rows(t).select("site", "month", "actual_kwh", *LEARNER_FEATURES), "booster-rows")
    starts = boosting.last_months(rows, "month", N_FOLDS)
    return rows, starts, boosting.fit_huber_booster(rows, "month", LEARNER_FEATURES, "actual_kwh", starts, **(BOOSTER | other))


@query(
    "huber_boosting_oof",
    "M4 W6",
    booster_query_sql(
        """SELECT site, month, fold AS fold_start, CAST((SELECT count(*) FROM tr WHERE tr.fold = p.fold) AS BIGINT) AS train_rows, y AS actual_kwh, round(pred, 2) AS pred
        FROM pred4 p JOIN r USING (k)"""
    ),
)
def _(t: Tables):
    rows, starts, model = fitted_booster(t)
    out = boosting.score_huber_booster(rows, model, "month", starts)
    return rounded(out.select("site", "month", "fold_start", "train_rows", "actual_kwh", "pred"), 2, "pred")


@query(
    "huber_stumps",
    "M4",
    booster_query_sql(
        f"""SELECT fold AS fold_start, b.f AS feature_no, CAST(coalesce((SELECT c FROM (SELECT c, row_number() OVER (ORDER BY c) - 1 AS i FROM cu WHERE cu.fold = v.fold AND cu.f = b.f) WHERE i = b.cut), 'infinity') AS DOUBLE) AS threshold,
        round(any_value(w), 4) AS width, round(max(v) FILTER (node = 2), 4) AS left_value, round(max(v) FILTER (node = 3), 4) AS right_value
        FROM v0 v JOIN w0 USING (fold) LEFT JOIN (SELECT * EXCLUDE (node) FROM b0_0) b USING (fold) GROUP BY ALL""".replace("v.fold AND", "b.fold AND"),
        rounds=1, depth=1,
    ),
)
def _(t: Tables):
    # One round of depth 1 shows what a round learns: the split, and the values of its two leaves.
    _, _, model = fitted_booster(t, rounds=1, depth=1)
    stumps = [(f, tree.feature[1], tree.threshold[1], tree.width, *tree.value) for f, (tree,) in model.trees.items()]
    out = small_table(t.spark, stumps, "fold_start date, feature_no bigint, threshold double, width double, left_value double, right_value double")
    return rounded(out, 4, "width", "left_value", "right_value")
