"""Queries over the monthly and daily forecast tables: projections, scores, baselines, folds, verdicts."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from sunledger.functions import columns as C
from sunledger.functions.stats import bias_metrics, error_metrics
from sunledger.operators import baselines, metrics
from sunledger.plans.common import SCORE_SQL, rounded, scores
from sunledger.plans.registry import query
from sunledger.plans.views import OOF_BASELINES, OOF_MODELS, Tables

IDS = ["site", "month", "half", "actual_kwh"]
TPCH_SITES = ["ASIA", "EUROPE", "AMERICA", "AFRICA", "MIDDLE EAST"]


def long(t: Tables):
    return metrics.to_long(t.oof, IDS, OOF_MODELS)


def pairs(t: Tables):
    return metrics.paired_rows(t.oof, ["site", "month", "half"], OOF_MODELS, "candidate")


# --- projections and filters -------------------------------------------------------------------


@query("actual_and_model", "P1", "SELECT site, month, actual_kwh, last_year FROM oof")
def _(t: Tables):
    return t.oof.select("site", "month", "actual_kwh", "last_year")


@query(
    "complete_rows",
    "P2",
    "SELECT site, month, actual_kwh, last_year, candidate FROM oof WHERE last_year IS NOT NULL AND candidate IS NOT NULL "
    "AND actual_kwh IS NOT NULL",
)
def _(t: Tables):
    return t.oof.select("site", "month", "actual_kwh", "last_year", "candidate").dropna(
        subset=["actual_kwh", "last_year", "candidate"]
    )


@query("first_half_rows", "P3", "SELECT site, month, half, actual_kwh FROM oof WHERE half = '상반기'")
def _(t: Tables):
    return t.oof.where(F.col("half") == C.FIRST_HALF).select("site", "month", "half", "actual_kwh")


@query(
    "error_columns",
    "P4",
    "SELECT site, month, round(candidate - actual_kwh, 6) AS e, round(abs(candidate - actual_kwh), 6) AS abs_e, "
    "round((candidate - actual_kwh) * (candidate - actual_kwh) / 1e6, 4) AS sq_e_millions FROM oof",
)
def _(t: Tables):
    e = C.error("actual_kwh", "candidate")
    return t.oof.select(
        "site",
        "month",
        F.round(e, 6).alias("e"),
        F.round(F.abs(e), 6).alias("abs_e"),
        F.round(e * e / 1e6, 4).alias("sq_e_millions"),
    )


@query("models_long", "P5", "SELECT site, month, model, ordinal, pred FROM oof_long")
def _(t: Tables):
    return long(t).select("site", "month", "model", "ordinal", "pred")


@query(
    "ordered_pairs",
    "P6",
    "SELECT DISTINCT site, b.model AS comparison, x.model FROM oof_long b, (VALUES ('persistence'), ('last_year'), "
    "('seasonal_mean'), ('candidate')) AS x(model) WHERE x.model IN (b.model, 'candidate')",
)
def _(t: Tables):
    names = long(t).select("site", F.col("model").alias("comparison")).distinct()
    return names.withColumn("model", F.explode(F.array_distinct(F.array("comparison", F.lit("candidate")))))


@query("half_labels", "P7", "SELECT site, month, CASE WHEN month(month) < 7 THEN '상반기' ELSE '하반기' END AS half FROM site_month")
def _(t: Tables):
    return t.site_month.select("site", "month", C.half_label("month").alias("half"))


SEASON_SQL = (
    "CASE WHEN month({0}) IN (3, 4, 5) THEN 'spring' WHEN month({0}) IN (6, 7, 8) THEN 'summer' "
    "WHEN month({0}) IN (9, 10, 11) THEN 'autumn' ELSE 'winter' END"
)


@query(
    "season_totals",
    "P8",
    f"SELECT site, {SEASON_SQL.format('month')} AS season, CAST(count(*) AS BIGINT) AS n_months, "
    "round(sum(actual_kwh), 2) AS kwh FROM site_month GROUP BY 1, 2",
)
def _(t: Tables):
    return t.site_month.groupBy("site", C.season("month").alias("season")).agg(
        F.count("*").alias("n_months"), F.round(F.sum("actual_kwh"), 2).alias("kwh")
    )


# --- scores ------------------------------------------------------------------------------------


@query("candidate_metrics", "A1", f"SELECT site, {SCORE_SQL} FROM (SELECT site, actual_kwh, candidate AS pred FROM oof) GROUP BY site")
def _(t: Tables):
    return scores(metrics.metrics(t.oof, "candidate", by=["site"]))


@query(
    "metrics_by_slice",
    "A2",
    f"SELECT site, model, half, {SCORE_SQL} FROM oof_long GROUP BY site, model, half "
    f"UNION ALL SELECT site, model, '전체' AS half, {SCORE_SQL} FROM oof_long GROUP BY site, model",
)
def _(t: Tables):
    return scores(metrics.metrics_by_slice(long(t), ["site", "model"], "half", C.WHOLE))


@query("paired_metrics", "A3", f"SELECT site, comparison, ordinal, model, {SCORE_SQL} FROM oof_pairs GROUP BY 1, 2, 3, 4")
def _(t: Tables):
    return scores(metrics.paired_metrics(pairs(t), ["site"]))


@query(
    "paired_sample",
    "J1",
    "SELECT site, month, comparison, model, pred, actual_kwh FROM oof_pairs",
)
def _(t: Tables):
    return pairs(t).select("site", "month", "comparison", "model", "pred", "actual_kwh")


@query(
    "paired_metrics_by_half",
    "A4",
    f"SELECT site, half, comparison, ordinal, model, {SCORE_SQL} FROM oof_pairs GROUP BY 1, 2, 3, 4, 5",
)
def _(t: Tables):
    return scores(metrics.paired_metrics(pairs(t), ["site", "half"]))


@query(
    "bias_metrics",
    "A5",
    """SELECT site, model, CAST(count(pred) AS BIGINT) AS n, round(avg(pred - actual_kwh), 4) AS me,
       round(avg((pred - actual_kwh) / nullif(actual_kwh, 0)) * 100, 6) AS mpe,
       round(avg(abs((pred - actual_kwh) / nullif(actual_kwh, 0))) * 100, 6) AS mape,
       round(avg(power(pred - actual_kwh, 2)) / 1e6, 4) AS mse_millions
       FROM oof_long GROUP BY site, model""",
)
def _(t: Tables):
    out = long(t).groupBy("site", "model").agg(*bias_metrics("actual_kwh", "pred"))
    return out.select(
        "site", "model", "n", F.round("me", 4).alias("me"), F.round("mpe", 6).alias("mpe"),
        F.round("mape", 6).alias("mape"), F.round(F.col("mse") / 1e6, 4).alias("mse_millions"),
    )


@query(
    "best_baseline",
    "A10",
    f"""WITH s AS (SELECT site, half, model, {SCORE_SQL} FROM oof_long WHERE model <> 'candidate' GROUP BY 1, 2, 3)
        SELECT site, half, model AS best_model, wape AS best_wape FROM s
        QUALIFY row_number() OVER (PARTITION BY site, half ORDER BY wape, model) = 1""",
)
def _(t: Tables):
    own = metrics.metrics(long(t).where(F.col("model") != "candidate"), "pred", by=["site", "half", "model"])
    return metrics.best_model(scores(own), ["site", "half"])


@query(
    "comparable_samples",
    "A29",
    """SELECT site, CAST(count(*) FILTER (l.pred IS NOT NULL) AS BIGINT) AS n_left,
         CAST(count(*) FILTER (r.pred IS NOT NULL) AS BIGINT) AS n_right,
         CAST(count(*) FILTER ((l.pred IS NULL) <> (r.pred IS NULL)) AS BIGINT) AS n_unshared,
         CASE WHEN count(*) FILTER ((l.pred IS NULL) <> (r.pred IS NULL)) = 0 THEN 'comparable' ELSE 'different sample' END AS verdict
       FROM (SELECT * FROM oof_long WHERE model = 'last_year') l JOIN (SELECT * FROM oof_long WHERE model = 'candidate') r
       USING (site, month) GROUP BY site""",
)
def _(t: Tables):
    return metrics.comparability(long(t), ["site"], ["month"], "last_year", "candidate")


@query(
    "scorecard",
    "A30",
    f"""SELECT site, CASE WHEN year(month) < 1999 THEN 'before 1999' ELSE 'from 1999' END AS label, model,
        CAST(sum(train_rows) AS BIGINT) AS train_rows, {SCORE_SQL}
        FROM (SELECT l.*, (SELECT count(*) FROM site_month h WHERE h.site = l.site AND h.month < l.month) AS train_rows
              FROM oof_long l) GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    folds = baselines.history_before(t.oof, ["site"], C.month_index("month"), "actual_kwh")
    rows = metrics.to_long(folds, [*IDS, "train_rows"], OOF_MODELS)
    label = F.when(F.year("month") < 1999, "before 1999").otherwise("from 1999")
    return scores(
        rows.groupBy("site", label.alias("label"), "model").agg(
            F.sum("train_rows").alias("train_rows"), *error_metrics("actual_kwh", "pred")
        )
    )


@query(
    "site_order",
    "K1",
    """SELECT site, CAST(CASE site WHEN 'ASIA' THEN 1 WHEN 'EUROPE' THEN 2 WHEN 'AMERICA' THEN 3 WHEN 'AFRICA' THEN 4 ELSE 5 END AS INTEGER)
       AS site_no, model, ordinal, CAST(count(pred) AS BIGINT) AS n FROM oof_long GROUP BY ALL ORDER BY site_no, ordinal""",
)
def _(t: Tables):
    return (
        long(t)
        .groupBy("site", "model", "ordinal")
        .agg(F.count("pred").alias("n"))
        .select("site", metrics.order_of("site", TPCH_SITES).alias("site_no"), "model", "ordinal", "n")
        .orderBy("site_no", "ordinal")
    )


# --- baselines ---------------------------------------------------------------------------------


@query("persistence_forecast", "W1", "SELECT site, month, persistence FROM oof")
def _(t: Tables):
    return t.site_month.select(
        "site", "month", baselines.persistence(["site"], "month", "actual_kwh").alias("persistence")
    )


@query("same_month_last_year", "W2 J8", "SELECT site, month, last_year FROM oof")
def _(t: Tables):
    return t.site_month.select(
        "site", "month", baselines.same_month_last_year(["site"], "month", "actual_kwh").alias("last_year")
    )


@query(
    "seasonal_mean_forecast",
    "W3",
    """SELECT a.site, a.month, round(coalesce(
         (SELECT avg(h.actual_kwh) FROM site_month h WHERE h.site = a.site AND h.month < a.month AND month(h.month) = month(a.month)),
         (SELECT avg(h.actual_kwh) FROM site_month h WHERE h.site = a.site AND h.month < a.month
          AND h.month >= DATE '1995-06-01')), 4) AS seasonal_mean FROM site_month a""",
)
def _(t: Tables):
    made = baselines.seasonal_mean(["site"], "month", "actual_kwh", history_start="1995-06-01")
    return t.site_month.select("site", "month", F.round(made, 4).alias("seasonal_mean"))


@query(
    "fold_history",
    "J9",
    """SELECT a.site, a.month, CAST((SELECT count(*) FROM site_month h WHERE h.site = a.site AND h.month < a.month) AS BIGINT) AS train_rows,
       (SELECT round(sum(h.actual_kwh), 2) / count(*) FROM site_month h WHERE h.site = a.site AND h.month < a.month) AS train_mean
       FROM site_month a""",
)
def _(t: Tables):
    out = baselines.history_before(t.site_month, ["site"], C.month_index("month"), "actual_kwh", digits=2)
    return out.select("site", "month", "train_rows", "train_mean")


CLIM_SQL = f"""d AS (SELECT *, {SEASON_SQL.format('day')} AS season, CAST(year(day) * 12 + month(day) - 1 AS BIGINT) AS fold FROM site_day)"""


@query(
    "fold_climatology",
    "W4",
    f"""WITH {CLIM_SQL}, f AS (SELECT DISTINCT site, season, fold FROM d)
        SELECT f.site, f.season, f.fold, round(sum(h.actual_kwh), 2) / nullif(count(h.day), 0) AS clim, CAST(count(h.day) AS BIGINT) AS train_days
        FROM f LEFT JOIN d h ON h.site = f.site AND h.season = f.season AND h.fold < f.fold GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    fold = C.month_index("day").cast("bigint")
    return baselines.fold_climatology(t.site_day, ["site"], "day", "actual_kwh", fold, digits=2)


def daily_models(t: Tables):
    """Daily totals with persistence, fold climatology and a blend, by season."""
    fold = C.month_index("day").cast("bigint")
    clim = baselines.season_climatology(["site"], "day", "actual_kwh", fold, digits=2)
    days = baselines.daily_persistence(t.site_day, ["site"], "day", "actual_kwh")
    return (
        days.withColumns({"season": C.season("day"), "clim": clim})
        .withColumn("blend", F.round(0.6 * F.col("clim") + 0.4 * F.col("persistence"), 6))
        .where(F.col("clim").isNotNull() & F.col("persistence").isNotNull())
    )


DAILY_SQL = f"""{CLIM_SQL},
  c AS (SELECT f.site, f.season, f.fold, round(sum(h.actual_kwh), 2) / count(*) AS clim FROM (SELECT DISTINCT site, season, fold FROM d) f
        JOIN d h ON h.site = f.site AND h.season = f.season AND h.fold < f.fold GROUP BY 1, 2, 3),
  m AS (SELECT d.site, d.day, d.season, d.actual_kwh, p.actual_kwh AS persistence, c.clim,
          round(0.6 * c.clim + 0.4 * p.actual_kwh, 6) AS blend
        FROM d JOIN d p ON p.site = d.site AND p.day = d.day - 1 JOIN c ON c.site = d.site AND c.season = d.season AND c.fold = d.fold)"""


@query(
    "daily_persistence_gain",
    "W5",
    f"""WITH {DAILY_SQL} SELECT site, CAST(count(*) AS BIGINT) AS n, round(avg(abs(persistence - actual_kwh)), 4) AS persistence_mae,
        round(avg(abs(blend - actual_kwh)), 4) AS model_mae,
        round((avg(abs(persistence - actual_kwh)) - avg(abs(blend - actual_kwh))) / avg(abs(persistence - actual_kwh)) * 100, 6) AS gain_pct
        FROM m GROUP BY site""",
)
def _(t: Tables):
    e = F.avg(F.abs(C.error("actual_kwh", "persistence")))
    b = F.avg(F.abs(C.error("actual_kwh", "blend")))
    return daily_models(t).groupBy("site").agg(
        F.count("*").alias("n"),
        F.round(e, 4).alias("persistence_mae"),
        F.round(b, 4).alias("model_mae"),
        F.round(F.try_divide(e - b, e) * 100, 6).alias("gain_pct"),
    )


@query(
    "season_improvement",
    "A7 A8",
    f"""WITH {DAILY_SQL} SELECT site, season, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT day) AS BIGINT) AS days,
        round((avg(abs(clim - actual_kwh)) - avg(abs(blend - actual_kwh))) / avg(abs(clim - actual_kwh)) * 100, 6) AS mae_gain_pct,
        round((sqrt(avg(power(clim - actual_kwh, 2))) - sqrt(avg(power(blend - actual_kwh, 2)))) / sqrt(avg(power(clim - actual_kwh, 2))) * 100, 6) AS rmse_gain_pct,
        CASE WHEN count(DISTINCT day) >= 450 THEN 'sufficient' ELSE 'hold' END AS verdict
        FROM m GROUP BY site, season""",
)
def _(t: Tables):
    rows = metrics.to_long(daily_models(t), ["site", "season", "day", "actual_kwh"], ["clim", "blend"])
    gain = metrics.improvement(metrics.metrics(rows, "pred", by=["site", "season", "model"]), ["site", "season"], "blend", "clim")
    # site_day holds one row per day, so the row count of one model is the number of independent days.
    gain = gain.withColumn("days", F.col("n")).withColumn("verdict", metrics.sample_gate("days", 450))
    return rounded(gain, 6, "mae_gain_pct", "rmse_gain_pct")


@query(
    "independent_days",
    "A8",
    f"""SELECT site, {SEASON_SQL.format('hour')} AS season, CAST(sum(n_obs) AS BIGINT) AS n_rows, CAST(count(DISTINCT CAST(hour AS DATE)) AS BIGINT) AS days,
        CASE WHEN count(DISTINCT CAST(hour AS DATE)) >= 30 THEN 'sufficient' ELSE 'hold' END AS verdict FROM site_hour GROUP BY 1, 2""",
)
def _(t: Tables):
    rows = t.events.select((F.col("user_id") % 4).alias("site"), C.season("ts").alias("season"), "ts")
    out = metrics.independent_days(rows, ["site", "season"], "ts")
    return out.withColumn("verdict", metrics.sample_gate("days"))


@query(
    "walk_forward_folds",
    "W6",
    """WITH o AS (SELECT site, min(day) AS first FROM site_day GROUP BY site),
       b AS (SELECT d.site, o.first, CAST(floor((d.day - o.first) / 30.0) AS BIGINT) AS fold, count(*) AS test_rows
             FROM site_day d JOIN o ON o.site = d.site GROUP BY 1, 2, 3)
       SELECT b.site, b.fold, CAST(first + CAST(fold * 30 AS INTEGER) AS DATE) AS test_start,
         CAST(first + CAST(fold * 30 + 29 AS INTEGER) AS DATE) AS test_end,
         CAST((SELECT count(*) FROM site_day h WHERE h.site = b.site AND h.day < b.first + CAST(b.fold * 30 AS INTEGER)) AS BIGINT) AS train_rows,
         CAST(test_rows AS BIGINT) AS test_rows FROM b WHERE fold >= 4""",
)
def _(t: Tables):
    return baselines.walk_forward_folds(t.site_day, ["site"], "day", 30, 4)


@query(
    "boundary_purge",
    "W7",
    """SELECT site, CAST(year(day) * 12 + month(day) - 1 AS BIGINT) AS fold, CAST(count(*) AS BIGINT) AS kept_rows,
       max(day) AS last_issue FROM site_day WHERE month(day + 2) = month(day) GROUP BY 1, 2""",
)
def _(t: Tables):
    kept = baselines.purge_boundary(t.site_day, F.col("day"), F.date_add("day", 2), C.month_index)
    return kept.groupBy("site", C.month_index("day").cast("bigint").alias("fold")).agg(
        F.count("*").alias("kept_rows"), F.max("day").alias("last_issue")
    )


# --- verdicts and uncertainty ------------------------------------------------------------------


def flagship(t: Tables):
    """Candidate against every baseline on the common sample, with the duel result."""
    rows = pairs(t)
    sliced = rows.withColumn("_s", F.explode(F.array(F.lit(C.WHOLE), "half"))).drop("half").withColumnRenamed("_s", "half")
    return metrics.paired_metrics(sliced, ["site", "half"])


DUEL_SQL = f"""s AS (SELECT site, half, comparison, ordinal, model, {SCORE_SQL} FROM oof_pairs GROUP BY 1, 2, 3, 4, 5
    UNION ALL SELECT site, '전체', comparison, ordinal, model, {SCORE_SQL} FROM oof_pairs GROUP BY 1, 2, 3, 4, 5),
  q AS (SELECT b.site, b.half, b.comparison, b.n, c.mae < b.mae AS wins_mae, c.rmse < b.rmse AS wins_rmse, c.wape < b.wape AS wins_wape
    FROM s b JOIN s c ON c.site = b.site AND c.half = b.half AND c.comparison = b.comparison AND c.model = 'candidate'
    WHERE b.model <> 'candidate')"""


@query("candidate_duels", "A9", f"WITH {DUEL_SQL} SELECT *, wins_mae AND wins_rmse AND wins_wape AS wins_all FROM q")
def _(t: Tables):
    return metrics.duel(scores(flagship(t)), ["site", "half"], "candidate")


@query(
    "candidate_verdict",
    "A9",
    f"""WITH {DUEL_SQL}, w AS (SELECT *, wins_mae AND wins_rmse AND wins_wape AS wins_all FROM q),
        o AS (SELECT site, comparison, n FROM w WHERE half = '전체')
        SELECT w.site, coalesce(bool_and(wins_all) FILTER (w.half = '전체' AND o.n >= 75), false) AS wins_overall,
          coalesce(bool_and(wins_all) FILTER (w.half <> '전체' AND o.n >= 75), false) AS wins_slices,
          coalesce(string_agg(w.comparison, ',' ORDER BY w.comparison) FILTER (w.half = '전체' AND NOT wins_all AND o.n >= 75), '') AS lost_to,
          coalesce(string_agg(w.comparison, ',' ORDER BY w.comparison) FILTER (w.half = '전체' AND o.n < 75), '') AS excluded_thin, '' AS absent
        FROM w JOIN o ON o.site = w.site AND o.comparison = w.comparison GROUP BY w.site""",
)
def _(t: Tables):
    duels = metrics.duel(scores(flagship(t)), ["site", "half"], "candidate")
    return metrics.verdict(duels, ["site"], "half", C.WHOLE, OOF_BASELINES, [C.FIRST_HALF, C.SECOND_HALF], min_n=75)


@query(
    "policy_comparison",
    "A25",
    f"""WITH keys AS (SELECT site, month FROM oof_long WHERE pred IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 4)
        SELECT site, model, CAST((SELECT count(*) FROM oof_long x WHERE x.site = l.site AND x.model = l.model AND x.pred IS NOT NULL) AS BIGINT) AS own_rows,
          {SCORE_SQL} FROM oof_long l JOIN keys USING (site, month) GROUP BY site, model""",
)
def _(t: Tables):
    shared = t.oof.withColumn("_all", F.expr(" AND ".join(f"{m} IS NOT NULL" for m in OOF_MODELS)))
    rows = metrics.to_long(shared, [*IDS, "_all"], OOF_MODELS)
    common = F.when(F.col("_all"), F.col("pred"))
    return scores(
        rows.groupBy("site", "model").agg(F.count("pred").alias("own_rows"), *error_metrics("actual_kwh", common))
    )


@query(
    "common_test_rows",
    "U4",
    """SELECT site, month FROM oof WHERE last_year IS NOT NULL INTERSECT SELECT site, month FROM oof WHERE persistence IS NOT NULL
       INTERSECT SELECT site, month FROM oof WHERE candidate IS NOT NULL""",
)
def _(t: Tables):
    needed = ["last_year", "persistence", "candidate"]
    return t.oof.dropna(subset=needed).select("site", "month")


def _poisson_sql() -> str:
    """How many cumulative Poisson(1) probabilities lie at or below u, up to the eighteenth."""
    sums, total = [], 0.0
    for k in range(18):
        total += math.exp(-1) / math.factorial(k)
        sums.append(f"(u >= {total!r})::INT")
    return " + ".join(sums)


@query(
    "bootstrap_interval",
    "A26",
    f"""WITH b AS (SELECT site, CAST(date_trunc('month', month) AS DATE) AS block, sum(abs(candidate - actual_kwh) - abs(seasonal_mean - actual_kwh)) AS d,
         count(*) AS n FROM oof WHERE candidate IS NOT NULL AND seasonal_mean IS NOT NULL GROUP BY 1, 2),
       u AS (SELECT b.*, rep, ('0x' || substr(md5(concat_ws('|', strftime(block, '%Y-%m-%d'), CAST(rep AS VARCHAR))), 1, 8))::BIGINT / 4294967296.0 AS u
         FROM b, (SELECT unnest(generate_series(1, 100)) AS rep)),
       r AS (SELECT site, rep, sum(w * d) / nullif(sum(w * n), 0) AS diff FROM
         (SELECT *, {_poisson_sql()} AS w FROM u) GROUP BY 1, 2)
       SELECT site, round(quantile_cont(diff, 0.025), 4) AS lo, round(quantile_cont(diff, 0.5), 4) AS mid,
         round(quantile_cont(diff, 0.975), 4) AS hi FROM r GROUP BY site""",
)
def _(t: Tables):
    rows = t.oof.withColumns(
        {
            "loss_c": F.abs(C.error("actual_kwh", "candidate")),
            "loss_b": F.abs(C.error("actual_kwh", "seasonal_mean")),
        }
    )
    out = metrics.bootstrap_difference(
        rows, ["site"], ["month"], "loss_c", "loss_b", 100, metrics.poisson_weight(C.hash_uniform("month", "rep")),
        {"lo": 0.025, "mid": 0.5, "hi": 0.975},
    )
    return rounded(out, 4, "lo", "mid", "hi")


# --- chart data --------------------------------------------------------------------------------


@query(
    "line_chart_data",
    "C1",
    """SELECT site, month, 'actual' AS series, actual_kwh AS kwh FROM oof UNION ALL SELECT site, month, 'candidate', candidate FROM oof
       UNION ALL SELECT site, month, 'last_year', last_year FROM oof""",
)
def _(t: Tables):
    wide = t.oof.select("site", "month", F.col("actual_kwh").alias("actual"), "candidate", "last_year")
    return wide.unpivot(["site", "month"], ["actual", "candidate", "last_year"], "series", "kwh")


@query(
    "bar_chart_data",
    "C2",
    f"""WITH s AS (SELECT site, model, half, {SCORE_SQL} FROM oof_long WHERE model IN ('persistence', 'candidate') GROUP BY 1, 2, 3
          UNION ALL SELECT site, model, '전체', {SCORE_SQL} FROM oof_long WHERE model IN ('persistence', 'candidate') GROUP BY 1, 2)
        SELECT site, half, model, n, mae, round(1.2 * max(mae) OVER (PARTITION BY site, half), 3) AS axis_max FROM s""",
)
def _(t: Tables):
    wanted = long(t).where(F.col("model").isin("persistence", "candidate"))
    s = scores(metrics.metrics_by_slice(wanted, ["site", "model"], "half", C.WHOLE))
    panel = Window.partitionBy("site", "half")
    return s.select("site", "half", "model", "n", "mae", F.round(1.2 * F.max("mae").over(panel), 3).alias("axis_max"))
