"""Scores on own and common samples, gates and verdicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.columns import col
from sunledger.functions.stats import error_metrics, improvement_pct

SCORES = ("mae", "rmse", "wape")


def metrics(df: DataFrame, pred: str, actual: str = "actual_kwh", by: Sequence[str] = ()) -> DataFrame:
    """Score of one model column on its own sample."""
    return df.groupBy(*by).agg(*error_metrics(actual, pred))


def to_long(
    df: DataFrame, ids: Sequence[str], models: Sequence[str], value: str = "pred", suffix: str = ""
) -> DataFrame:
    """Wide model columns to (ids, model, ordinal, pred); the ordinal keeps the given model order."""
    cols = [m + suffix for m in models]
    long = df.unpivot([*ids], cols, "model", value)
    if suffix:
        long = long.withColumn("model", F.expr(f"substr(model, 1, length(model) - {len(suffix)})"))
    return long.withColumn("ordinal", order_of("model", models))


def order_of(name: str | Column, wanted: Sequence[str]) -> Column:
    """Position in a fixed list, from 1; names outside the list come last."""
    found = F.array_position(F.array(*[F.lit(w) for w in wanted]), col(name))
    return F.when(found > 0, found).otherwise(len(wanted) + 1).cast("int")


def metrics_by_slice(
    long: DataFrame, by: Sequence[str], slice_col: str, whole: str, actual: str = "actual_kwh", pred: str = "pred"
) -> DataFrame:
    """Scores per slice and over all slices in one pass; ``whole`` labels the total."""
    keyed = long.withColumn("_slice", F.col(slice_col))
    sets = keyed.groupingSets([[*by], [*by, "_slice"]], *by, "_slice")
    out = sets.agg(F.grouping("_slice").alias("_total"), *error_metrics(actual, pred))
    label = F.when(F.col("_total") == 1, F.lit(whole)).otherwise(F.col("_slice"))
    return out.select(*by, label.alias(slice_col), "n", *SCORES)


def paired_rows(
    wide: DataFrame, ids: Sequence[str], models: Sequence[str], candidate: str, actual: str = "actual_kwh", suffix: str = ""
) -> DataFrame:
    """Rows of each (comparison, model) on the sample both models share; one row where they are the same.

    The models are columns of one row, so the common sample needs no join.
    """
    pairs = []
    for i, m in enumerate(models, 1):
        names = [m] if m == candidate else [m, candidate]
        both = F.col(m + suffix).isNotNull() & F.col(candidate + suffix).isNotNull()
        for name in names:
            entry = F.struct(
                F.lit(m).alias("comparison"),
                F.lit(i).alias("ordinal"),
                F.lit(name).alias("model"),
                F.col(name + suffix).alias("pred"),
            )
            pairs.append(F.when(both, entry))
    return (
        wide.where(F.col(actual).isNotNull())
        .select(*ids, actual, F.explode(F.filter(F.array(*pairs), lambda p: p.isNotNull())).alias("p"))
        .select(*ids, actual, "p.comparison", "p.ordinal", "p.model", "p.pred")
    )


def paired_metrics(pairs: DataFrame, by: Sequence[str], actual: str = "actual_kwh") -> DataFrame:
    """Scores of candidate and baseline on their common sample."""
    return pairs.groupBy(*by, "comparison", "ordinal", "model").agg(*error_metrics(actual, "pred"))


def improvement(scores: DataFrame, by: Sequence[str], model: str, base: str) -> DataFrame:
    """Gain of ``model`` over ``base`` in percent of the baseline's MAE and RMSE."""
    pick = {name: F.col("model") == key for name, key in (("m", model), ("b", base))}
    side = scores.groupBy(*by).agg(
        *[F.max(F.when(cond, F.col(s))).alias(f"_{s}_{k}") for k, cond in pick.items() for s in ("mae", "rmse")],
        F.max(F.when(pick["m"], F.col("n"))).alias("n"),
    )
    return side.select(
        *by,
        "n",
        improvement_pct("_mae_b", "_mae_m").alias("mae_gain_pct"),
        improvement_pct("_rmse_b", "_rmse_m").alias("rmse_gain_pct"),
    )


def independent_days(df: DataFrame, by: Sequence[str], ts: str) -> DataFrame:
    """Rows and independent days per group, counted in two steps so that no task holds a set of days."""
    per_day = df.groupBy(*by, col(ts).cast("date").alias("_day")).agg(F.count("*").alias("_n"))
    return per_day.groupBy(*by).agg(F.sum("_n").alias("n_rows"), F.count("*").alias("days"))


def sample_gate(count: str | Column, threshold: int = 30) -> Column:
    """``sufficient`` from ``threshold`` independent days on, else ``hold``."""
    return F.when(col(count) >= threshold, "sufficient").otherwise("hold")


def duel(paired: DataFrame, by: Sequence[str], candidate: str) -> DataFrame:
    """One row per (by, comparison): which scores the candidate wins strictly on the common sample."""
    mine = F.col("model") == candidate
    wide = paired.where(F.col("comparison") != candidate).groupBy(*by, "comparison").agg(
        F.max("n").alias("n"),
        *[F.max(F.when(mine, F.col(s))).alias(f"_c_{s}") for s in SCORES],
        *[F.max(F.when(~mine, F.col(s))).alias(f"_b_{s}") for s in SCORES],
    )
    wins = [F.coalesce(F.col(f"_c_{s}") < F.col(f"_b_{s}"), F.lit(False)) for s in SCORES]
    return wide.select(
        *by, "comparison", "n", *[w.alias(f"wins_{s}") for w, s in zip(wins, SCORES)],
        (wins[0] & wins[1] & wins[2]).alias("wins_all"),
    )


def verdict(
    duels: DataFrame, by: Sequence[str], slice_col: str, whole: str, baselines: Sequence[str], slices: Sequence[str], min_n: int = 0
) -> DataFrame:
    """Does the candidate beat every listed baseline overall and in each of ``slices``?

    Baselines with fewer than ``min_n`` common rows overall are left out and named. A listed baseline without any row, or one
    that lacks a slice, is named in ``absent``, and the verdict over it is false.
    """
    listed = duels.where(F.col("comparison").isin(list(baselines)))
    total = F.col(slice_col) == whole
    thin = F.col("_overall_n") < min_n
    overall = (
        listed.where(total).select(*by, "comparison", F.col("n").alias("_overall_n"))
    )
    judged = listed.join(overall, [*by, "comparison"], "left").withColumn("_thin", F.coalesce(thin, F.lit(True)))
    failing = F.array_join(
        F.array_sort(F.collect_set(F.when(total & ~F.col("_thin") & ~F.col("wins_all"), F.col("comparison")))), ","
    )
    excluded = F.array_join(F.array_sort(F.collect_set(F.when(F.col("_thin"), F.col("comparison")))), ",")
    used = ~F.col("_thin")
    cell = F.concat_ws(":", F.col("comparison"), F.col(slice_col))
    out = judged.groupBy(*by).agg(
        F.coalesce(F.bool_and(F.when(total & used, F.col("wins_all"))), F.lit(False)).alias("wins_overall"),
        F.coalesce(F.bool_and(F.when(~total & used, F.col("wins_all"))), F.lit(False)).alias("wins_slices"),
        failing.alias("lost_to"),
        excluded.alias("excluded_thin"),
        F.collect_set(F.when(F.col("n") > 0, cell)).alias("_cells"),
        F.collect_set(F.when(F.col("_thin") & total, F.col("comparison"))).alias("_left_out"),
    )
    # At most baselines x (slices + 1) names.
    wanted = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(s).alias("s")) for b in baselines for s in (whole, *slices)])
    lacking = F.filter(wanted, lambda w: ~F.array_contains("_cells", F.concat_ws(":", w["b"], w["s"])) & ~F.array_contains("_left_out", w["b"]))
    absent = F.array_sort(F.array_distinct(F.transform(lacking, lambda w: F.when(w["s"] == whole, w["b"]).otherwise(F.concat_ws(":", w["b"], w["s"])))))
    whole_lacks = F.exists(lacking, lambda w: w["s"] == whole)
    return out.select(
        *by,
        (F.col("wins_overall") & ~whole_lacks).alias("wins_overall"),
        (F.col("wins_slices") & (F.size(lacking) == 0)).alias("wins_slices"),
        "lost_to",
        "excluded_thin",
        F.array_join(absent, ",").alias("absent"),
    )


def best_model(scores: DataFrame, by: Sequence[str], score: str = "wape") -> DataFrame:
    """Lowest score per group; ties go to the first name."""
    known = scores.where(F.col(score).isNotNull())
    return known.groupBy(*by).agg(
        F.min_by("model", F.struct(score, "model")).alias("best_model"), F.min(score).alias(f"best_{score}")
    )


def comparability(long: DataFrame, by: Sequence[str], target: Sequence[str], left: str, right: str) -> DataFrame:
    """May two models be compared? Only if they were scored on the same (by, target) keys.

    One aggregate over the keys replaces two set differences.
    """
    has = {
        side: F.max(F.when((F.col("model") == name) & F.col("pred").isNotNull(), 1).otherwise(0)).alias(side)
        for side, name in (("_l", left), ("_r", right))
    }
    keyed = long.where(F.col("model").isin(left, right) & F.col("actual_kwh").isNotNull())
    return (
        keyed.groupBy(*by, *target)
        .agg(*has.values())
        .groupBy(*by)
        .agg(
            F.sum("_l").alias("n_left"),
            F.sum("_r").alias("n_right"),
            F.sum(F.when(F.col("_l") != F.col("_r"), 1).otherwise(0)).alias("n_unshared"),
        )
        .withColumn("verdict", F.when(F.col("n_unshared") == 0, "comparable").otherwise("different sample"))
    )


def poisson_weight(u: Column, limit: float = 1e-15) -> Column:
    """Poisson(1) count of a uniform number, by inversion without a ceiling.

    Terms are added until the tail is below ``limit``, finer than the hash that makes ``u``, so no weight is cut.
    """
    steps, term, below, k = [], 0.36787944117144233, 0.36787944117144233, 0  # exp(-1)
    while term > limit:
        steps.append(F.when(u >= below, 1).otherwise(0))
        k += 1
        term /= k
        below += term
    total = F.lit(0)
    for s in steps:
        total = total + s
    return total


def bootstrap_difference(
    rows: DataFrame,
    by: Sequence[str],
    block: Sequence[str],
    loss_a: str,
    loss_b: str,
    replicates: int,
    weight: Column,
    quantiles: Mapping[str, float],
) -> DataFrame:
    """Block bootstrap interval of mean(loss_a) - mean(loss_b) on paired rows.

    Losses are summed per block before replicates are made, so the explosion is blocks x replicates.
    ``weight`` is a repeatable resampling weight over (block, ``rep``).
    """
    blocks = (
        rows.where(F.col(loss_a).isNotNull() & F.col(loss_b).isNotNull())
        .groupBy(*by, *block)
        .agg(F.sum(F.col(loss_a) - F.col(loss_b)).alias("_d"), F.count("*").alias("_n"))
    )
    reps = (
        blocks.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
        .withColumn("_w", weight)
        .groupBy(*by, "rep")
        .agg(F.try_divide(F.sum(F.col("_w") * F.col("_d")), F.sum(F.col("_w") * F.col("_n"))).alias("_diff"))
    )
    # ``replicates`` values per group, so an in-memory percentile is bounded.
    return reps.groupBy(*by).agg(*[F.percentile("_diff", q).alias(name) for name, q in quantiles.items()])
