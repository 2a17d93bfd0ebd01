"""Row quality, unit checks, capacity roles and reference limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.columns import as_time, clip, col, epoch_seconds
from sunledger.operators.scans import DAY, MINUTE, exact_quantiles, scan, time_bucket


def flag_range(df: DataFrame, limits: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Mark values outside the limits of their group; groups without limits are ``no_limit``."""
    inside = F.col(value).between(F.col("lo"), F.col("hi"))
    state = (
        F.when(F.col(value).isNull(), "missing")
        .when(F.col("lo").isNull(), "no_limit")
        .when(inside, "ok")
        .otherwise("range_violation")
    )
    return df.join(limits, list(on), "left").withColumn("range_state", state).drop("lo", "hi")


def quality_state(raw_status: str | Column, in_range: Column, filled: Column | None = None) -> Column:
    """One state per value: observed, interpolated, comm_missing, source_missing or range_violation."""
    s = col(raw_status)
    out = F.when((s == "ok") & ~in_range, "range_violation").when(s == "ok", "observed")
    if filled is not None:
        out = out.when(filled.isNotNull(), "interpolated")
    return out.when(s == "comm_error", "comm_missing").otherwise("source_missing")


def state_counts(df: DataFrame, by: Sequence[str | Column], state: str, states: Sequence[str]) -> DataFrame:
    """Counts per state, carried along any aggregation."""
    return df.groupBy(*by).agg(*[F.count_if(F.col(state) == s).alias(f"n_{s}") for s in states])


def screen_invalid(value: str, known_invalid: float) -> Column:
    """Status that excludes a known invalid measurement from alarms without changing the raw value."""
    return F.when(F.col(value).isNull(), "missing").when(F.col(value) == known_invalid, "not_valid").otherwise("valid")


def _inside_periods(df: DataFrame, periods: DataFrame, on: Sequence[str], ts: str) -> DataFrame:
    """Add ``_inside``: does ``ts`` lie in a listed period of its unit (start included, end excluded)?

    A period without an end is open: it covers everything from its start on. Periods are laid out by (unit, day), only over
    the days that the unit has rows in, and folded to one short array each, so a row is never multiplied, is
    compared only with the periods of its own day, and a busy unit is spread over its days.
    """
    spans = df.groupBy(*on).agg(F.min(time_bucket(ts, DAY)).alias("_a"), F.max(time_bucket(ts, DAY)).alias("_b"))
    last = F.coalesce(F.col("to_ts"), F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))
    held = periods.withColumn("to_ts", last).where(F.col("from_ts") < F.col("to_ts")).join(spans, list(on))
    a, b = F.greatest(time_bucket("from_ts", DAY), "_a"), F.least(time_bucket("to_ts", DAY), "_b")
    by_day = held.where(a <= b).select(*on, "from_ts", "to_ts", F.explode(F.sequence(a, b)).alias("_day"))
    lists = by_day.groupBy(*on, "_day").agg(F.collect_set(F.struct("from_ts", "to_ts")).alias("_periods"))
    hit = F.exists("_periods", lambda p: (F.col(ts) >= p["from_ts"]) & (F.col(ts) < p["to_ts"]))
    out = df.withColumn("_day", time_bucket(ts, DAY)).join(lists, [*on, "_day"], "left")
    return out.withColumn("_inside", F.coalesce(hit, F.lit(False))).drop("_day", "_periods")


def exclude_periods(df: DataFrame, periods: DataFrame, on: Sequence[str], ts: str) -> DataFrame:
    """Drop rows inside listed periods of their unit."""
    return _inside_periods(df, periods, on, ts).where(~F.col("_inside")).drop("_inside").select(*df.columns)


def audit_state(df: DataFrame, periods: DataFrame, audited: Sequence[str], on: str, ts: str) -> DataFrame:
    """``defect``, ``audited`` or ``unaudited``: no listed defect is no proof without an audit."""
    state = F.when(F.col("_inside"), "defect").when(F.col(on).isin(list(audited)), "audited").otherwise("unaudited")
    rows = _inside_periods(df, periods, [on], ts).withColumn("audit_state", state)
    return rows.select(*df.columns, "audit_state")


def scale_check(df: DataFrame, by: Sequence[str], fine: str, coarse: str, factor: float, lo: float, hi: float) -> DataFrame:
    """Do two columns describe one quantity at a fixed factor? Count mismatches and invalid ranges."""
    both = F.col(fine).isNotNull() & F.col(coarse).isNotNull()
    off = both & (F.abs(F.col(fine) - F.lit(factor) * F.col(coarse)) > 1e-6)
    return df.groupBy(*by).agg(
        F.count_if(both).alias("n_compared"),
        F.count_if(off).alias("n_mismatch"),
        F.count_if(both & (F.abs(F.col(fine) - F.col(coarse)) <= 1e-6) & (F.col(fine) != 0)).alias("n_same_scale"),
        F.count_if(~F.col(fine).between(lo, hi)).alias("n_out_of_range"),
        F.coalesce(~F.bool_or(off), F.lit(True)).alias("consistent"),
    )


def clip_predictions(df: DataFrame, capacity: DataFrame, on: Sequence[str], role: str, pred: str) -> DataFrame:
    """Clip a prediction to [0, capacity] by the capacity role meant for clipping."""
    return with_capacity(df, capacity, on, role).withColumn("clipped", clip(pred, "capacity_kw"))


def with_capacity(df: DataFrame, capacity: DataFrame, on: Sequence[str], role: str) -> DataFrame:
    """Add the capacity of one role; roles are never mixed. The optimizer broadcasts small registers."""
    one = capacity.where(F.col("role") == role).select(*on, F.col("kw").alias("capacity_kw"))
    return df.join(one, list(on), "left")


def normalized_scores(df: DataFrame, by: Sequence[str], actual: str, pred: str, capacity: str) -> DataFrame:
    """nMAE and nRMSE in percent of the capacity of each row."""
    e = (F.col(pred) - F.col(actual)) / F.when(F.col(capacity) > 0, F.col(capacity))
    return df.groupBy(*by).agg(
        F.count(e).alias("n"), (F.avg(F.abs(e)) * 100).alias("nmae"), (F.sqrt(F.avg(e * e)) * 100).alias("nrmse")
    )


def complete_only(df: DataFrame, observed: str, expected: Column, value: str, min_ratio: float) -> DataFrame:
    """Keep the value of complete periods; others get NULL and a reason."""
    ratio = F.try_divide(F.col(observed), expected)
    done = F.coalesce(ratio >= min_ratio, F.lit(False))
    return df.withColumns(
        {
            "coverage": ratio,
            "complete_value": F.when(done, F.col(value)),
            "reason": F.when(~done, "incomplete"),
        }
    )


def peer_mean(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean of the other units of the same group and time.

    Group sums are joined back, so a site with very many units never lands in one window partition.
    """
    totals = df.groupBy(*by).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    others = F.col("_n") - F.when(F.col(value).isNotNull(), 1).otherwise(0)
    rest = F.col("_sum") - F.coalesce(F.col(value), F.lit(0.0))
    return (
        df.join(totals, list(by), "left")
        .withColumns({"n_peers": others, "peer_mean": F.try_divide(rest, others)})
        .drop("_sum", "_n")
    )


def conditional_iqr(df: DataFrame, by: Sequence[str], value: str, k: float = 1.5) -> DataFrame:
    """Flag values outside [Q1 - k IQR, Q3 + k IQR] of their condition (hour or elevation bin)."""
    q = exact_quantiles(df, by, value, {"q1": 0.25, "q3": 0.75})
    lo = F.col("q1") - k * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + k * (F.col("q3") - F.col("q1"))
    return df.join(q, list(by), "left").withColumn("outlier", ~F.col(value).between(lo, hi))


def peer_deviation(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    capacity: str,
    verified: str,
    light: str,
    min_light: float,
    limit: float,
) -> DataFrame:
    """Compare capacity-normalised output with the median of the same time.

    Dark rows are left out of the medians; units without a verified capacity are ``cannot_judge``.
    """
    norm = F.when((F.col(light) >= min_light) & F.col(verified) & (F.col(capacity) > 0), F.col(value) / F.col(capacity))
    work = df.withColumn("norm", norm)
    mid = exact_quantiles(work, by, "norm", {"median_norm": 0.5})
    state = (
        F.when(~F.col(verified), "cannot_judge")
        .when(F.col(light) < min_light, "low_light")
        .when(F.col("norm").isNull() | F.col("median_norm").isNull(), "cannot_judge")
        .when(F.col("norm") < F.col("median_norm") * (1 - limit), "low")
        .when(F.col("norm") > F.col("median_norm") * (1 + limit), "high")
        .otherwise("normal")
    )
    return work.join(mid, list(by), "left").withColumn("peer_state", state)


def control_chart(df: DataFrame, by: Sequence[str], ts: str, value: str, start: str, end: str, sigmas: float = 3.0) -> DataFrame:
    """Centre line and limits from a stated baseline period; every point is compared with them."""
    base = df.where((F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz")))
    lines = base.groupBy(*by).agg(F.avg(value).alias("centre"), F.stddev_pop(value).alias("_sd"))
    out = df.join(lines, list(by), "left")
    return out.select(
        *df.columns,
        "centre",
        (F.col("centre") + sigmas * F.col("_sd")).alias("ucl"),
        (F.col("centre") - sigmas * F.col("_sd")).alias("lcl"),
    ).withColumn("outside", ~F.col(value).between(F.col("lcl"), F.col("ucl")))


def meter_increments(df: DataFrame, keys: Sequence[str], ts: str, tie: str, counter: str) -> DataFrame:
    """Difference to the previous counter reading; after a reset the new reading itself counts."""
    prev = scan(df, keys, time_bucket(ts, MINUTE), [ts, tie], before={"prev_counter": F.col(counter)})
    reset = F.col(counter) < F.col("prev_counter")
    step = F.when(F.col("prev_counter").isNull(), F.lit(None)).when(reset, F.col(counter)).otherwise(
        F.col(counter) - F.col("prev_counter")
    )
    return prev.withColumns({"increment": step, "is_reset": F.coalesce(reset, F.lit(False))})


def stuck_runs(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, min_run: int) -> DataFrame:
    """Runs in which the source returned the same value again, at least ``min_run`` readings long."""
    order = [ts, tie]
    bucket = time_bucket(ts, MINUTE)
    prev = scan(df, keys, bucket, order, before={"_prev": F.col(value)})
    change = F.when(F.col("_prev").isNull() | (F.col("_prev") != F.col(value)), F.col(tie))
    runs = scan(prev.withColumn("_start", change), keys, bucket, order, before={"run_id": F.col("_start")}, inclusive=True)
    return (
        runs.groupBy(*keys, "run_id", F.col(value))
        .agg(F.min(ts).alias("from_ts"), F.max(ts).alias("to_ts"), F.count("*").alias("run_length"))
        .where(F.col("run_length") >= min_run)
    )


def unit_ratio_fill(
    df: DataFrame, keys: Sequence[str], unit: str, time: Sequence[str], value: str, train: Column
) -> DataFrame:
    """Fill a missing unit from its present peers times its usual strength ratio.

    The ratio uses training rows only; an observed value always stays.
    """
    peers = peer_mean(df, [*keys, *time], value)
    ratio = (
        peers.where(train & F.col(value).isNotNull() & (F.col("peer_mean") > 0))
        .groupBy(*keys, unit)
        .agg(F.avg(F.col(value) / F.col("peer_mean")).alias("ratio"))
    )
    made = F.col("peer_mean") * F.col("ratio")
    return peers.join(ratio, [*keys, unit], "left").withColumns(
        {"filled": F.coalesce(F.col(value), made), "was_filled": F.col(value).isNull() & made.isNotNull()}
    )


def silences(
    readings: DataFrame, register: DataFrame, keys: Sequence[str], ts: str, minutes: int, min_slots: int, first: str | Column, as_of: str | Column
) -> DataFrame:
    """Silences of at least ``min_slots`` slots per registered unit, from the slot ``first`` to the slot ``as_of``.

    A unit that has not come back is silent up to ``as_of`` (``is_open``, no ``next_slot``); one that has not spoken yet has no
    ``prev_slot`` either. The length counts the slots between, and none of them is filled.
    """
    width = minutes * 60
    start, now = as_time(first), as_time(as_of)
    known = readings.where(F.col(ts).between(start, now)).select(*keys, ts)
    prev = scan(known, keys, time_bucket(ts, 7 * DAY), [ts], before={"prev_slot": F.col(ts)})
    closed = prev.select(*keys, "prev_slot", F.col(ts).alias("next_slot"))
    heard = known.groupBy(*keys).agg(F.max(ts).alias("prev_slot"))
    open_ = register.select(*keys).distinct().join(heard, list(keys), "left").select(*keys, "prev_slot", F.lit(None).cast("timestamp_ntz").alias("next_slot"))
    before = F.coalesce(epoch_seconds("prev_slot"), epoch_seconds(start) - width)
    after = F.coalesce(epoch_seconds("next_slot"), epoch_seconds(now) + width)
    rows = closed.unionByName(open_).withColumn("gap_slots", ((after - before) / width - 1).cast("bigint"))
    return rows.where(F.col("gap_slots") >= min_slots).withColumn("is_open", F.col("next_slot").isNull())


def reconcile(a: DataFrame, b: DataFrame, on: Sequence[str], left: str, right: str, tol_pct: float) -> DataFrame:
    """Two sources side by side: difference and share, no cause."""
    out = a.join(b, list(on), "full_outer")
    diff = F.col(left) - F.col(right)
    share = F.try_divide(F.abs(diff), F.col(right)) * 100
    state = (
        F.when(F.col(left).isNull(), "left_missing")
        .when(F.col(right).isNull(), "right_missing")
        .when(share <= tol_pct, "within")
        .otherwise("outside")
    )
    return out.select(*on, left, right, diff.alias("diff"), share.alias("diff_pct"), state.alias("state"))


def max_difference(a: DataFrame, b: DataFrame, on: Sequence[str], value: str, by: Sequence[str]) -> DataFrame:
    """Before/after comparison of a derived column: largest absolute difference and unmatched keys."""
    old, new = a.withColumnRenamed(value, "_old"), b.withColumnRenamed(value, "_new")
    j = old.join(new, list(on), "full_outer")
    return j.groupBy(*by).agg(
        F.count("*").alias("n_keys"),
        F.count_if(F.col("_old").isNull() | F.col("_new").isNull()).alias("n_unmatched"),
        F.max(F.abs(F.col("_new") - F.col("_old"))).alias("max_abs_diff"),
    )


def performance_ratio(
    df: DataFrame, energy: str, capacity: str, hours: Column, irradiation: Column, coverage: str, min_coverage: float, plane_ok: Column
) -> DataFrame:
    """Capacity factor and performance ratio, or the reason why they are withheld."""
    reason = (
        F.when(F.col(capacity).isNull() | (F.col(capacity) <= 0), "no capacity")
        .when(F.coalesce(F.col(coverage) < min_coverage, F.lit(True)), "incomplete period")
        .when(~F.coalesce(plane_ok, F.lit(False)), "no plane irradiance")
    )
    usable = reason.isNull() | (reason == "no plane irradiance")
    return df.withColumns(
        {
            "reason": reason,
            "capacity_factor": F.when(usable, F.try_divide(F.col(energy), F.col(capacity) * hours)),
            "performance_ratio": F.when(reason.isNull(), F.try_divide(F.col(energy), F.col(capacity) * irradiation)),
        }
    )


def funnel(df: DataFrame, stages: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows left after each stage, in one pass; a stage counts only rows that passed the earlier ones."""
    out, so_far = [], F.lit(True)
    for name, cond in stages.items():
        so_far = so_far & F.coalesce(cond, F.lit(False))
        out.append(F.count_if(so_far).alias(name))
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), *out)


def coverage(expected: DataFrame, facts: DataFrame, keys: Sequence[str], ts: str, by: Sequence[str | Column]) -> DataFrame:
    """Observed over expected slots, and the gap rate."""
    seen = facts.select(*keys, ts).distinct().withColumn("_seen", F.lit(1))
    return (
        expected.join(seen, [*keys, ts], "left")
        .groupBy(*by)
        .agg(F.count("*").alias("expected_slots"), F.count("_seen").alias("observed_slots"))
        .withColumn("gap_rate", 1 - F.try_divide(F.col("observed_slots"), F.col("expected_slots")))
    )


def slot_state(ts: str, value: str, as_of: Column) -> Column:
    """A slot whose time has not come is ``future``, not ``missing``."""
    return F.when(F.col(value).isNotNull(), "observed").when(F.col(ts) > as_of, "future").otherwise("missing")


def energy(df: DataFrame, keys: Sequence[str], ts: str, kw: str, slot_hours: float, period: Column, name: str) -> DataFrame:
    """Power to energy: each present value counts for one slot; absent slots add nothing."""
    return df.groupBy(*keys, period.alias(name)).agg(
        (F.sum(kw) * slot_hours).alias("energy_kwh"), F.count(kw).alias("n_slots")
    )
