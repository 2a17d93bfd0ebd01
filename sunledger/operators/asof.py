"""Joins that respect the time at which a value was really received."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.columns import as_time, epoch_micros, minutes_between, shift_seconds
from sunledger.operators.scans import MINUTE, scan, time_bucket


def match_actuals(fc: DataFrame, actuals: DataFrame, on: Sequence[str], actual: str) -> DataFrame:
    """Forecasts with the actual that has arrived; a target without one stays, as ``pending``."""
    out = fc.join(actuals, list(on), "left")
    return out.withColumn("match_state", F.when(F.col(actual).isNull(), "pending").otherwise("matched"))


def pool_leads(fc: DataFrame, issue: str, target: str, lo_h: float, hi_h: float) -> DataFrame:
    """Forecasts whose lead lies in [lo_h, hi_h] hours."""
    return fc.where((minutes_between(target, issue) / 60).between(lo_h, hi_h))


def _timeline(
    facts: DataFrame, asks: DataFrame, keys: Sequence[str], fact_ts: str, ask_ts: str, tie: Column, payload: Column
) -> DataFrame:
    """Facts and questions on one time line; facts come before questions of the same instant."""
    left = facts.where(F.col(fact_ts).isNotNull()).groupBy(*keys, F.col(fact_ts).alias("_t")).agg(
        # Equal receipt times are folded before the shuffle; the highest tie-break wins.
        F.max_by(payload, tie).alias("_fact")
    )
    left = left.select(*keys, "_t", F.lit(0).alias("_kind"), "_fact")
    rest = [c for c in asks.columns if c not in keys]
    ask = F.struct(*[F.col(c) for c in rest])
    right = asks.select(*keys, F.col(ask_ts).alias("_t"), F.lit(1).alias("_kind"), ask.alias("_ask"))
    fact_type = left.schema["_fact"].dataType
    left = left.withColumn("_ask", F.lit(None).cast(right.schema["_ask"].dataType))
    return left.unionByName(right.withColumn("_fact", F.lit(None).cast(fact_type)))


def as_known_at(
    versions: DataFrame,
    issues: DataFrame,
    keys: Sequence[str],
    received: str,
    tie: str,
    issue: str,
    payload: Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """Per question, the last version received by the issue time (``received <= issue``).

    ``where`` limits the versions that count, for instance to complete observations. Work is linear in
    versions plus issues; no pairs are made. Adds ``payload`` columns, NULL where nothing was known.
    """
    used = versions if where is None else versions.where(where)
    line = _timeline(used, issues, keys, received, issue, F.col(tie), F.struct(*[F.col(c) for c in payload]))
    # Several questions may share an instant; they see the same facts, so their order does not matter.
    seen = scan(line, keys, time_bucket("_t", MINUTE), ["_t", "_kind"], before={"_known": F.col("_fact")}, inclusive=True)
    return seen.where("_kind = 1").select(*keys, "_ask.*", *[F.col(f"_known.{c}").alias(c) for c in payload])


def freshest_complete(
    versions: DataFrame,
    issues: DataFrame,
    keys: Sequence[str],
    received: str,
    tie: str,
    issue: str,
    observed: str,
    needed: Sequence[str],
    max_age_h: float,
) -> DataFrame:
    """Freshest observation with all of ``needed`` present, at most ``max_age_h`` old, else ``waiting``.

    Freshest means the latest observation time among those received by the issue, and of that one the version
    that was received last (``tie`` decides between equal receipt times).
    """
    whole = versions.where(F.expr(" AND ".join(f"{c} IS NOT NULL" for c in needed)))
    # Running maximum: a late receipt of an old observation must not hide a newer one.
    payload = [observed, *needed]
    # The rank stands before the values, so a correction wins whatever its size.
    item = F.struct(observed, F.col(received).alias("_received"), F.col(tie).alias("_tie"), *needed)
    line = _timeline(whole, issues, keys, received, issue, F.struct(observed, tie), item)
    newest = scan_max(line, keys, "_fact")
    fresh = minutes_between(issue, f"_known.{observed}") <= max_age_h * 60
    ok = F.coalesce(fresh, F.lit(False))
    out = newest.where("_kind = 1").select(*keys, "_ask.*", "_known")
    return out.select(
        *keys,
        *[c for c in issues.columns if c not in keys],
        *[F.when(ok, F.col(f"_known.{c}")).alias(c) for c in payload],
        F.when(ok, "ready").otherwise("waiting").alias("status"),
    )


def scan_max(line: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Running maximum of a time line in (``_t``, ``_kind``) order, in two levels."""
    part = [*keys, "_bucket"]
    work = line.withColumn("_bucket", time_bucket("_t", MINUTE))
    totals = work.groupBy(*part).agg(F.max(value).alias("_m"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*part, F.max("_m").over(earlier).alias("_carry"))
    inside = Window.partitionBy(*part).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    local = work.repartition(*part).withColumn("_loc", F.max(value).over(inside))
    best = F.when(F.col("_carry").isNull(), F.col("_loc")).when(F.col("_loc").isNull(), F.col("_carry"))
    return local.join(carry, part, "left").withColumn(
        "_known", best.otherwise(F.greatest(F.col("_loc"), F.col("_carry")))
    )


def lag_aligned(
    readings: DataFrame,
    issues: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    value: str,
    issue: str,
    lags_min: Sequence[int],
    tolerance_min: Column,
) -> DataFrame:
    """Reading nearest to ``issue - lag`` within a tolerance; ties go to the earlier reading.

    The nearest reading is the last one before or the first one after, so both are found in one linear
    scan and no pairs are made. ``tolerance_min`` may use the key columns and ``lag_min``.
    """
    asks = issues.withColumn("lag_min", F.explode(F.array(*[F.lit(m).cast("bigint") for m in lags_min]))).withColumn(
        "_want", shift_seconds(issue, -F.col("lag_min") * 60)
    )
    item = F.struct(F.col(ts).alias("at"), F.col(value).alias("v"))
    line = _timeline(readings.where(F.col(value).isNotNull()), asks, keys, ts, "_want", F.col(tie), item)
    near = scan(
        line, keys, time_bucket("_t", MINUTE), ["_t", "_kind"], before={"_b": F.col("_fact")}, after={"_a": F.col("_fact")}
    )
    back = epoch_micros("_t") - epoch_micros("_b.at")
    ahead = epoch_micros("_a.at") - epoch_micros("_t")
    earlier = F.coalesce(back <= ahead, back.isNotNull())
    pick = F.when(earlier, F.col("_b")).otherwise(F.col("_a"))
    dist = F.when(earlier, back).otherwise(ahead)
    rows = near.where("_kind = 1").select(*keys, "_ask.*", pick.alias("_p"), dist.alias("_d"))
    hit = F.coalesce(F.col("_d") <= tolerance_min * 60_000_000, F.lit(False))
    return rows.select(
        *keys,
        *[c for c in issues.columns if c not in keys],
        "lag_min",
        F.when(hit, F.col("_p.at")).alias("reading_ts"),
        F.when(hit, F.col("_p.v")).alias("lag_value"),
        F.when(hit, "aligned").otherwise("waiting").alias("status"),
    )


def revisions(fc: DataFrame, keys: Sequence[str], received: str, tie: str, value: str) -> DataFrame:
    """Value history per forecast key: first valid receipt, number of changes, time of the last change."""
    prev = scan(
        fc.where(F.col(value).isNotNull()), keys, time_bucket(received, MINUTE), [received, tie], before={"_prev": F.col(value)}
    )
    changed = F.col("_prev").isNotNull() & (F.col("_prev") != F.col(value))
    return prev.groupBy(*keys).agg(
        F.count("*").alias("n_versions"),
        F.min(received).alias("first_valid_receipt"),
        F.min_by(value, F.struct(received, tie)).alias("first_value"),
        F.max_by(value, F.struct(received, tie)).alias("last_value"),
        F.count_if(changed).alias("n_revisions"),
        F.max(F.when(changed, F.col(received))).alias("last_change"),
    )


def lead_coverage(
    fc: DataFrame, keys: Sequence[str], issue: str, lead: str, issue_hours: Sequence[int], leads: Sequence[int], first_day: str | Column, last_day: str | Column
) -> DataFrame:
    """Share of the days of a period on which each (issue hour, lead) cell exists.

    The period is given, so a day without any forecast counts; the keys are those of ``fc``.
    """
    day = F.col(issue).cast("date")
    first, last = as_time(first_day).cast("date"), as_time(last_day).cast("date")
    fc = fc.where(day.between(first, last))
    n_days = F.datediff(last, first) + 1
    days = fc.groupBy(*keys).agg(F.count("*").alias("_n")).select(*keys, n_days.cast("bigint").alias("expected_days"))
    cells = days.withColumn("issue_hour", F.explode(F.array(*[F.lit(h).cast("bigint") for h in issue_hours]))).withColumn(
        "lead_h", F.explode(F.sequence(F.lit(min(leads)).cast("bigint"), F.lit(max(leads)).cast("bigint")))
    )
    have = (
        fc.where(F.col(lead).between(min(leads), max(leads)))
        .groupBy(*keys, day.alias("_day"), F.hour(issue).cast("bigint").alias("issue_hour"), F.col(lead).alias("lead_h"))
        .agg(F.count("*").alias("_n"))
        .groupBy(*keys, "issue_hour", "lead_h")
        .agg(F.count("*").alias("filled_days"))
    )
    return (
        cells.join(have, [*keys, "issue_hour", "lead_h"], "left")
        .fillna({"filled_days": 0})
        .withColumn("share", F.col("filled_days") / F.col("expected_days"))
    )


def leakage_audit(df: DataFrame, by: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """Count of rows that break each time rule, of rows for which a rule cannot be decided, and whether all rules hold.

    A rule that is NULL, as with an unknown receipt time, is ``unknown`` and not clean.
    """
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()]
    open_ = F.lit(False)
    for c in rules.values():
        open_ = open_ | c.isNull()
    out = df.groupBy(*by).agg(F.count("*").alias("n_rows"), *counts, F.count_if(open_).alias("unknown"))
    total = F.col("unknown")
    for n in rules:
        total = total + F.col(n)
    return out.withColumn("clean", total == 0)


def assemble_inputs(lags: DataFrame, weather: DataFrame, keys: Sequence[str], issue: str, lag_names: Mapping[int, str]) -> DataFrame:
    """One feature row per issue. A missing required input gives ``waiting`` and names it; nothing is zero-filled."""
    wide = lags.groupBy(*keys, issue).agg(
        *[F.max(F.when(F.col("lag_min") == m, F.col("lag_value"))).alias(n) for m, n in lag_names.items()]
    )
    rows = weather.withColumnRenamed("status", "_weather").join(wide, [*keys, issue], "left")
    missing = F.filter(
        F.array(
            *[F.when(F.col(n).isNull(), n) for n in lag_names.values()],
            F.when(F.col("_weather") != "ready", "weather"),
        ),
        lambda x: x.isNotNull(),
    )
    return rows.withColumn("missing_inputs", F.array_join(missing, ",")).withColumn(
        "status", F.when(F.col("missing_inputs") == "", "ready").otherwise("waiting")
    ).drop("_weather")
