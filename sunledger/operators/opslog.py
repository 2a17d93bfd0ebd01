"""Reports on run and collection logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.columns import minutes_between
from sunledger.operators.scans import exact_quantiles


def delay_distribution(df: DataFrame, by: Sequence[str], delay: str, late_after: float) -> DataFrame:
    """Exact median, p90 and p95 of a delay, and the share above ``late_after``; a group without any delay stays, with NULLs."""
    q = exact_quantiles(df, by, delay, {"median": 0.5, "p90": 0.9, "p95": 0.95})
    rest = df.groupBy(*by).agg(
        F.count(delay).alias("n"), F.avg(F.when(F.col(delay).isNotNull(), (F.col(delay) > late_after).cast("int"))).alias("late_share")
    )
    return rest.join(q, list(by), "left")


def approximate_delays(df: DataFrame, by: Sequence[str], delay: str, accuracy: int = 10_000) -> DataFrame:
    """One-pass variant with a mergeable sketch, for streams and very large logs."""
    q = F.percentile_approx(delay, [0.5, 0.9, 0.95], accuracy)
    return df.groupBy(*by).agg(F.count(delay).alias("n"), q.alias("_q")).select(
        *by, "n", F.col("_q")[0].alias("median"), F.col("_q")[1].alias("p90"), F.col("_q")[2].alias("p95")
    )


def run_summary(runs: DataFrame, by: Sequence[str], states: Sequence[str]) -> DataFrame:
    """Runs per status, and whether the job has never succeeded."""
    return runs.groupBy(*by).agg(
        F.count("*").alias("n_runs"),
        *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in states],
        (~F.bool_or(F.col("status") == "success")).alias("never_succeeded"),
    )


def gate_rates(expected: DataFrame, runs: DataFrame, on: Sequence[str], by: Sequence[str], outage: Column) -> DataFrame:
    """Execution and generation rate over the expected slots, and the same without outage slots.

    The raw rates stay; the conditional rate is a column of its own.
    """
    per_slot = runs.groupBy(*on).agg(F.lit(1).alias("_ran"), F.max((F.col("status") == "success").cast("int")).alias("_made"))
    rows = expected.join(per_slot, list(on), "left").withColumn("_out", outage)
    made = F.coalesce(F.col("_made"), F.lit(0)) == 1
    out = rows.groupBy(*by).agg(
        F.count("*").alias("expected_slots"),
        F.count("_ran").alias("executed"),
        F.count_if(made).alias("generated"),
        F.count_if(F.col("_out")).alias("outage_slots"),
        F.count_if(made & ~F.col("_out")).alias("_made_up"),
    )
    return out.select(
        *by,
        "expected_slots",
        "executed",
        "generated",
        "outage_slots",
        F.try_divide("executed", "expected_slots").alias("execution_rate"),
        F.try_divide("generated", "expected_slots").alias("generation_rate"),
        F.try_divide(F.col("_made_up"), F.col("expected_slots") - F.col("outage_slots")).alias("conditional_rate"),
    )


def request_use(calls: DataFrame, by: Sequence[str | Column], request: Sequence[str | Column], quota: int) -> DataFrame:
    """Calls, distinct calls, share of a quota and the possible saving. Equal requests fold before the shuffle."""
    names = [b if isinstance(b, str) else f"_by{i}" for i, b in enumerate(by)]
    keyed = [F.col(b) if isinstance(b, str) else b.alias(n) for b, n in zip(by, names)]
    one = calls.groupBy(*keyed, *request).agg(F.count("*").alias("_c"))
    return one.groupBy(*names).agg(F.sum("_c").alias("calls"), F.count("*").alias("distinct_calls")).withColumns(
        {
            "quota_share": F.col("calls") / quota,
            "reduction_pct": (1 - F.col("distinct_calls") / F.col("calls")) * 100,
        }
    )


def backfill_progress(done: DataFrame, by: Sequence[str], slot: str, expected: int) -> DataFrame:
    """Done and remaining slots, rate per day and days to the end."""
    per_day = done.select(*by, slot).distinct().groupBy(*by, F.col(slot).cast("date").alias("_day")).agg(F.count("*").alias("_n"))
    out = per_day.groupBy(*by).agg(F.sum("_n").alias("done"), F.count("*").alias("days"))
    left = F.greatest(F.lit(0).cast("bigint"), F.lit(expected) - F.col("done"))
    return out.select(
        *by,
        "done",
        left.alias("remaining"),
        (F.col("done") / F.col("days")).alias("rate_per_day"),
        F.try_divide(left * F.col("days"), F.col("done")).alias("eta_days"),
    )


def feed_status(
    log: DataFrame, register: DataFrame, by: Sequence[str], ts: str, valid: Column, as_of: Column, late_min: int, missing_min: int
) -> DataFrame:
    """Last attempt and last valid value are kept apart; one status function for every card.

    ``register`` lists what should report; an entry that never attempted is ``missing``. What comes after ``as_of`` is not known yet.
    """
    seen = log.where(F.col(ts) <= as_of).groupBy(*by).agg(
        F.max(ts).alias("last_attempt"), F.max(F.when(valid, F.col(ts))).alias("last_valid"), F.count("*").alias("attempts")
    )
    out = register.select(*by).distinct().join(seen, list(by), "left").fillna({"attempts": 0})
    age = minutes_between(as_of, F.col("last_valid"))
    status = (
        F.when(F.col("last_valid").isNull(), "missing")
        .when(age <= late_min, "normal")
        .when(age <= missing_min, "late")
        .otherwise("missing")
    )
    return out.withColumn("status", status)


def status_cards(status: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return status.groupBy(*by, "status").agg(F.count("*").alias("n"))


def arrived_feeds(arrived: DataFrame, expected: DataFrame, by: Sequence[str], feed: str) -> DataFrame:
    """``expected`` with the set of feeds that arrived, empty where nothing did. A group has as many feeds as there are names."""
    seen = arrived.groupBy(*by).agg(F.collect_set(feed).alias("_seen"))
    return expected.select(*by).join(seen, list(by), "left").withColumn("_seen", F.coalesce("_seen", F.array().cast("array<string>")))


def model_readiness(arrived: DataFrame, expected: DataFrame, by: Sequence[str], feed: str, required: Mapping[str, Sequence[str]]) -> DataFrame:
    """Status of each model from its own required feeds; a feed the model does not use cannot block it.

    ``expected`` lists every group that should have reported, so one in which nothing arrived is not ready. ``required``
    is the models' register (model to feeds), a short configuration.
    """
    seen = arrived_feeds(arrived, expected, by, feed)
    needs = F.array(
        *[F.struct(F.lit(m).alias("model"), F.array(*[F.lit(f) for f in feeds]).alias("feeds")) for m, feeds in required.items()]
    )
    rows = seen.withColumn("_m", F.explode(needs))
    missing = F.array_sort(F.array_except("_m.feeds", "_seen"))
    return rows.select(
        *by, F.col("_m.model").alias("model"), F.array_join(missing, ",").alias("blocked_by"), (F.size(missing) == 0).alias("ready")
    )


def feeds_not_arrived(arrived: DataFrame, expected: DataFrame, by: Sequence[str], feed: str, feeds: Sequence[str]) -> DataFrame:
    """Expected feeds EXCEPT the feeds that arrived, for each expected group."""
    seen = arrived_feeds(arrived, expected, by, feed)
    return seen.select(*by, F.explode(F.array_except(F.array(*[F.lit(f) for f in feeds]), "_seen")).alias(feed))


def latest_valid(log: DataFrame, keys: Sequence[str], order: Sequence[str], valid: Column, payload: Sequence[str]) -> DataFrame:
    """Latest valid record per key; partial aggregates fold hot keys before the shuffle."""
    rank = F.struct(*[F.col(c) for c in order])
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), rank)
    return log.where(valid).groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def last_attempts(log: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Last ``n`` attempts per feed; the rank limit is applied before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return log.withColumn("attempt_no", F.row_number().over(w)).where(F.col("attempt_no") <= n)
