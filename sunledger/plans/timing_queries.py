"""Queries on receipt times, forecasts, run logs and input readiness."""

from __future__ import annotations

from pyspark.sql import functions as F

from sunledger.functions import columns as C
from sunledger.operators import asof, grid, opslog, registers
from sunledger.plans.common import rounded
from sunledger.plans.registry import query
from sunledger.plans.views import REQUIRED, Tables
from sunledger.session import small_table
from sunledger.streaming import inputs


@query(
    "matched_forecasts",
    "J2",
    """SELECT f.event_id, f.site, f.model, f.target_ts, f.pred, h.actual_kw, CASE WHEN h.actual_kw IS NULL THEN 'pending' ELSE 'matched' END AS match_state
       FROM fc f LEFT JOIN site_hour h ON h.site = f.site AND h.hour = f.target_ts""",
)
def _(t: Tables):
    act = t.site_hour.select("site", F.col("hour").alias("target_ts"), "actual_kw")
    out = asof.match_actuals(t.fc, act, ["site", "target_ts"], "actual_kw")
    return out.select("event_id", "site", "model", "target_ts", "pred", "actual_kw", "match_state")


@query(
    "lead_pool_48h",
    "J3",
    """SELECT site, model, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT target_ts) AS BIGINT) AS n_targets, round(avg(pred), 5) AS mean_pred
       FROM fc WHERE lead_h BETWEEN 37 AND 59 GROUP BY 1, 2""",
)
def _(t: Tables):
    pool = asof.pool_leads(t.fc, "issue_ts", "target_ts", 37, 59)
    # Targets fold to one row each before they are counted, so no group holds a set of distinct values.
    per_target = pool.groupBy("site", "model", "target_ts").agg(F.count("*").alias("c"), F.sum("pred").alias("s"))
    return per_target.groupBy("site", "model").agg(
        F.sum("c").alias("n"), F.count("*").alias("n_targets"), F.round(F.sum("s") / F.sum("c"), 5).alias("mean_pred")
    )


@query(
    "as_known_at_issue",
    "J4",
    """SELECT i.station, i.issue_ts, o.event_id, o.obs_ts, o.temp, o.received_at FROM issues i LEFT JOIN obs o ON o.station = i.station AND o.received_at <= i.issue_ts
       QUALIFY row_number() OVER (PARTITION BY i.station, i.issue_ts ORDER BY o.received_at DESC NULLS LAST, o.event_id DESC) = 1""",
)
def _(t: Tables):
    return asof.as_known_at(
        t.obs, t.issues, ["station"], "received_at", "event_id", "issue_ts", ["event_id", "obs_ts", "temp", "received_at"]
    )


FRESH_SQL = """w AS (SELECT i.station, i.issue_ts, o.obs_ts, o.temp, o.humidity, o.cloud_pct FROM issues i LEFT JOIN obs o
    ON o.station = i.station AND o.received_at <= i.issue_ts AND o.obs_ts >= i.issue_ts - INTERVAL '12 hours'
    AND o.temp IS NOT NULL AND o.humidity IS NOT NULL AND o.cloud_pct IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY i.station, i.issue_ts ORDER BY o.obs_ts DESC NULLS LAST, o.received_at DESC, o.event_id DESC) = 1)"""


def weather(t: Tables):
    return asof.freshest_complete(
        t.obs, t.issues, ["station"], "received_at", "event_id", "issue_ts", "obs_ts", ["temp", "humidity", "cloud_pct"], 12
    )


@query(
    "freshest_complete_weather",
    "J5",
    f"WITH {FRESH_SQL} SELECT *, CASE WHEN obs_ts IS NULL THEN 'waiting' ELSE 'ready' END AS status FROM w",
)
def _(t: Tables):
    return weather(t)


LAG_SQL = """p AS (SELECT event_id, CAST(user_id % 4 AS BIGINT) AS station, ts, value FROM events WHERE event_type <> 'view'),
  q AS (SELECT station, issue_ts, lag_min, issue_ts - lag_min * INTERVAL '1 minute' AS want,
      CASE WHEN lag_min = 0 THEN 1 WHEN station = 0 THEN 5 ELSE 4 END AS tol FROM issues, (VALUES (0), (15), (30), (60)) AS v(lag_min)),
  l AS (SELECT q.station, q.issue_ts, q.lag_min, p.ts AS reading_ts, p.value AS lag_value FROM q LEFT JOIN p ON p.station = q.station
      AND p.ts BETWEEN want - tol * INTERVAL '1 minute' AND want + tol * INTERVAL '1 minute'
      QUALIFY row_number() OVER (PARTITION BY q.station, q.issue_ts, q.lag_min ORDER BY abs(epoch_us(p.ts) - epoch_us(want)) NULLS LAST, p.ts) = 1)"""


def power(t: Tables):
    return t.events.where("event_type <> 'view'").select("event_id", (F.col("user_id") % 4).alias("station"), "ts", "value")


def tolerance():
    return F.when(F.col("lag_min") == 0, 1).when(F.col("station") == 0, 5).otherwise(4)


def input_spec() -> inputs.InputSpec:
    """The inputs of the model, for training rows here and for live rows in ``stream_assembled_inputs``."""
    names = {15: "power_lag_15min", 30: "power_lag_30min", 60: "power_lag_60min"}
    return inputs.InputSpec(("station",), names, tolerance(), 5, "obs_ts", ("temp", "humidity", "cloud_pct"), 12)


def power_lags(t: Tables):
    return asof.lag_aligned(power(t), t.issues, ["station"], "ts", "event_id", "value", "issue_ts", [0, 15, 30, 60], tolerance())


@query(
    "aligned_lags",
    "J6",
    f"WITH {LAG_SQL} SELECT station, issue_ts, CAST(lag_min AS BIGINT) AS lag_min, reading_ts, lag_value, "
    "CASE WHEN reading_ts IS NULL THEN 'waiting' ELSE 'aligned' END AS status FROM l",
)
def _(t: Tables):
    return power_lags(t)


INPUTS_SQL = f"""{FRESH_SQL}, {LAG_SQL}, x AS (SELECT station, issue_ts, max(lag_value) FILTER (lag_min = 15) AS power_lag_15min,
          max(lag_value) FILTER (lag_min = 30) AS power_lag_30min, max(lag_value) FILTER (lag_min = 60) AS power_lag_60min FROM l GROUP BY 1, 2),
        y AS (SELECT w.*, power_lag_15min, power_lag_30min, power_lag_60min, concat_ws(',', CASE WHEN power_lag_15min IS NULL THEN 'power_lag_15min' END,
          CASE WHEN power_lag_30min IS NULL THEN 'power_lag_30min' END, CASE WHEN power_lag_60min IS NULL THEN 'power_lag_60min' END,
          CASE WHEN obs_ts IS NULL THEN 'weather' END) AS missing_inputs FROM w JOIN x USING (station, issue_ts))"""


@query("assembled_inputs", "M6", f"WITH {INPUTS_SQL} SELECT *, CASE WHEN missing_inputs = '' THEN 'ready' ELSE 'waiting' END AS status FROM y")
def _(t: Tables):
    return inputs.training_inputs(input_spec(), t.obs, power(t), t.issues, "received_at", "ts", "event_id", "value", "issue_ts")


@query(
    "forecast_revisions",
    "W28",
    """WITH v AS (SELECT *, lag(pred) OVER (PARTITION BY site, model, target_ts ORDER BY received_at, event_id) AS prev FROM fc)
       SELECT site, model, target_ts, CAST(count(*) AS BIGINT) AS n_versions, min(received_at) AS first_valid_receipt,
         arg_min(pred, received_at) AS first_value, arg_max(pred, received_at) AS last_value,
         CAST(count(*) FILTER (prev <> pred) AS BIGINT) AS n_revisions, max(received_at) FILTER (prev <> pred) AS last_change FROM v GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    return asof.revisions(t.fc, ["site", "model", "target_ts"], "received_at", "event_id", "pred")


@query(
    "lead_coverage",
    "A32",
    """WITH d AS (SELECT DISTINCT site, (SELECT date_diff('day', a, z) + 1 FROM log_period) AS expected_days FROM fc),
       h AS (SELECT site, hour(issue_ts) AS issue_hour, lead_h, count(DISTINCT CAST(issue_ts AS DATE)) AS filled_days FROM fc GROUP BY 1, 2, 3)
       SELECT d.site, CAST(i AS BIGINT) AS issue_hour, CAST(l AS BIGINT) AS lead_h, CAST(expected_days AS BIGINT) AS expected_days,
         CAST(coalesce(filled_days, 0) AS BIGINT) AS filled_days, round(coalesce(filled_days, 0) / expected_days, 6) AS share
       FROM d, (SELECT unnest(range(0, 24, 3)) AS i), (SELECT unnest(range(0, 100)) AS l) LEFT JOIN h ON h.site = d.site AND h.issue_hour = i AND h.lead_h = l""",
)
def _(t: Tables):
    out = asof.lead_coverage(t.fc, ["site"], "issue_ts", "lead_h", range(0, 24, 3), range(0, 100), t.first, t.end)
    return rounded(out, 6, "share")


@query(
    "leakage_audit",
    "M5",
    """SELECT model, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (received_at > issue_ts + INTERVAL '30 minutes') AS BIGINT) AS received_after_bound,
       CAST(count(*) FILTER (target_ts <= issue_ts) AS BIGINT) AS target_not_future,
       CAST(count(*) FILTER (issue_ts < TIMESTAMP '2024-01-16 00:00:00' AND target_ts >= TIMESTAMP '2024-01-16 00:00:00') AS BIGINT) AS crosses_fold,
       CAST(count(*) FILTER (received_at IS NULL) AS BIGINT) AS unknown,
       count(*) FILTER (received_at IS NULL OR received_at > issue_ts + INTERVAL '30 minutes' OR target_ts <= issue_ts OR
         (issue_ts < TIMESTAMP '2024-01-16 00:00:00' AND target_ts >= TIMESTAMP '2024-01-16 00:00:00')) = 0 AS clean FROM (SELECT * REPLACE (CASE WHEN event_id % 89 <> 0 THEN received_at END AS received_at) FROM fc) GROUP BY model""",
)
def _(t: Tables):
    border = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    rules = {
        "received_after_bound": F.col("received_at") > C.shift_seconds("issue_ts", 1800),
        "target_not_future": F.col("target_ts") <= F.col("issue_ts"),
        "crosses_fold": (F.col("issue_ts") < border) & (F.col("target_ts") >= border),
    }
    # Some receipt times are unknown, so that the third state occurs.
    rows = t.fc.withColumn("received_at", F.when(F.col("event_id") % 89 != 0, F.col("received_at")))
    return asof.leakage_audit(rows, ["model"], rules)


FIRST_SQL, END_SQL = "(SELECT a FROM log_period)", "(SELECT z FROM log_period)"  # the reporting period of the logs, whatever its year


def last_minute(t: Tables):
    return C.shift_seconds(t.end, -60)


def jobs(t: Tables):
    """The register of jobs; it does not depend on what arrived."""
    return small_table(t.spark, [(j,) for j in range(4)], "job bigint")


def job_hours(t: Tables):
    return grid.period_slots(jobs(t), "hour", t.first, last_minute(t), 60)


# --- logs --------------------------------------------------------------------------------------


@query(
    "observation_delays",
    "A13",
    """WITH d AS (SELECT station, (epoch_us(received_at) - epoch_us(obs_ts)) / 60000000.0 AS delay FROM obs)
       SELECT station, CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN delay > 60 THEN 1 ELSE 0 END), 6) AS late_share, round(quantile_cont(delay, 0.5), 5) AS median,
         round(quantile_cont(delay, 0.9), 5) AS p90, round(quantile_cont(delay, 0.95), 5) AS p95 FROM d GROUP BY station""",
)
def _(t: Tables):
    rows = t.obs.select("station", C.minutes_between("received_at", "obs_ts").alias("delay"))
    return rounded(rounded(opslog.delay_distribution(rows, ["station"], "delay", 60), 6, "late_share"), 5, "median", "p90", "p95")


@query(
    "run_status_summary",
    "A14",
    """SELECT job, feed, CAST(count(*) AS BIGINT) AS n_runs, CAST(count(*) FILTER (status = 'success') AS BIGINT) AS n_success,
       CAST(count(*) FILTER (status = 'error') AS BIGINT) AS n_error, CAST(count(*) FILTER (status = 'warming_up') AS BIGINT) AS n_warming_up,
       CAST(count(*) FILTER (status = 'waiting') AS BIGINT) AS n_waiting, NOT bool_or(status = 'success') AS never_succeeded FROM runs GROUP BY 1, 2""",
)
def _(t: Tables):
    return opslog.run_summary(t.runs, ["job", "feed"], ["success", "error", "warming_up", "waiting"])


@query(
    "gate_rates",
    "A15",
    f"""WITH e AS (SELECT job, unnest(generate_series({FIRST_SQL}, {END_SQL} - INTERVAL '15 minutes', INTERVAL '15 minutes')) AS slot
         FROM (VALUES (0::BIGINT), (1), (2), (3)) AS v(job)),
       x AS (SELECT e.job, e.slot, e.slot >= {FIRST_SQL} + INTERVAL '9 days' AND e.slot < {FIRST_SQL} + INTERVAL '11 days' AS o, r.made FROM e
         LEFT JOIN (SELECT job, slot, bool_or(status = 'success') AS made FROM runs GROUP BY 1, 2) r ON r.job = e.job AND r.slot = e.slot
         WHERE hour(e.slot) * 60 + minute(e.slot) BETWEEN 270 AND 1230)
       SELECT job, CAST(count(*) AS BIGINT) AS expected_slots, CAST(count(made) AS BIGINT) AS executed, CAST(count(*) FILTER (made) AS BIGINT) AS generated,
         CAST(count(*) FILTER (o) AS BIGINT) AS outage_slots, round(count(made) / count(*), 6) AS execution_rate, round(count(*) FILTER (made) / count(*), 6) AS generation_rate,
         round(count(*) FILTER (made AND NOT o) / count(*) FILTER (NOT o), 6) AS conditional_rate FROM x GROUP BY job""",
)
def _(t: Tables):
    slots = grid.period_slots(jobs(t), "slot", t.first, last_minute(t), 15)
    minute = F.hour("slot") * 60 + F.minute("slot")
    lo, hi = (C.shift_seconds(t.first, n * 86400) for n in (9, 11))
    outage = (F.col("slot") >= lo) & (F.col("slot") < hi)
    out = opslog.gate_rates(slots.where(minute.between(270, 1230)), t.runs, ["job", "slot"], ["job"], outage)
    return rounded(out, 6, "execution_rate", "generation_rate", "conditional_rate")


@query(
    "request_use",
    "A16",
    """SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS calls, CAST(count(DISTINCT concat_ws('|', job, feed, k % 10, hour(ts))) AS BIGINT) AS distinct_calls,
       round(count(*) / 400, 6) AS quota_share, round((1 - count(DISTINCT concat_ws('|', job, feed, k % 10, hour(ts))) / count(*)) * 100, 6) AS reduction_pct
       FROM runs GROUP BY 1""",
)
def _(t: Tables):
    rows = t.runs.select("job", "feed", (F.col("k") % 10).alias("kk"), F.hour("ts").alias("h"), F.col("ts").cast("date").alias("day"))
    return rounded(opslog.request_use(rows, ["day"], ["job", "feed", "kk", "h"], 400), 6, "quota_share", "reduction_pct")


@query(
    "backfill_progress",
    "A17",
    """WITH d AS (SELECT site, count(DISTINCT hour) AS done, count(DISTINCT CAST(hour AS DATE)) AS days FROM site_hour GROUP BY 1)
       SELECT site, CAST(done AS BIGINT) AS done, CAST(1440 - done AS BIGINT) AS remaining, round(done / days, 6) AS rate_per_day, round((1440 - done) * days / done, 6) AS eta_days FROM d""",
)
def _(t: Tables):
    return rounded(opslog.backfill_progress(t.site_hour, ["site"], "hour", 1440), 6, "rate_per_day", "eta_days")


STATUS_SQL = f"""st AS (SELECT v.job, f.feed, max(ts) AS last_attempt, max(ts) FILTER (k < 60) AS last_valid, CAST(count(ts) AS BIGINT) AS attempts
    FROM (VALUES (0::BIGINT), (1), (2), (3)) AS v(job), (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('error'), ('heartbeat')) AS f(feed)
    LEFT JOIN runs r ON r.job = v.job AND r.feed = f.feed AND ts <= {END_SQL} - INTERVAL '1 minute' GROUP BY 1, 2),
  sx AS (SELECT *, CASE WHEN last_valid IS NULL THEN 'missing' WHEN {END_SQL} - INTERVAL '1 minute' - last_valid <= INTERVAL '300 minutes' THEN 'normal'
    WHEN {END_SQL} - INTERVAL '1 minute' - last_valid <= INTERVAL '600 minutes' THEN 'late' ELSE 'missing' END AS status FROM st)"""


def statuses(t: Tables):
    as_of = last_minute(t)
    # The heartbeat feed is registered but never reports.
    feeds = F.array(*[F.lit(f) for f in ("click", "view", "purchase", "signup", "error", "heartbeat")])
    register = jobs(t).select("job", F.explode(feeds).alias("feed"))
    return opslog.feed_status(t.runs, register, ["job", "feed"], "ts", F.col("k") < 60, as_of, 300, 600)


@query("feed_status", "T4 A24", f"WITH {STATUS_SQL} SELECT * FROM sx")
def _(t: Tables):
    return statuses(t)


@query("status_cards", "A24", f"WITH {STATUS_SQL} SELECT job, status, CAST(count(*) AS BIGINT) AS n FROM sx GROUP BY 1, 2")
def _(t: Tables):
    return opslog.status_cards(statuses(t), ["job"])


@query(
    "model_readiness",
    "J14",
    f"""WITH h AS (SELECT job, unnest(generate_series({FIRST_SQL}, {END_SQL} - INTERVAL '1 hour', INTERVAL '1 hour')) AS hour
         FROM (VALUES (0::BIGINT), (1), (2), (3)) AS v(job)), a AS (SELECT DISTINCT job, date_trunc('hour', ts) AS hour, feed FROM runs),
       x AS (SELECT h.job, h.hour, r.model, r.feed, a.feed IS NOT NULL AS ok FROM h CROSS JOIN required r LEFT JOIN a ON a.job = h.job AND a.hour = h.hour AND a.feed = r.feed)
       SELECT job, hour, model, coalesce(string_agg(feed, ',' ORDER BY feed) FILTER (NOT ok), '') AS blocked_by, bool_and(ok) AS ready FROM x GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    needs: dict[str, list[str]] = {}
    for model, feed in REQUIRED:
        needs.setdefault(model, []).append(feed)
    arrived = t.runs.select("job", C.slot_start("ts", 60).alias("hour"), "feed")
    return opslog.model_readiness(arrived, job_hours(t), ["job", "hour"], "feed", needs)


@query(
    "feeds_not_arrived",
    "U3",
    f"""WITH h AS (SELECT job, unnest(generate_series({FIRST_SQL}, {END_SQL} - INTERVAL '1 hour', INTERVAL '1 hour')) AS hour
         FROM (VALUES (0::BIGINT), (1), (2), (3)) AS v(job))
       SELECT h.job, h.hour, feed FROM h CROSS JOIN (SELECT DISTINCT feed FROM required) EXCEPT SELECT DISTINCT job, date_trunc('hour', ts), feed FROM runs""",
)
def _(t: Tables):
    arrived = t.runs.select("job", C.slot_start("ts", 60).alias("hour"), "feed")
    return opslog.feeds_not_arrived(arrived, job_hours(t), ["job", "hour"], "feed", sorted({f for _, f in REQUIRED}))


@query(
    "latest_valid_receipt",
    "K2",
    """SELECT station, event_id, obs_ts, temp FROM obs WHERE temp IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY station ORDER BY received_at DESC, event_id DESC) = 1""",
)
def _(t: Tables):
    return opslog.latest_valid(
        t.obs, ["station"], ["received_at", "event_id"], F.col("temp").isNotNull(), ["event_id", "obs_ts", "temp"]
    )


@query(
    "last_12_attempts",
    "K3",
    """SELECT job, feed, event_id, status, CAST(row_number() OVER (PARTITION BY job, feed ORDER BY ts DESC, event_id DESC) AS INTEGER) AS attempt_no
       FROM runs QUALIFY attempt_no <= 12""",
)
def _(t: Tables):
    return opslog.last_attempts(t.runs, ["job", "feed"], ["ts", "event_id"], 12).select("job", "feed", "event_id", "status", "attempt_no")

# --- registers with effective dates --------------------------------------------------------------

TAGGED_SQL = "tr AS (SELECT r.* REPLACE (CAST(user_id % 8 AS BIGINT) AS job) FROM runs r JOIN events USING (event_id))"
REGISTER_SQL = f"""{TAGGED_SQL}, rc AS (SELECT t.job, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (i) AS BIGINT) AS n_inside,
    CAST(count(*) FILTER (NOT i AND k) AS BIGINT) AS n_outside_dates, CAST(count(*) FILTER (NOT k) AS BIGINT) AS n_unknown FROM
    (SELECT job, EXISTS (SELECT 1 FROM dated_jobs d WHERE d.job = tr.job AND date_trunc('second', ts) >= from_ts AND date_trunc('second', ts) < coalesce(to_ts, {END_SQL})
       AND ts < {END_SQL}) AS i, job IN (SELECT job FROM dated_jobs) AS k FROM tr) t GROUP BY 1)"""


def register_audit(t: Tables):
    return registers.register_counts(t.tagged_runs, t.dated_jobs, ["job"], "ts", t.end)


@query(
    "register_audit",
    "J14 U3 A15 A24",
    f"""WITH {REGISTER_SQL} SELECT job, coalesce(n_rows, 0) AS n_rows, coalesce(n_inside, 0) AS n_inside, coalesce(n_outside_dates, 0) AS n_outside_dates,
        coalesce(n_unknown, 0) AS n_unknown FROM (SELECT DISTINCT job FROM dated_jobs) d FULL JOIN rc USING (job)""",
)
def _(t: Tables):
    return register_audit(t)


def due_sql(minutes: int) -> str:
    return f"""SELECT DISTINCT d.job, s.slot FROM dated_jobs d JOIN (SELECT unnest(generate_series({FIRST_SQL}, {END_SQL} - INTERVAL '{minutes} minutes',
        INTERVAL '{minutes} minutes')) AS slot) s ON s.slot >= d.from_ts AND s.slot < coalesce(d.to_ts, {END_SQL})"""


@query(
    "dated_gate_rates",
    "A15",
    f"""WITH {REGISTER_SQL}, e AS ({due_sql(15)}),
       x AS (SELECT e.job, e.slot, made FROM e LEFT JOIN (SELECT job, slot, bool_or(status = 'success') AS made FROM tr GROUP BY 1, 2) r ON r.job = e.job AND r.slot = e.slot)
       SELECT job, CAST(count(*) AS BIGINT) AS expected_slots, CAST(count(made) AS BIGINT) AS executed, CAST(count(*) FILTER (made) AS BIGINT) AS generated,
         round(count(made) / count(*), 6) AS execution_rate, round(count(*) FILTER (made) / count(*), 6) AS generation_rate,
         coalesce(any_value(n_outside_dates), 0) AS n_outside_dates FROM x LEFT JOIN rc USING (job) GROUP BY 1""",
)
def _(t: Tables):
    due = registers.due_slots(t.dated_jobs, ["job"], "slot", t.first, t.end, 15)
    rates = opslog.gate_rates(due, t.tagged_runs, ["job", "slot"], ["job"], F.lit(False)).drop("outage_slots", "conditional_rate")
    out = rates.join(register_audit(t).select("job", "n_outside_dates"), "job", "left")
    return rounded(out, 6, "execution_rate", "generation_rate")


@query(
    "dated_readiness",
    "J14 U3",
    f"""WITH {TAGGED_SQL}, h AS ({due_sql(60)}), a AS (SELECT DISTINCT job, date_trunc('hour', ts) AS hour, feed FROM tr),
       x AS (SELECT h.job, h.slot AS hour, r.model, a.feed IS NOT NULL AS ok FROM h CROSS JOIN required r LEFT JOIN a ON a.job = h.job AND a.hour = h.slot AND a.feed = r.feed),
       m AS (SELECT job, hour, model, bool_and(ok) AS ready, bool_or(ok) AS any_ok FROM x GROUP BY 1, 2, 3)
       SELECT job, model, CAST(count(*) AS BIGINT) AS due_hours, CAST(count(*) FILTER (ready) AS BIGINT) AS ready_hours, CAST(count(*) FILTER (NOT any_ok) AS BIGINT) AS silent_hours FROM m GROUP BY 1, 2""",
)
def _(t: Tables):
    needs: dict[str, list[str]] = {}
    for model, feed in REQUIRED:
        needs.setdefault(model, []).append(feed)
    due = registers.due_slots(t.dated_jobs, ["job"], "hour", t.first, t.end, 60)
    arrived = t.tagged_runs.select("job", C.slot_start("ts", 60).alias("hour"), "feed")
    rows = opslog.model_readiness(arrived, due, ["job", "hour"], "feed", needs)
    blocked = F.size(F.split("blocked_by", ",")) == F.element_at(F.create_map(*[F.lit(x) for m, f in needs.items() for x in (m, len(f))]), F.col("model"))
    return rows.groupBy("job", "model").agg(
        F.count("*").alias("due_hours"), F.count_if("ready").alias("ready_hours"), F.count_if(blocked & ~F.col("ready")).alias("silent_hours")
    )
