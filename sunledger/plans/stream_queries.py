"""Streaming jobs run over what has landed, compared with batch SQL on closed windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions import columns as C
from sunledger.functions.stats import stable_mean
from sunledger.plans.registry import query
from sunledger.plans.timing_queries import INPUTS_SQL, input_spec
from sunledger.plans.views import Tables, minutes_k
from sunledger.session import shared_dir
from sunledger.streaming import heartbeat, inputs, jobs


def events(t: Tables) -> DataFrame:
    # The braces make it a pattern, which fits a single file as well as a folder of files.
    return jobs.landing_stream(t.spark, f"{t.sf_dir}/{{events.parquet}}", t.events.schema)


def us_to_ntz(df: DataFrame, **names: str) -> DataFrame:
    return df.withColumns({n: F.timestamp_micros(F.col(c)).cast("timestamp_ntz") for n, c in names.items()})


@query(
    "stream_hourly_readings",
    "T1",
    """WITH w AS (SELECT max(ts) - INTERVAL '1 hour' AS mark FROM events)
       SELECT event_type AS unit, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL '1 hour' AS window_end,
         CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) / count(*) AS mean_kw FROM events, w GROUP BY 1, 2, 3, mark HAVING window_end <= mark""",
)
def _(t: Tables):
    s = jobs.event_time(events(t), "ts", "1 hour").withColumnRenamed("event_type", "unit")
    agg = [F.count("*").alias("n"), stable_mean("value").alias("mean_kw")]
    out = jobs.ntz(jobs.tumbling(s, "ts", "1 hour", ["unit"], agg), "window_start", "window_end")
    return jobs.run_to_table(out, "hourly-readings")


@query(
    "stream_bounded_readings",
    "T1 S5",
    """WITH w AS (SELECT max(ts) - INTERVAL '1 hour' AS mark FROM events)
       SELECT event_type AS unit, date_trunc('hour', ts) AS window_start, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events, w
       GROUP BY 1, 2, mark HAVING date_trunc('hour', ts) + INTERVAL '1 hour' <= mark""",
)
def _(t: Tables):
    # The readings land in files that each hold rows of the whole period, and are taken file by file.
    base = shared_dir(t.spark, "bounded-readings")
    t.events.repartition(4, "event_id").write.parquet(f"{base}/landing")
    source = jobs.landing_stream(t.spark, f"{base}/landing", t.events.schema, files_per_trigger=1)
    source = source.select(F.col("event_type").alias("unit"), F.col("ts").cast("timestamp").alias("ts"), "value")
    amount = [F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(28,6)")).alias("total")]
    hourly = lambda rows: jobs.tumbling(rows, "ts", "1 hour", ["unit"], amount)
    closed, stored = jobs.run_bounded(source, "ts", "1 hour", hourly, "bounded", f"{base}/split", deadline=F.window("ts", "1 hour").end)
    closed = closed.drop("window_end")
    late = stored.where("late").groupBy("unit", F.window("ts", "1 hour").start.alias("window_start")).agg(*amount)
    both = closed.unionByName(late).groupBy("unit", "window_start").agg(F.sum("n").alias("n"), F.round(F.sum("total").cast("double"), 4).alias("total"))
    return jobs.ntz(both, "window_start")


@query(
    "stream_distinct_requests",
    "T2",
    "SELECT DISTINCT job, feed, k % 10 AS kk, date_trunc('hour', ts) AS hour FROM runs",
)
def _(t: Tables):
    s = jobs.event_time(events(t), "ts", "2 hours").select(
        "ts",
        (F.col("user_id") % 4).alias("job"),
        F.col("event_type").alias("feed"),
        (minutes_k() % 10).alias("kk"),
        F.window("ts", "1 hour").start.alias("hour"),
    )
    out = jobs.drop_repeats(s, ["job", "feed", "kk", "hour"]).select("job", "feed", "kk", F.col("hour").cast("timestamp_ntz").alias("hour"))
    return jobs.run_to_table(out, "distinct-requests")


@query(
    "stream_late_receipts",
    "T3",
    """WITH x AS (SELECT event_id, station, received_at, CASE WHEN date_trunc('hour', obs_ts) = obs_ts THEN obs_ts ELSE date_trunc('hour', obs_ts) + INTERVAL '1 hour' END AS issue_ts,
         CASE WHEN date_trunc('hour', received_at) = received_at THEN received_at ELSE date_trunc('hour', received_at) + INTERVAL '1 hour' END AS usable_from FROM obs)
       SELECT x.event_id, x.station, x.issue_ts, x.usable_from, CASE WHEN i.issue_ts IS NULL THEN 'no_issue' WHEN received_at <= x.issue_ts THEN 'on_time' ELSE 'late' END AS receipt_state
       FROM x LEFT JOIN issues i ON i.station = x.station AND i.issue_ts = x.issue_ts""",
)
def _(t: Tables):
    k = minutes_k()
    s = events(t).where("event_type = 'view'").select(
        "event_id",
        (F.col("user_id") % 4).alias("station"),
        F.col("ts").cast("timestamp").alias("obs_ts"),
        C.shift_seconds("ts", k * 60).cast("timestamp").alias("received_at"),
    )
    out = jobs.split_late_receipts(s, t.issues, ["station"], "obs_ts", "received_at")
    out = jobs.ntz(out, "issue_ts", "usable_from").select("event_id", "station", "issue_ts", "usable_from", "receipt_state")
    return jobs.run_to_table(out, "late-receipts", partition_by=["receipt_state"])


FRESH = """w AS (SELECT max(ts) - INTERVAL '1 hour' AS mark FROM events),
  a AS (SELECT job, feed, slot + INTERVAL '15 minutes' AS window_end, max(ts) AS la, max(ts) FILTER (k < 60) AS lv FROM runs GROUP BY 1, 2, 3),
  r AS (SELECT job, feed, window_end, max(la) OVER p AS last_attempt, max(lv) OVER p AS last_valid FROM a, w WHERE window_end <= mark
        WINDOW p AS (PARTITION BY job, feed ORDER BY window_end ROWS UNBOUNDED PRECEDING))"""


def freshness(t: Tables, deadline_min: int = 300) -> DataFrame:
    s = jobs.event_time(events(t), "ts", "1 hour").withColumns(
        {"job": F.col("user_id") % 4, "feed": F.col("event_type"), "us": F.unix_micros("ts"), "k": minutes_k()}
    )
    agg = [F.max("us").alias("attempt_us"), F.max(F.when(F.col("k") < 60, F.col("us"))).alias("valid_us")]
    w = jobs.tumbling(s, "ts", "15 minutes", ["job", "feed"], agg)
    w = w.select("job", "feed", F.unix_micros("window_end").alias("window_us"), "attempt_us", "valid_us", "window_end")
    schema = "kind string, job bigint, feed string, window_us bigint, attempt_us bigint, valid_us bigint, status string"
    out = jobs.with_state(w, ["job", "feed"], jobs.FeedFreshness(["job", "feed"], deadline_min), schema, "EventTime")
    out = us_to_ntz(out, window_end="window_us", last_attempt="attempt_us", last_valid="valid_us")
    return out.select("kind", "job", "feed", "window_end", "last_attempt", "last_valid", "status")


@query(
    "stream_feed_freshness",
    "T4",
    f"""WITH {FRESH} SELECT job, feed, window_end, last_attempt, last_valid,
        CASE WHEN last_valid IS NOT NULL AND window_end - last_valid <= INTERVAL '300 minutes' THEN 'normal' ELSE 'late' END AS status FROM r""",
)
def _(t: Tables):
    return jobs.run_to_table(freshness(t), "feed-freshness", stateful=True).where("kind = 'update'").drop("kind")


@query(
    "stream_feed_deadlines",
    "T4",
    f"""WITH {FRESH}, l AS (SELECT job, feed, max(last_attempt) AS last_attempt, max(last_valid) AS last_valid, min(last_attempt) AS first_attempt FROM r GROUP BY 1, 2)
        SELECT job, feed, date_trunc('millisecond', coalesce(last_valid, first_attempt) + INTERVAL '60 minutes') AS deadline, last_attempt, last_valid, 'late' AS status FROM l, w
        WHERE date_trunc('millisecond', coalesce(last_valid, first_attempt) + INTERVAL '60 minutes') < date_trunc('millisecond', mark)""",
)
def _(t: Tables):
    table = jobs.run_to_table(freshness(t, 60), "feed-deadlines", stateful=True)
    return table.where("kind = 'deadline'").drop("kind").withColumnRenamed("window_end", "deadline")


def forecasts_with_actuals(t: Tables, purpose: str) -> DataFrame:
    k = minutes_k()
    hour = F.window("ts", "1 hour").start
    site = (F.col("user_id") % 4).alias("site")
    f = events(t).select(
        "event_id", site, F.col("event_type").alias("model"), F.col("value").alias("pred"),
        C.shift_seconds(C.slot_start("ts", 60), k * 3600).cast("timestamp").alias("target_ts"),
    ).withWatermark("target_ts", "5 days")
    a = jobs.event_time(events(t), "ts", "1 hour").select("ts", site, "value")
    a = jobs.tumbling(a, "ts", "1 hour", ["site"], [stable_mean("value").alias("actual_kw"), F.count("*").alias("n_obs")])
    a = a.select("site", F.col("window_start").alias("hour"), "actual_kw", "n_obs")
    out = jobs.match_as_they_arrive(f, a, "site", "target_ts", "hour").drop("hour")
    return jobs.run_to_table(jobs.ntz(out, "target_ts"), purpose)


@query(
    "stream_matched_forecasts",
    "T5",
    """WITH w AS (SELECT least((SELECT max(ts) FROM events) - INTERVAL '1 hour', (SELECT max(target_ts) FROM fc) - INTERVAL '5 days') AS mark)
       SELECT f.event_id, f.site, f.model, f.target_ts, f.pred, h.actual_kw, h.n_obs FROM fc f JOIN site_hour h ON h.site = f.site AND h.hour = f.target_ts, w
       WHERE h.hour + INTERVAL '1 hour' <= w.mark""",
)
def _(t: Tables):
    return forecasts_with_actuals(t, "matched-forecasts").where(F.col("actual_kw").isNotNull())


@query(
    "stream_forecast_states",
    "T5",
    """WITH w AS (SELECT least((SELECT max(ts) FROM events) - INTERVAL '1 hour', (SELECT max(target_ts) FROM fc) - INTERVAL '5 days') AS mark),
       h AS (SELECT site_hour.* FROM site_hour, w WHERE hour + INTERVAL '1 hour' <= mark)
       SELECT f.event_id, f.site, f.model, f.target_ts, f.pred, h.actual_kw, h.n_obs, CASE WHEN h.hour IS NULL THEN 'unmatched' ELSE 'matched' END AS state
       FROM fc f CROSS JOIN w LEFT JOIN h ON h.site = f.site AND h.hour = f.target_ts WHERE h.hour IS NOT NULL OR f.target_ts <= w.mark""",
)
def _(t: Tables):
    # Every forecast up to the watermark, also those that met no closed hour.
    table = forecasts_with_actuals(t, "forecast-states")
    return table.withColumn("state", F.when(F.col("n_obs").isNull(), "unmatched").otherwise("matched"))


GATE_SQL = """w AS (SELECT max(ts) - INTERVAL '1 hour' AS mark FROM events),
       s AS (SELECT job, slot, bool_or(status = 'success') AS made, hour(slot) * 60 + minute(slot) BETWEEN 270 AND 1230 AS d FROM runs GROUP BY 1, 2),
       g AS (SELECT job, time_bucket(INTERVAL '7 days', slot, TIMESTAMP '1970-01-01 00:00:00') AS window_start, CAST(count(*) FILTER (d) AS BIGINT) AS executed,
         CAST(count(*) FILTER (made AND d) AS BIGINT) AS generated, CAST(count(*) FILTER (NOT d) AS BIGINT) AS night_waits FROM s, w GROUP BY 1, 2, mark HAVING window_start + INTERVAL '7 days' <= mark)"""


def weekly_gate(t: Tables) -> DataFrame:
    s = jobs.event_time(events(t), "ts", "1 hour").select(
        "ts", (F.col("user_id") % 4).alias("job"), (F.col("event_type") == "purchase").alias("ok")
    )
    operating = (F.hour("slot_start") * 60 + F.minute("slot_start")).between(270, 1230)
    # 65 slots a day from 04:30 to 20:30.
    return jobs.reliability_gate(s, "ts", ["job"], "ok", "15 minutes", "7 days", operating, 7 * 65)


@query(
    "stream_reliability_gate",
    "T6",
    f"WITH {GATE_SQL} SELECT job, window_start, window_start + INTERVAL '7 days' AS window_end, CAST(455 AS BIGINT) AS expected, executed, generated, night_waits FROM g",
)
def _(t: Tables):
    return jobs.run_to_table(jobs.ntz(weekly_gate(t), "window_start", "window_end"), "reliability-gate")


@query(
    "stream_registered_gate",
    "T6 A15",
    f"""WITH {GATE_SQL},
       e AS (SELECT DISTINCT job, unnest(generate_series(time_bucket(INTERVAL '7 days', from_ts, TIMESTAMP '1970-01-01 00:00:00'), coalesce(to_ts - INTERVAL '1 microsecond', mark), INTERVAL '7 days')) AS window_start FROM job_register, w),
       x AS (SELECT job, window_start, e.job IS NOT NULL AS registered, executed, generated, night_waits FROM (SELECT e.* FROM e, w WHERE window_start + INTERVAL '7 days' <= mark) e FULL JOIN g USING (job, window_start))
       SELECT job, window_start, window_start + INTERVAL '7 days' AS window_end, registered, CAST(CASE WHEN registered THEN 455 ELSE 0 END AS BIGINT) AS expected,
         coalesce(executed, 0) AS executed, coalesce(generated, 0) AS generated, coalesce(night_waits, 0) AS night_waits FROM x""",
)
def _(t: Tables):
    # The register lands as a table of its own.
    path = shared_dir(t.spark, "job-register")
    t.job_register.write.parquet(path)
    register = jobs.landing_stream(t.spark, path, t.job_register.schema)
    week = heartbeat.expected_periods(weekly_gate(t).drop("expected"), register, ["job"], ["executed", "generated", "night_waits"], 7 * 86400, 7 * 65)
    return jobs.run_to_table(jobs.ntz(week, "window_start", "window_end"), "registered-gate", stateful=True)


@query(
    "stream_outage_sessions",
    "T7",
    """WITH e AS (SELECT job, ts, event_id, lag(ts) OVER (PARTITION BY job ORDER BY ts, event_id) AS prev FROM runs WHERE status = 'error'),
       i AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL '2 hours' THEN 1 ELSE 0 END) OVER (PARTITION BY job ORDER BY ts, event_id) AS no FROM e),
       w AS (SELECT max(ts) - INTERVAL '1 hour' AS mark FROM e)
       SELECT job, min(ts) AS first_failure, max(ts) AS last_failure, CAST(count(*) AS BIGINT) AS failures FROM i, w GROUP BY job, no, mark
       HAVING max(ts) + INTERVAL '2 hours' <= mark""",
)
def _(t: Tables):
    s = jobs.event_time(events(t).where("event_type = 'error'"), "ts", "1 hour").select("ts", (F.col("user_id") % 4).alias("job"))
    out = jobs.ntz(jobs.outage_sessions(s, "ts", ["job"], "2 hours"), "first_failure", "last_failure")
    return jobs.run_to_table(out, "outage-sessions")


@query(
    "stream_stuck_values",
    "T8",
    """WITH w AS (SELECT max(ts) - INTERVAL '1 hour' AS mark FROM events),
       a AS (SELECT feed AS unit, slot, arg_max(k, ts) // 40 AS level FROM runs, w GROUP BY 1, 2, mark HAVING slot + INTERVAL '15 minutes' <= mark),
       p AS (SELECT *, lag(level) OVER o AS pl, lag(slot) OVER o AS ps FROM a WINDOW o AS (PARTITION BY unit ORDER BY slot)),
       s AS (SELECT *, max(CASE WHEN ps IS NULL OR slot - ps <> INTERVAL '15 minutes' OR pl <> level THEN slot END) OVER (PARTITION BY unit ORDER BY slot ROWS UNBOUNDED PRECEDING) AS st FROM p)
       SELECT unit, slot, CAST(level AS BIGINT) AS level, CAST(row_number() OVER (PARTITION BY unit, st ORDER BY slot) AS BIGINT) AS run_length FROM s QUALIFY run_length >= 3""",
)
def _(t: Tables):
    s = jobs.event_time(events(t), "ts", "1 hour").select("ts", "event_id", F.col("event_type").alias("unit"), minutes_k().alias("k"))
    last = F.max_by("k", F.struct("ts", "event_id")).alias("k")
    w = jobs.tumbling(s, "ts", "15 minutes", ["unit"], [last])
    w = w.select("unit", F.unix_micros("window_start").alias("window_us"), F.expr("k div 40").alias("level"), "window_end")
    out = jobs.with_state(w, ["unit"], jobs.StuckValue(["unit"], 900_000_000, 3), "unit string, window_us bigint, level bigint, run_length bigint", "None")
    out = us_to_ntz(out, slot="window_us").select("unit", "slot", "level", "run_length")
    return jobs.run_to_table(out, "stuck-values", stateful=True)


@query(
    "stream_assembled_inputs",
    "M6 J4 J5 J6",
    f"""WITH {INPUTS_SQL}, z AS (SELECT least((SELECT max(received_at) FROM obs), (SELECT max(ts) FROM p), (SELECT max(issue_ts) FROM issues)) - INTERVAL '1 hour' AS mark)
        SELECT y.*, CASE WHEN missing_inputs = '' THEN 'ready' ELSE 'waiting' END AS status FROM y, z WHERE issue_ts + INTERVAL '1 minute' < date_trunc('millisecond', mark)""",
)
def _(t: Tables):
    spec, station = input_spec(), (F.col("user_id") % 4).alias("station")
    k = minutes_k()
    versions = events(t).where("event_type = 'view'").select(
        "event_id", station, F.col("ts").cast("timestamp").alias("obs_ts"), k.cast("double").alias("cloud_pct"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("temp"),
        F.when(F.col("event_id") % 11 != 0, F.col("value") / 2).alias("humidity"), C.shift_seconds("ts", k * 60).cast("timestamp").alias("received_at"),
    ).withWatermark("received_at", "1 hour")
    readings = jobs.event_time(events(t).where("event_type <> 'view'").select("event_id", station, "ts", "value"), "ts", "1 hour")
    # The schedule lands as a table of its own, as a scheduler would write it.
    path = shared_dir(t.spark, "schedule")
    t.issues.write.parquet(path)
    asks = jobs.event_time(jobs.landing_stream(t.spark, path, t.issues.schema), "issue_ts", "1 hour")
    out = inputs.live_inputs(spec, versions, readings, asks, "received_at", "ts", "event_id", "value", "issue_ts")
    return jobs.run_to_table(out, "assembled-inputs", stateful=True)
