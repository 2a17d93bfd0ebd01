"""Queries on slot grids: gaps, fills, segments, energy, coverage, masking."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sunledger.functions import columns as C
from sunledger.functions.stats import stable_mean
from sunledger.operators import grid, quality
from sunledger.plans.common import rounded
from sunledger.plans.registry import query
from sunledger.plans.views import Tables
from sunledger.session import small_table

FIRST_SQL, END_SQL = "(SELECT a FROM log_period)", "(SELECT z FROM log_period)"  # of the logs, whatever their year
LIVE_AFTER_DAYS = 21
LIVE_SQL = f"{FIRST_SQL} + INTERVAL '{LIVE_AFTER_DAYS} days'"


def units(t: Tables):
    """The register of units; the spare one never reports."""
    return small_table(t.spark, [(u,) for u in ("click", "view", "purchase", "signup", "error", "spare")], "unit string")


def live_from(t: Tables):
    return C.shift_seconds(t.first, LIVE_AFTER_DAYS * 86400)


# --- parsing and states ------------------------------------------------------------------------


@query(
    "parsed_readings",
    "P11 S5",
    """SELECT event_id, unit, TRY_CAST(raw AS DOUBLE) AS value,
       CASE WHEN raw IS NULL THEN 'source_null' WHEN TRY_CAST(raw AS DOUBLE) IS NULL THEN 'comm_error' ELSE 'ok' END AS parse_status
       FROM readings_raw""",
)
def _(t: Tables):
    return t.readings_raw.select(
        "event_id", "unit", C.parsed_value("raw").alias("value"), C.parse_status("raw").alias("parse_status")
    )


STATE_SQL = """CASE WHEN raw IS NULL THEN 'source_missing' WHEN TRY_CAST(raw AS DOUBLE) IS NULL THEN 'comm_missing'
  WHEN TRY_CAST(raw AS DOUBLE) BETWEEN 0 AND 240 THEN 'observed' ELSE 'range_violation' END"""


@query(
    "quality_states_by_hour",
    "P12",
    f"""SELECT unit, date_trunc('hour', ts) AS hour, CAST(count(*) FILTER (s = 'observed') AS BIGINT) AS n_observed,
        CAST(count(*) FILTER (s = 'comm_missing') AS BIGINT) AS n_comm_missing,
        CAST(count(*) FILTER (s = 'source_missing') AS BIGINT) AS n_source_missing,
        CAST(count(*) FILTER (s = 'range_violation') AS BIGINT) AS n_range_violation
        FROM (SELECT *, {STATE_SQL} AS s FROM readings_raw) GROUP BY 1, 2""",
)
def _(t: Tables):
    v = C.parsed_value("raw")
    state = quality.quality_state(C.parse_status("raw"), v.between(0, 240))
    rows = t.readings_raw.select("unit", "ts", state.alias("s"))
    return quality.state_counts(
        rows, ["unit", C.slot_start("ts", 60).alias("hour")], "s",
        ["observed", "comm_missing", "source_missing", "range_violation"],
    )


@query(
    "range_flags",
    "P9",
    """SELECT event_id, unit, CASE WHEN TRY_CAST(raw AS DOUBLE) IS NULL THEN 'missing' WHEN hi IS NULL THEN 'no_limit'
         WHEN TRY_CAST(raw AS DOUBLE) BETWEEN lo AND hi THEN 'ok' ELSE 'range_violation' END AS range_state
       FROM readings_raw LEFT JOIN (VALUES ('click', 0.0, 100.0), ('view', 0.0, 60.0), ('purchase', 5.0, 240.0)) AS l(u, lo, hi)
       ON u = unit""",
)
def _(t: Tables):
    limits = small_table(
        t.spark, [("click", 0.0, 100.0), ("view", 0.0, 60.0), ("purchase", 5.0, 240.0)], "unit string, lo double, hi double"
    )
    rows = t.readings_raw.select("event_id", "unit", C.parsed_value("raw").alias("value"))
    return quality.flag_range(rows, limits, ["unit"], "value").select("event_id", "unit", "range_state")


@query(
    "invalid_sensor_screen",
    "P13",
    """SELECT unit, s AS status, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (s = 'valid' AND k > 90) AS BIGINT) AS n_alarm
       FROM (SELECT unit, k, CASE WHEN k IS NULL THEN 'missing' WHEN k = 0 THEN 'not_valid' ELSE 'valid' END AS s FROM readings_raw)
       GROUP BY 1, 2""",
)
def _(t: Tables):
    rows = t.readings_raw.withColumn("status", quality.screen_invalid("k", 0))
    return rows.groupBy("unit", "status").agg(
        F.count("*").alias("n"), F.count_if((F.col("status") == "valid") & (F.col("k") > 90)).alias("n_alarm")
    )


@query(
    "row_funnel",
    "A28",
    """SELECT unit, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (raw IS NOT NULL) AS BIGINT) AS has_text,
       CAST(count(*) FILTER (TRY_CAST(raw AS DOUBLE) IS NOT NULL) AS BIGINT) AS is_number,
       CAST(count(*) FILTER (TRY_CAST(raw AS DOUBLE) BETWEEN 0 AND 240) AS BIGINT) AS in_range,
       round(count(*) FILTER (TRY_CAST(raw AS DOUBLE) BETWEEN 0 AND 240) / count(*), 6) AS valid_share
       FROM readings_raw GROUP BY unit""",
)
def _(t: Tables):
    v = C.parsed_value("raw")
    out = quality.funnel(
        t.readings_raw,
        {"has_text": F.col("raw").isNotNull(), "is_number": v.isNotNull(), "in_range": v.between(0, 240)},
        by=["unit"],
    )
    return out.withColumn("valid_share", F.round(F.col("in_range") / F.col("n_rows"), 6))


# --- grid --------------------------------------------------------------------------------------


@query("slot_grid", "W8", "SELECT unit, slot, kw FROM grid")
def _(t: Tables):
    return t.grid.select("unit", "slot", "kw")


@query("missing_slots", "J11", "SELECT unit, slot FROM grid WHERE n_obs IS NULL")
def _(t: Tables):
    return grid.missing_slots(t.readings, ["unit"], "slot", 15)


@query(
    "slot_states",
    "P20",
    f"""SELECT unit, slot, CASE WHEN kw IS NOT NULL THEN 'observed' WHEN slot > a THEN 'future' ELSE 'missing' END AS state
       FROM (SELECT u.unit, u.slot, r.kw, {END_SQL} - INTERVAL '730 minutes' AS a FROM (SELECT unit, unnest(generate_series({FIRST_SQL},
           {END_SQL} - INTERVAL '15 minutes', INTERVAL '15 minutes')) AS slot FROM (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('error'), ('spare')) AS v(unit)) u
         LEFT JOIN readings r ON r.unit = u.unit AND r.slot = u.slot)""",
)
def _(t: Tables):
    # One clock and one register for all: a unit that is silent, or was never heard of, is missing and not in the future.
    slots = grid.period_slots(units(t), "slot", t.first, C.shift_seconds(t.end, -900), 15)
    now = C.shift_seconds(t.end, -730 * 60)
    rows = slots.join(t.readings, ["unit", "slot"], "left")
    return rows.select("unit", "slot", quality.slot_state("slot", "kw", now).alias("state"))


@query(
    "gap_lengths",
    "W11",
    """SELECT unit, prev_slot + INTERVAL '15 minutes' AS gap_start, gap_slots, CAST(count(*) AS BIGINT) AS n_rows FROM gaps
       WHERE gap_slots IS NOT NULL GROUP BY ALL""",
)
def _(t: Tables):
    return (
        t.gaps.where(F.col("gap_slots").isNotNull())
        .groupBy("unit", C.shift_seconds("prev_slot", 900).alias("gap_start"), "gap_slots")
        .agg(F.count("*").alias("n_rows"))
    )


@query(
    "linear_fill",
    "W12",
    """SELECT unit, slot, round(coalesce(kw, CASE WHEN gap_slots <= 2 THEN prev_kw + (next_kw - prev_kw)
         * date_diff('minute', prev_slot, slot) / date_diff('minute', prev_slot, next_slot) END), 8) AS kw,
       CASE WHEN kw IS NOT NULL THEN 'observed' WHEN gap_slots <= 2 THEN 'interpolated' ELSE 'comm_missing' END AS state FROM gaps""",
)
def _(t: Tables):
    made = grid.fill("linear", "slot", "kw", 2)
    return t.gaps.select("unit", "slot", F.round(made, 8).alias("kw"), grid.fill_state("kw", made).alias("state"))


@query(
    "other_fills",
    "W13",
    """SELECT unit, slot, round(coalesce(kw, CASE WHEN gap_slots <= 2 THEN prev_kw END), 6) AS previous,
       round(coalesce(kw, CASE WHEN gap_slots <= 2 THEN (prev_kw + next_kw) / 2 END), 8) AS neighbour_mean,
       round(coalesce(kw, CASE WHEN gap_slots <= 2 THEN
         CASE WHEN date_diff('minute', prev_slot, slot) * 2 <= date_diff('minute', prev_slot, next_slot) THEN prev_kw ELSE next_kw END END), 6) AS nearest
       FROM gaps""",
)
def _(t: Tables):
    digits = {"previous": 6, "neighbour_mean": 8, "nearest": 6}
    return t.gaps.select(
        "unit", "slot", *[F.round(grid.fill(m, "slot", "kw", 2), d).alias(m) for m, d in digits.items()]
    )


@query(
    "causal_fill",
    "W15",
    """SELECT unit, slot, round(coalesce(CASE WHEN received_at <= slot + INTERVAL '1 hour' THEN kw END,
         CASE WHEN kw IS NULL AND gap_slots <= 2 AND next_received <= slot + INTERVAL '1 hour' AND prev_received <= slot + INTERVAL '1 hour'
         THEN prev_kw + (next_kw - prev_kw) * date_diff('minute', prev_slot, slot) / date_diff('minute', prev_slot, next_slot) END), 8) AS kw
       FROM gaps""",
)
def _(t: Tables):
    issue = C.shift_seconds("slot", 3600)
    return t.gaps.select("unit", "slot", F.round(grid.fill("linear", "slot", "kw", 2, as_of=issue), 8).alias("kw"))


def _weights_sql() -> str:
    rows = [
        f"({n}, {p}, {off}, {w!r}::DOUBLE)" for n in (1, 2, 3) for p, off, w in grid.spline_weights(n, 3)
    ]
    return "(VALUES " + ", ".join(rows) + ") AS w(gap_slots, pos, off, w)"


@query(
    "spline_fill",
    "W14",
    f"""SELECT m.unit, m.slot, CAST(m.gap_slots AS BIGINT) AS gap_slots, round(sum(w.w * g.kw), 4) AS spline_kw,
          sum(w.w * g.kw) NOT BETWEEN 0 AND 240 AS out_of_range
        FROM (SELECT unit, slot, gap_slots, date_diff('minute', prev_slot, slot) / 15 - 1 AS pos FROM gaps WHERE gap_slots <= 3) m
        JOIN {_weights_sql()} ON w.gap_slots = m.gap_slots AND w.pos = m.pos
        JOIN grid g ON g.unit = m.unit AND g.slot = m.slot + (w.off - w.pos) * INTERVAL '15 minutes' AND g.kw IS NOT NULL
        GROUP BY 1, 2, 3 HAVING count(*) = 6""",
)
def _(t: Tables):
    out = grid.spline_fill(t.gaps, ["unit"], "slot", "kw", 15, 3, knots=3)
    return out.select(
        "unit", "slot", "gap_slots", F.round("spline_kw", 4).alias("spline_kw"),
        (~F.col("spline_kw").between(0, 240)).alias("out_of_range"),
    )


SEG_SQL = """p AS (SELECT *, lag(slot) OVER (PARTITION BY unit ORDER BY slot) AS prev FROM readings),
  s AS (SELECT unit, slot, kw, max(CASE WHEN prev IS NULL OR slot - prev > INTERVAL '45 minutes' THEN slot END)
        OVER (PARTITION BY unit ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS segment_start FROM p)"""


def segmented(t: Tables):
    return grid.segments(t.readings.select("unit", "slot", "kw"), ["unit"], "slot", 45 * 60)


@query(
    "segments",
    "W9",
    f"WITH {SEG_SQL} SELECT unit, segment_start, max(slot) AS segment_end, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1, 2",
)
def _(t: Tables):
    return segmented(t).groupBy("unit", "segment_start").agg(F.max("slot").alias("segment_end"), F.count("*").alias("n"))


@query(
    "segment_lags",
    "W10",
    f"""WITH {SEG_SQL} SELECT unit, slot, max(kw) OVER (w RANGE BETWEEN INTERVAL '15 minutes' PRECEDING AND INTERVAL '15 minutes' PRECEDING) AS lag_15,
          max(kw) OVER (w RANGE BETWEEN INTERVAL '60 minutes' PRECEDING AND INTERVAL '60 minutes' PRECEDING) AS lag_60,
          round(avg(kw) OVER (w RANGE BETWEEN INTERVAL '60 minutes' PRECEDING AND CURRENT ROW), 8) AS mean_60
        FROM s WINDOW w AS (PARTITION BY unit, segment_start ORDER BY slot)""",
)
def _(t: Tables):
    out = grid.segment_windows(
        segmented(t), ["unit"], "slot", "kw", {"lag_15": 900, "lag_60": 3600}, {"mean_60": 3600}
    )
    return out.select("unit", "slot", "lag_15", "lag_60", F.round("mean_60", 8).alias("mean_60"))


@query(
    "horizon_targets",
    "W26",
    f"""WITH {SEG_SQL} SELECT a.unit, a.slot, CAST(h AS BIGINT) AS horizon_h, b.kw AS target FROM s a, (VALUES (1), (2), (3), (4)) AS v(h)
        LEFT JOIN s b ON b.unit = a.unit AND b.segment_start = a.segment_start AND b.slot = a.slot + h * INTERVAL '1 hour'""",
)
def _(t: Tables):
    out = grid.horizon_targets(segmented(t), ["unit"], "slot", "kw", [1, 2, 3, 4])
    return out.select("unit", "slot", "horizon_h", "target")


@query(
    "calendar_features",
    "W25",
    """SELECT unit, slot, CAST(hour(slot) AS BIGINT) AS hour, CAST(dayofyear(slot) AS BIGINT) AS day_of_year, CAST(month(slot) AS BIGINT) AS month_no,
       round(sin(2 * pi() / 24 * hour(slot)), 8) AS hour_sin, round(cos(2 * pi() / 24 * hour(slot)), 8) AS hour_cos,
       round(sin(2 * pi() / 365 * dayofyear(slot)), 8) AS doy_sin, round(cos(2 * pi() / 365 * dayofyear(slot)), 8) AS doy_cos FROM readings""",
)
def _(t: Tables):
    f = C.calendar_features("slot")
    out = t.readings.select("unit", "slot", *[c.alias(n) for n, c in f.items()])
    return rounded(out, 8, "hour_sin", "hour_cos", "doy_sin", "doy_cos")


ELEV_SQL = """degrees(asin(greatest(-1, least(1, sin(radians(35.1)) * sin(radians(23.45) * sin(2 * pi() / 365 * (dayofyear({0}) + 284)))
  + cos(radians(35.1)) * cos(radians(23.45) * sin(2 * pi() / 365 * (dayofyear({0}) + 284)))
  * cos(radians((hour({0}) + minute({0}) / 60.0 + (126.9 - 135.0) / 15.0 - 12.0) * 15.0))))))"""


@query(
    "solar_elevation",
    "P16",
    f"SELECT unit, slot, round({ELEV_SQL.format('slot')}, 6) AS elevation, {ELEV_SQL.format('slot')} > 5 AS is_day FROM readings",
)
def _(t: Tables):
    e = C.solar_elevation("slot", 35.1, 126.9)
    return t.readings.select("unit", "slot", F.round(e, 6).alias("elevation"), (e > 5).alias("is_day"))


@query(
    "daytime_rows",
    "P17",
    f"""SELECT unit, CAST(count(*) FILTER (d AND kw >= 5) AS BIGINT) AS n_day, CAST(count(*) FILTER (NOT d) AS BIGINT) AS n_night_wait,
        CAST(count(*) FILTER (d AND kw < 5) AS BIGINT) AS n_low, round(avg(kw) FILTER (d AND kw >= 5), 5) AS day_mean
        FROM (SELECT *, {ELEV_SQL.format('slot')} > 5 AS d FROM readings) GROUP BY unit""",
)
def _(t: Tables):
    rows = t.readings.withColumn("d", C.solar_elevation("slot", 35.1, 126.9) > 5)
    use = F.col("d") & (F.col("kw") >= 5)
    return rows.groupBy("unit").agg(
        F.count_if(use).alias("n_day"),
        F.count_if(~F.col("d")).alias("n_night_wait"),
        F.count_if(F.col("d") & (F.col("kw") < 5)).alias("n_low"),
        F.round(F.avg(F.when(use, F.col("kw"))), 5).alias("day_mean"),
    )


# --- energy, coverage, periods -----------------------------------------------------------------


@query(
    "hourly_energy",
    "A11",
    """SELECT unit, date_trunc('hour', slot) AS hour, round(sum(kw) * 0.25, 8) AS energy_kwh, CAST(count(kw) AS BIGINT) AS n_slots
       FROM readings GROUP BY 1, 2""",
)
def _(t: Tables):
    out = quality.energy(t.readings, ["unit"], "slot", "kw", 0.25, C.slot_start("slot", 60), "hour")
    return rounded(out, 8, "energy_kwh")


@query(
    "daily_energy",
    "A11",
    """SELECT unit, CAST(slot AS DATE) AS day, round(sum(kw) * 0.25, 8) AS energy_kwh, CAST(count(kw) AS BIGINT) AS n_slots
       FROM readings GROUP BY 1, 2""",
)
def _(t: Tables):
    out = quality.energy(t.readings, ["unit"], "slot", "kw", 0.25, F.col("slot").cast("date"), "day")
    return rounded(out, 8, "energy_kwh")


PERIOD_SQL = f"CASE WHEN slot >= {LIVE_SQL} THEN 'live' ELSE 'archive' END"


@query(
    "slot_coverage",
    "A12",
    f"""SELECT unit, {PERIOD_SQL} AS period, CAST(count(*) AS BIGINT) AS expected_slots, CAST(count(n_obs) AS BIGINT) AS observed_slots,
        round(1 - count(n_obs) / count(*), 6) AS gap_rate FROM (SELECT v.unit, v.slot, r.n_obs FROM
          (SELECT unit, unnest(generate_series({FIRST_SQL}, {END_SQL} + INTERVAL '1425 minutes', INTERVAL '15 minutes')) AS slot
           FROM (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('error'), ('spare')) AS u(unit)) v LEFT JOIN readings r USING (unit, slot)) GROUP BY 1, 2""",
)
def _(t: Tables):
    period = F.when(F.col("slot") >= live_from(t), "live").otherwise("archive").alias("period")
    expected = grid.period_slots(units(t), "slot", t.first, C.shift_seconds(t.end, 1425 * 60), 15)
    return rounded(quality.coverage(expected, t.readings, ["unit"], "slot", ["unit", period]), 6, "gap_rate")


@query(
    "archive_and_live",
    "U2 U1",
    f"""SELECT unit, slot, kw, n_obs, 'archive' AS period FROM readings WHERE slot < {LIVE_SQL}
        UNION ALL SELECT unit, slot, kw, NULL, 'live' FROM readings WHERE slot >= {LIVE_SQL}""",
)
def _(t: Tables):
    archive = t.readings.where(F.col("slot") < live_from(t)).select("unit", "slot", "kw", "n_obs", F.lit("archive").alias("period"))
    live = t.readings.where(F.col("slot") >= live_from(t)).select("unit", "slot", "kw", F.lit("live").alias("period"))
    return archive.unionByName(live, allowMissingColumns=True)


@query(
    "complete_months",
    "P18",
    """SELECT site, month, round(n_days / day(last_day(month)), 6) AS coverage,
         CASE WHEN n_days = day(last_day(month)) THEN actual_kwh END AS complete_value,
         CASE WHEN n_days < day(last_day(month)) THEN 'incomplete' END AS reason FROM site_month""",
)
def _(t: Tables):
    out = quality.complete_only(t.site_month, "n_days", F.dayofmonth(F.last_day("month")), "actual_kwh", 1.0)
    return rounded(out.select("site", "month", "coverage", "complete_value", "reason"), 6, "coverage")


@query(
    "silent_units",
    "W27",
    f"""WITH x AS (SELECT unit, slot, coalesce(lag(slot) OVER (PARTITION BY unit ORDER BY slot), {FIRST_SQL} - INTERVAL '15 minutes') AS prev_slot FROM readings
         UNION ALL SELECT v.unit, NULL, coalesce(max(slot), {FIRST_SQL} - INTERVAL '15 minutes') FROM (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('error'), ('spare')) AS v(unit)
           LEFT JOIN readings r ON r.unit = v.unit GROUP BY 1)
       SELECT unit, CASE WHEN prev_slot >= {FIRST_SQL} THEN prev_slot END AS prev_slot, slot AS next_slot,
         CAST(date_diff('minute', prev_slot, coalesce(slot, {END_SQL} + INTERVAL '735 minutes')) / 15 - 1 AS BIGINT) AS gap_slots, slot IS NULL AS is_open
       FROM x WHERE date_diff('minute', prev_slot, coalesce(slot, {END_SQL} + INTERVAL '735 minutes')) / 15 - 1 >= 6""",
)
def _(t: Tables):
    return quality.silences(t.readings, units(t), ["unit"], "slot", 15, 6, t.first, C.shift_seconds(t.end, 12 * 3600))


# --- masking experiment ------------------------------------------------------------------------

HOURLY_SQL = """h AS (SELECT g.unit, g.slot, r.kw FROM (SELECT unit, unnest(generate_series(date_trunc('day', min(ts)),
    date_trunc('day', max(ts)) + INTERVAL '23 hours', INTERVAL '1 hour')) AS slot FROM readings_raw WHERE k < 94 GROUP BY unit) g
  LEFT JOIN (SELECT unit, date_trunc('hour', ts) AS slot, round(sum(TRY_CAST(raw AS DOUBLE)), 6) / count(*) AS kw FROM readings_raw WHERE k < 94
    GROUP BY 1, 2) r ON r.unit = g.unit AND r.slot = g.slot),
  c AS (SELECT h.unit, h.slot AS mask_start, n AS mask_slots FROM h, (VALUES (1), (2), (3), (6)) AS v(n)
    WHERE (SELECT count(kw) FROM h x WHERE x.unit = h.unit AND x.slot BETWEEN h.slot - 6 * INTERVAL '1 hour'
           AND h.slot + (n + 5) * INTERVAL '1 hour') = n + 12),
  m AS (SELECT *, row_number() OVER (PARTITION BY mask_slots ORDER BY
      md5(concat_ws('|', '42', unit, CAST(CAST(epoch(mask_start) AS BIGINT) AS VARCHAR), CAST(mask_slots AS VARCHAR))), unit, mask_start) AS case_no FROM c
    QUALIFY case_no <= 500),
  z AS (SELECT m.*, pos, l.kw AS left_kw, r.kw AS right_kw, a.kw AS actual FROM m, (SELECT unnest(range(6)) AS pos)
    JOIN h l ON l.unit = m.unit AND l.slot = mask_start - INTERVAL '1 hour'
    JOIN h r ON r.unit = m.unit AND r.slot = mask_start + mask_slots * INTERVAL '1 hour'
    JOIN h a ON a.unit = m.unit AND a.slot = mask_start + pos * INTERVAL '1 hour' WHERE pos < mask_slots)"""


def hourly(t: Tables):
    raw = t.readings_raw.where("k < 94").groupBy("unit", C.slot_start("ts", 60).alias("slot"))
    return grid.reindex(raw.agg(stable_mean(C.parsed_value("raw")).alias("kw")), ["unit"], "slot", 60)


def rebuilt(t: Tables):
    h = hourly(t)
    runs = grid.complete_runs(h, ["unit"], "slot", "kw", [1, 2, 3, 6], 60, 6)
    masks = grid.sample_masks(runs, ["unit"], 500, 42)
    return grid.masked_reconstruction(masks, h, ["unit"], "slot", "kw", 60, 6, [1, 2, 3, 6])


def _mask_weights_sql() -> str:
    rows = [f"({n}, {p}, {off}, {w!r}::DOUBLE)" for n in (1, 2, 3, 6) for p, off, w in grid.spline_weights(n, 6)]
    return "(VALUES " + ", ".join(rows) + ") AS w(n, pos, off, w)"


@query(
    "masked_reconstruction",
    "W16",
    f"""WITH {HOURLY_SQL}, sp AS (SELECT z.unit, z.mask_start, z.mask_slots, z.pos, sum(w.w * x.kw) AS spline FROM z
          JOIN {_mask_weights_sql()} ON w.n = z.mask_slots AND w.pos = z.pos
          JOIN h x ON x.unit = z.unit AND x.slot = z.mask_start + w.off * INTERVAL '1 hour' GROUP BY 1, 2, 3, 4)
        SELECT CAST(mask_slots AS BIGINT) AS mask_slots, CAST(count(DISTINCT case_no) AS BIGINT) AS cases,
          round(avg(abs(left_kw + (right_kw - left_kw) * (pos + 1) / (mask_slots + 1) - actual)), 4) AS linear_mae,
          round(avg(abs(left_kw - actual)), 4) AS previous_mae, round(avg(abs((left_kw + right_kw) / 2 - actual)), 4) AS neighbour_mean_mae,
          round(avg(abs(CASE WHEN (pos + 1) * 2 <= mask_slots + 1 THEN left_kw ELSE right_kw END - actual)), 4) AS nearest_mae,
          round(avg(abs(spline - actual)), 4) AS spline_mae, CAST(count(*) FILTER (spline NOT BETWEEN 0 AND 240) AS BIGINT) AS spline_out_of_range
        FROM z JOIN sp USING (unit, mask_start, mask_slots, pos) GROUP BY mask_slots""",
)
def _(t: Tables):
    methods = ["linear", "previous", "neighbour_mean", "nearest", "spline"]
    return rebuilt(t).groupBy("mask_slots").agg(
        F.count_distinct("case_no").alias("cases"),
        *[F.round(F.avg(F.abs(F.col(m) - F.col("actual"))), 4).alias(f"{m}_mae") for m in methods],
        F.count_if(~F.col("spline").between(0, 240)).alias("spline_out_of_range"),
    )


@query(
    "fill_error_by_volatility",
    "W17",
    f"""WITH {HOURLY_SQL}, q AS (SELECT DISTINCT mask_slots, unit, mask_start, case_no, abs(right_kw - left_kw) AS change FROM z),
          b AS (SELECT *, ntile(4) OVER (PARTITION BY mask_slots ORDER BY change, case_no) AS quartile FROM q)
        SELECT CAST(mask_slots AS BIGINT) AS mask_slots, CAST(quartile AS INTEGER) AS quartile, CAST(count(*) AS BIGINT) AS n,
          round(avg(abs(left_kw + (right_kw - left_kw) * (pos + 1) / (mask_slots + 1) - actual)), 4) AS linear_mae
        FROM z JOIN b USING (mask_slots, unit, mask_start, case_no) GROUP BY 1, 2""",
)
def _(t: Tables):
    rows = rebuilt(t)
    cases = rows.groupBy("mask_slots", "case_no").agg(F.max(F.abs(F.col("right_kw") - F.col("left_kw"))).alias("change"))
    # The sampled cases of a length are at most the sample size, so a ranked partition is bounded.
    ranked = cases.withColumn("quartile", F.ntile(4).over(Window.partitionBy("mask_slots").orderBy("change", "case_no"))).drop("change")
    return (
        rows.join(ranked, ["mask_slots", "case_no"])
        .groupBy("mask_slots", "quartile")
        .agg(F.count("*").alias("n"), F.round(F.avg(F.abs(F.col("linear") - F.col("actual"))), 4).alias("linear_mae"))
    )
