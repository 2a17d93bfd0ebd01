"""Queries on capacity roles, peers, limits, meters and reconciliations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sunledger.functions import columns as C
from sunledger.functions.stats import stable_mean
from sunledger.operators import grid, quality
from sunledger.operators.scans import DAY, with_halo
from sunledger.plans.common import rounded
from sunledger.plans.registry import query
from sunledger.plans.views import Tables


@query(
    "clipped_predictions",
    "P10",
    """SELECT u.unit, u.month, round(CASE WHEN kwh / 100 - 300 < 0 THEN 0.0 WHEN kwh / 100 - 300 > c.kw THEN c.kw ELSE kwh / 100 - 300 END, 4) AS clipped
       FROM unit_month u LEFT JOIN capacity c ON c.unit = u.unit AND c.role = 'inverter_sum'""",
)
def _(t: Tables):
    rows = t.unit_month.withColumn("pred", F.col("kwh") / 100 - 300)
    out = quality.clip_predictions(rows, t.capacity, ["unit"], "inverter_sum", "pred")
    return out.select("unit", "month", F.round("clipped", 4).alias("clipped"))


@query(
    "capacity_by_role",
    "J7",
    """SELECT u.site, CAST(count(*) AS BIGINT) AS n, round(sum(i.kw), 4) AS inverter_kw, round(sum(p.kw), 4) AS api_kw
       FROM unit_month u JOIN capacity i ON i.unit = u.unit AND i.role = 'inverter_sum'
       JOIN capacity p ON p.unit = u.unit AND p.role = 'plant_api' GROUP BY u.site""",
)
def _(t: Tables):
    rows = quality.with_capacity(t.unit_month, t.capacity, ["unit"], "inverter_sum").withColumnRenamed("capacity_kw", "i")
    rows = quality.with_capacity(rows, t.capacity, ["unit"], "plant_api").withColumnRenamed("capacity_kw", "p")
    return rows.groupBy("site").agg(
        F.count("*").alias("n"), F.round(F.sum("i"), 4).alias("inverter_kw"), F.round(F.sum("p"), 4).alias("api_kw")
    )


PEER_SQL = """peers AS (SELECT unit, site, month, kwh, CAST(count(*) OVER g - 1 AS BIGINT) AS n_peers,
  (sum(kwh) OVER g - kwh) / nullif(count(*) OVER g - 1, 0) AS peer_mean FROM unit_month WINDOW g AS (PARTITION BY site, month))"""


@query("peer_comparison", "J10", f"WITH {PEER_SQL} SELECT unit, site, month, n_peers, round(peer_mean, 7) AS peer_mean FROM peers")
def _(t: Tables):
    out = quality.peer_mean(t.unit_month, ["site", "month"], "kwh")
    return out.select("unit", "site", "month", "n_peers", F.round("peer_mean", 7).alias("peer_mean"))


@query(
    "normalized_scores",
    "A6",
    f"""WITH {PEER_SQL} SELECT p.site, CAST(count(peer_mean) AS BIGINT) AS n,
        round(avg(abs(peer_mean - kwh) / c.kw) * 100, 4) AS nmae, round(sqrt(avg(power((peer_mean - kwh) / c.kw, 2))) * 100, 4) AS nrmse
        FROM peers p JOIN capacity c ON c.unit = p.unit AND c.role = 'plant_api' GROUP BY p.site""",
)
def _(t: Tables):
    rows = quality.peer_mean(t.unit_month, ["site", "month"], "kwh")
    rows = quality.with_capacity(rows, t.capacity, ["unit"], "plant_api")
    return rounded(quality.normalized_scores(rows, ["site"], "kwh", "peer_mean", "capacity_kw"), 4, "nmae", "nrmse")


@query(
    "outside_defects",
    "P14",
    """SELECT event_id, unit, ts FROM readings_raw r WHERE NOT EXISTS
       (SELECT 1 FROM defects d WHERE d.unit = r.unit AND r.ts >= d.from_ts AND r.ts < d.to_ts)""",
)
def _(t: Tables):
    return quality.exclude_periods(t.readings_raw, t.defects, ["unit"], "ts").select("event_id", "unit", "ts")


@query(
    "defect_audit_states",
    "P14",
    """SELECT unit, s AS audit_state, CAST(count(*) AS BIGINT) AS n FROM (SELECT unit, CASE WHEN EXISTS
         (SELECT 1 FROM defects d WHERE d.unit = r.unit AND r.ts >= d.from_ts AND r.ts < d.to_ts) THEN 'defect'
         WHEN unit IN ('click', 'error') THEN 'audited' ELSE 'unaudited' END AS s FROM readings_raw r) GROUP BY 1, 2""",
)
def _(t: Tables):
    rows = quality.audit_state(t.readings_raw, t.defects, ["click", "error"], "unit", "ts")
    return rows.groupBy("unit", "audit_state").agg(F.count("*").alias("n"))


@query(
    "partial_capacity_days",
    "P19",
    """SELECT unit, CAST(slot AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_slots,
         CAST(count(*) FILTER (b) AS BIGINT) AS n_out, bool_or(b) AS partial_capacity
       FROM (SELECT r.*, EXISTS (SELECT 1 FROM defects d WHERE d.unit = r.unit AND r.slot >= d.from_ts AND r.slot < d.to_ts) AS b FROM readings r)
       GROUP BY 1, 2""",
)
def _(t: Tables):
    rows = quality.audit_state(t.readings, t.defects, [], "unit", "slot")
    out = F.col("audit_state") == "defect"
    return rows.groupBy("unit", F.col("slot").cast("date").alias("day")).agg(
        F.count("*").alias("n_slots"), F.count_if(out).alias("n_out"), F.bool_or(out).alias("partial_capacity")
    )


@query(
    "scale_check",
    "P15",
    """SELECT station, CAST(count(*) AS BIGINT) AS n_compared, CAST(count(*) FILTER (abs(cloud_pct - 10 * cloud_tenths) > 1e-6) AS BIGINT) AS n_mismatch,
       CAST(count(*) FILTER (abs(cloud_pct - cloud_tenths) <= 1e-6 AND cloud_pct <> 0) AS BIGINT) AS n_same_scale,
       CAST(count(*) FILTER (cloud_pct NOT BETWEEN 0 AND 95) AS BIGINT) AS n_out_of_range,
       bool_and(abs(cloud_pct - 10 * cloud_tenths) <= 1e-6) AS consistent FROM obs GROUP BY station""",
)
def _(t: Tables):
    return quality.scale_check(t.obs, ["station"], "cloud_pct", "cloud_tenths", 10.0, 0, 95)


@query(
    "nearby_stations",
    "J12",
    """WITH h AS (SELECT station, date_trunc('hour', obs_ts) AS hour, round(sum(temp), 6) / nullif(count(temp), 0) AS temp FROM obs GROUP BY 1, 2)
       SELECT s.station, s.hour, n.station AS near_station, s.temp AS site_temp, n.temp AS near_temp, round(n.temp - s.temp, 6) AS diff
       FROM h s LEFT JOIN h n ON n.hour = s.hour AND n.station <> s.station""",
)
def _(t: Tables):
    h = t.obs.groupBy("station", C.slot_start("obs_ts", 60).alias("hour")).agg(stable_mean("temp").alias("temp"))
    # As many rows as stations meet in an hour; one that is alone stays, without a neighbour.
    site = h.select("station", "hour", F.col("temp").alias("site_temp"))
    near = h.select(F.col("hour").alias("near_hour"), F.col("station").alias("near_station"), F.col("temp").alias("near_temp"))
    both = site.join(near, (F.col("hour") == F.col("near_hour")) & (F.col("station") != F.col("near_station")), "left").drop("near_hour")
    return both.withColumn("diff", F.round(F.col("near_temp") - F.col("site_temp"), 6))


@query(
    "meter_reconciliation",
    "J13",
    """WITH m AS (SELECT r_name AS site, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
           round(sum(CASE WHEN month(l_shipdate) <> 2 THEN l_extendedprice * (1 - l_discount) END), 4) AS meter_kwh
         FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
         GROUP BY 1, 2)
       SELECT site, month, s.actual_kwh AS inverter_kwh, meter_kwh, round(s.actual_kwh - meter_kwh, 4) AS diff,
         round(abs(s.actual_kwh - meter_kwh) / nullif(meter_kwh, 0) * 100, 5) AS diff_pct,
         CASE WHEN s.actual_kwh IS NULL THEN 'left_missing' WHEN meter_kwh IS NULL THEN 'right_missing'
              WHEN abs(s.actual_kwh - meter_kwh) / nullif(meter_kwh, 0) * 100 <= 5.25 THEN 'within' ELSE 'outside' END AS state
       FROM site_month s FULL JOIN m USING (site, month)""",
)
def _(t: Tables):
    meter = (
        # The meter is silent in February: its value is NULL there, the rows stay.
        t.sold.groupBy("site", F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"))
        .agg(F.round(F.sum(F.when(F.month("l_shipdate") != 2, F.col("l_extendedprice") * (1 - F.col("l_discount")))), 4).alias("meter_kwh"))
    )
    inverters = t.site_month.select("site", "month", F.col("actual_kwh").alias("inverter_kwh"))
    out = quality.reconcile(inverters, meter, ["site", "month"], "inverter_kwh", "meter_kwh", 5.25)
    return rounded(rounded(out, 4, "diff"), 5, "diff_pct")


@query(
    "recalculation_difference",
    "A23",
    """SELECT b.site, CAST(count(*) AS BIGINT) AS n_keys, CAST(count(*) FILTER (b.unit % 50 = 3) AS BIGINT) AS n_unmatched,
       round(max(abs(b.kwh - CASE WHEN b.unit % 50 <> 3 THEN round(b.kwh, 0) END)), 4) AS max_abs_diff FROM unit_month b GROUP BY b.site""",
)
def _(t: Tables):
    # Some units had no value before; their rows stay.
    before = t.unit_month.select("unit", "site", "month", F.when(F.col("unit") % 50 != 3, F.round("kwh", 0)).alias("kwh"))
    out = quality.max_difference(before, t.unit_month, ["site", "unit", "month"], "kwh", ["site"])
    return rounded(out, 4, "max_abs_diff")


@query(
    "performance_ratio",
    "A27",
    """WITH c AS (SELECT r_name AS site, CASE WHEN r_name <> 'AFRICA' THEN sum(0.95 * (abs(s_acctbal) + 100)) END AS kw FROM supplier JOIN nation ON s_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey GROUP BY 1),
       x AS (SELECT m.*, c.kw, day(last_day(month)) AS dim, n_days / day(last_day(month)) AS cov FROM site_month m LEFT JOIN c USING (site)),
       y AS (SELECT *, CASE WHEN kw IS NULL OR kw <= 0 THEN 'no capacity' WHEN cov < 1 THEN 'incomplete period'
             WHEN month(month) % 2 = 1 THEN 'no plane irradiance' END AS reason FROM x)
       SELECT site, month, reason, CASE WHEN reason IS NULL OR reason = 'no plane irradiance' THEN round(actual_kwh / (kw * dim * 24), 6) END AS capacity_factor,
         CASE WHEN reason IS NULL THEN round(actual_kwh / (kw * (100 + month(month))), 6) END AS performance_ratio FROM y""",
)
def _(t: Tables):
    cap = (
        t.table("supplier")
        .join(t.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("site"))
        .agg(F.sum(0.95 * (F.abs("s_acctbal") + 100)).alias("kw"))
        # One site's capacity is unknown.
        .withColumn("kw", F.when(F.col("site") != "AFRICA", F.col("kw")))
    )
    days = F.dayofmonth(F.last_day("month"))
    rows = t.site_month.join(cap, "site", "left").withColumn("cov", F.col("n_days") / days)
    out = quality.performance_ratio(
        rows, "actual_kwh", "kw", days * 24, F.lit(100) + F.month("month"), "cov", 1.0, F.month("month") % 2 == 0
    )
    return rounded(out.select("site", "month", "reason", "capacity_factor", "performance_ratio"), 6, "capacity_factor", "performance_ratio")


@query(
    "best_fill_policy",
    "A31",
    """WITH p AS (SELECT * FROM (VALUES (0), (1), (2), (4), (8)) AS v(max_slots)),
       f AS (SELECT unit, slot, max_slots, coalesce(kw, CASE WHEN gap_slots <= max_slots THEN prev_kw + (next_kw - prev_kw)
              * date_diff('minute', prev_slot, slot) / date_diff('minute', prev_slot, next_slot) END) AS v FROM gaps, p),
       r AS (SELECT unit, slot, max_slots, avg(v) OVER (PARTITION BY unit, max_slots ORDER BY slot RANGE BETWEEN INTERVAL '45 minutes' PRECEDING AND CURRENT ROW) AS pred FROM f),
       s AS (SELECT h AS horizon_h, max_slots, round(avg(abs(r.pred - g.kw)), 6) AS mae, count(*) AS n FROM r, (VALUES (1), (2), (3), (4)) AS v(h)
             JOIN grid g ON g.unit = r.unit AND g.slot = r.slot + h * INTERVAL '1 hour' AND g.kw IS NOT NULL
             WHERE (SELECT count(q.pred) FROM r q WHERE q.unit = r.unit AND q.slot = r.slot) = 5 GROUP BY 1, 2)
       SELECT CAST(horizon_h AS BIGINT) AS horizon_h, CAST(max_slots AS BIGINT) AS best_max_slots, mae AS best_mae, CAST(n AS BIGINT) AS n FROM s
       QUALIFY row_number() OVER (PARTITION BY horizon_h ORDER BY mae, max_slots) = 1""",
)
def _(t: Tables):
    from pyspark.sql import Window

    policies = [0, 1, 2, 4, 8]
    filled = t.gaps.select(
        "unit", "slot", "kw", *[grid.fill("linear", "slot", "kw", p).alias(f"f{p}") for p in policies]
    )
    halo = with_halo(filled, "slot", 7 * DAY, back_s=2700)
    last_hour = Window.partitionBy("unit", "_bucket").orderBy(C.epoch_seconds("slot")).rangeBetween(-2700, 0)
    preds = (
        halo.select("unit", "slot", "_own", *[F.avg(f"f{p}").over(last_hour).alias(f"p{p}") for p in policies])
        .where("_own")
        .dropna(subset=[f"p{p}" for p in policies])
        .withColumn("horizon_h", F.explode(F.array(*[F.lit(h).cast("bigint") for h in (1, 2, 3, 4)])))
        .withColumn("target", C.shift_seconds("slot", F.col("horizon_h") * 3600))
    )
    actual = t.readings.select("unit", F.col("slot").alias("target"), F.col("kw").alias("actual"))
    scored = preds.join(actual, ["unit", "target"]).groupBy("horizon_h").agg(
        F.count("*").alias("n"),
        *[F.round(F.avg(F.abs(F.col(f"p{p}") - F.col("actual"))), 6).alias(f"m{p}") for p in policies],
    )
    ranked = F.array_min(F.array(*[F.struct(F.col(f"m{p}").alias("mae"), F.lit(p).cast("bigint").alias("p")) for p in policies]))
    return scored.select("horizon_h", ranked["p"].alias("best_max_slots"), ranked["mae"].alias("best_mae"), "n")


@query(
    "unit_configuration",
    "A33",
    """WITH r AS (SELECT site, count(*) AS n_registered, round(sum(kw), 4) AS registered_kw FROM capacity WHERE role = 'inverter_sum' GROUP BY 1),
       s AS (SELECT u.site, u.month, count(*) AS n_seen, round(sum(c.kw), 4) AS seen_kw FROM unit_month u JOIN capacity c ON c.unit = u.unit AND c.role = 'inverter_sum'
             GROUP BY 1, 2),
       m AS (SELECT DISTINCT month FROM unit_month)
       SELECT r.site, m.month, CAST(n_registered AS BIGINT) AS n_registered, registered_kw, CAST(coalesce(n_seen, 0) AS BIGINT) AS n_seen, coalesce(seen_kw, 0.0) AS seen_kw,
         coalesce(n_seen, 0) <> n_registered AS changed FROM r CROSS JOIN m LEFT JOIN s ON s.site = r.site AND s.month = m.month""",
)
def _(t: Tables):
    one = t.capacity.where("role = 'inverter_sum'")
    registered = one.groupBy("site").agg(F.count("*").alias("n_registered"), F.round(F.sum("kw"), 4).alias("registered_kw"))
    seen = (
        quality.with_capacity(t.unit_month, t.capacity, ["unit"], "inverter_sum")
        .groupBy("site", "month")
        .agg(F.count("*").alias("n_seen"), F.round(F.sum("capacity_kw"), 4).alias("seen_kw"))
    )
    # Every month of the table for every registered site: a site without any unit seen in a month has changed.
    first, last = t.unit_month.agg(F.min("month"), F.max("month")).first()
    months = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 MONTH"))
    cells = registered.withColumn("month", F.explode(months))
    return (
        cells.join(seen, ["site", "month"], "left")
        .fillna({"n_seen": 0, "seen_kw": 0.0})
        .withColumn("changed", F.col("n_seen") != F.col("n_registered"))
    )


@query(
    "conditional_iqr",
    "W18",
    """WITH q AS (SELECT unit, hour(slot) AS hour, quantile_cont(kw, 0.25) AS q1, quantile_cont(kw, 0.75) AS q3 FROM readings GROUP BY 1, 2)
       SELECT r.unit, r.slot, round(q1, 8) AS q1, round(q3, 8) AS q3, kw NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS outlier
       FROM readings r JOIN q ON q.unit = r.unit AND q.hour = hour(r.slot)""",
)
def _(t: Tables):
    rows = t.readings.select("unit", "slot", "kw", F.hour("slot").alias("hour"))
    out = quality.conditional_iqr(rows, ["unit", "hour"], "kw", 1.5)
    return rounded(out.select("unit", "slot", "q1", "q3", "outlier"), 8, "q1", "q3")


@query(
    "peer_deviation",
    "W19",
    """WITH x AS (SELECT u.*, c.kw, u.unit % 10 <> 0 AS verified, month(u.month) AS light FROM unit_month u JOIN capacity c ON c.unit = u.unit AND c.role = 'plant_api'),
       n AS (SELECT *, CASE WHEN light >= 3 AND verified THEN kwh / kw END AS norm FROM x),
       m AS (SELECT site, month, quantile_cont(norm, 0.5) AS med FROM n GROUP BY 1, 2)
       SELECT unit, site, month, round(med, 6) AS median_norm, CASE WHEN NOT verified THEN 'cannot_judge' WHEN light < 3 THEN 'low_light'
         WHEN norm IS NULL OR med IS NULL THEN 'cannot_judge' WHEN norm < med * 0.7 THEN 'low' WHEN norm > med * 1.3 THEN 'high' ELSE 'normal' END AS peer_state
       FROM n JOIN m USING (site, month)""",
)
def _(t: Tables):
    rows = quality.with_capacity(t.unit_month, t.capacity, ["unit"], "plant_api").withColumns(
        {"verified": F.col("unit") % 10 != 0, "light": F.month("month")}
    )
    out = quality.peer_deviation(rows, ["site", "month"], "kwh", "capacity_kw", "verified", "light", 3, 0.3)
    return rounded(out.select("unit", "site", "month", "median_norm", "peer_state"), 6, "median_norm")


@query(
    "control_chart",
    "W20",
    """WITH d AS (SELECT unit, date_trunc('day', slot) AS day_ts, sum(kw) * 0.25 AS kwh FROM readings GROUP BY 1, 2),
       b AS (SELECT unit, avg(kwh) AS c, stddev_pop(kwh) AS s FROM d WHERE day_ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1)
       SELECT unit, CAST(day_ts AS TIMESTAMP) AS day_ts, round(kwh, 8) AS kwh, round(c, 5) AS centre, round(c + 3 * s, 5) AS ucl, round(c - 3 * s, 5) AS lcl,
         kwh NOT BETWEEN c - 3 * s AND c + 3 * s AS outside FROM d JOIN b USING (unit)""",
)
def _(t: Tables):
    days = t.readings.groupBy("unit", C.slot_start("slot", 1440).alias("day_ts")).agg((F.sum("kw") * 0.25).alias("kwh"))
    out = quality.control_chart(days, ["unit"], "day_ts", "kwh", "2024-01-01 00:00:00", "2024-01-15 00:00:00")
    return rounded(rounded(out, 8, "kwh"), 5, "centre", "ucl", "lcl")


@query(
    "meter_increments",
    "W21",
    """WITH p AS (SELECT event_id, unit, k, lag(k) OVER (PARTITION BY unit ORDER BY ts, event_id) AS prev FROM readings_raw)
       SELECT event_id, unit, k AS counter, CASE WHEN prev IS NULL THEN NULL WHEN k < prev THEN k ELSE k - prev END AS increment, coalesce(k < prev, false) AS is_reset FROM p""",
)
def _(t: Tables):
    rows = t.readings_raw.select("event_id", "unit", "ts", F.col("k").alias("counter"))
    out = quality.meter_increments(rows, ["unit"], "ts", "event_id", "counter")
    return out.select("event_id", "unit", "counter", "increment", "is_reset")


@query(
    "stuck_values",
    "W22",
    """WITH v AS (SELECT event_id, unit, ts, k // 20 AS level FROM readings_raw), p AS (SELECT *, lag(level) OVER (PARTITION BY unit ORDER BY ts, event_id) AS prev FROM v),
       r AS (SELECT *, max(CASE WHEN prev IS NULL OR prev <> level THEN event_id END) OVER (PARTITION BY unit ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run_id FROM p)
       SELECT unit, run_id, level, min(ts) AS from_ts, max(ts) AS to_ts, CAST(count(*) AS BIGINT) AS run_length FROM r GROUP BY 1, 2, 3 HAVING count(*) >= 3""",
)
def _(t: Tables):
    rows = t.readings_raw.select("event_id", "unit", "ts", F.expr("k div 20").alias("level"))
    return quality.stuck_runs(rows, ["unit"], "ts", "event_id", "level", 3)


HOLES = "CASE WHEN (unit + month(month)) % 11 = 0 THEN NULL ELSE kwh END"


@query(
    "unit_ratio_fill",
    "W23",
    f"""WITH u AS (SELECT unit, site, month, {HOLES} AS kwh FROM unit_month),
        s AS (SELECT *, sum(kwh) OVER g AS sm, count(kwh) OVER g AS n FROM u WINDOW g AS (PARTITION BY site, month)),
        p AS (SELECT *, (sm - coalesce(kwh, 0)) / nullif(n - CASE WHEN kwh IS NULL THEN 0 ELSE 1 END, 0) AS pm FROM s),
        r AS (SELECT site, unit, avg(kwh / pm) AS ratio FROM p WHERE month < DATE '1999-01-01' AND kwh IS NOT NULL AND pm > 1 GROUP BY 1, 2)
        SELECT p.unit, p.site, p.month, round(coalesce(kwh, pm * ratio), 3) AS filled, kwh IS NULL AND pm * ratio IS NOT NULL AS was_filled
        FROM p LEFT JOIN r ON r.unit = p.unit AND r.site = p.site""",
)
def _(t: Tables):
    rows = t.unit_month.withColumn("kwh", F.expr(HOLES))
    train = (F.col("month") < F.lit("1999-01-01").cast("date")) & (F.col("peer_mean") > 1)
    out = quality.unit_ratio_fill(rows, ["site"], "unit", ["month"], "kwh", train)
    return out.select("unit", "site", "month", F.round("filled", 3).alias("filled"), "was_filled")


@query(
    "per_unit_completeness",
    "W24",
    f"""SELECT site, month, CAST(count(*) AS BIGINT) AS n_units, CAST(count(v) AS BIGINT) AS n_present, round(sum(v), 2) AS present_kwh,
        CASE WHEN count(v) = count(*) THEN round(sum(v), 2) END AS gated_kwh FROM (SELECT *, {HOLES} AS v FROM unit_month) GROUP BY 1, 2""",
)
def _(t: Tables):
    rows = t.unit_month.withColumn("v", F.expr(HOLES))
    total = F.round(F.sum("v"), 2)
    return rows.groupBy("site", "month").agg(
        F.count("*").alias("n_units"),
        F.count("v").alias("n_present"),
        total.alias("present_kwh"),
        F.when(F.count("v") == F.count("*"), total).alias("gated_kwh"),
    )
