"""The test inputs as SQL views. Written apart from the Spark views, so that each checks the other."""

from __future__ import annotations

import re

# Each view may use the given tables and the other views.
VIEWS: dict[str, str] = {
    "log_period": """
        SELECT date_trunc('day', min(ts)) AS a, date_trunc('day', max(ts)) + INTERVAL '1 day' AS z FROM events""",
    "dated_jobs": """
        SELECT job, from_ts, CASE WHEN job % 3 = 2 THEN from_ts + INTERVAL '12 days' END AS to_ts FROM
          (SELECT CAST(n_nationkey AS BIGINT) AS job, (SELECT a FROM log_period) + (n_regionkey - 2) * INTERVAL '5 days' AS from_ts FROM nation WHERE n_nationkey < 6)
        UNION ALL SELECT CAST(n_nationkey AS BIGINT), (SELECT a FROM log_period) + INTERVAL '20 days', NULL FROM nation WHERE n_nationkey < 6 AND n_nationkey % 3 = 2""",
    "site_day": """
        SELECT r_name AS site, CAST(l_shipdate AS DATE) AS day, round(sum(l_extendedprice), 2) AS actual_kwh
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "site_month": """
        SELECT site, CAST(date_trunc('month', day) AS DATE) AS month, round(sum(actual_kwh), 2) AS actual_kwh,
               CAST(count(*) AS BIGINT) AS n_days
        FROM site_day GROUP BY 1, 2""",
    "unit_month": """
        SELECT l_suppkey AS unit, CAST(s_nationkey AS BIGINT) AS site,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS month, round(sum(l_extendedprice), 2) AS kwh
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3""",
    "month_keyed": """
        SELECT *, CAST(year(month) * 12 + month(month) - 1 AS BIGINT) AS mi FROM site_month""",
    "oof_wide": """
        SELECT a.site, a.month, CASE WHEN month(a.month) <= 6 THEN '상반기' ELSE '하반기' END AS half, a.actual_kwh,
               a.mi, p.actual_kwh AS persistence, y.actual_kwh AS last_year,
               round(coalesce(
                 (SELECT avg(h.actual_kwh) FROM month_keyed h WHERE h.site = a.site AND h.mi < a.mi
                  AND month(h.month) = month(a.month)),
                 (SELECT avg(h.actual_kwh) FROM month_keyed h WHERE h.site = a.site AND h.mi < a.mi)), 6) AS seasonal_mean
        FROM month_keyed a
        LEFT JOIN month_keyed p ON p.site = a.site AND p.mi = a.mi - 1
        LEFT JOIN month_keyed y ON y.site = a.site AND y.mi = a.mi - 12""",
    "oof": """
        SELECT *, round(0.7 * seasonal_mean + 0.3 * persistence, 6) AS candidate FROM oof_wide""",
    "oof_long": """
        SELECT site, month, half, actual_kwh, 'persistence' AS model, 1 AS ordinal, persistence AS pred FROM oof
        UNION ALL SELECT site, month, half, actual_kwh, 'last_year', 2, last_year FROM oof
        UNION ALL SELECT site, month, half, actual_kwh, 'seasonal_mean', 3, seasonal_mean FROM oof
        UNION ALL SELECT site, month, half, actual_kwh, 'candidate', 4, candidate FROM oof""",
    "oof_pairs": """
        SELECT b.site, b.month, b.half, b.actual_kwh, b.model AS comparison, b.ordinal, x.model, x.pred
        FROM oof_long b JOIN oof_long c ON c.site = b.site AND c.month = b.month AND c.model = 'candidate'
        JOIN oof_long x ON x.site = b.site AND x.month = b.month AND x.model IN (b.model, 'candidate')
        WHERE b.pred IS NOT NULL AND c.pred IS NOT NULL AND b.actual_kwh IS NOT NULL""",
    "readings_raw": """
        SELECT event_id, ts, event_type AS unit, CAST(user_id % 4 AS BIGINT) AS site,
               CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
               CASE WHEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) >= 95 THEN 'COMM_ERR'
                    WHEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) = 94 THEN NULL
                    ELSE CAST(value AS VARCHAR) END AS raw
        FROM events""",
    "readings": """
        SELECT unit, time_bucket(INTERVAL '15 minutes', ts) AS slot, round(sum(TRY_CAST(raw AS DOUBLE)), 6) / count(*) AS kw,
               CAST(count(*) AS BIGINT) AS n_obs, max(ts + k * INTERVAL '1 minute') AS received_at
        FROM readings_raw WHERE k < 94 GROUP BY 1, 2""",
    "grid": """
        SELECT g.unit, g.slot, r.kw, r.n_obs, r.received_at FROM (
          SELECT unit, unnest(generate_series(date_trunc('day', min(slot)),
                 date_trunc('day', max(slot)) + INTERVAL '1 day' - INTERVAL '15 minutes', INTERVAL '15 minutes')) AS slot
          FROM readings GROUP BY unit) g LEFT JOIN readings r ON r.unit = g.unit AND r.slot = g.slot""",
    "neighbours": """
        SELECT unit, slot, kw, received_at,
          max(CASE WHEN kw IS NOT NULL THEN slot END) OVER b AS prev_slot,
          min(CASE WHEN kw IS NOT NULL THEN slot END) OVER a AS next_slot,
          last_value(kw IGNORE NULLS) OVER b AS prev_kw,
          first_value(kw IGNORE NULLS) OVER a AS next_kw,
          last_value(CASE WHEN kw IS NOT NULL THEN received_at END IGNORE NULLS) OVER b AS prev_received,
          first_value(received_at IGNORE NULLS) OVER a AS next_received
        FROM grid
        WINDOW b AS (PARTITION BY unit ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               a AS (PARTITION BY unit ORDER BY slot ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    "gaps": """
        SELECT *, CASE WHEN kw IS NULL AND prev_slot IS NOT NULL AND next_slot IS NOT NULL
                       THEN CAST(date_diff('minute', prev_slot, next_slot) / 15 - 1 AS BIGINT) END AS gap_slots
        FROM neighbours""",
    "obs": """
        SELECT event_id, CAST(user_id % 4 AS BIGINT) AS station, ts AS obs_ts, CAST(k AS DOUBLE) AS cloud_pct,
               CASE WHEN event_id % 97 = 0 THEN CAST(k AS DOUBLE) ELSE k / 10.0 END AS cloud_tenths,
               CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS temp,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 2 END AS humidity,
               ts + k * INTERVAL '1 minute' AS received_at
        FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events WHERE event_type = 'view')""",
    "issues": """
        SELECT station, unnest(generate_series(date_trunc('hour', min(obs_ts)), date_trunc('hour', max(obs_ts)),
               INTERVAL '1 hour')) AS issue_ts FROM obs GROUP BY station""",
    "fc": """
        SELECT event_id, CAST(user_id % 4 AS BIGINT) AS site, event_type AS model, date_trunc('hour', ts) AS issue_ts, k AS lead_h,
               date_trunc('hour', ts) + k * INTERVAL '1 hour' AS target_ts, ts AS received_at, value AS pred
        FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events)""",
    "site_hour": """
        SELECT CAST(user_id % 4 AS BIGINT) AS site, date_trunc('hour', ts) AS hour, round(sum(value), 6) / count(*) AS actual_kw,
               CAST(count(*) AS BIGINT) AS n_obs FROM events GROUP BY 1, 2""",
    "capacity": """
        SELECT s_suppkey AS unit, CAST(s_nationkey AS BIGINT) AS site, 'inverter_sum' AS role, abs(s_acctbal) + 100 AS kw FROM supplier
        UNION ALL SELECT s_suppkey, CAST(s_nationkey AS BIGINT), 'plant_api', round(0.95 * (abs(s_acctbal) + 100), 6) FROM supplier""",
    "defects": """
        SELECT * FROM (VALUES
          ('click', TIMESTAMP '2024-01-05 00:00:00', TIMESTAMP '2024-01-07 12:00:00'),
          ('view', TIMESTAMP '2024-01-10 06:00:00', TIMESTAMP '2024-01-10 18:00:00'),
          ('error', TIMESTAMP '2024-01-20 00:00:00', TIMESTAMP '2024-01-25 00:00:00')) AS d(unit, from_ts, to_ts)""",
    "runs": """
        SELECT event_id, CAST(user_id % 4 AS BIGINT) AS job, ts, time_bucket(INTERVAL '15 minutes', ts) AS slot,
               CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'error'
                    WHEN 'signup' THEN 'warming_up' ELSE 'waiting' END AS status,
               CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, event_type AS feed, value
        FROM events""",
    "job_register": """
        SELECT job, from_ts, CASE WHEN job % 3 = 2 THEN from_ts + INTERVAL '21 days' END AS to_ts FROM
          (SELECT CAST(n_nationkey AS BIGINT) AS job, TIMESTAMP '2023-12-20 00:00:00' + n_regionkey * INTERVAL '5 days' AS from_ts FROM nation WHERE n_nationkey < 6)""",
    "required": """
        SELECT * FROM (VALUES ('ultra_short', 'click'), ('ultra_short', 'view'), ('short_24h', 'click'),
          ('short_24h', 'purchase'), ('short_48h', 'signup'), ('short_48h', 'error')) AS d(model, feed)""",
    "features": """
        SELECT l_orderkey AS row_key, l_linenumber AS row_no, CAST(l_shipdate AS DATE) AS day, l_quantity AS quantity, l_extendedprice AS price,
               l_discount AS discount, l_tax AS tax FROM lineitem""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it uses, in dependency order."""
    order: list[str] = []

    def visit_name(name: str) -> None:
        body = VIEWS[name]
        for other in VIEWS:
            if other != name and other not in order and re.search(rf"(FROM|JOIN)\s+{other}\b", body):
                visit_name(other)
        order.append(name)

    for name in VIEWS:
        if name not in order and re.search(rf"(FROM|JOIN|,)\s+{name}\b", sql):
            visit_name(name)
    if not order:
        return sql
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
