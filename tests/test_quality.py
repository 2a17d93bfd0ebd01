"""Acceptance cases: readiness, status cards, capacity, peers, completeness."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sunledger.functions import columns as C
from sunledger.operators import opslog, quality
from tests.helpers import at, frame, rows


def test_unused_feed_never_blocks_a_model(spark):
    got = frame(spark, "job string, feed string", ("j", "lag"), ("j", "obs"))
    out = opslog.model_readiness(got, got.select("job").distinct(), ["job"], "feed", {"ultra_short": ["lag", "obs"], "short": ["grid", "nwp", "lag"]})
    assert rows(out, "model") == [("j", "short", "grid,nwp", False), ("j", "ultra_short", "", True)]


def test_http_ok_with_all_null_is_not_valid(spark):
    log = frame(
        spark, "feed string, ts timestamp_ntz, v double",
        ("a", at("2024-05-01 10:00:00"), 1.0), ("a", at("2024-05-01 11:00:00"), None), ("b", at("2024-05-01 11:00:00"), None),
    )
    as_of = F.lit("2024-05-01 11:30:00").cast("timestamp_ntz")
    st = opslog.feed_status(log, log, ["feed"], "ts", F.col("v").isNotNull(), as_of, 60, 120)
    assert [(r["feed"], r["status"]) for r in st.orderBy("feed").collect()] == [("a", "late"), ("b", "missing")]
    assert rows(opslog.status_cards(st)) == [("late", 1), ("missing", 1)]


def test_error_text_null_and_zero_differ(spark):
    df = frame(spark, "raw string", ("0",), ("COMM",), (None,), ("NaN",), ("7.5",))
    got = [tuple(r) for r in df.select(C.parsed_value("raw"), C.parse_status("raw")).collect()]
    assert got == [(0.0, "ok"), (None, "comm_error"), (None, "source_null"), (None, "comm_error"), (7.5, "ok")]


def test_clip_keeps_null(spark):
    df = frame(spark, "p double", (-1.0,), (None,), (500.0,))
    assert [r[0] for r in df.select(C.clip("p", 241.58)).collect()] == [0.0, None, 241.58]


def test_different_capacity_is_no_fault(spark):
    schema = "unit string, ts int, kw double, cap double, ok boolean, light double"
    data = [("a", 1, 10.0, 20.0, True, 9.0), ("b", 1, 5.0, 10.0, True, 9.0), ("c", 1, 2.0, 10.0, True, 9.0), ("d", 1, 1.0, 9.0, False, 9.0)]
    dark = [("a", 2, 0.1, 20.0, True, 0.0), ("b", 2, 0.0, 10.0, True, 0.0)]
    out = quality.peer_deviation(frame(spark, schema, *data, *dark), ["ts"], "kw", "cap", "ok", "light", 1.0, 0.3)
    got = {(r["unit"], r["ts"]): r["peer_state"] for r in out.collect()}
    assert got == {("a", 1): "normal", ("b", 1): "normal", ("c", 1): "low", ("d", 1): "cannot_judge", ("a", 2): "low_light", ("b", 2): "low_light"}


def test_one_missing_unit_is_filled_from_peers_only_when_missing(spark):
    data = [("s", u, t, 10.0 * k) for t in (1, 2) for k, u in enumerate("abc", 1)] + [("s", "a", 3, None), ("s", "b", 3, 20.0), ("s", "c", 3, 30.0)]
    df = frame(spark, "site string, unit string, t int, v double", *data)
    out = quality.unit_ratio_fill(df, ["site"], "unit", ["t"], "v", F.col("t") < 3)
    got = {(r["unit"], r["t"]): (r["filled"], r["was_filled"]) for r in out.collect()}
    assert got["a", 3] == (pytest.approx(10.0), True) and got["b", 3] == (20.0, False)


def test_incomplete_day_has_a_reason_not_a_value(spark):
    df = frame(spark, "kwh double, n bigint", (10.0, 13), (20.0, 24))
    out = quality.complete_only(df, "n", F.lit(24), "kwh", 0.9).collect()
    assert [(r["complete_value"], r["reason"]) for r in out] == [(None, "incomplete"), (20.0, None)]


def test_performance_ratio_is_withheld_without_plane_irradiance(spark):
    df = frame(spark, "e double, cap double, cov double, plane boolean", (100.0, 10.0, 1.0, True), (100.0, 10.0, 1.0, False), (100.0, 10.0, 0.5, True), (1.0, None, 1.0, True))
    out = quality.performance_ratio(df, "e", "cap", F.lit(24), F.lit(12.5), "cov", 0.9, F.col("plane")).collect()
    assert [(r["reason"], r["performance_ratio"]) for r in out] == [
        (None, 0.8), ("no plane irradiance", None), ("incomplete period", None), ("no capacity", None)
    ]


def test_defect_borders(spark):
    df = frame(spark, "unit string, ts timestamp_ntz", *[("u", at(f"2024-05-0{d} 00:00:00")) for d in (1, 2, 3)], ("x", at("2024-05-02 00:00:00")))
    p = frame(spark, "unit string, from_ts timestamp_ntz, to_ts timestamp_ntz", ("u", at("2024-05-02 00:00:00"), at("2024-05-03 00:00:00")))
    assert quality.exclude_periods(df, p, ["unit"], "ts").count() == 3
    states = quality.audit_state(df, p, ["u"], "unit", "ts")
    assert sorted(r["audit_state"] for r in states.collect()) == ["audited", "audited", "defect", "unaudited"]


def test_meter_reset(spark):
    df = frame(spark, "u string, ts timestamp_ntz, id bigint, c double", *[("u", at(f"2024-05-01 0{i}:00:00"), i, c) for i, c in enumerate([5.0, 9.0, 2.0, 3.0])])
    out = quality.meter_increments(df, ["u"], "ts", "id", "c").orderBy("id").collect()
    assert [(r["increment"], r["is_reset"]) for r in out] == [(None, False), (4.0, False), (2.0, True), (1.0, False)]


def test_gate_rates_keep_the_raw_denominator(spark):
    slots = frame(spark, "job string, slot int", *[("j", i) for i in range(10)])
    runs = frame(spark, "job string, slot int, status string", ("j", 1, "success"), ("j", 1, "error"), ("j", 2, "error"), ("j", 99, "success"))
    r = opslog.gate_rates(slots, runs, ["job", "slot"], ["job"], F.col("slot") >= 5).collect()[0]
    assert (r["expected_slots"], r["executed"], r["generated"]) == (10, 2, 1)
    assert (r["execution_rate"], r["generation_rate"], r["conditional_rate"]) == (0.2, 0.1, 0.2)


def test_sketch_delays_stay_close_to_exact_ones(spark):
    df = spark.range(10_001).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("d"))
    r = opslog.approximate_delays(df, ["k"], "d").collect()[0]
    assert abs(r["median"] - 5000) <= 2 and abs(r["p95"] - 9500) <= 2


def test_season_uses_target_month(spark):
    df = frame(spark, "d date", (dt.date(2024, 2, 29),))
    assert df.select(C.season(F.date_add("d", 1))).collect()[0][0] == "spring"


def test_open_and_endless_periods(spark):
    df = frame(spark, "u string, ts timestamp_ntz", ("a", at("2024-05-01 00:00:00")), ("a", at("2024-05-03 00:00:00")), ("b", at("2024-05-01 00:00:00")))
    p = frame(spark, "u string, from_ts timestamp_ntz, to_ts timestamp_ntz", ("a", at("2024-05-02 00:00:00"), None), ("b", at("1000-01-01 00:00:00"), at("9999-12-31 00:00:00")))
    assert rows(quality.exclude_periods(df, p, ["u"], "ts")) == [("a", at("2024-05-01 00:00:00"))]


def test_delay_groups_without_a_delay_stay(spark):
    df = frame(spark, "k string, d double", ("a", 5.0), ("a", 7.0), ("b", None))
    got = rows(opslog.delay_distribution(df, ["k"], "d", 6).select("k", "n", "late_share", "median"))
    assert got == [("a", 2, 0.5, 6.0), ("b", 0, None, None)]


def test_registers_name_what_never_arrived(spark):
    arrived = frame(spark, "job bigint, feed string", (1, "x"))
    jobs = frame(spark, "job bigint", (1,), (2,))
    ready = opslog.model_readiness(arrived, jobs, ["job"], "feed", {"m": ["x"]})
    assert rows(ready.select("job", "ready", "blocked_by")) == [(1, True, ""), (2, False, "x")]
    assert rows(opslog.feeds_not_arrived(arrived, jobs, ["job"], "feed", ["x", "y"])) == [(1, "y"), (2, "x"), (2, "y")]
    log = frame(spark, "feed string, ts timestamp_ntz", ("x", at("2024-05-01 00:00:00")))
    register = frame(spark, "feed string", ("x",), ("z",))
    st = opslog.feed_status(log, register, ["feed"], "ts", F.lit(True), F.lit(at("2024-05-01 00:10:00")), 60, 120)
    assert rows(st.select("feed", "attempts", "status")) == [("x", 1, "normal"), ("z", 0, "missing")]
