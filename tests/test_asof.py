from pyspark.sql import functions as F

from sunledger.operators import asof
from tests.helpers import at, frame, rows

V = "k string, id bigint, obs timestamp_ntz, received timestamp_ntz, v double, w double"
I = "k string, issue timestamp_ntz"  # noqa: E741


def t(h, m=0, s=0):
    return at(f"2024-05-01 {h:02d}:{m:02d}:{s:02d}")


def test_as_known_at_takes_the_boundary_and_breaks_ties(spark):
    v = frame(spark, V, ("a", 1, t(1), t(2), 1.0, 1.0), ("a", 2, t(1), t(2), 2.0, 1.0), ("a", 3, t(1), t(2, 0, 1), 3.0, 1.0))
    i = frame(spark, I, ("a", t(1, 59)), ("a", t(2)), ("a", t(3)), ("b", t(3)))
    out = asof.as_known_at(v, i, ["k"], "received", "id", "issue", ["id", "v"])
    assert rows(out, "k", "issue") == [("a", t(1, 59), None, None), ("a", t(2), 2, 2.0), ("a", t(3), 3, 3.0), ("b", t(3), None, None)]


def test_late_receipt_is_usable_later_but_never_back_dated(spark):
    v = frame(spark, V, ("a", 1, t(1), t(5), 9.0, 1.0))
    i = frame(spark, I, ("a", t(2)), ("a", t(6)))
    out = asof.as_known_at(v, i, ["k"], "received", "id", "issue", ["v"])
    assert rows(out, "issue") == [("a", t(2), None), ("a", t(6), 9.0)]


def test_freshest_complete_skips_incomplete_and_ignores_old_late_comers(spark):
    v = frame(
        spark, V,
        ("a", 1, t(3), t(3, 10), 3.0, 1.0),
        ("a", 2, t(1), t(3, 30), 1.0, 1.0),   # received later, observed earlier
        ("a", 3, t(4), t(4, 5), None, 1.0),   # incomplete
    )
    i = frame(spark, I, ("a", t(3)), ("a", t(5)), ("a", t(16)))
    out = asof.freshest_complete(v, i, ["k"], "received", "id", "issue", "obs", ["v", "w"], 12)
    got = [(r["issue"], r["v"], r["status"]) for r in out.orderBy("issue").collect()]
    assert got == [(t(3), None, "waiting"), (t(5), 3.0, "ready"), (t(16), None, "waiting")]


def test_freshest_takes_the_latest_version(spark):
    v = frame(spark, V, ("a", 1, t(10), t(10, 10), 20.0, 1.0), ("a", 2, t(10), t(10, 30), 15.0, 1.0), ("a", 3, t(9), t(10, 50), 99.0, 1.0))
    i = frame(spark, I, ("a", t(10, 20)), ("a", t(11)))
    out = asof.freshest_complete(v, i, ["k"], "received", "id", "issue", "obs", ["v", "w"], 12)
    assert [(r["issue"], r["v"]) for r in out.orderBy("issue").collect()] == [(t(10, 20), 20.0), (t(11), 15.0)]


def test_unknown_receipt_is_not_clean(spark):
    df = frame(spark, "k string, r timestamp_ntz, i timestamp_ntz", ("a", t(1), t(2)), ("a", None, t(2)), ("b", t(1), t(2)), ("c", t(3), t(2)))
    out = asof.leakage_audit(df, ["k"], {"late": F.col("r") > F.col("i")})
    assert rows(out.select("k", "late", "unknown", "clean")) == [("a", 0, 1, False), ("b", 0, 0, True), ("c", 1, 0, False)]


def test_lead_coverage_counts_days_without_forecasts(spark):
    fc = frame(spark, "k string, issue timestamp_ntz, lead bigint", ("a", t(3), 70), ("a", t(3), 70))
    out = asof.lead_coverage(fc, ["k"], "issue", "lead", [3], [70, 71], "2024-05-01", "2024-05-04")
    assert [(r["lead_h"], r["filled_days"], r["share"]) for r in out.orderBy("lead_h").collect()] == [(70, 1, 0.25), (71, 0, 0.0)]


def test_lag_alignment_tolerance_and_tie(spark):
    r = frame(spark, "k string, id bigint, ts timestamp_ntz, v double", ("a", 1, t(1, 41), 1.0), ("a", 2, t(1, 49), 2.0), ("b", 3, t(1, 40), 3.0))
    i = frame(spark, I, ("a", t(2)), ("b", t(2)))
    tol = F.when(F.col("k") == "b", 5).otherwise(4)
    out = asof.lag_aligned(r, i, ["k"], "ts", "id", "v", "issue", [15], tol)
    assert [(x["k"], x["lag_value"], x["status"]) for x in out.orderBy("k").collect()] == [("a", 1.0, "aligned"), ("b", 3.0, "aligned")]
    strict = asof.lag_aligned(r, i, ["k"], "ts", "id", "v", "issue", [15], F.lit(4))
    assert [x["status"] for x in strict.orderBy("k").collect()] == ["aligned", "waiting"]


def test_missing_input_gives_waiting_not_zero(spark):
    lags = frame(spark, "k string, issue timestamp_ntz, lag_min bigint, lag_value double", ("a", t(2), 15, 0.0), ("a", t(3), 15, None))
    weather = frame(spark, "k string, issue timestamp_ntz, v double, status string", ("a", t(2), 1.0, "ready"), ("a", t(3), 1.0, "ready"))
    out = asof.assemble_inputs(lags, weather, ["k"], "issue", {15: "lag_15"})
    got = [(r["lag_15"], r["missing_inputs"], r["status"]) for r in out.orderBy("issue").collect()]
    assert got == [(0.0, "", "ready"), (None, "lag_15", "waiting")]


def test_revisions(spark):
    f = frame(
        spark, "k string, received timestamp_ntz, id bigint, p double",
        ("a", t(1), 1, None), ("a", t(2), 2, 5.0), ("a", t(3), 3, 5.0), ("a", t(4), 4, 6.0),
    )
    r = asof.revisions(f, ["k"], "received", "id", "p").collect()[0]
    assert (r["n_versions"], r["first_valid_receipt"], r["n_revisions"], r["last_change"]) == (3, t(2), 1, t(4))


def test_unarrived_actual_stays_pending(spark):
    f = frame(spark, "k string, target timestamp_ntz, p double", ("a", t(1), 1.0), ("a", t(2), 2.0))
    a = frame(spark, "k string, target timestamp_ntz, y double", ("a", t(1), 4.0))
    out = asof.match_actuals(f, a, ["k", "target"], "y")
    assert [(r["y"], r["match_state"]) for r in out.orderBy("target").collect()] == [(4.0, "matched"), (None, "pending")]
