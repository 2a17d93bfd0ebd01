import numpy as np
import pytest
from pyspark.sql import functions as F

from sunledger.functions import columns as C
from sunledger.operators import grid, quality
from tests.helpers import at, frame, rows

DAY = "2024-05-01 {:02d}:{:02d}:00"


def series(spark, values, unit="u", minutes=5):
    """Values from midnight on; None is an absent reading."""
    data = [(unit, at(DAY.format(i * minutes // 60, i * minutes % 60)), v) for i, v in enumerate(values) if v is not None]
    return frame(spark, "unit string, slot timestamp_ntz, kw double", *data)


def gaps(spark, values, minutes=5):
    g = grid.reindex(series(spark, values, minutes=minutes), ["unit"], "slot", minutes)
    return grid.with_neighbours(g, ["unit"], "slot", "kw", minutes)


def filled(df, method, limit, n):
    return [r[0] for r in df.orderBy("slot").select(grid.fill(method, "slot", "kw", limit)).limit(n).collect()]


def test_grid_has_all_slots_and_no_zeros(spark):
    g = grid.reindex(series(spark, [1.0, None, 0.0]), ["unit"], "slot", 5)
    got = [r["kw"] for r in g.orderBy("slot").collect()]
    assert len(got) == 288 and got[:3] == [1.0, None, 0.0] and set(got[3:]) == {None}


def test_linear_fill_is_exact_on_a_line_and_limited(spark):
    df = gaps(spark, [0.0, None, None, 3.0, None, None, None, 7.0, None])
    assert filled(df, "linear", 2, 9) == [0.0, 1.0, 2.0, 3.0, None, None, None, 7.0, None]
    assert filled(df, "linear", 3, 8) == pytest.approx([0, 1, 2, 3, 4, 5, 6, 7])
    assert filled(df, "linear", 0, 9) == [0.0, None, None, 3.0, None, None, None, 7.0, None]


def test_other_methods(spark):
    df = gaps(spark, [2.0, None, None, None, 8.0])
    assert filled(df, "previous", 3, 5) == [2.0, 2.0, 2.0, 2.0, 8.0]
    assert filled(df, "neighbour_mean", 3, 5) == [2.0, 5.0, 5.0, 5.0, 8.0]
    assert filled(df, "nearest", 3, 5) == [2.0, 2.0, 2.0, 8.0, 8.0]


def test_causal_fill_needs_the_right_neighbour_in_time(spark):
    base = series(spark, [1.0, None, 3.0]).withColumn("received_at", C.shift_seconds("slot", 1800))
    g = grid.with_neighbours(grid.reindex(base, ["unit"], "slot", 5), ["unit"], "slot", "kw", 5, received="received_at")
    at_once = grid.fill("linear", "slot", "kw", 2, as_of=F.col("slot"))
    later = grid.fill("linear", "slot", "kw", 2, as_of=C.shift_seconds("slot", 35 * 60))
    got = g.orderBy("slot").select(at_once, later).limit(3).collect()
    # Half an hour late: at once nothing is known, not even the observed values.
    assert [tuple(r) for r in got] == [(None, 1.0), (None, 2.0), (None, 3.0)]


def test_causal_fill_needs_the_left_neighbour_too(spark):
    base = series(spark, [1.0, None, 3.0]).withColumn("received_at", F.when(F.col("kw") == 1, at(DAY.format(9, 0))).otherwise(F.col("slot")))
    g = grid.with_neighbours(grid.reindex(base, ["unit"], "slot", 5), ["unit"], "slot", "kw", 5, received="received_at")
    fills = [grid.fill(m, "slot", "kw", 2, as_of=F.lit(at(DAY.format(1, 5)))) for m in ("linear", "previous")]
    assert [tuple(r) for r in g.orderBy("slot").select(*fills).limit(3).collect()] == [(None, None), (None, None), (3.0, 3.0)]


def test_masks_of_any_length_are_rebuilt(spark):
    df = gaps(spark, [float(i) for i in range(40)])
    runs = grid.complete_runs(df, ["unit"], "slot", "kw", [2, 4], 5, 3)
    masks = grid.sample_masks(runs, ["unit"], 5, 42)
    out = grid.masked_reconstruction(masks, df, ["unit"], "slot", "kw", 5, 3, [2, 4]).collect()
    assert sorted({r["mask_slots"]: 0 for r in out}) == [2, 4] and len(out) == 5 * 2 + 5 * 4
    assert all(abs(r["spline"] - r["actual"]) < 1e-9 for r in out)


def test_open_silences_and_units_never_heard(spark):
    r = frame(spark, "unit string, slot timestamp_ntz", ("a", at("2024-05-01 00:00:00")), ("a", at("2024-05-01 01:00:00")), ("b", at("2024-05-01 00:15:00")), ("b", at("2024-05-09 23:45:00")))
    register = frame(spark, "unit string", ("a",), ("b",), ("c",))
    got = rows(quality.silences(r, register, ["unit"], "slot", 15, 4, "2024-05-01 00:00:00", "2024-05-09 23:45:00").select("unit", "gap_slots", "is_open"))
    assert got == [("a", 9 * 96 - 5, True), ("b", 9 * 96 - 3, False), ("c", 9 * 96, True)]


def test_period_slots_do_not_depend_on_rows(spark):
    register = frame(spark, "unit string", ("a",), ("b",))
    assert grid.period_slots(register, "slot", "2024-05-01 00:00:00", "2024-05-02 11:45:00", 15).count() == 2 * 144


def brute_spline(x, y, at_x):
    """Natural cubic spline by the full tridiagonal system on actual values."""
    n, h = len(x), np.diff(x)
    a, b = np.eye(n), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = [h[i - 1], 2 * (h[i - 1] + h[i]), h[i]]
        b[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    m = np.linalg.solve(a, b)
    i = np.searchsorted(x, at_x) - 1
    u, t = x[i + 1] - at_x, at_x - x[i]
    return (m[i] * u**3 + m[i + 1] * t**3) / (6 * h[i]) + (y[i] / h[i] - m[i] * h[i] / 6) * u + (y[i + 1] / h[i] - m[i + 1] * h[i] / 6) * t


@pytest.mark.parametrize("length", [1, 2, 3, 6])
def test_spline_weights_equal_a_full_solve(length):
    knots, rng = 4, np.random.default_rng(length)
    x = np.array([*range(-knots, 0), *range(length, length + knots)], dtype=float)
    y = rng.normal(size=len(x))
    for p in range(length):
        w = {off: weight for pos, off, weight in grid.spline_weights(length, knots) if pos == p}
        assert sum(w.values()) == pytest.approx(1)
        assert sum(w[int(o)] * v for o, v in zip(x, y)) == pytest.approx(brute_spline(x, y, float(p)))


def test_spline_fill_needs_all_knots(spark):
    line = [float(i) for i in range(12)]
    line[5] = line[6] = None
    df = gaps(spark, line)
    got = rows(grid.spline_fill(df, ["unit"], "slot", "kw", 5, 2, knots=4).select("slot", F.round("spline_kw", 9)))
    assert [r[1] for r in got] == [5.0, 6.0]
    assert grid.spline_fill(df, ["unit"], "slot", "kw", 5, 2, knots=6).count() == 0


def test_segments_break_lags_and_targets(spark):
    df = series(spark, [1.0, 2.0, None, None, None, 6.0, 7.0], minutes=60)
    seg = grid.segments(df, ["unit"], "slot", 3600)
    out = grid.segment_windows(seg, ["unit"], "slot", "kw", {"lag": 3600}, {"mean": 7200}).orderBy("slot").collect()
    assert [(r["lag"], r["mean"]) for r in out] == [(None, 1.0), (1.0, 1.5), (None, 6.0), (6.0, 6.5)]
    targets = grid.horizon_targets(seg, ["unit"], "slot", "kw", [1, 4]).orderBy("slot", "horizon_h").collect()
    assert [r["target"] for r in targets] == [2.0, None, None, None, 7.0, None, None, None]


def test_masks_keep_knots_inside_the_run(spark):
    df = gaps(spark, [1.0] * 6 + [None] + [1.0] * 4)
    runs = grid.complete_runs(df, ["unit"], "slot", "kw", [1, 2], 5, 2)
    assert rows(runs.select("mask_slots", F.minute("mask_start"))) == [(1, 10), (1, 15), (2, 10)]
    again = [rows(grid.sample_masks(runs, ["unit"], 1, 42)) for _ in range(2)]
    assert again[0] == again[1] and len(again[0]) == 2


def test_future_is_not_missing(spark):
    g = grid.reindex(series(spark, [1.0, None, 2.0]), ["unit"], "slot", 5)
    state = quality.slot_state("slot", "kw", F.lit("2024-05-01 00:10:00").cast("timestamp_ntz"))
    got = [r[0] for r in g.orderBy("slot").select(state).limit(4).collect()]
    assert got == ["observed", "missing", "observed", "future"]


def test_row_order_does_not_matter(spark):
    values = [float(i % 7) if i % 5 else None for i in range(60)]
    a = gaps(spark, values)
    shuffled = series(spark, values).orderBy(F.rand(3))
    b = grid.with_neighbours(grid.reindex(shuffled, ["unit"], "slot", 5), ["unit"], "slot", "kw", 5)
    assert a.exceptAll(b).count() == 0
