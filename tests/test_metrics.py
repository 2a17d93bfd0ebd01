import datetime as dt

import pytest
from pyspark.sql import functions as F

from sunledger.functions import columns as C
from sunledger.operators import baselines, metrics
from tests.helpers import frame, rows

# A published monthly series (kWh) from 2025-05 on, and a candidate's forecasts from 2025-06 on.
ACTUAL = [
    19758.930375, 20083.059204545454, 21196.49425, 15976.775802845528, 10973.52025, 12345.693166666666,
    15301.704890604575, 15193.894404761904, 17086.39383333333, 18693.191104166664, 24074.019625,
    19767.940416666665, 22839.992208333333, 20468.573125, 17967.542458333333,
]
CANDIDATE = [
    None, 20174.57595261491, 20271.742457209737, 20721.346653410485, 19156.02698897671, 14175.000249295788,
    15534.525602368369, 15453.567540117145, 15530.749752276868, 20167.428819843728, 21520.045587758137,
    19603.44117962385, 19272.40251120157, 20322.830001810475, 20421.134114437413,
]
# The published scores of both on 14 months and on the seven months of the first half.
PERSISTENCE_SCORE = (14, 2659.088497977525, 3153.5759880108944, 14.774543415211841)
CANDIDATE_SCORE = (14, 2012.8876148280797, 2972.5915624197796, 11.184093902041704)
PERSISTENCE_FIRST_HALF_MAE = 2707.686304730984


@pytest.fixture(scope="module")
def monthly(spark):
    months = [dt.date(2025 + (4 + i) // 12, (4 + i) % 12 + 1, 1) for i in range(len(ACTUAL))]
    df = frame(spark, "site string, month date, actual_kwh double, candidate double", *[("a", *r) for r in zip(months, ACTUAL, CANDIDATE)])
    wide = baselines.monthly_baselines(df, ["site"], "month", "actual_kwh")
    return wide.withColumn("half", C.half_label("month"))


def score(df):
    r = df.collect()[0]
    return r["n"], r["mae"], r["rmse"], r["wape"]


def test_published_scores(monthly):
    assert score(metrics.metrics(monthly, "persistence")) == pytest.approx(PERSISTENCE_SCORE, rel=1e-12)
    assert score(metrics.metrics(monthly, "candidate")) == pytest.approx(CANDIDATE_SCORE, rel=1e-12)


def test_published_half_year_slice(monthly):
    long = metrics.to_long(monthly, ["site", "half", "actual_kwh"], ["persistence", "candidate"])
    out = metrics.metrics_by_slice(long, ["model"], "half", C.WHOLE)
    got = {(r["model"], r["half"]): (r["n"], r["mae"]) for r in out.collect()}
    assert got["persistence", C.FIRST_HALF] == pytest.approx((7, PERSISTENCE_FIRST_HALF_MAE), rel=1e-12)
    assert got["persistence", C.WHOLE][0] == 14 and len(got) == 6


def test_paired_sample_counts_only_shared_months(monthly):
    pairs = metrics.paired_rows(monthly, ["site"], ["persistence", "last_year", "candidate"], "candidate")
    got = {(r["comparison"], r["model"]): r["n"] for r in metrics.paired_metrics(pairs, []).collect()}
    assert got == {
        ("persistence", "persistence"): 14, ("persistence", "candidate"): 14,
        ("last_year", "last_year"): 3, ("last_year", "candidate"): 3, ("candidate", "candidate"): 14,
    }


def test_missing_month_does_not_shift_baselines(spark):
    df = frame(
        spark, "site string, month date, actual_kwh double",
        ("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 3, 1), 3.0), ("a", dt.date(2025, 1, 1), 5.0), ("a", dt.date(2025, 2, 1), 7.0),
    )
    out = baselines.monthly_baselines(df, ["site"], "month", "actual_kwh").orderBy("month").collect()
    assert [r["persistence"] for r in out] == [None, None, None, 5.0]
    assert [r["last_year"] for r in out] == [None, None, 1.0, None]
    assert [r["seasonal_mean"] for r in out] == [None, 1.0, 1.0, 3.0]


def test_season_is_meteorological(spark):
    df = spark.range(1, 13).select(F.make_date(F.lit(2025), F.col("id").cast("int"), F.lit(1)).alias("d"))
    got = [r[0] for r in df.select(C.season("d")).collect()]
    assert got == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["autumn"] * 3 + ["winter"]


def test_sample_gate(spark):
    df = frame(spark, "n bigint", (13,), (30,), (88,))
    assert rows(df.select("n", metrics.sample_gate("n"))) == [(13, "hold"), (30, "sufficient"), (88, "sufficient")]


def test_empty_sample_gives_null_and_zero_actual_does_not_divide(spark):
    df = frame(spark, "actual_kwh double, p double", (0.0, 1.0), (None, 2.0))
    assert score(metrics.metrics(df, "p")) == (1, 1.0, 1.0, None)
    assert score(metrics.metrics(df.where("p > 5"), "p")) == (0, None, None, None)


def test_verdict_needs_every_score_and_slice(spark):
    schema = "half string, comparison string, model string, n bigint, mae double, rmse double, wape double"
    df = frame(
        spark, schema,
        ("전체", "b1", "b1", 14, 2.0, 3.0, 4.0), ("전체", "b1", "c", 14, 1.0, 2.0, 3.0),
        ("상반기", "b1", "b1", 7, 2.0, 3.0, 4.0), ("상반기", "b1", "c", 7, 1.0, 2.0, 3.0),
        ("하반기", "b1", "b1", 7, 1.0, 3.0, 4.0), ("하반기", "b1", "c", 7, 1.0, 2.0, 3.0),
    ).withColumn("site", F.lit("s"))
    duels = metrics.duel(df, ["site", "half"], "c")
    v = metrics.verdict(duels, ["site"], "half", C.WHOLE, ["b1"], [C.FIRST_HALF, C.SECOND_HALF]).collect()[0]
    assert (v["wins_overall"], v["wins_slices"], v["lost_to"], v["absent"]) == (True, False, "", "")


def test_verdict_demands_every_listed_baseline_and_slice(spark):
    schema = "site string, half string, comparison string, model string, n bigint, mae double, rmse double, wape double"
    cells = [("전체", "b1"), ("상반기", "b1")]
    df = frame(spark, schema, *[("s", h, b, m, 14, *([s] * 3)) for h, b in cells for m, s in (("b1", 2.0), ("c", 1.0))])
    duels = metrics.duel(df, ["site", "half"], "c")
    v = metrics.verdict(duels, ["site"], "half", C.WHOLE, ["b1", "b2"], [C.FIRST_HALF, C.SECOND_HALF]).collect()[0]
    assert (v["wins_overall"], v["wins_slices"]) == (False, False)
    assert v["absent"] == "b1:하반기,b2,b2:상반기,b2:하반기"


def test_poisson_weight_has_no_ceiling(spark):
    got = spark.createDataFrame([(0.0,), (0.5,), (0.9999999,), (1 - 2.0**-32,)], "u double").select(metrics.poisson_weight(F.col("u"))).collect()
    assert [r[0] for r in got] == [0, 1, 10, 12]
    mean = spark.range(200_000).select(metrics.poisson_weight((F.col("id") + 0.5) / 200_000).alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert abs(mean[0] - 1) < 1e-3 and abs(mean[1] - 1) < 1e-2


# Published MAE, RMSE and WAPE on common samples, (n, baseline's scores, candidate's scores).
WHOLE_YEAR = [
    (14, (2659.1, 3153.6, 14.77), (2012.9, 2972.6, 11.18)),
    (11, (2677.9, 3222.6, 15.13), (2038.1, 3020.1, 11.51)),
    (14, (2595.6, 3067.3, 14.42), (2012.9, 2972.6, 11.18)),
    (14, (4878.2, 8240.7, 27.1), (2012.9, 2972.6, 11.18)),
    (14, (3065.9, 5775.4, 17.03), (2012.9, 2972.6, 11.18)),
]
SECOND_HALF = [
    (7, (2610.5, 3171.4, 16.77), (2661.0, 3776.0, 17.1)),
    (5, (2899.0, 3593.6, 20.19), (2591.6, 3910.0, 18.05)),
    (7, (2857.4, 3383.9, 18.36), (2661.0, 3776.0, 17.1)),
    (7, (5105.3, 8599.3, 32.8), (2661.0, 3776.0, 17.1)),
    (7, (1269.4, 1690.1, 8.16), (2661.0, 3776.0, 17.1)),
]


@pytest.mark.parametrize("min_n, excluded", [(0, ""), (12, "전년동월")])
def test_published_verdict(spark, min_n, excluded):
    data = [
        ("s", half, base, model, n, *score)
        for half, table in ((C.WHOLE, WHOLE_YEAR), (C.SECOND_HALF, SECOND_HALF))
        for base, (n, b, c) in zip(C.VERDICT_BASELINES, table)
        for model, score in ((base, b), ("GBHuber", c))
    ]
    df = frame(spark, "site string, half string, comparison string, model string, n bigint, mae double, rmse double, wape double", *data)
    duels = metrics.duel(df, ["site", "half"], "GBHuber")
    v = metrics.verdict(duels, ["site"], "half", C.WHOLE, C.VERDICT_BASELINES, [C.SECOND_HALF], min_n=min_n).collect()[0]
    assert (v["wins_overall"], v["wins_slices"], v["lost_to"], v["excluded_thin"]) == (True, False, "", excluded)


def test_reporting_order(spark):
    df = frame(spark, "site string", *[(s,) for s in [*reversed(C.SITE_ORDER), "elsewhere"]])
    assert [r[0] for r in df.orderBy(metrics.order_of("site", C.SITE_ORDER)).collect()] == [*C.SITE_ORDER, "elsewhere"]


def test_folds_never_use_the_test_period(spark):
    days = spark.range(100).select(F.lit("s").alias("site"), F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    folds = baselines.walk_forward_folds(days, ["site"], "day", 30, 1).orderBy("fold").collect()
    assert [(f["fold"], f["train_rows"], f["test_rows"]) for f in folds] == [(1, 30, 30), (2, 60, 30), (3, 90, 10)]
    for f in folds:
        assert f["train_rows"] == days.where(F.col("day") < F.lit(f["test_start"])).count()
