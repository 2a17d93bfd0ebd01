"""Two-level scans and quantiles against brute force, with one hot key and tied values."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sunledger.operators import features
from sunledger.operators.scans import exact_quantiles, scan, time_bucket, with_halo


@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(7)
    n = 3000
    key = np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcdefgh"), n))
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 20 * 86400, n), unit="s")
    value = np.where(rng.random(n) < 0.3, np.nan, rng.integers(0, 40, n).astype(float))
    pdf = pd.DataFrame({"k": key, "ts": ts, "id": np.arange(n), "v": value})
    df = spark.createDataFrame(pdf).withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "v": F.when(~F.isnan("v"), F.col("v"))})
    return df, pdf.sort_values(["k", "ts", "id"])


def test_scan_equals_plain_order(hot):
    df, pdf = hot
    out = scan(
        df, ["k"], time_bucket("ts"), ["ts", "id"],
        before={"b": F.col("v")}, after={"a": F.col("v")}, totals={"t": F.coalesce("v", F.lit(0.0))},
    ).toPandas().sort_values(["k", "ts", "id"])
    g = pdf.groupby("k")["v"]
    want_b = g.transform(lambda s: s.ffill().shift(1))
    want_a = g.transform(lambda s: s.bfill().shift(-1))
    want_t = pdf.assign(v=pdf.v.fillna(0)).groupby("k")["v"].cumsum()
    assert len(out) == len(pdf)
    np.testing.assert_array_equal(out["b"].to_numpy(float), want_b.to_numpy())
    np.testing.assert_array_equal(out["a"].to_numpy(float), want_a.to_numpy())
    np.testing.assert_allclose(out["t"].to_numpy(), want_t.to_numpy())


def test_scan_does_not_depend_on_bucket_width(hot):
    df, _ = hot
    make = lambda s: scan(df, ["k"], time_bucket("ts", s), ["ts", "id"], before={"b": F.col("v")}, inclusive=True)
    assert make(3600).exceptAll(make(30 * 86400)).count() == 0


@pytest.mark.parametrize("splits", [2, 64])
def test_exact_quantiles_with_ties_and_hot_key(hot, splits):
    df, pdf = hot
    probs = {"q0": 0.0, "q1": 0.25, "mid": 0.5, "p95": 0.95, "q4": 1.0}
    got = exact_quantiles(df, ["k"], "v", probs, splits=splits).toPandas().set_index("k")
    for k, part in pdf.dropna().groupby("k"):
        np.testing.assert_allclose(got.loc[k, list(probs)].to_numpy(float), np.quantile(part.v, list(probs.values())))


def test_quantile_of_a_single_value(spark):
    df = spark.createDataFrame([("x", 3.5), ("y", None)], "k string, v double")
    assert [tuple(r) for r in exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()] == [("x", 3.5)]


def test_halo_copies_only_near_edges(spark):
    df = spark.range(0, 100).select(F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"))
    out = with_halo(df, "ts", 3600, back_s=600)
    assert out.where("_own").count() == 100
    assert out.where("NOT _own").count() == 10


@pytest.mark.parametrize("splits", [2, 16, None])
def test_spearman_removes_nulls_by_pair_and_splits_hot_values(spark, splits):
    rng = np.random.default_rng(5)
    n = 900
    x = rng.normal(size=n)
    pdf = pd.DataFrame({"x": x, "y": np.exp(x) + rng.normal(size=n), "z": rng.integers(0, 5, n).astype(float), "hot": np.where(rng.random(n) < 0.4, 0.0, x + rng.normal(size=n))})
    for c in pdf:  # gaps in other rows of each column
        pdf.loc[rng.random(n) < 0.2, c] = np.nan
    pdf["constant"], pdf["empty"] = 1.0, np.nan
    names = list(pdf)
    df = spark.createDataFrame(pdf).select([F.when(~F.isnan(c), F.col(c)).alias(c) for c in names])
    got = {(r["x"], r["y"]): (r["n"], r["r"]) for r in features.spearman_table(df, names, splits).collect()}
    counts = {(r["x"], r["y"]): r["n"] for r in features.pearson_table(df, names).collect()}
    assert {k: v[0] for k, v in got.items()} == counts
    for (a, b), (_, r) in got.items():
        both = pdf[[a, b]].dropna().rank()
        want = both[a].corr(both[b])
        assert r is None if np.isnan(want) else r == pytest.approx(want), (a, b)


def test_ranks_of_a_value_in_a_third_of_the_rows(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id") / 1.0).alias("v"), F.rand(1).alias("w"))
    ranked = features.pairwise_ranks(df, ["v", "w"], 16)
    got = ranked.select("_k_v_w").toPandas().iloc[:, 0].sort_values().to_numpy()
    want = df.toPandas().v.rank().sort_values().to_numpy()
    np.testing.assert_allclose(got, want)


def test_rank_tasks_grow_in_number_not_in_rows(spark):
    """Both shuffles state their partitions, and no hash aggregate by row runs before the second."""
    df = spark.range(1000).select(F.rand(1).alias("v"), F.rand(2).alias("w"))
    p = features.pairwise_ranks(df, ["v", "w"], 32)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(_f#\d+, _cell#\d+, 32\), REPARTITION_BY_NUM", p)
    after, before = re.split(r"hashpartitioning\(_row#\d+L, 32\), REPARTITION_BY_NUM", p)
    assert "HashAggregate(keys=[_row" in after and "HashAggregate(keys=[_row" not in before


def test_spearman_of_no_rows(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert [tuple(r) for r in features.spearman_table(df, ["a", "b"]).collect()] == [("a", "b", 0, None)]


def test_prune_drops_highest_vif_then_later_name():
    m = np.array([[1.0, 0.99, 0.75], [0.99, 1.0, 0.7], [0.75, 0.7, 1.0]])
    steps = features.prune_steps(m, ["a", "b", "c"], 10.0, 0.69)
    dropped = [s[:2] for s in steps if s[1] == "dropped"]
    assert [d[0] for d in dropped] == ["a", "c"]
    assert [s[0] for s in features.prune_steps(m, ["a", "b", "c"], None, None)] == ["a", "b", "c"]


def test_vif_blames_only_the_collinear(spark):
    m = np.array([[1, 1, 0.1], [1, 1, 0.1], [0.1, 0.1, 1]])
    v = features.vif_values(m)
    assert np.isinf(v[:2]).all() and abs(v[2] - 1 / (1 - 0.01)) < 1e-9
    assert [s[0] for s in features.prune_steps(m, ["a", "b", "z"], 10.0, None) if s[1] == "dropped"] == ["b"]
    nan = float("nan")
    constant = np.array([[1, nan, 0.5], [nan, 1, nan], [0.5, nan, 1]])
    v = features.vif_values(constant)
    assert np.isnan(v[1]) and abs(v[0] - 1 / 0.75) < 1e-9
    assert features.prune_steps(constant, ["a", "k", "z"], 10.0, None)[0][:4] == ("k", "dropped", 1, "constant")
