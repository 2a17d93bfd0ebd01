"""The distributed Huber booster against a plain one."""

import datetime as dt
import math
import random

import pytest

from sunledger.operators import boosting

SCHEMA = "id bigint, day date, a double, b double, c double, y double, fold_x string"
FEATURES = ["a", "b", "c"]


def rank(values, p):
    values = sorted(values)
    return values[max(1, math.ceil(p * len(values))) - 1]


def plain(train, held, rounds, depth, rate, bins, alpha, min_leaf):
    """Predictions of ``held`` (lists of features) by a booster on ``train`` (features, y)."""
    cuts = []
    for i in range(len(FEATURES)):
        known = [x[i] for x, _ in train if x[i] is not None]
        cuts.append(sorted({rank(known, k / bins) for k in range(1, bins)}) if known else [])
    low = lambda x: [-1 if v is None else sum(c < v for c in cuts[i]) for i, v in enumerate(x)]
    rows = [(low(x), y) for x, y in train]
    others = [low(x) for x in held]
    base = rank([y for _, y in rows], 0.5)
    pred, out = [base] * len(rows), [base] * len(others)
    for _ in range(rounds):
        r = [y - p for (_, y), p in zip(rows, pred)]
        w = rank([abs(v) for v in r], alpha)
        clip = lambda v: max(min(v, w), -w)  # noqa: E731, B023
        node, onode = [1] * len(rows), [1] * len(others)
        for _ in range(depth):
            splits = {}
            for n in set(node):
                own = [k for k, v in enumerate(node) if v == n]
                total, best = math.fsum(round(clip(r[k]), 6) for k in own), None
                for f in range(len(FEATURES)):
                    for b in sorted({rows[k][0][f] for k in own})[:-1]:
                        left = [k for k in own if rows[k][0][f] <= b]
                        if min(len(left), len(own) - len(left)) < min_leaf:
                            continue
                        s = math.fsum(round(clip(r[k]), 6) for k in left)
                        gain = s * s / len(left) + (total - s) ** 2 / (len(own) - len(left)) - total * total / len(own)
                        if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-12)):
                            best = (gain, f, b)
                splits[n] = best
            go = lambda n, x: 2 * n + (splits.get(n) is not None and x[splits[n][1]] > splits[n][2])  # noqa: E731, B023
            node, onode = [go(n, x) for n, (x, _) in zip(node, rows)], [go(n, x) for n, x in zip(onode, others)]
        value = {}
        for n in set(node):
            own = [r[k] for k, v in enumerate(node) if v == n]
            m = rank(own, 0.5)
            value[n] = m + math.fsum(round(clip(v - m), 6) for v in own) / len(own)
        pred = [p + rate * value[n] for p, n in zip(pred, node)]
        out = [p + rate * value.get(n, 0.0) for p, n in zip(out, onode)]
    return out


def data(seed, n=260):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        a, b, c = rng.uniform(-2, 2), rng.choice([1.0, 2.0, 5.0]), rng.gauss(0, 1)
        y = 3 * (a > 0.3) + b * (c > 0) + rng.gauss(0, 0.1) + (50 if rng.random() < 0.03 else 0)
        hide = rng.random()
        rows.append((k, dt.date(2024, 1, 1) + dt.timedelta(days=k), None if hide < 0.1 else a, b, float("nan") if hide > 0.95 else c, y if k % 41 else None, "x"))
    return rows


@pytest.mark.parametrize(("rounds", "depth", "bins", "min_leaf"), [(1, 1, 4, 1), (4, 2, 8, 5), (3, 3, 16, 1)])
def test_folds_equal_a_plain_booster(spark, rounds, depth, bins, min_leaf):
    rows = data(rounds)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    starts = [dt.date(2024, 1, 1), dt.date(2024, 4, 1), dt.date(2024, 7, 20)]
    kw = {"rounds": rounds, "depth": depth, "rate": 0.3, "bins": bins, "alpha": 0.9, "min_leaf": min_leaf}
    model = boosting.fit_huber_booster(df, "day", FEATURES, "y", starts, **kw)
    got = {r["id"]: r for r in boosting.score_huber_booster(df, model, "day", starts).collect()}
    assert len(got) == len(rows)
    clean = lambda x: [None if v is None or math.isnan(v) else v for v in x]
    for start, end in zip(starts, [*starts[1:], dt.date.max]):
        train = [(clean(r[2:5]), r[5]) for r in rows if r[1] < start and r[5] is not None]
        held = [r for r in rows if start <= r[1] < end]
        assert {got[r[0]]["fold_start"] for r in held} == {start} and {got[r[0]]["train_rows"] for r in held} == {len(train)}
        if not train:
            assert all(got[r[0]]["pred"] is None for r in held)
            continue
        want = plain(train, [clean(r[2:5]) for r in held], **kw)
        assert [got[r[0]]["pred"] for r in held] == pytest.approx(want, abs=1e-9)


def test_outliers_pull_less_than_with_squared_error(spark):
    df = spark.createDataFrame(data(9, 400), SCHEMA)
    start = [dt.date(2024, 12, 1)]
    model = boosting.fit_huber_booster(df, "day", FEATURES, "y", start, rounds=8, depth=2, rate=0.5, bins=16, min_leaf=10)
    rows = [r for r in boosting.score_huber_booster(df, model, "day", start).collect() if r["y"] is not None and r["y"] < 30]
    before = [abs(r["y"] - model.base[start[0]]) for r in rows]
    after = [abs(r["y"] - r["pred"]) for r in rows]
    assert rows and sum(after) < 0.4 * sum(before)


def test_empty_and_unlabelled_tables(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 5, 5), 1.0, None, 2.0, None, "x")], SCHEMA)
    for rows in (df, df.where("1 = 0")):
        starts = boosting.last_months(rows, "day", 3)
        model = boosting.fit_huber_booster(rows, "day", FEATURES, "y", starts)
        assert model.trees == {} and boosting.score_huber_booster(rows, model, "day", starts).where("pred is not null").count() == 0
    assert boosting.last_months(df, "day", 3) == [dt.date(2024, 3, 1), dt.date(2024, 4, 1), dt.date(2024, 5, 1)]
