"""Near-duplicate vectors and exact top-k against brute force."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunledger.llm import graph, vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, rep string, dim string"


@pytest.fixture(scope="module")
def odd(spark):
    rng, rows = np.random.default_rng(3), []
    centres = rng.standard_normal((6, 16))
    for i in range(400):
        v = centres[i % 6] + rng.standard_normal(16) * [0.02, 0.1, 0.4][i % 3]
        rows.append((i, (v * rng.uniform(0.01, 50)).astype(np.float32).tolist(), i % 4))
    rows += [(400 + i, rows[50][1], 2) for i in range(60)]  # copies, also of another label's vector
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [], 1), (503, [None] + [1.0] * 15, 1), (504, [nan] + [1.0] * 15, 1), (550, [inf] + [1.0] * 15, 1)]
    rows += [(600, [1.0, 2.0, 3.0], 1), (650, [1.0, 2.0, 3.0001], 1), (601, rows[0][1], None), (None, rows[0][1], 0), (700, [0.0, -0.0, 0.0], 1), rows[7]]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(5)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_near_duplicates_equal_brute_force(odd, block):
    rows = odd.collect()
    good = [i for i, r in enumerate(rows) if r["vec_id"] is not None and r["label"] is not None and usable(r["embedding"]) and any(r["embedding"])]
    links, parent = Counter(), {r["vec_id"]: r["vec_id"] for r in rows if r["vec_id"] is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in good:
        for b in good:
            x, y = rows[a], rows[b]
            if a < b and x["label"] == y["label"] and len(x["embedding"]) == len(y["embedding"]):
                u, v = np.array(x["embedding"], float), np.array(y["embedding"], float)
                if u @ v / math.sqrt((u @ u) * (v @ v)) >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    p, q = find(x["vec_id"]), find(y["vec_id"])
                    parent[max(p, q)] = min(p, q)
    want = Counter()
    for i, r in enumerate(rows):
        component = None if r["vec_id"] is None else find(r["vec_id"])
        want[r["vec_id"], links[i], component, component is None or component == r["vec_id"]] += 1
    got = Counter(tuple(r) for r in vectors.near_duplicates(odd, 0.98, block).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == want and sum(links.values()) > 1000


def test_bound_holds_for_every_pair():
    rng = np.random.default_rng(4)
    for scale in (1e-20, 1.0, 1e15):
        x, y = rng.standard_normal((80, 1500)) * scale, rng.standard_normal((70, 1500)) * scale
        u, v = x / np.linalg.norm(x, axis=1)[:, None], y / np.linalg.norm(y, axis=1)[:, None]
        p, s, e = vectors.quantise(u)
        q, t, f = vectors.quantise(v)
        bound = e[:, None] + (1 + e[:, None]) * f
        assert (np.abs(vectors.int_products(p, q) * s[:, None] * t - u @ v.T) <= bound).all()
        assert (vectors.int_products(p, q) == p.astype(int) @ q.astype(int).T).all()


def test_forest():
    i, j = np.array([1, 2, 8, 5, 9]), np.array([2, 3, 9, 5, 4])
    assert graph.forest(10, i, j).tolist() == [0, 1, 1, 1, 4, 5, 6, 7, 4, 4]


@pytest.mark.parametrize("blocks", [(3, 11), (1024, 4096)])
def test_top_k_equals_brute_force(odd, blocks):
    rows = [(r["vec_id"], [math.floor(256 * x) for x in r["embedding"]]) for r in odd.collect() if r["vec_id"] is not None and usable(r["embedding"])]
    want = []
    for q, v in rows:
        if q % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in rows if c != q and len(w) == len(v))[:5]
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(found)]
    got = vectors.top_k(odd, F.col("vec_id") % 50 == 0, 5, 256.0, *blocks).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(r[0] == 650 for r in want)


def test_empty_tables(odd):
    none = odd.where("1 = 0")
    assert vectors.near_duplicates(none).count() == 0 and vectors.top_k(none, F.col("vec_id") % 50 == 0).count() == 0
    assert vectors.top_k(odd.where("vec_id = 3"), F.col("vec_id") % 50 == 0).count() == 0
    assert vectors.top_k(odd.where("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0
