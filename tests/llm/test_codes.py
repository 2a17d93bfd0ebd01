"""Product codes against a plain computation with Python's whole numbers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunledger.llm import codes
from tests.llm.test_vectors import usable

SCHEMA = "vec_id bigint, embedding array<float>, label int, code_ string, id string, vector string, dim string, part string"


def plain(rows, parts=8, entries=16, rounds=6, factor=4096):
    """{(id, vector): (code, error)} and the digest, for rows (id, vector) of one length."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    whole = [[math.floor(factor * x) for x in v] for _, v in rows]
    width = -(-len(whole[0]) // parts)
    cut = [[(v + [0] * (width * parts - len(v)))[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def best(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            homes = [best(p, c[p])[0] for c in cut]
            for e in range(len(books[p])):
                mine = [c[p] for c, h in zip(cut, homes) if h == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    out = []
    for (i, v), c in zip(rows, cut):
        found = [best(p, c[p]) for p in range(parts)]
        out.append((i, v, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found)))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    rng, rows = np.random.default_rng(5), []
    centres = rng.standard_normal((7, 16))
    for i in range(300):
        rows.append((i * 3, (centres[i % 7] + rng.standard_normal(16) * 0.2).astype(np.float32).tolist(), [None, 1, 2][i % 3]))
    rows += [(2000 + i, rows[50][1], 2) for i in range(40)]  # copies
    nan, inf = float("nan"), float("inf")
    rows += [(1, None, 1), (2, [0.0] * 16, 1), (4, [None] + [1.0] * 15, 1), (5, [nan] + [1.0] * 15, 1), (7, [-inf] + [1.0] * 15, 1), (None, rows[0][1], 0), rows[7], rows[7]]
    rows += [(9000 + i, [float(i), -2.5, 0.1 * i], 1) for i in range(20)] + [(9100, [], 1)]
    return spark.createDataFrame([(*r, "x", "y", "z", "u", "w") for r in rows], SCHEMA).repartition(4)


def coded(df, **kw):
    fitted = codes.fit(df, **kw)
    out = fitted.encode(df)
    assert out.columns == [*df.columns, "code", "error"]
    return fitted, sorted(((r["vec_id"], tuple(r["embedding"]), r["code"], r["error"]) for r in out.collect()), key=str)


def test_equal_to_plain_computation(odd):
    fitted, got = coded(odd)
    want, rows = [], [(r["vec_id"], r["embedding"]) for r in odd.collect() if usable(r["embedding"])]
    for dim in (16, 3):
        some, digest = plain([r for r in rows if len(r[1]) == dim])
        want += [(i, tuple(v), c, d) for i, v, c, d in some]
        assert fitted.digest(dim) == digest
    want.append((9100, (), "00" * 8, 0))
    assert got == sorted(want, key=str) and len(got) == 300 + 40 + 4 + 20 + 1


def test_fewer_vectors_than_entries_and_other_parameters(odd):
    few = odd.where("vec_id < 25 and vec_id % 3 = 0")
    fitted, got = coded(few, parts=4, entries=16, rounds=2, factor=64.0)
    want, digest = plain([(r["vec_id"], r["embedding"]) for r in few.collect()], 4, 16, 2, 64)
    assert got == sorted(((i, tuple(v), c, d) for i, v, c, d in want), key=str) and fitted.digest(16) == digest
    with pytest.raises(ValueError):
        codes.fit(odd, factor=1000.0)


def test_components_beyond_64_bits(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(8) * 10.0 ** rng.integers(-3, 37)).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    fitted, got = coded(df, parts=2, entries=4, rounds=3)
    want, digest = plain(rows, 2, 4, 3)
    assert fitted.digest(8) == digest
    assert got == sorted(((i, tuple(v), c, d if d < 2**63 else None) for i, v, c, d in want), key=str)
    assert any(g[3] is None for g in got) and any(g[3] is not None for g in got)


@pytest.mark.parametrize("scale", [3, 900, 1 << 40])
def test_tree_search_equals_comparing_all(scale):
    rng = np.random.default_rng(scale)
    kind = object if scale > codes.SMALL else np.int64
    for n in (1, 2, 5, 16, 40, 200):
        entries = rng.integers(-scale, scale, (n, 2)).astype(kind)
        entries[n // 2] = entries[0]  # equal entries: the lower number wins
        points = np.vstack([rng.integers(-scale, scale, (300, 2)).astype(kind), entries])
        all_ = ((points[:, None] - entries) ** 2).sum(axis=2)
        which, best, counted = codes.nearest(codes.gnat(entries), entries, points)
        assert (which == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()
        if n == 200:
            assert counted < 0.6 * n * len(points)  # subtrees are ruled out


def test_decoded_vectors_are_near(odd):
    fitted = codes.fit(odd.where(F.size("embedding") == 16))
    for r in fitted.encode(odd.where("vec_id < 60 and size(embedding) = 16")).collect():
        back = np.array(fitted.decode(r["code"], 16))
        assert abs(((back - np.array(r["embedding"])) ** 2).sum() * 4096**2 - r["error"]) <= 0.01 * r["error"] + 1e5


def test_empty_tables(odd):
    none = odd.where("1 = 0")
    fitted, got = coded(none)
    assert fitted.books == {} and got == []
    assert codes.fit(odd.where("vec_id in (1, 4, 5)")).books == {}
    with pytest.raises(ValueError):
        fitted.encode(none.withColumn("code", F.lit(1)))
