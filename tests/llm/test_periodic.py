"""Grammar extensions and periodic runs against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunledger.llm import periodic
from sunledger.llm.recompression import Grammar

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sequences():
    rng = np.random.default_rng(7)
    yield np.zeros(0, np.int32)
    yield np.array([3], np.int32)
    yield np.zeros(200, np.int32)
    for letters in (1, 2, 3, 50):
        x = rng.integers(0, letters, 300).astype(np.int32)
        x[rng.integers(0, 300, 4)] = -1
        yield x
    yield np.r_[np.tile([0, 1, 0, 0, 1], 40), -1, np.tile([0, 1, 0, 0, 1], 30), 7].astype(np.int32)
    a, b = np.array([0]), np.array([0, 1])
    for _ in range(11):
        a, b = b, np.r_[b, a]  # a Fibonacci word
    yield b.astype(np.int32)


@pytest.mark.parametrize("sequence", list(sequences()), ids=lambda s: f"{len(s)}-{len(set(s.tolist()))}")
def test_common_extensions(sequence):
    n = len(sequence)
    rng = np.random.default_rng(8)
    x = np.r_[rng.integers(0, n + 1, 3000), np.arange(n)]
    y = np.r_[rng.integers(0, n + 1, 3000), np.arange(n) + 1]
    x, y = x[x != y], y[x != y]
    grammar = Grammar(sequence)

    def plain(s, i, j):
        k = 0
        while i + k < len(s) and j + k < len(s) and s[i + k] == s[j + k] >= 0:
            k += 1
        return k

    s, r = sequence.tolist(), sequence[::-1].tolist()
    assert grammar.common(x, y).tolist() == [plain(s, i, j) for i, j in zip(x.tolist(), y.tolist())]
    assert grammar.mirrored().common(n - x, n - y).tolist() == [plain(r, n - i, n - j) for i, j in zip(x.tolist(), y.tolist())]


def test_the_grammar_is_small_and_spells_the_sequence():
    rng = np.random.default_rng(9)
    grammar = Grammar(rng.integers(0, 1000, 20_000).astype(np.int32))
    sizes = [len(level.symbol) for level in grammar.levels]
    assert sizes[-1] == 1 and sum(sizes) < 6 * sizes[0] and len(sizes) < 80
    for below, above in zip(grammar.levels, grammar.levels[1:]):
        assert (above.start[:-1] == below.start[below.first]).all() and (below.first[below.up] <= np.arange(len(below.symbol))).all()
    assert len(Grammar(np.zeros(1 << 20, np.int32)).levels) == 2  # one block


def plain_runs(words, least=24, repeats=3):
    n, found = len(words), {}
    for p in range(1, n // repeats + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, repeats * p) and j > i:
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def plain_rest(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    rng = np.random.default_rng(10)
    out = [None, "", " \t\n", "a", "a " * 23, "a " * 24, "\x0b".join(["é"] * 30), "x\x1cy " * 40, "A b " * 11 + "A b", "A b " * 12]
    for _ in range(60):
        w = [f"w{v}" for v in rng.integers(0, rng.integers(1, 6), rng.integers(20, 200))]
        p, k = int(rng.integers(1, 20)), int(rng.integers(2, 9))
        at = int(rng.integers(0, len(w)))
        out.append(" ".join(w[:at] + (w[at : at + p] or ["z"]) * k + w[at:]))
    long = [f"t{v}" for v in rng.integers(0, 3000, 9000)]
    out.append(" ".join(long[:2000] + long[100:1600] * 3 + long))
    return out


TEXTS = texts()


def test_runs_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string").repartition(3)
    n = 0
    for r in periodic.find_runs(df).collect():
        words = WORD.findall(r["text"] or "")
        if len(words) < 5000:
            want = plain_runs(words)
            n += len(want)
            assert [tuple(x) for x in r["runs"]] == want and r["collapsed"] == plain_rest(words, want), r["doc_id"]
        else:
            assert [tuple(x) for x in r["runs"]] == [(2000, 4500, 1500)] and len(r["collapsed"].split(" ")) == len(words) - 3000
    assert n > 50


def test_small_steps_and_other_bounds(spark, monkeypatch):
    sequences_ = [WORD.findall(t or "") for t in TEXTS[:-1]]
    for least, repeats, step in ((2, 2, 17), (10, 2, 1000), (30, 4, 64)):
        monkeypatch.setattr(periodic, "CANDIDATES", step)
        _, sequence, first = periodic.interned([t or "" for t in TEXTS[:-1]])
        text, start, length, period = periodic.runs_of(sequence, first, least, repeats)
        want = [(k, *x) for k, w in enumerate(sequences_) for x in plain_runs(w, least, repeats)]
        assert list(zip(text.tolist(), start.tolist(), length.tolist(), period.tolist())) == want and len(want) > 20


def test_long_text_of_one_word(spark):
    r = periodic.find_runs(spark.createDataFrame([("la " * 60_000 + "di da " * 20_000,)], "text string")).first()
    assert [tuple(x) for x in r["runs"]] == [(0, 60_000, 1), (60_000, 40_000, 2)] and r["collapsed"] == "la di da"


def test_odd_and_empty_tables(spark, nasty, empty):
    out = periodic.find_runs(nasty)
    assert out.columns == [*nasty.columns, "runs", "collapsed"] and out.count() == nasty.count()
    assert periodic.find_runs(empty).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(nasty.withColumn("runs", F.lit(1)))
