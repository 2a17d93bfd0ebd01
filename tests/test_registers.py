"""Registers with effective dates, and the queries over registers on logs of another year."""

import datetime as dt
import os

import duckdb
import pytest

from sunledger.operators import registers
from tests.oracle import SF_ROOT, TABLES, connect, problems

OVER_REGISTERS = (
    "slot_states slot_coverage silent_units archive_and_live gate_rates model_readiness feeds_not_arrived feed_status status_cards lead_coverage "
    "register_audit dated_gate_rates dated_readiness"
).split()


@pytest.fixture(scope="module")
def other_year(tmp_path_factory):
    """The small tables with the log three years and eleven days earlier."""
    folder = tmp_path_factory.mktemp("other-year")
    for t in TABLES:
        source = f"{SF_ROOT}/sf0.001/{t}.parquet"
        if t == "events":
            duckdb.sql(f"COPY (SELECT * REPLACE (ts - INTERVAL '1107 days' AS ts) FROM '{source}') TO '{folder}/{t}.parquet' (FORMAT parquet)")
        else:
            os.symlink(source, folder / f"{t}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", OVER_REGISTERS)
def test_logs_of_another_year_give_full_results(spark, other_year, name):
    from sunledger.plans import runner

    assert problems(spark, name, other_year, connect(other_year)) == []
    here, there = (runner(name)(spark, d) for d in (f"{SF_ROOT}/sf0.001", other_year))
    # The same rows at other times: their number and all columns that hold no time agree.
    plain = [f.name for f in here.schema if f.dataType.typeName() not in ("timestamp_ntz", "timestamp", "date")]
    rows = [sorted(map(str, d.select(*plain).collect())) for d in (here, there)]
    assert rows[0] == rows[1]


def time(day, hour=0, minute=0, second=0):
    return dt.datetime(2021, 3, day, hour, minute, second)


@pytest.fixture(scope="module")
def register(spark):
    rows = [
        ("a", time(1), time(3)),
        ("a", time(2, 12), time(4, 0, 10)),  # overlaps the entry before
        ("a", time(20), None),  # comes back, open
        ("b", time(5), time(5)),  # never holds
        ("c", time(30), None),  # after the clock
        ("d", dt.datetime(2019, 1, 1), None),
        (None, time(1), None),
    ]
    return spark.createDataFrame(rows, "unit string, from_ts timestamp_ntz, to_ts timestamp_ntz")


def test_due_slots_against_brute_force(spark, register):
    first, end = time(1), time(22)
    for minutes in (15, 60, 7):
        got = registers.due_slots(register, ["unit"], "slot", "2021-03-01 00:00:00", "2021-03-22 00:00:00", minutes).collect()
        want = set()
        for unit, a, z in register.collect():
            at = dt.datetime(1970, 1, 1) + dt.timedelta(minutes=-(-((first - dt.datetime(1970, 1, 1)) // dt.timedelta(minutes=1)) // minutes) * minutes)
            while at < end:
                if a <= at < (z or end) and at >= first:
                    want.add((unit, at))
                at += dt.timedelta(minutes=minutes)
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_states_against_brute_force(spark, register):
    facts = [(u, time(d, h, m, s), i) for i, (u, d, h, m, s) in enumerate((u, d, h, m, s) for u in "abcdx" for d in range(1, 30) for h, m, s in ((0, 0, 0), (12, 0, 9), (0, 0, 10), (23, 59, 59)))]
    facts += [("d", None, -1), (None, time(4), -2), ("a", time(2, 13), -3), ("a", time(2, 13), -3)]
    rows = spark.createDataFrame(facts, "unit string, ts timestamp_ntz, n int")
    got = registers.register_state(rows, register, ["unit"], "ts", "2021-03-22 00:00:00").collect()
    entries = register.collect()

    def state(unit, ts):
        mine = [(a, z) for u, a, z in entries if u == unit and unit is not None]
        if ts is not None and any(a <= ts < min(z or time(22), time(22)) for a, z in mine):
            return "inside"
        return "outside_dates" if mine else "unknown"

    assert len(got) == len(facts)
    for r in got:
        assert r["register_state"] == state(r["unit"], r["ts"]), r
    counts = {r["unit"]: r for r in registers.register_counts(rows.dropna(subset=["unit"]), register.dropna(subset=["unit"]), ["unit"], "ts", "2021-03-22 00:00:00").collect()}
    for unit in "abcdx":
        mine = [state(u, t) for u, t, _ in facts if u == unit]
        assert [counts[unit][c] for c in ("n_rows", "n_inside", "n_outside_dates", "n_unknown")] == [len(mine), *[mine.count(s) for s in ("inside", "outside_dates", "unknown")]]


def test_empty_register_and_facts(spark, register):
    none = register.limit(0)
    facts = spark.createDataFrame([("a", time(1))], "unit string, ts timestamp_ntz")
    assert registers.due_slots(none, ["unit"], "slot", "2021-03-01 00:00:00", "2021-03-02 00:00:00", 15).count() == 0
    assert [r["register_state"] for r in registers.register_state(facts, none, ["unit"], "ts", "2021-03-02 00:00:00").collect()] == ["unknown"]
    silent = registers.register_counts(facts.limit(0), register.dropna(subset=["unit"]), ["unit"], "ts", "2021-03-22 00:00:00").collect()
    assert {r["unit"]: r["n_rows"] for r in silent} == dict.fromkeys("abcd", 0)
