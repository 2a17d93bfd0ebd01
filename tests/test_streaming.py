"""Streams fed file by file and restarted from their checkpoint."""

import os

import pytest
from pyspark.sql import functions as F

from sunledger.streaming import jobs
from tests.helpers import at, frame

SCHEMA = "feed string, ts timestamp_ntz, id bigint, v double"


def t(h, m=0, d=1):
    return at(f"2024-05-{d:02d} {h:02d}:{m:02d}:00")


class Landing:
    """A folder in which files land, and a job that goes on from its checkpoint."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, path, 0
        os.makedirs(f"{path}/in")

    def land(self, *data, schema=SCHEMA):
        self.n += 1
        frame(self.spark, schema, *data).coalesce(1).write.parquet(f"{self.path}/in/f{self.n}")
        self.schema = schema

    def run(self, make, name, **kw):
        src = (
            self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
            .parquet(f"{self.path}/in")
        )
        return jobs.run_to_table(make(src), name, location=f"{self.path}/{name}-job", **kw)


@pytest.fixture()
def landing(spark, tmp_path):
    return Landing(spark, str(tmp_path))


def test_windows_close_once_across_restarts(landing):
    def make(s):
        w = jobs.tumbling(jobs.event_time(s, "ts", "1 hour"), "ts", "1 hour", ["feed"], [F.sum("v").alias("v")])
        return jobs.ntz(w, "window_start", "window_end")

    landing.land(("a", t(1, 10), 1, 1.0), ("a", t(1, 50), 2, 2.0), ("a", t(2, 5), 3, 4.0))
    assert landing.run(make, "w").count() == 0
    landing.land(("a", t(1, 59), 4, 8.0), ("a", t(4), 5, 16.0))
    got = landing.run(make, "w")
    assert sorted((r["window_start"], r["v"]) for r in got.collect()) == [(t(1), 11.0), (t(2), 4.0)]
    landing.land(("a", t(1, 30), 6, 32.0), ("a", t(9), 7, 1.0))
    got = landing.run(make, "w")
    assert sorted((r["window_start"], r["v"]) for r in got.collect()) == [(t(1), 11.0), (t(2), 4.0), (t(4), 16.0)]


def test_repeated_requests_are_dropped_across_files(landing):
    make = lambda s: jobs.ntz(jobs.drop_repeats(jobs.event_time(s, "ts", "2 hours"), ["feed", "id"]), "ts")
    landing.land(("a", t(1), 1, 0.0), ("a", t(1, 5), 1, 0.0))
    landing.run(make, "d")
    landing.land(("a", t(1, 30), 1, 0.0), ("a", t(1, 40), 2, 0.0))
    assert sorted((r["feed"], r["id"]) for r in landing.run(make, "d").collect()) == [("a", 1), ("a", 2)]


def test_session_spans_files(landing):
    make = lambda s: jobs.ntz(
        jobs.outage_sessions(jobs.event_time(s, "ts", "0 seconds"), "ts", ["feed"], "1 hour"), "first_failure", "last_failure"
    )
    landing.land(("a", t(1), 1, 0.0), ("a", t(1, 30), 2, 0.0))
    landing.run(make, "s")
    landing.land(("a", t(2, 10), 3, 0.0))
    landing.run(make, "s")
    landing.land(("a", t(9), 4, 0.0))
    got = [(r["first_failure"], r["last_failure"], r["failures"]) for r in landing.run(make, "s").collect()]
    assert got == [(t(1), t(2, 10), 3)]


def test_deadline_fires_when_a_feed_falls_silent(landing):
    def make(s):
        s = jobs.event_time(s, "ts", "0 seconds").withColumn("us", F.unix_micros("ts"))
        agg = [F.max("us").alias("attempt_us"), F.max(F.when(F.col("v").isNotNull(), F.col("us"))).alias("valid_us")]
        w = jobs.tumbling(s, "ts", "15 minutes", ["feed"], agg)
        w = w.select("feed", F.unix_micros("window_end").alias("window_us"), "attempt_us", "valid_us", "window_end")
        schema = "kind string, feed string, window_us bigint, attempt_us bigint, valid_us bigint, status string"
        return jobs.with_state(w, ["feed"], jobs.FeedFreshness(["feed"], 60), schema, "EventTime")

    # ``null`` answers on time but without values; ``ok`` keeps the clock going.
    landing.land(("null", t(1), 1, 5.0), ("ok", t(1), 2, 1.0), ("ok", t(1, 20), 3, 1.0))
    landing.run(make, "f", stateful=True, state_partitions=2)
    landing.land(("null", t(1, 25), 4, None), ("ok", t(1, 50), 5, 1.0), ("ok", t(2, 20), 6, 1.0))
    landing.run(make, "f", stateful=True, state_partitions=2)
    landing.land(("ok", t(3), 7, 1.0), ("ok", t(3, 20), 8, 1.0))
    got = landing.run(make, "f", stateful=True, state_partitions=2).collect()
    late = [r for r in got if r["kind"] == "deadline"]
    assert {r["feed"] for r in late} == {"null"}
    assert late[0]["attempt_us"] > late[0]["valid_us"]


def test_stuck_run_continues_across_files(landing):
    def make(s):
        w = jobs.tumbling(jobs.event_time(s, "ts", "0 seconds"), "ts", "15 minutes", ["feed"], [F.max_by("id", "ts").alias("level")])
        w = w.select("feed", F.unix_micros("window_start").alias("window_us"), "level", "window_end")
        return jobs.with_state(w, ["feed"], jobs.StuckValue(["feed"], 900_000_000, 3), "feed string, window_us bigint, level bigint, run_length bigint", "None")

    landing.land(("a", t(1), 7, 0.0), ("a", t(1, 15), 7, 0.0))
    landing.run(make, "k", stateful=True, state_partitions=2)
    landing.land(("a", t(1, 30), 7, 0.0), ("a", t(1, 45), 8, 0.0), ("a", t(2, 15), 8, 0.0), ("a", t(3), 1, 0.0))
    got = landing.run(make, "k", stateful=True, state_partitions=2).collect()
    assert [(r["level"], r["run_length"]) for r in got] == [(7, 3)]


def test_unmatched_forecast_comes_out_with_null(spark, tmp_path):
    frame(spark, "site string, target timestamp_ntz, p double", ("a", t(1), 1.0), ("a", t(2), 2.0), ("a", t(1, d=9), 3.0)).write.parquet(f"{tmp_path}/f")
    frame(spark, "site string, hour timestamp_ntz, y double", ("a", t(1), 5.0), ("a", t(1, d=9), 6.0)).write.parquet(f"{tmp_path}/a")
    f = jobs.event_time(jobs.landing_stream(spark, f"{tmp_path}/f", spark.read.parquet(f"{tmp_path}/f").schema), "target", "1 hour")
    a = jobs.event_time(jobs.landing_stream(spark, f"{tmp_path}/a", spark.read.parquet(f"{tmp_path}/a").schema), "hour", "1 hour")
    out = jobs.ntz(jobs.match_as_they_arrive(f, a, "site", "target", "hour"), "target", "hour")
    got = jobs.run_to_table(out, "m", location=f"{tmp_path}/m-1").collect()
    assert sorted((r["target"], r["y"]) for r in got if r["target"] < t(1, d=2)) == [(t(1), 5.0), (t(2), None)]


def test_forecasts_without_an_actual_are_kept(spark):
    from sunledger.plans import runner
    from tests.oracle import SF_ROOT

    sf = f"{SF_ROOT}/sf0.001"
    rows = runner("stream_forecast_states")(spark, sf).select("event_id", "state", "actual_kw").collect()
    matched = {r["event_id"] for r in runner("stream_matched_forecasts")(spark, sf).select("event_id").collect()}
    assert len({r["event_id"] for r in rows}) == len(rows)
    assert {r["event_id"] for r in rows if r["state"] == "matched"} == matched
    lost = [r for r in rows if r["state"] == "unmatched"]
    assert lost and all(r["actual_kw"] is None for r in lost)


def bounded_run(spark, root, files, restarts=()):
    """Hourly totals of files that are out of time order, one file a batch: (all stored rows, windows that closed, late rows by window)."""
    hour = F.window("ts", "1 hour")
    amount = [F.count("*").alias("n"), F.sum("v").alias("v")]
    for k, rows in enumerate(files):
        frame(spark, SCHEMA, *rows).coalesce(1).write.parquet(f"{root}/in/f{k}")
        if k in restarts or k == len(files) - 1:
            src = spark.readStream.schema(spark.read.parquet(f"{root}/in/f0").schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
            src = src.withColumn("ts", F.col("ts").cast("timestamp"))
            closed, stored = jobs.run_bounded(
                src, "ts", "30 minutes", lambda rows: jobs.tumbling(rows, "ts", "1 hour", ["feed"], amount), "w", f"{root}/job", deadline=hour.end, state_partitions=2
            )
    late = stored.where("late").groupBy("feed", hour.start.alias("window_start"), hour.end.alias("window_end")).agg(*amount)
    return stored, closed, late


def test_bounded_batches_lose_nothing(spark, tmp_path):
    rows = [("ab"[i % 2], t(1 + i % 20, (i * 7) % 60), i, float(i)) for i in range(400)] + [("a", t(23, 59), 900, 1.0)]
    order = sorted(rows, key=lambda r: (r[2] * 37) % 101)
    files = [order[k::20] for k in range(20)]
    totals = []
    for name, split, restarts in (("many", files, (3, 11)), ("one", [rows], ())):
        stored, closed, late = bounded_run(spark, f"{tmp_path}/{name}", split, restarts)
        assert stored.count() == len(rows)  # nothing is stored twice
        n_late = stored.where("late").count()
        assert (n_late > 50) == (name == "many")
        assert closed.agg(F.sum("n")).first()[0] + n_late == sum(r[1] < t(23) for r in rows)
        both = closed.unionByName(late).groupBy("feed", "window_start").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
        totals.append(sorted(tuple(r) for r in both.collect()))
    assert totals[0] == totals[1]
    want = {}
    for feed, ts, _, v in rows:
        if ts < t(23):
            n, s = want.get((feed, ts.replace(minute=0)), (0, 0.0))
            want[feed, ts.replace(minute=0)] = n + 1, s + v
    assert len(totals[0]) == len(want) and {r[2:] for r in totals[0]} == set(want.values())


def test_silent_periods_have_rows(spark, tmp_path):
    from sunledger.streaming import heartbeat

    register = "feed string, from_ts timestamp_ntz, to_ts timestamp_ntz"

    def run():
        src = spark.readStream.schema(spark.createDataFrame([], SCHEMA).schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        spans = spark.readStream.schema(spark.createDataFrame([], register).schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/register")
        day = jobs.tumbling(jobs.event_time(src, "ts", "0 seconds"), "ts", "1 day", ["feed"], [F.count("*").alias("executed"), F.count("v").alias("generated")])
        out = jobs.ntz(heartbeat.expected_periods(day, spans, ["feed"], ["executed", "generated"], 86400, 24), "window_start", "window_end")
        got = jobs.run_to_table(out, "p", location=f"{tmp_path}/job", stateful=True, state_partitions=2)
        return sorted((r["feed"], r["window_start"].day, r["registered"], r["expected"], r["executed"], r["generated"]) for r in got.collect())

    def land(k, *rows):
        frame(spark, SCHEMA, *rows).coalesce(1).write.parquet(f"{tmp_path}/in/f{k}")

    frame(spark, register, ("a", t(6), None), ("b", t(0), t(0, d=3)), ("b", t(12, d=5), t(13, d=5)), ("silent", t(0, d=2), None)).coalesce(1).write.parquet(f"{tmp_path}/register/r0")
    land(0, ("a", t(1), 1, 1.0), ("a", t(2), 2, None), ("b", t(1, d=2), 3, 1.0), ("x", t(1, d=2), 4, 1.0))
    run()
    land(1, ("a", t(9, d=2), 5, 1.0))
    first = [("a", 1, True, 24, 2, 1), ("b", 1, True, 24, 0, 0)]
    assert run() == first
    # The clock jumps over days without any row; ``b`` runs on after its end.
    land(2, ("b", t(3, d=4), 6, 1.0), ("a", t(1, d=7), 7, 1.0))
    frame(spark, register, ("new", t(0, d=6), None)).coalesce(1).write.parquet(f"{tmp_path}/register/r1")
    want = [
        *first, ("a", 2, True, 24, 1, 1), *[("a", k, True, 24, 0, 0) for k in (3, 4, 5, 6)], ("b", 2, True, 24, 1, 1), ("b", 4, False, 0, 1, 1), ("b", 5, True, 24, 0, 0),
        ("new", 6, True, 24, 0, 0), *[("silent", k, True, 24, 0, 0) for k in (2, 3, 4, 5, 6)], ("x", 2, False, 0, 1, 1),
    ]
    assert run() == sorted(want)
    land(3, ("a", t(1, d=9), 8, 1.0))
    assert run() == sorted([*want, ("a", 7, True, 24, 1, 1), ("a", 8, True, 24, 0, 0), *[(f, k, True, 24, 0, 0) for f in ("silent", "new") for k in (7, 8)]])
