"""Model inputs on a live stream: the stateful twin of the receipt-time joins in ``operators.asof``.

Versions of observations, readings and asks (issues for which inputs are wanted) are three streams with a watermark each; the slowest one sets the
clock. A row of inputs leaves once the clock has passed its issue, so nothing that arrived in time is missed and nothing later is seen.

State is kept by (keys, bucket of issue time). Before it is dealt, a version is folded to the best of its minute of receipt, and readings to the first
and last of their minute; no issue on a full minute can tell the difference. So the state of a bucket is bounded by its minutes, not by the
rows, a busy key is spread over its buckets, and a bucket's state goes when the clock has passed it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sunledger.operators import asof
from sunledger.streaming.jobs import with_state

MINUTE_US = 60_000_000
HOUR_US = 60 * MINUTE_US


@dataclass(frozen=True)
class InputSpec:
    """What a model needs at an issue, the one definition for training rows and for live rows.

    ``lags`` names the reading nearest to issue - m minutes for each m, within ``tolerance`` minutes (an expression over the key columns and
    ``lag_min``, never above ``max_tolerance_min``). ``needed`` are the columns of the freshest complete observation received by the
    issue and at most ``max_age_h`` old; ``observed`` is its time.
    """

    keys: tuple[str, ...]
    lags: Mapping[int, str]
    tolerance: Column
    max_tolerance_min: int
    observed: str
    needed: tuple[str, ...]
    max_age_h: int

    @property
    def slack_us(self) -> int:
        """How long after an issue a reading may come that its lags still use, up to the end of the minute."""
        return (max(0, self.max_tolerance_min - min(self.lags)) + 1) * MINUTE_US


def training_inputs(spec: InputSpec, versions: DataFrame, readings: DataFrame, issues: DataFrame, received: str, ts: str, tie: str, value: str, issue: str) -> DataFrame:
    """Input rows of all issues from stored tables."""
    keys = list(spec.keys)
    fresh = asof.freshest_complete(versions, issues, keys, received, tie, issue, spec.observed, list(spec.needed), spec.max_age_h)
    lags = asof.lag_aligned(readings, issues, keys, ts, tie, value, issue, list(spec.lags), spec.tolerance)
    return asof.assemble_inputs(lags, fresh, keys, issue, spec.lags)


class LiveInputs(StatefulProcessor):
    """Answers each ask of a (keys, bucket) when the clock has passed it, from the versions and readings dealt to the bucket."""

    def __init__(self, keys: Sequence[str], lags: Sequence[int], n_needed: int, max_age_us: int, bucket_us: int, slack_us: int):
        self.keys, self.lags, self.n_needed = list(keys), list(lags), n_needed
        self.max_age_us, self.bucket_us, self.slack_us = max_age_us, bucket_us, slack_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # At most one version and two readings a minute, and the asks.
        self.versions = handle.getListState("versions", "observed bigint, received bigint, tie bigint, vals array<double>")
        self.readings = handle.getListState("readings", "ts bigint, tie bigint, value double")
        self.asks = handle.getListState("asks", "issue bigint, tolerance array<int>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        versions, readings, asks = [], [], []
        for r in rows:
            if r.kind == 0:
                versions.append((r.us, r.received_us, r.tie, list(r.vals)))
            elif r.kind == 1:
                readings.append((r.us, r.tie, r.vals[0]))
            else:
                asks.append((r.us, list(r.tolerance)))
        for state, new in ((self.versions, versions), (self.readings, readings), (self.asks, asks)):
            if new:
                state.appendList(new)
        for issue, _ in asks:
            self.handle.registerTimer((issue + self.slack_us) // 1000)
        self.handle.registerTimer(((key[-1] + 1) * self.bucket_us + self.slack_us) // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        issue = expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.slack_us
        if issue >= (key[-1] + 1) * self.bucket_us:
            for state in (self.versions, self.readings, self.asks):
                state.clear()
            return
        asked = [tuple(a)[1] for a in self.asks.get() if tuple(a)[0] == issue] if self.asks.exists() else []
        if not asked:
            return
        known = [tuple(v) for v in self.versions.get()] if self.versions.exists() else []
        usable = [v for v in known if v[1] <= issue and issue - v[0] <= self.max_age_us]
        best = max(usable, key=lambda v: v[:3], default=None)
        readings = sorted((tuple(r) for r in self.readings.get()), key=lambda r: (r[0], -r[1])) if self.readings.exists() else []
        for tolerance in asked:
            found: list[float | None] = []
            for lag, tol in zip(self.lags, tolerance):
                want = issue - lag * MINUTE_US
                near = [(abs(ts - want), ts, -tie, value) for ts, tie, value in readings if abs(ts - want) <= tol * MINUTE_US]
                found.append(min(near)[3] if near else None)
            yield Row(
                **dict(zip(self.keys, key[:-1])), issue_us=issue, observed_us=best[0] if best else None,
                vals=list(best[3]) if best else [None] * self.n_needed, lags=found,
            )

    def close(self) -> None:
        pass


def _dealt(rows: DataFrame, first_us: Column, last_us: Column, bucket_us: int) -> DataFrame:
    """Rows once for each bucket between two instants."""
    return rows.withColumn("bucket", F.explode(F.sequence(F.floor(first_us / bucket_us).cast("bigint"), F.floor(last_us / bucket_us).cast("bigint"))))


def live_inputs(
    spec: InputSpec, versions: DataFrame, readings: DataFrame, asks: DataFrame, received: str, ts: str, tie: str, value: str, issue: str, bucket_h: int = 6
) -> DataFrame:
    """Input rows of all asks as the streams go on; the same columns as ``training_inputs``.

    The three streams carry watermarks on ``received``, ``ts`` and ``issue`` (TIMESTAMP); after a restart the clock waits until each has had a row again. Issues are full minutes. The row of an issue comes out
    when all three watermarks have passed it by ``spec.slack_us``. Versions without all of ``needed``, and readings without a value, count as
    absent. An observation from the future is used no longer than a current one would be. Asks may repeat; each has a row.
    """
    keys, bucket_us, age_us = list(spec.keys), bucket_h * HOUR_US, spec.max_age_h * HOUR_US
    layout = [*keys, "bucket", "kind", "at", "us", "received_us", "tie", "vals", "tolerance"]
    no_tolerance = F.lit(None).cast("array<int>")

    whole = versions.where(F.expr(" AND ".join(f"{c} IS NOT NULL" for c in (*spec.needed, spec.observed))))
    # Received at 10:00:00 is in time for 10:00, the rest of that minute is not, so full minutes fold apart.
    item = F.struct(F.unix_micros(F.col(spec.observed).cast("timestamp")).alias("us"), F.unix_micros(received).alias("received_us"), F.col(tie).alias("tie"), F.array(*[F.col(c).cast("double") for c in spec.needed]).alias("vals"))
    best = whole.withColumn("_item", item).groupBy(F.window(received, "1 minute"), *keys, (F.unix_micros(received) % MINUTE_US == 0).alias("_full")).agg(F.max("_item").alias("_item"))
    best = best.select(*keys, F.lit(0).alias("kind"), F.col("window.end").alias("at"), "_item.*", no_tolerance.alias("tolerance"))
    until = F.least(F.col("us") + age_us, F.col("received_us") + age_us)
    best = _dealt(best.where(F.col("us") + age_us >= F.col("received_us")), F.col("received_us"), until, bucket_us).select(*layout)

    us = F.unix_micros(ts)
    reading = F.struct(us.alias("us"), F.col(tie).alias("tie"), F.col(value).cast("double").alias("value"))
    # Of readings of one instant the one with the highest tie-break counts.
    first = F.min(F.struct(us.alias("us"), (-F.col(tie)).alias("back"), reading.alias("r")))
    ends = readings.where(F.col(value).isNotNull()).groupBy(F.window(ts, "1 minute"), *keys).agg(first["r"].alias("a"), F.max(reading).alias("b"))
    ends = ends.select(*keys, F.lit(1).alias("kind"), F.col("window.end").alias("at"), F.explode(F.array_distinct(F.array("a", "b"))).alias("_r"))
    ends = ends.select(*keys, "kind", "at", "_r.us", F.lit(None).cast("bigint").alias("received_us"), "_r.tie", F.array("_r.value").alias("vals"), no_tolerance.alias("tolerance"))
    reach = spec.max_tolerance_min * MINUTE_US
    ends = _dealt(ends, F.col("us") + min(spec.lags) * MINUTE_US - reach, F.col("us") + max(spec.lags) * MINUTE_US + reach, bucket_us).select(*layout)

    wanted = asks
    for m in spec.lags:
        wanted = wanted.withColumn("lag_min", F.lit(m).cast("bigint")).withColumn(f"_tol{m}", spec.tolerance.cast("int")).drop("lag_min")
    wanted = wanted.select(
        *keys, F.floor(F.unix_micros(issue) / bucket_us).cast("bigint").alias("bucket"), F.lit(2).alias("kind"), F.col(issue).alias("at"), F.unix_micros(issue).alias("us"),
        F.lit(None).cast("bigint").alias("received_us"), F.lit(None).cast("bigint").alias("tie"), F.lit(None).cast("array<double>").alias("vals"), F.array(*[f"_tol{m}" for m in spec.lags]).alias("tolerance"),
    )

    processor = LiveInputs(keys, list(spec.lags), len(spec.needed), age_us, bucket_us, spec.slack_us)
    fields = {f.name: f.dataType.simpleString() for f in asks.schema}
    output = ", ".join(f"{k} {fields[k]}" for k in keys) + ", issue_us bigint, observed_us bigint, vals array<double>, lags array<double>"
    rows = with_state(best.unionByName(ends).unionByName(wanted), [*keys, "bucket"], processor, output, "EventTime")
    names = list(spec.lags.values())
    missing = F.concat_ws(",", *[F.when(F.col("lags")[i].isNull(), n) for i, n in enumerate(names)], F.when(F.col("observed_us").isNull(), "weather"))
    instant = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    out = rows.select(
        *keys, instant("issue_us").alias(issue), instant("observed_us").alias(spec.observed), *[F.col("vals")[i].alias(n) for i, n in enumerate(spec.needed)],
        *[F.col("lags")[i].alias(n) for i, n in enumerate(names)], missing.alias("missing_inputs"),
    )
    return out.withColumn("status", F.when(F.col("missing_inputs") == "", "ready").otherwise("waiting"))
