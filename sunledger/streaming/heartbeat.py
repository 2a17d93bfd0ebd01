"""Periods that should have come: a register of keys with dates, and a timer for each period that closes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sunledger.streaming.jobs import with_state

FOREVER = 1 << 62


class ExpectedPeriods(StatefulProcessor):
    """One row for each period of a registered key once the clock has passed its end, with counts of 0 if nothing came.

    State per key: the registered spans, the counts of periods that have come but are not due, and the start of the next due period.
    Input is one row per (key, period), so it does not grow with the runs.
    """

    def __init__(self, keys: Sequence[str], counts: Sequence[str], period_us: int):
        self.keys, self.counts, self.period_us = list(keys), list(counts), period_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getListState("spans", "begin bigint, until bigint")
        self.came = handle.getMapState("came", "start bigint", "counts array<bigint>")
        self.next = handle.getValueState("next", "start bigint")

    def registered(self, start: int) -> bool:
        return any(begin < start + self.period_us and start < until for begin, until in self.known)

    def row(self, key, start: int, counts: Sequence[int] | None, registered: bool) -> Row:
        counts = [0] * len(self.counts) if counts is None else [int(c) for c in counts]
        return Row(**dict(zip(self.keys, key)), start_us=start, registered=registered, **dict(zip(self.counts, counts)))

    def load(self) -> None:
        self.known = [tuple(s) for s in self.spans.get()] if self.spans.exists() else []

    def due(self, after: int) -> int | None:
        """The first registered period that starts at ``after`` or later."""
        starts = [max(after, begin // self.period_us * self.period_us) for begin, until in self.known if begin < until]
        return min((s for s in starts if self.registered(s)), default=None)

    def wait(self, start: int | None, old: int | None) -> None:
        if start == old:
            return
        if old is not None:
            self.handle.deleteTimer((old + self.period_us) // 1000)
        if start is None:
            self.next.clear()
        else:
            self.next.update((start,))
            self.handle.registerTimer((start + self.period_us) // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        spans, periods = [], []
        for r in rows:
            (spans if r.counts is None else periods).append(r)
        if spans:
            self.spans.appendList([(r.begin, r.until) for r in spans])
        self.load()
        old = self.next.get()[0] if self.next.exists() else None
        if spans:
            # A span that is entered afterwards brings the periods that it begins with, and none that have come out already.
            first = [min(s.begin for s in spans) // self.period_us * self.period_us]
            self.wait(self.due(min(first + ([old] if old is not None else []))), old)
        for r in periods:
            if self.registered(r.start):
                self.came.updateValue((r.start,), (list(r.counts),))
            else:
                yield self.row(key, r.start, r.counts, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.load()
        start = expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.period_us
        clock = timerValues.getCurrentWatermarkInMs() * 1000
        self.next.clear()
        while start is not None and start + self.period_us <= clock:
            held = self.came.containsKey((start,))
            yield self.row(key, start, self.came.getValue((start,))[0] if held else None, True)
            if held:
                self.came.removeKey((start,))
            start = self.due(start + self.period_us)
        self.wait(start, None)

    def close(self) -> None:
        pass


def expected_periods(periods: DataFrame, register: DataFrame, keys: Sequence[str], counts: Sequence[str], period_s: int, expected: int) -> DataFrame:
    """Closed ``periods`` (keys, window_start, window_end, counts; a stream with a watermark) completed by the periods of registered keys that had no row.

    ``register`` is a stream of (keys, from_ts, to_ts), TIMESTAMP_NTZ, to_ts NULL for an open end; a key may have several spans. Every period that a span touches
    comes out when the watermark has passed its end, with ``expected`` and counts of 0 if nothing came. Periods of keys or times outside
    the register come out too, with ``registered`` false and nothing expected. A register entry counts from the batch it lands in.
    """
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    none = F.lit(None).cast("bigint")
    came = periods.select(*keys, "window_end", F.unix_micros("window_start").alias("start"), none.alias("begin"), none.alias("until"), F.array(*[F.col(c).cast("bigint") for c in counts]).alias("counts"))
    # Entries are never late, and as the register has no watermark of its own it does not hold the clock back.
    spans = register.withColumn("window_end", F.lit("9000-01-01 00:00:00").cast("timestamp"))
    spans = spans.select(*keys, "window_end", none.alias("start"), us("from_ts").alias("begin"), F.coalesce(us("to_ts"), F.lit(FOREVER)).alias("until"), F.lit(None).cast("array<bigint>").alias("counts"))
    types = {f.name: f.dataType.simpleString() for f in periods.schema}
    output = ", ".join(f"{k} {types[k]}" for k in keys) + ", start_us bigint, registered boolean, " + ", ".join(f"{c} bigint" for c in counts)
    rows = with_state(came.unionByName(spans), keys, ExpectedPeriods(keys, counts, period_s * 1_000_000), output, "EventTime")
    start = F.timestamp_micros("start_us")
    return rows.select(
        *keys, start.alias("window_start"), F.timestamp_micros(F.col("start_us") + period_s * 1_000_000).alias("window_end"), "registered",
        F.when(F.col("registered"), F.lit(expected)).otherwise(0).cast("bigint").alias("expected"), *counts,
    )
