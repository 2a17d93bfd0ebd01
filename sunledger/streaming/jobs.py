"""Structured Streaming jobs. Each has a batch twin among the registered queries.

Time columns of the tables are wall clock (NTZ); watermarks need TIMESTAMP, so jobs cast on entry and cast
back on exit. Checkpoints and output tables lie in the shared folder, so a lost executor or a restarted
driver goes on from the last committed batch.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, TimestampType

from sunledger.session import shared_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS_KEY = "spark.sql.shuffle.partitions"


def landing_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files landing at a path or pattern, as a stream.

    By default a backlog is one batch, so rows of a file that is out of time order are never late. Bound the
    batches by ``files_per_trigger`` for a long backlog, and let ``run_bounded`` keep what comes behind the watermark.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run_to_table(
    stream: DataFrame, name: str, partition_by: Sequence[str] = (), location: str | None = None, stateful: bool = False,
    state_partitions: int | None = None,
) -> DataFrame:
    """Process what has landed, write it exactly once to a table in the shared folder and read it back.

    Give the same ``location`` again to go on where the last run ended; without it each run is its own.
    State is split in ``state_partitions`` for the life of a location (default: the session's shuffle
    partitions; on one machine no more than twice its cores).
    """
    spark = stream.sparkSession
    base = location or shared_dir(spark, f"stream-{name}")
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{base}/table")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .queryName(f"{name}-{base.rsplit('-', 1)[-1]}")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    context = spark.sparkContext
    if state_partitions is None and context.master.startswith("local"):
        state_partitions = min(int(spark.conf.get(PARTITIONS_KEY)), 2 * context.defaultParallelism)
    # Both settings are read when the query starts. Custom state needs RocksDB.
    wanted = {PROVIDER_KEY: ROCKSDB} if stateful else {}
    if state_partitions is not None:
        wanted[PARTITIONS_KEY] = str(state_partitions)
    old = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        query = writer.start()
        query.awaitTermination()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


SPLIT = [StructField("late", BooleanType()), StructField("batch", LongType())]


def run_bounded(
    stream: DataFrame, ts: str, delay: str, make: Callable[[DataFrame], DataFrame], name: str, location: str, deadline: Column | None = None, **how
) -> tuple[DataFrame, DataFrame]:
    """Run a job over a backlog in bounded batches without losing a row: (the table of the job, all rows with ``late`` and ``batch``).

    A stateful operator drops rows behind the watermark without a word. Here each batch of ``stream`` is stored once, each row marked ``late`` if its
    ``deadline`` (default ``ts``; for a windowed job the end of its window) is not after the mark of the batch, which is the greatest ``ts`` of all
    earlier batches less ``delay``. Then the job ``make(rows on time)`` goes on over what was stored; its watermark is never ahead of the mark, so it drops
    none. The late rows are a table of their own, to be counted or merged. ``how`` goes to ``run_to_table``.

    Give the same ``location`` again to go on. A batch that runs again finds what it has stored. Rows without ``ts`` are on time and set no mark.
    """
    spark, schema = stream.sparkSession, stream.schema
    stored = StructType([*schema.fields, *SPLIT])
    marks = StructType([SPLIT[1], StructField("greatest", TimestampType())])
    limit = F.col(ts) if deadline is None else deadline
    # Folders exist from the start, so that readers find them.
    spark.createDataFrame([], stored).write.mode("ignore").parquet(f"{location}/rows/none")
    spark.createDataFrame([], marks).write.mode("ignore").parquet(f"{location}/marks/none")

    def go_on() -> DataFrame:
        rows = spark.readStream.schema(stored).parquet(f"{location}/rows/*").where(~F.col("late")).drop(*[f.name for f in SPLIT])
        return run_to_table(make(rows.withWatermark(ts, delay)), name, location=f"{location}/job", **how)

    def store(rows: DataFrame, batch: int) -> None:
        here = rows.sparkSession
        known = here.read.schema(marks).parquet(f"{location}/marks/*")  # one row a batch
        seen, done = known.agg(F.max(F.when(F.col("batch") < batch, F.col("greatest"))), F.count_if(F.col("batch") == batch)).first()
        if not done:
            late = F.coalesce(limit <= F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}"), F.lit(False))
            number = F.lit(batch).cast("bigint").alias("batch")
            rows.select("*", late.alias("late"), number).write.mode("overwrite").parquet(f"{location}/rows/{batch}")
            greatest = here.read.schema(stored).parquet(f"{location}/rows/{batch}").agg(number, F.max(ts).alias("greatest"))
            greatest.write.mode("overwrite").parquet(f"{location}/marks/{batch}")  # from here on the batch is stored
        go_on()

    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{location}/split").trigger(availableNow=True).start()
    query.awaitTermination()
    return go_on(), spark.read.schema(stored).parquet(f"{location}/rows/*")


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def tumbling(stream: DataFrame, ts: str, width: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Tumbling aggregate; a window appears once the watermark has passed its end."""
    out = stream.groupBy(F.window(ts, width).alias("_w"), *keys).agg(*aggs)
    names = [c for c in out.columns if c not in ("_w", *keys)]
    return out.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *names)


def reliability_gate(
    runs: DataFrame, ts: str, keys: Sequence[str], success: str, slot: str, period: str, operating: Column, expected: int
) -> DataFrame:
    """Expected, executed and generated slots per period, by two chained window aggregates.

    Several runs in a slot count once. ``operating`` is a condition on ``slot_start``; slots outside it are a normal
    wait. A slot without a successful run stays not generated.
    """
    slots = runs.groupBy(F.window(ts, slot).alias("_s"), *keys).agg(F.max(F.col(success).cast("int")).alias("_made"))
    slots = slots.withColumns({"slot_start": F.col("_s.start")}).withColumn("_on", operating)
    out = slots.groupBy(F.window(F.col("_s"), period).alias("_w"), *keys).agg(
        F.count_if("_on").alias("executed"),
        F.count_if(F.col("_on") & (F.col("_made") == 1)).alias("generated"),
        F.count_if(~F.col("_on")).alias("night_waits"),
    )
    return out.select(
        *keys,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        F.lit(expected).cast("bigint").alias("expected"),
        "executed",
        "generated",
        "night_waits",
    )


def drop_repeats(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First request of each key; state is dropped after the watermark."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def split_late_receipts(stream: DataFrame, issues: DataFrame, keys: Sequence[str], observed: str, received: str) -> DataFrame:
    """Stream-static join with the issue each observation was meant for.

    A value received after its issue is ``late``: unusable there, usable from the next issue on, never
    back-dated. An observation without a planned issue stays, as ``no_issue``. Write the result partitioned by ``receipt_state`` to keep late rows apart.
    """
    hour = 3_600_000_000

    def next_issue(ts: str) -> Column:
        """The instant itself if it is a full hour, else the next full hour."""
        us = F.unix_micros(ts)
        return F.timestamp_micros(us + F.pmod(-us, F.lit(hour)))

    rows = stream.withColumns({"issue_ts": next_issue(observed), "usable_from": next_issue(received)})
    known = issues.select(*keys, F.col("issue_ts").cast("timestamp").alias("issue_ts"))
    known = known.withColumn("_known", F.lit(True))
    state = F.when(F.col("_known").isNull(), "no_issue").when(F.col(received) <= F.col("issue_ts"), "on_time").otherwise("late")
    return rows.join(known, [*keys, "issue_ts"], "left").withColumn("receipt_state", state).drop("_known")


def match_as_they_arrive(forecasts: DataFrame, actuals: DataFrame, key: str, target: str, hour: str) -> DataFrame:
    """Stream-stream left outer join; both sides carry watermarks, so unmatched forecasts come out in the end."""
    a = actuals.withColumnRenamed(key, "_key")
    cond = (F.col(key) == F.col("_key")) & (F.col(target) == F.col(hour))
    return forecasts.join(a, cond, "left_outer").drop("_key")


def outage_sessions(failures: DataFrame, ts: str, keys: Sequence[str], quiet: str) -> DataFrame:
    """Consecutive failures per feed, closed after a quiet period. A candidate outage, not a proven one."""
    out = failures.groupBy(F.session_window(ts, quiet).alias("_w"), *keys).agg(F.count("*").alias("failures"), F.max(ts).alias("last_failure"))
    return out.select(*keys, F.col("_w.start").alias("first_failure"), "last_failure", "failures")


class FeedFreshness(StatefulProcessor):
    """Last attempt and last valid value per feed, with a deadline timer in event time.

    The deadline counts from the last valid value, or from the first attempt of a feed that never had one.

    Input is one row per (feed, window), so the rows per feed and batch follow the windows, not the calls.
    """

    def __init__(self, keys: Sequence[str], deadline_min: int):
        self.keys, self.deadline_us = list(keys), deadline_min * 60_000_000

    def row(self, key, kind: str, window_us: int, attempt: int, valid: int | None, status: str) -> Row:
        return Row(
            kind=kind, **dict(zip(self.keys, key)), window_us=window_us, attempt_us=attempt, valid_us=valid, status=status
        )

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "first_attempt bigint, last_attempt bigint, last_valid bigint, deadline bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first, attempt, valid, old = self.state.get() if self.state.exists() else (None, None, None, None)
        for r in sorted(rows, key=lambda x: x.window_us):
            first = r.attempt_us if first is None else first
            attempt = max(x for x in (attempt, r.attempt_us) if x is not None)
            valid = max((x for x in (valid, r.valid_us) if x is not None), default=None)
            fresh = valid is not None and r.window_us - valid <= self.deadline_us
            yield self.row(key, "update", r.window_us, attempt, valid, "normal" if fresh else "late")
        deadline = ((first if valid is None else valid) + self.deadline_us) // 1000
        if deadline != old:
            # A timer that is already due fires in this batch; an unchanged one fires only once.
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(deadline)
        self.state.update((first, attempt, valid, deadline))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _, attempt, valid, _ = self.state.get()
        yield self.row(key, "deadline", expiredTimerInfo.getExpiryTimeInMs() * 1000, attempt, valid, "late")

    def close(self) -> None:
        pass


class StuckValue(StatefulProcessor):
    """Length of the current run of equal slot values per unit; a missing slot ends the run."""

    def __init__(self, keys: Sequence[str], slot_us: int, min_run: int):
        self.keys, self.slot_us, self.min_run = list(keys), slot_us, min_run

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", "slot bigint, level bigint, length bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        slot, level, length = self.state.get() if self.state.exists() else (None, None, 0)
        for r in sorted(rows, key=lambda x: x.window_us):
            follows = slot is not None and r.window_us - slot == self.slot_us and r.level == level
            slot, level, length = r.window_us, r.level, length + 1 if follows else 1
            if length >= self.min_run:
                yield Row(**dict(zip(self.keys, key)), window_us=slot, level=level, run_length=length)
        self.state.update((slot, level, length))

    def close(self) -> None:
        pass


def with_state(windows: DataFrame, keys: Sequence[str], processor: StatefulProcessor, output: str, mode: str) -> DataFrame:
    """Apply a stateful processor per key on pre-aggregated windows."""
    cloudpickle.register_pickle_by_value(sys.modules[type(processor).__module__])  # workers need not have this package
    return windows.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode=mode
    )
