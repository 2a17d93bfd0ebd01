"""Registers with effective dates: what is due at a time, and which facts the register does not know.

An entry holds from ``begin`` up to, not including, ``end``; a NULL end is open. A key may have several entries, also
overlapping ones. Nothing here depends on what arrived, so a silent key is due all the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.columns import as_ntz, as_time, epoch_seconds
from sunledger.operators.scans import DAY, time_bucket

INSIDE, OUTSIDE_DATES, UNKNOWN = "inside", "outside_dates", "unknown"


def due_slots(
    register: DataFrame, keys: Sequence[str], ts: str, first: str | Column, end: str | Column, minutes: int, begin: str = "from_ts", until: str = "to_ts"
) -> DataFrame:
    """Each slot of [``first``, ``end``) in which a key has an entry, once; a slot counts if an entry holds at its start.

    Slots lie on multiples of ``minutes``. Days are spread before their slots are made, so a long period is not one huge array.
    """
    width = minutes * 60
    start = F.greatest(epoch_seconds(begin), epoch_seconds(as_time(first)))
    stop = F.least(F.coalesce(epoch_seconds(until), epoch_seconds(as_time(end))), epoch_seconds(as_time(end)))
    a, b = F.ceil(start / width) * width, F.ceil(stop / width) * width - width  # first and last slot that start inside
    spans = register.select(*keys, a.cast("bigint").alias("_a"), b.cast("bigint").alias("_b")).where("_a <= _b")
    spread = spans.withColumn("_d", F.explode(F.sequence(F.floor(F.col("_a") / DAY), F.floor(F.col("_b") / DAY))))
    days = spread.repartition(*keys, "_d")  # by (key, day), so that the distinct below needs no second exchange of slots
    slots = F.sequence(
        F.greatest("_a", F.ceil(F.col("_d") * DAY / width).cast("bigint") * width), F.least("_b", F.floor(((F.col("_d") + 1) * DAY - 1) / width).cast("bigint") * width), F.lit(width).cast("bigint")
    )
    return days.select(*keys, "_d", F.explode(slots).alias("_s")).distinct().select(*keys, as_ntz(F.col("_s")).alias(ts))


def register_state(
    facts: DataFrame, register: DataFrame, keys: Sequence[str], ts: str, end: str | Column, begin: str = "from_ts", until: str = "to_ts", name: str = "register_state"
) -> DataFrame:
    """``facts`` with one more column: ``inside`` an entry of its key, ``outside_dates`` of all of them, or a key that is ``unknown``.

    An interval join by (key, week): entries meet facts only in the weeks they touch, as one array a week, so no fact is
    doubled and a busy key is spread over its weeks. Open entries are laid out up to ``end``; later facts are outside. A fact without a time
    or without a key is outside its dates or unknown.
    """
    keys = list(keys)
    last = epoch_seconds(as_time(end))
    entries = register.select(*keys, epoch_seconds(begin).alias("_a"), F.least(F.coalesce(epoch_seconds(until), last), last).alias("_z")).where("_a < _z")
    week = 7 * DAY
    weeks = entries.withColumn("_week", F.explode(F.sequence(F.floor(F.col("_a") / week), F.floor((F.col("_z") - 1) / week))))
    per_week = weeks.groupBy(*keys, "_week").agg(F.collect_set(F.struct("_a", "_z")).alias("_spans"))
    names = register.select(*keys).distinct().withColumn("_known", F.lit(True))
    at = epoch_seconds(ts)
    held = F.exists("_spans", lambda s: (at >= s["_a"]) & (at < s["_z"]))
    state = F.when(F.coalesce(held, F.lit(False)), INSIDE).when(F.col("_known"), OUTSIDE_DATES).otherwise(UNKNOWN)
    rows = facts.withColumn("_week", time_bucket(ts, week)).join(per_week, [*keys, "_week"], "left").join(names, keys, "left")
    return rows.select(*[F.col(c) for c in facts.columns], state.alias(name))


def register_counts(facts: DataFrame, register: DataFrame, keys: Sequence[str], ts: str, end: str | Column, **columns: str) -> DataFrame:
    """Rows per key by their state; a registered key without any fact has zeros. Facts fold to (key, second) counts before they meet the register."""
    folded = facts.groupBy(*keys, as_ntz(epoch_seconds(ts)).alias(ts)).agg(F.count("*").alias("_n"))
    marked = register_state(folded, register, keys, ts, end, name="_state", **columns)
    states = {f"n_{s}": s for s in (INSIDE, OUTSIDE_DATES, UNKNOWN)}
    counts = marked.groupBy(*keys).agg(F.sum("_n").alias("n_rows"), *[F.sum(F.when(F.col("_state") == s, F.col("_n")).otherwise(0)).alias(n) for n, s in states.items()])
    out = register.select(*keys).distinct().join(counts, list(keys), "full_outer")
    return out.fillna(0, ["n_rows", *states])
