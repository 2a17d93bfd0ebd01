"""Regular time grids, gaps, limited filling and segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunledger.functions.columns import as_ntz, as_time, col, epoch_seconds, hash_order, shift_seconds
from sunledger.operators.scans import DAY, scan, time_bucket, with_halo
from sunledger.session import small_table


def slot_calendar(df: DataFrame, keys: Sequence[str], ts: str, minutes: int) -> DataFrame:
    """All slots per key from the start of its first day to the end of its last day.

    Days are exploded and spread before slots, so a long span is neither one huge array nor one task.
    """
    width = minutes * 60
    day = F.floor(epoch_seconds(ts) / F.lit(DAY)).cast("bigint")
    spans = df.groupBy(*keys).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    days = spans.select(*keys, F.explode(F.sequence("_a", "_b")).alias("_day")).repartition(*keys, "_day")
    return days.select(
        *keys,
        F.explode(F.sequence(F.col("_day") * DAY, F.col("_day") * DAY + (DAY - width), F.lit(width).cast("bigint"))).alias("_s"),
    ).select(*keys, as_ntz(F.col("_s")).alias(ts))


def period_slots(register: DataFrame, ts: str, first: str | Column, last: str | Column, minutes: int) -> DataFrame:
    """All slots of a stated period for each row of a register, whatever arrived. ``first`` is a slot; ``last`` lies in the last one.

    Days are exploded and spread before slots, so a long period is not one huge array.
    """
    width = minutes * 60
    a, b = (epoch_seconds(as_time(x)) for x in (first, last))
    days = register.withColumn("_d", F.explode(F.sequence(a, b, F.lit(DAY).cast("bigint")))).repartition(*register.columns, "_d")
    slots = F.sequence("_d", F.least(F.col("_d") + (DAY - width), b), F.lit(width).cast("bigint"))
    return days.withColumn("_s", F.explode(slots)).select(*register.columns, as_ntz(F.col("_s")).alias(ts))


def reindex(df: DataFrame, keys: Sequence[str], ts: str, minutes: int) -> DataFrame:
    """Continuous grid with the facts where they exist and NULL where they do not; nothing becomes zero."""
    rest = [c for c in df.columns if c not in (*keys, ts)]
    grid = slot_calendar(df, keys, ts, minutes)
    return grid.join(df, [*keys, ts], "left").select(*keys, ts, *rest)


def missing_slots(df: DataFrame, keys: Sequence[str], ts: str, minutes: int) -> DataFrame:
    """Expected slots without a fact."""
    return slot_calendar(df, keys, ts, minutes).join(df, [*keys, ts], "left_anti")


def with_neighbours(
    grid: DataFrame, keys: Sequence[str], ts: str, value: str, minutes: int, received: str | None = None
) -> DataFrame:
    """Nearest observed slot on either side of each grid row, and the length of the gap a missing row is in.

    ``gap_slots`` is NULL for observed rows and for gaps without an observed value on both sides.
    """
    seen = F.col(value).isNotNull()
    item = [F.col(ts).alias("slot"), F.col(value).alias("v")]
    if received is not None:
        item.append(F.col(received).alias("received"))
    entry = F.when(seen, F.struct(*item))
    out = scan(grid, keys, time_bucket(ts, 7 * DAY), [ts], before={"_p": entry}, after={"_n": entry})
    both = F.col(value).isNull() & F.col("_p").isNotNull() & F.col("_n").isNotNull()
    length = (epoch_seconds("_n.slot") - epoch_seconds("_p.slot")) / F.lit(minutes * 60) - 1
    extra = [] if received is None else [F.col("_p.received").alias("prev_received"), F.col("_n.received").alias("next_received")]
    return out.select(
        *grid.columns,
        F.col("_p.slot").alias("prev_slot"),
        F.col("_p.v").alias("prev_kw"),
        F.col("_n.slot").alias("next_slot"),
        F.col("_n.v").alias("next_kw"),
        *extra,
        F.when(both, length.cast("bigint")).alias("gap_slots"),
    )


def fill(
    method: str, ts: str, value: str, max_slots: int, as_of: Column | None = None, received: str = "received_at"
) -> Column:
    """Value after filling gaps of at most ``max_slots`` slots; longer gaps stay wholly NULL.

    Works on the columns of ``with_neighbours``. With ``as_of`` nothing counts that had not been received by then: an
    observed value (by ``received``) stays NULL, and a fill needs each neighbour it uses.
    """
    pv, nv = F.col("prev_kw"), F.col("next_kw")
    past = epoch_seconds(ts) - epoch_seconds("prev_slot")
    whole = epoch_seconds("next_slot") - epoch_seconds("prev_slot")
    made = {
        "linear": pv + (nv - pv) * past / whole,
        "previous": pv,
        "neighbour_mean": (pv + nv) / 2,
        "nearest": F.when(past * 2 <= whole, pv).otherwise(nv),
    }[method]
    allowed = F.col("gap_slots") <= max_slots
    own = F.col(value)
    if as_of is not None:
        allowed = allowed & own.isNull() & (F.col("prev_received") <= as_of)
        if method != "previous":
            allowed = allowed & (F.col("next_received") <= as_of)
        own = F.when(F.col(received) <= as_of, own)
    return F.coalesce(own, F.when(allowed, made))


def fill_state(value: str, filled: str | Column) -> Column:
    """Quality state after filling."""
    return (
        F.when(F.col(value).isNotNull(), "observed")
        .when(col(filled).isNotNull(), "interpolated")
        .otherwise("comm_missing")
    )


@lru_cache(maxsize=64)
def spline_weights(length: int, knots: int) -> tuple[tuple[int, int, float], ...]:
    """Weights (position, knot offset, weight) of a natural cubic spline across one gap of ``length`` slots.

    The spline is linear in its knot values, so one small table serves every gap of that length. Offsets
    count slots from the first missing slot: -knots..-1 on the left, length..length+knots-1 on the right.
    """
    x = np.array([*range(-knots, 0), *range(length, length + knots)], dtype=float)
    n, h = len(x), np.diff(x)
    left, right = np.zeros((n, n)), np.zeros((n, n))
    left[0, 0] = left[-1, -1] = 1.0
    for i in range(1, n - 1):
        left[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        right[i, i - 1 : i + 2] = 6 / h[i - 1], -6 / h[i - 1] - 6 / h[i], 6 / h[i]
    curve = np.linalg.solve(left, right)
    j, step = knots - 1, length + 1.0
    rows = []
    for p in range(length):
        t = p + 1.0
        u = step - t
        w = curve[j] * (u**3 / (6 * step) - u * step / 6) + curve[j + 1] * (t**3 / (6 * step) - t * step / 6)
        w[j] += u / step
        w[j + 1] += t / step
        rows += [(p, int(x[i]), round(float(w[i]), 12)) for i in range(n)]
    return tuple(rows)


def spline_table(spark: SparkSession, lengths: Sequence[int], knots: int) -> DataFrame:
    rows = [(length, p, off, w) for length in lengths for p, off, w in spline_weights(length, knots)]
    return small_table(spark, rows, "gap_slots bigint, pos bigint, off bigint, w double")


def weights_hint(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast a weight table of proven size; beyond 100,000 rows Spark decides."""
    return F.broadcast(table) if rows <= 100_000 else table


def spline_fill(
    gaps: DataFrame, keys: Sequence[str], ts: str, value: str, minutes: int, max_slots: int, knots: int = 6
) -> DataFrame:
    """Natural-spline values for gaps of at most ``max_slots`` whose knots are all observed.

    Missing rows are matched to their knots by (keys, slot), so the work follows the number of gaps.
    Returns (keys, ts, gap_slots, spline_kw).
    """
    width = minutes * 60
    table = weights_hint(spline_table(gaps.sparkSession, range(1, max_slots + 1), knots), sum(range(1, max_slots + 1)) * 2 * knots)
    missing = gaps.where(F.col("gap_slots") <= max_slots).select(
        *keys,
        ts,
        "gap_slots",
        ((epoch_seconds(ts) - epoch_seconds("prev_slot")) / width - 1).cast("bigint").alias("pos"),
    )
    asks = missing.join(table, ["gap_slots", "pos"]).withColumn(
        "_knot", shift_seconds(ts, (F.col("off") - F.col("pos")) * width)
    )
    known = gaps.where(F.col(value).isNotNull()).select(*keys, F.col(ts).alias("_knot"), F.col(value).alias("_y"))
    return (
        asks.join(known, [*keys, "_knot"])
        .groupBy(*keys, ts, "gap_slots")
        .agg(F.count("*").alias("_k"), F.sum(F.col("w") * F.col("_y")).alias("spline_kw"))
        .where(F.col("_k") == 2 * knots)
        .drop("_k")
    )


def segments(df: DataFrame, keys: Sequence[str], ts: str, max_gap_s: int) -> DataFrame:
    """Add ``segment_start``: rows more than ``max_gap_s`` apart belong to different segments."""
    cols = df.columns
    prev = scan(df, keys, time_bucket(ts, 7 * DAY), [ts], before={"_prev": F.col(ts)})
    opens = F.col("_prev").isNull() | (epoch_seconds(ts) - epoch_seconds("_prev") > max_gap_s)
    out = scan(
        prev.withColumn("_open", F.when(opens, F.col(ts))),
        keys,
        time_bucket(ts, 7 * DAY),
        [ts],
        before={"segment_start": F.col("_open")},
        inclusive=True,
    )
    return out.select(*cols, "segment_start")


def segment_windows(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, lags_s: Mapping[str, int], rolling_s: Mapping[str, int]
) -> DataFrame:
    """Lags and rolling means by time distance that never look across a segment border.

    Frames are fixed in width, so buckets with a halo give the exact result without whole-unit partitions.
    """
    reach = max([*lags_s.values(), *rolling_s.values()])
    size = max(7 * DAY, reach)
    haloed = with_halo(df, ts, size, back_s=reach)
    base = Window.partitionBy(*keys, "segment_start", "_bucket").orderBy(epoch_seconds(ts))
    made = [F.max(value).over(base.rangeBetween(-s, -s)).alias(n) for n, s in lags_s.items()]
    made += [F.avg(value).over(base.rangeBetween(-s, 0)).alias(n) for n, s in rolling_s.items()]
    return haloed.select(*df.columns, "_own", *made).where("_own").drop("_own")


def horizon_targets(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, horizons_h: Sequence[int]
) -> DataFrame:
    """Value at t + h hours for each h, only inside the same segment, else NULL. Long form."""
    asks = df.withColumn("horizon_h", F.explode(F.array(*[F.lit(h).cast("bigint") for h in horizons_h]))).withColumn(
        "target_ts", shift_seconds(ts, F.col("horizon_h") * 3600)
    )
    later = df.select(
        *keys, "segment_start", F.col(ts).alias("target_ts"), F.col(value).alias("target")
    )
    return asks.join(later, [*keys, "segment_start", "target_ts"], "left")


def complete_runs(gaps: DataFrame, keys: Sequence[str], ts: str, value: str, lengths: Sequence[int], minutes: int, knots: int) -> DataFrame:
    """Starts of observed runs long enough to mask ``length`` slots and keep ``knots`` on each side."""
    width = minutes * 60
    hole = F.when(F.col(value).isNull(), F.col(ts))
    edges = scan(gaps, keys, time_bucket(ts, 7 * DAY), [ts], before={"_hole_b": hole}, after={"_hole_a": hole})
    first = F.min(epoch_seconds(ts)).alias("_first"), F.max(epoch_seconds(ts)).alias("_last")
    span = gaps.groupBy(*keys).agg(*first)
    s = epoch_seconds(ts)
    room = edges.where(F.col(value).isNotNull()).join(span, list(keys)).select(
        *keys,
        ts,
        # Observed slots before this one, and from this one on, without a hole.
        ((s - F.coalesce(epoch_seconds("_hole_b"), F.col("_first") - width)) / width - 1).alias("_left"),
        ((F.coalesce(epoch_seconds("_hole_a"), F.col("_last") + width) - s) / width).alias("_right"),
    )
    spots = room.withColumn("mask_slots", F.explode(F.array(*[F.lit(n).cast("bigint") for n in lengths])))
    return spots.where((F.col("_left") >= knots) & (F.col("_right") >= F.col("mask_slots") + knots)).select(
        *keys, F.col(ts).alias("mask_start"), "mask_slots"
    )


def sample_masks(runs: DataFrame, keys: Sequence[str], per_length: int, seed: int) -> DataFrame:
    """A repeatable sample of ``per_length`` masks for each length; the rank filter runs before the shuffle too."""
    pick = hash_order(F.lit(seed), *keys, epoch_seconds("mask_start"), "mask_slots")
    order = Window.partitionBy("mask_slots").orderBy("_h", *keys, "mask_start")
    return (
        runs.withColumn("_h", pick)
        .withColumn("case_no", F.row_number().over(order))
        .where(F.col("case_no") <= per_length)
        .withColumn("case_no", F.col("case_no").cast("bigint"))
        .drop("_h")
    )


def masked_reconstruction(
    masks: DataFrame, grid: DataFrame, keys: Sequence[str], ts: str, value: str, minutes: int, knots: int, lengths: Sequence[int]
) -> DataFrame:
    """Hide the sampled slots and rebuild them by five methods; ``lengths`` are those that ``masks`` were made with.

    Returns (keys, mask_start, mask_slots, case_no, pos, actual, linear, previous, neighbour_mean, nearest,
    spline, left_kw, right_kw). Values are fetched by (keys, slot).
    """
    width = minutes * 60
    offsets = F.sequence(F.lit(-knots).cast("bigint"), F.col("mask_slots") + (knots - 1))
    asks = masks.withColumn("off", F.explode(offsets)).withColumn(
        ts, shift_seconds("mask_start", F.col("off") * width)
    )
    known = grid.where(F.col(value).isNotNull()).select(*keys, ts, F.col(value).alias("_y"))
    found = asks.join(known, [*keys, ts])
    case = [*keys, "mask_start", "mask_slots", "case_no"]
    around = found.groupBy(*case).agg(
        F.max(F.when(F.col("off") == -1, F.col("_y"))).alias("left_kw"),
        F.max(F.when(F.col("off") == F.col("mask_slots"), F.col("_y"))).alias("right_kw"),
        F.map_from_entries(F.collect_list(F.struct("off", "_y"))).alias("_ys"),
    )
    # At most length + 2 * knots values per case, so the map is small.
    weights = spline_table(grid.sparkSession, sorted(set(lengths)), knots).withColumnRenamed("gap_slots", "mask_slots")
    per_pos = weights.groupBy("mask_slots", "pos").agg(
        F.sort_array(F.collect_list(F.struct("off", "w"))).alias("_ws")
    )
    rows = around.join(weights_hint(per_pos, sum(set(lengths))), "mask_slots")
    share = (F.col("pos") + 1) / (F.col("mask_slots") + 1)
    spline = F.aggregate(
        "_ws", F.lit(0.0), lambda acc, k: acc + k["w"] * F.element_at(F.col("_ys"), k["off"])
    )
    return rows.select(
        *case,
        "pos",
        F.element_at("_ys", F.col("pos")).alias("actual"),
        (F.col("left_kw") + (F.col("right_kw") - F.col("left_kw")) * share).alias("linear"),
        F.col("left_kw").alias("previous"),
        ((F.col("left_kw") + F.col("right_kw")) / 2).alias("neighbour_mean"),
        F.when((F.col("pos") + 1) * 2 <= F.col("mask_slots") + 1, F.col("left_kw"))
        .otherwise(F.col("right_kw"))
        .alias("nearest"),
        spline.alias("spline"),
        "left_kw",
        "right_kw",
    )
