"""Ordered scans over long series that no single task has to hold.

A plain window over (unit, order) puts a whole unit in one task. Here the series is cut into time
buckets: a window works inside (unit, bucket), a partial aggregate makes one row per (unit, bucket),
a small window carries state over those rows, and a join brings the carry back. The result is exact.
The carry window holds as many rows per unit as there are buckets in the span, whatever the row count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.columns import epoch_seconds

# Bucket widths. Slot grids hold at most 288 five-minute slots per unit and day. Raw logs are cut by the
# minute: folded to one row per instant, a (key, minute) holds at most 60 million microseconds.
DAY = 86_400
MINUTE = 60
SALTS = 8


def time_bucket(ts: str | Column, seconds: int = DAY) -> Column:
    """Number of the ``seconds``-wide bucket; monotone in ``ts``."""
    return F.floor(epoch_seconds(ts) / F.lit(seconds)).cast("bigint")


def scan(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    before: Mapping[str, Column] | None = None,
    after: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Add ordered-scan columns per ``keys`` in the order of ``order`` (which must be total).

    ``before``: last non-NULL value of the expression in earlier rows; ``after``: first non-NULL in
    later rows; ``totals``: running sum up to and with the row. ``inclusive`` lets the row itself
    count for ``before`` and ``after``. ``bucket`` must be monotone in the order.
    """
    before, after, totals = dict(before or {}), dict(after or {}), dict(totals or {})
    cols = df.columns
    part = [*keys, "_bucket"]
    work = df.withColumn("_bucket", bucket)
    for name, expr in {**before, **after, **totals}.items():
        work = work.withColumn(f"_in_{name}", expr)

    rank = F.struct(*[F.col(c) for c in order])

    def at(name: str) -> Column:
        return F.when(F.col(f"_in_{name}").isNotNull(), rank)

    edge = (
        [F.max_by(F.col(f"_in_{n}"), at(n)).alias(f"_edge_{n}") for n in before]
        + [F.min_by(F.col(f"_in_{n}"), at(n)).alias(f"_edge_{n}") for n in after]
        + [F.sum(F.col(f"_in_{n}")).alias(f"_edge_{n}") for n in totals]
    )
    buckets = work.groupBy(*part).agg(*edge)
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Frames that end at the last row are recomputed for every row, so looking ahead is looking back in
    # descending order.
    later = Window.partitionBy(*keys).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    carry = buckets.select(
        *part,
        *[F.last(F.col(f"_edge_{n}"), ignorenulls=True).over(earlier).alias(f"_carry_{n}") for n in before],
        *[F.last(F.col(f"_edge_{n}"), ignorenulls=True).over(later).alias(f"_carry_{n}") for n in after],
        *[F.sum(F.col(f"_edge_{n}")).over(earlier).alias(f"_carry_{n}") for n in totals],
    )

    here = 0 if inclusive else 1
    inside = Window.partitionBy(*part).orderBy(*order)
    back = inside.rowsBetween(Window.unboundedPreceding, -here)
    ahead = Window.partitionBy(*part).orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -here)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # Stated outright: an input already spread by a part of the keys would otherwise keep a unit in one task.
    local = work.repartition(*part).select(
        *cols,
        "_bucket",
        *[F.last(F.col(f"_in_{n}"), ignorenulls=True).over(back).alias(f"_loc_{n}") for n in before],
        *[F.last(F.col(f"_in_{n}"), ignorenulls=True).over(ahead).alias(f"_loc_{n}") for n in after],
        *[F.sum(F.col(f"_in_{n}")).over(upto).alias(f"_loc_{n}") for n in totals],
    )
    joined = local.join(carry, part, "left")
    return joined.select(
        *cols,
        *[F.coalesce(F.col(f"_loc_{n}"), F.col(f"_carry_{n}")).alias(n) for n in [*before, *after]],
        *[
            (F.coalesce(F.col(f"_loc_{n}"), F.lit(0)) + F.coalesce(F.col(f"_carry_{n}"), F.lit(0))).alias(n)
            for n in totals
        ],
    )


def with_halo(df: DataFrame, ts: str, bucket_s: int, back_s: int = 0, ahead_s: int = 0) -> DataFrame:
    """Copy rows near a bucket edge into the neighbour bucket, so fixed-width frames stay in one bucket.

    Adds ``_bucket`` and ``_own``; frames may look ``back_s`` seconds back and ``ahead_s`` ahead, both at
    most one bucket. Window over (keys, ``_bucket``), then keep the rows with ``_own``.
    """
    if max(back_s, ahead_s) > bucket_s:
        raise ValueError("the frame is wider than a bucket")
    s = epoch_seconds(ts)
    own = F.floor(s / F.lit(bucket_s)).cast("bigint")
    reach = F.array_distinct(
        F.array(
            own,
            F.floor((s + back_s) / F.lit(bucket_s)).cast("bigint"),
            F.floor((s - ahead_s) / F.lit(bucket_s)).cast("bigint"),
        )
    )
    copied = df.withColumn("_home", own).withColumn("_bucket", F.explode(reach))
    return copied.withColumn("_own", F.col("_home") == F.col("_bucket")).drop("_home")


def edge_index(edges: Column, value: Column, splits: int) -> Column:
    """Number of cut points below ``value``, by binary search.

    ``edges`` is a sorted array of ``splits`` - 1 cut points and ``splits`` a power of two.
    """
    steps = F.array(*[F.lit(splits >> i) for i in range(1, splits.bit_length())])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.element_at(edges, at + step) < value, step).otherwise(0)
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], splits: int = 64
) -> DataFrame:
    """Exact, linearly interpolated quantiles per key without holding a key in one task.

    Equal values are folded before the shuffle, a mergeable sketch proposes cut points, counts per cut
    interval locate the wanted ranks, and only those intervals are ordered.
    """
    keys = list(keys)
    folded = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    levels = [i / splits for i in range(1, splits)]
    edges = folded.groupBy(*keys).agg(
        F.percentile_approx("_v", levels, 10_000).alias("_edges"), F.sum("_c").alias("_n")
    )
    # The cut points are copied once per salt, so a hot key's values meet them in several tasks.
    salted = edges.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    binned = folded.withColumn("_salt", F.pmod(F.hash("_v"), F.lit(SALTS))).join(salted, [*keys, "_salt"]).select(
        *keys, "_v", "_c", "_n", edge_index(F.col("_edges"), F.col("_v"), splits).alias("_bin")
    )
    counts = binned.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_bc"), F.first("_n").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    offsets = counts.withColumn("_end", F.sum("_bc").over(upto)).withColumn("_start", F.col("_end") - F.col("_bc"))

    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("q"), F.lit(float(p)).alias("p"))
            for name, p in probs.items()
        ]
    )
    # One row per (key, bin, wanted quantile) whose lower or upper rank falls in the bin.
    spots = (
        offsets.withColumn("_w", F.explode(wanted))
        .withColumn("_pos", F.col("_w.p") * (F.col("_n") - 1))
        .withColumn("_lo", F.floor("_pos"))
        .withColumn("_hi", F.ceil("_pos"))
        .where(
            F.col("_lo").between(F.col("_start"), F.col("_end") - 1)
            | F.col("_hi").between(F.col("_start"), F.col("_end") - 1)
        )
        .groupBy(*keys, "_bin", "_start")
        .agg(F.collect_list(F.struct(F.col("_w.q").alias("q"), "_pos", "_lo", "_hi")).alias("_asks"))
    )
    ordered = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        binned.join(spots, [*keys, "_bin"])
        .repartition(*keys, "_bin")
        .withColumn("_last", F.col("_start") + F.sum("_c").over(ordered) - 1)
        .withColumn("_first", F.col("_last") - F.col("_c") + 1)
        .withColumn("_ask", F.explode("_asks"))
    )

    def pick(name: str) -> Column:
        mine = F.col("_ask.q") == name
        lo = F.max(F.when(mine & F.col("_ask._lo").between(F.col("_first"), F.col("_last")), F.col("_v")))
        hi = F.max(F.when(mine & F.col("_ask._hi").between(F.col("_first"), F.col("_last")), F.col("_v")))
        part = F.max(F.when(mine, F.col("_ask._pos") - F.col("_ask._lo")))
        return (lo + (hi - lo) * part).alias(name)

    return ranked.groupBy(*keys).agg(*[pick(name) for name in probs])
