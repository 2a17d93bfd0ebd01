"""Column expressions shared by the operators. All are built-in Spark columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the stored result tables.
FIRST_HALF = "상반기"
SECOND_HALF = "하반기"
WHOLE = "전체"

# The model columns of the stored monthly table, in their order.
MODELS = ["전월지속성", "전년동월", "계절평균", "선형회귀", "Ridge", "LightGBM", "GBHuber"]
VERDICT_BASELINES = ["전월지속성", "전년동월", "계절평균", "선형회귀", "Ridge"]

# Reporting order of the plants.
SITE_ORDER = ["gwangju", "buan", "gimje", "yeonggwang"]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_label(month: str | Column) -> Column:
    """First half of the year up to June, second half after it."""
    return F.when(F.month(col(month)) <= 6, F.lit(FIRST_HALF)).otherwise(F.lit(SECOND_HALF))


def season(ts: str | Column) -> Column:
    """Meteorological season of the target month."""
    m = F.month(col(ts))
    return (
        F.when(m.between(3, 5), "spring")
        .when(m.between(6, 8), "summer")
        .when(m.between(9, 11), "autumn")
        .otherwise("winter")
    )


def month_index(month: str | Column) -> Column:
    """Months since year 0, so that shifts and frames are by calendar month and not by row."""
    c = col(month)
    return F.year(c) * 12 + F.month(c) - 1


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds of a wall-clock time (session zone is UTC)."""
    return F.unix_seconds(col(ts).cast("timestamp"))


def epoch_micros(ts: str | Column) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def minutes_between(later: str | Column, earlier: str | Column) -> Column:
    """Exact difference in minutes as DOUBLE."""
    return (epoch_micros(later) - epoch_micros(earlier)) / F.lit(60_000_000.0)


def slot_start(ts: str | Column, minutes: int) -> Column:
    """Start of the ``minutes``-wide slot holding ``ts``; keeps TIMESTAMP_NTZ."""
    width = minutes * 60
    s = epoch_seconds(ts)
    return F.timestamp_seconds(s - F.pmod(s, F.lit(width))).cast("timestamp_ntz")


def as_time(at: str | Column) -> Column:
    """A wall-clock time from its text; a column stays as it is."""
    return F.lit(at).cast("timestamp_ntz") if isinstance(at, str) else at


def shift_seconds(ts: str | Column, seconds: int | Column) -> Column:
    """``ts`` moved by a number of seconds; keeps the sub-second part and TIMESTAMP_NTZ."""
    step = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_micros(epoch_micros(ts) + step.cast("bigint") * 1_000_000).cast("timestamp_ntz")


def as_ntz(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def error(actual: str | Column, pred: str | Column) -> Column:
    """Prediction minus actual: positive means over-forecast."""
    return col(pred) - col(actual)


def in_range(value: str | Column, lo: float | Column, hi: float | Column) -> Column:
    return col(value).between(lo, hi)


def clip(value: str | Column, cap: str | float | Column) -> Column:
    """Physical limits [0, cap]; NULL stays NULL."""
    c = F.lit(cap) if isinstance(cap, (int, float)) else col(cap)
    v = col(value)
    return F.when(v.isNotNull(), F.greatest(F.lit(0.0), F.least(v, c)))


def parsed_value(raw: str | Column) -> Column:
    """Number in a text column; an error text gives NULL, and so does the text ``NaN``."""
    v = col(raw).try_cast("double")
    return F.when(~F.isnan(v), v)


def parse_status(raw: str | Column) -> Column:
    """``ok``, ``comm_error`` (text that is not a number) or ``source_null``; zero is ``ok``."""
    return (
        F.when(col(raw).isNull(), "source_null")
        .when(parsed_value(raw).isNull(), "comm_error")
        .otherwise("ok")
    )


def solar_elevation(ts: str | Column, lat: float | Column, lon: float | Column, meridian: float = 135.0) -> Column:
    """Solar elevation in degrees from clock time, by declination and hour angle.

    ``meridian`` is the longitude of the clock's time zone (135 for Korean time).
    """
    lat_c = F.lit(lat) if isinstance(lat, (int, float)) else lat
    lon_c = F.lit(lon) if isinstance(lon, (int, float)) else lon
    t = col(ts)
    clock = F.hour(t) + F.minute(t) / F.lit(60.0)
    declination = F.radians(F.lit(23.45)) * F.sin(F.lit(2 * math.pi / 365) * (F.dayofyear(t) + 284))
    hour_angle = F.radians((clock + (lon_c - F.lit(meridian)) / F.lit(15.0) - 12.0) * 15.0)
    phi = F.radians(lat_c)
    height = F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.cos(hour_angle)
    return F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), height))))


def calendar_features(ts: str | Column) -> dict[str, Column]:
    """Hour, day of year, month and their cyclic forms."""
    t = col(ts)
    day_angle = F.lit(2 * math.pi / 24) * F.hour(t)
    year_angle = F.lit(2 * math.pi / 365) * F.dayofyear(t)
    return {
        "hour": F.hour(t).cast("bigint"),
        "day_of_year": F.dayofyear(t).cast("bigint"),
        "month_no": F.month(t).cast("bigint"),
        "hour_sin": F.sin(day_angle),
        "hour_cos": F.cos(day_angle),
        "doy_sin": F.sin(year_angle),
        "doy_cos": F.cos(year_angle),
    }


def hash_uniform(*parts: str | Column) -> Column:
    """A number in [0, 1) that depends only on the values: repeatable sampling on any cluster."""
    text = F.concat_ws("|", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_order(*parts: str | Column) -> Column:
    """Text whose order is a repeatable shuffle."""
    return F.md5(F.concat_ws("|", *[col(p).cast("string") for p in parts]))
