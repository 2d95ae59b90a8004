"""Date/time features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import col


def local_time(ts: str | Column, tz: str, source_tz: str = "UTC") -> Column:
    """Wall-clock time in ``tz`` for a zone-less timestamp recorded in ``source_tz``
    (independent of the session time zone; rule M17)."""
    return F.convert_timezone(F.lit(source_tz), F.lit(tz), col(ts).cast("timestamp_ntz"))


def time_features(df: DataFrame, ts: str, tz: str | None = None, source_tz: str = "UTC",
                  handover: Sequence[tuple[int, int]] = ((6, 7), (18, 19)),
                  night: tuple[int, int] = (19, 7)) -> DataFrame:
    """Hour, weekday (Monday = 0, rule M16), month, cyclic hour,
    handover-window flag (inclusive ranges) and night-shift flag."""
    lt = local_time(ts, tz, source_tz) if tz else col(ts)
    out = df.withColumn("_lt", lt)
    h = F.hour("_lt")
    hand = None
    for a, b in handover:
        c = h.between(a, b)
        hand = c if hand is None else (hand | c)
    return out.withColumns({
        "hour": h,
        "weekday": F.weekday("_lt"),
        "month": F.month("_lt"),
        "hour_sin": F.sin(F.lit(2 * math.pi) * h / F.lit(24)),
        "hour_cos": F.cos(F.lit(2 * math.pi) * h / F.lit(24)),
        "handover": hand.cast("int"),
        "night_shift": ((h >= night[0]) | (h < night[1])).cast("int"),
    }).drop("_lt")


def day_parts(df: DataFrame, ts: str) -> DataFrame:
    """Day name, day of month, hour, second-half-of-month and after-noon flags."""
    return df.withColumns({
        "day_name": F.date_format(col(ts), "EEEE"),
        "day_of_month": F.dayofmonth(col(ts)),
        "hour": F.hour(col(ts)),
        "second_half": (F.dayofmonth(col(ts)) > 15).cast("int"),
        "after_noon": (F.hour(col(ts)) >= 12).cast("int"),
    })


def month_bucket(ts: str | Column) -> Column:
    """First instant of the month."""
    return F.date_trunc("month", col(ts))


def time_split(ts: str | Column, d0: str, d1: str) -> Column:
    """Q10: ``train`` before ``d0``, ``val`` before ``d1``, else ``test``."""
    x = col(ts)
    return (F.when(x < F.to_timestamp(F.lit(d0)), F.lit("train"))
            .when(x < F.to_timestamp(F.lit(d1)), F.lit("val")).otherwise(F.lit("test")))
