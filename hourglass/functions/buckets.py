"""Epoch time buckets. All maths is integer division truncating toward zero,
counted from the epoch (a "month" is 28 days, not a calendar month)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the bucket maths.
HOUR_SECS = 3600
HOURS_PER_DAY = 24
DAYS_PER_WEEK = 7
DAYS_PER_MONTH = 28


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a: Column | str, b: int) -> Column:
    """Integral division truncating toward zero (SQL ``a div b``), BIGINT."""
    return F.call_function("div", _col(a), F.lit(b))


def hour_bucket(secs: Column | str) -> Column:
    """Hours since the epoch of an epoch-seconds column."""
    return idiv(secs, HOUR_SECS)


def day_bucket(hour: Column | str) -> Column:
    return idiv(hour, HOURS_PER_DAY)


def week_bucket(hour: Column | str) -> Column:
    return idiv(day_bucket(hour), DAYS_PER_WEEK)


def month_bucket(hour: Column | str) -> Column:
    return idiv(day_bucket(hour), DAYS_PER_MONTH)


def granularity_buckets(hour: Column | str) -> Column:
    """Array of (granularity, bucket) structs for one hour bucket: h, d, w, m.

    ``explode`` of this column is the 1 -> 4 row fan-out of the rollup; it stays
    inside whole-stage codegen (Generate).
    """
    h = _col(hour).cast("bigint")
    return F.array(
        F.struct(F.lit("h").alias("granularity"), h.alias("bucket")),
        F.struct(F.lit("d").alias("granularity"), day_bucket(h).alias("bucket")),
        F.struct(F.lit("w").alias("granularity"), week_bucket(h).alias("bucket")),
        F.struct(F.lit("m").alias("granularity"), month_bucket(h).alias("bucket")),
    )


HOURS_PER_PERIOD = HOURS_PER_DAY * DAYS_PER_MONTH   # 672
WEEKS_PER_PERIOD = DAYS_PER_MONTH // DAYS_PER_WEEK   # 4


def view_period(gran: Column | str, bucket: Column | str) -> Column:
    """Storage period (28-day epoch month) a view row's bucket falls in.

    Used only as a partition column of the stored view: a refresh rewrites
    the periods its new facts touch, and a serving range prunes to the
    periods it spans.
    """
    g, b = _col(gran), _col(bucket)
    return (F.when(g == "h", idiv(b, HOURS_PER_PERIOD))
            .when(g == "d", idiv(b, DAYS_PER_MONTH))
            .when(g == "w", idiv(b, WEEKS_PER_PERIOD))
            .otherwise(b))


def epoch_secs(ts: Column | str) -> Column:
    """Whole epoch seconds of a timestamp (floor)."""
    return F.unix_timestamp(_col(ts))
