"""Numeric columns: rates, exact averages, safe casts, date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
VIRAL_PLAYS = 1_000_000
SCD2_CHANGE = 0.05


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def as_bool(c: Column) -> Column:
    """0/1/NULL to boolean, NULL counting as false."""
    return F.coalesce(c.cast("boolean"), F.lit(False))


def engagement_rate(likes: Column, comments: Column, shares: Column, plays: Column) -> Column:
    """Interactions per play at 6 places; NULL when likes are unknown or plays are 0."""
    return F.round(F.try_divide(likes + comments + shares, plays), 6)


def is_viral(plays: Column, threshold: int = VIRAL_PLAYS) -> Column:
    return F.coalesce(plays >= threshold, F.lit(False))


def date_key(ts: Column) -> Column:
    """yyyymmdd as an integer; NULL stays NULL."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def exact_mean(total: Column, count: Column, digits: int, factor: int = 1) -> Column:
    """``round(total / count * factor, digits)``, half away from zero, without binary error.

    ``total`` must be an integer or decimal. The result is a double so that reports have one
    numeric type; NULL when nothing was counted.
    """
    # Adding a decimal 0 turns an integer into a decimal and leaves a decimal's scale alone.
    total = total + F.lit(0).cast("decimal(1,0)")
    q = F.try_divide(total, count.cast("decimal(20,0)"))
    return F.round(q if factor == 1 else q * F.lit(factor), digits).cast("double")


def relative_change_exceeds(new: Column, old: Column, threshold: float) -> Column:
    """|new - old| / old > threshold; false where there is no positive old value."""
    return F.coalesce(
        (old > 0) & (F.try_divide(F.abs(new - old), old) > F.lit(threshold)), F.lit(False)
    )
