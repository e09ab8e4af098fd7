"""Buckets and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (inclusive, seconds) and labels.
DURATION_BOUNDS = (15, 60, 180)
DURATION_KEYS = ("short_15s", "medium_60s", "long_3m", "extended")
DURATION_LABELS = ("Short (<=15s)", "Medium (<=60s)", "Long (<=3m)", "Extended (>3m)")
# Upper bounds (exclusive, followers) and labels.
TIER_BOUNDS = (10_000, 100_000, 1_000_000, 10_000_000)
TIER_LABELS = (
    "Nano (<10K)", "Micro (10K-100K)", "Mid (100K-1M)", "Macro (1M-10M)", "Mega (>10M)",
)
# Lower bounds (inclusive, percent positive) and labels.
SENTIMENT_BOUNDS = (70, 50, 30)
SENTIMENT_LABELS = (
    "Highly Positive (>=70%)", "Mostly Positive (50-69%)", "Mixed (30-49%)",
    "Mostly Negative (<30%)",
)


def _ladder(tests: list[Column], labels) -> Column:
    """First label whose test holds, else the last; an unknown value falls through to it."""
    out = F.when(tests[0], labels[0])
    for test, label in zip(tests[1:], labels[1:]):
        out = out.when(test, label)
    return out.otherwise(labels[-1])


def duration_bucket(seconds: Column, report: bool = False) -> Column:
    labels = DURATION_LABELS if report else DURATION_KEYS
    return _ladder([seconds <= b for b in DURATION_BOUNDS], labels)


def influencer_tier(followers: Column, numbered: bool = False) -> Column:
    labels = [f"{i}. {t}" for i, t in enumerate(TIER_LABELS, 1)] if numbered else TIER_LABELS
    return _ladder([followers < b for b in TIER_BOUNDS], labels)


def sentiment_bucket(positive_pct: Column) -> Column:
    return _ladder([positive_pct >= b for b in SENTIMENT_BOUNDS], SENTIMENT_LABELS)


def period(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year.cast("int"), month.cast("int"))


def music_kind(is_original: Column) -> Column:
    return F.when(is_original, "Original").otherwise("Non-Original")


def day_kind(is_weekend: Column) -> Column:
    return F.when(is_weekend, "Weekend").otherwise("Weekday")


def holiday_kind(is_holiday: Column) -> Column:
    return F.when(is_holiday, "Holiday").otherwise("Regular Day")
