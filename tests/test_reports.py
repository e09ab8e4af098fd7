"""Reports over a hand-made warehouse; results worked out by hand."""

import math
import random
from datetime import date
from decimal import Decimal

import pytest
from frames import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vidmart import schemas
from vidmart.operators import dimensions
from vidmart.plans import reports


def _table(spark, ddl, records):
    names = [f.name for f in schemas.struct(ddl).fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ddl)


def warehouse(spark, *videos, creators=(), music=()):
    base = {"play_count": 100, "like_count": 10, "engagement_rate": Decimal("0.1"),
            "is_viral": False, "hashtag_count": 2, "primary_category": "Music",
            "total_comments_scraped": 0, "date_id": 20260105, "video_duration_sec": 10,
            "post_hour": 7, "primary_brand_safe": 1, "post_year": 2026}
    facts = [{"video_sk": i, **base, **v} for i, v in enumerate(videos, 1)]
    people = [{"creator_nk": f"c{c['creator_sk']}", "is_current": True, "is_verified": False,
               "valid_from": date(2026, 1, 1), **c} for c in creators]
    holiday = spark.createDataFrame([(date(2026, 1, 6), "Epiphany")], schemas.HOLIDAY)
    return {
        "fact": _table(spark, schemas.FACT, facts),
        "dim_date": dimensions.date_table(spark, date(2025, 1, 1), date(2026, 12, 31), holiday),
        "dim_creator": _table(spark, schemas.DIM_CREATOR, people),
        "dim_music": _table(spark, schemas.DIM_MUSIC, music),
    }


def test_monthly(spark):
    t = warehouse(
        spark,
        {"play_count": 1}, {"play_count": 2, "engagement_rate": None, "is_viral": True},
        {"date_id": 20260201}, {"date_id": None}, {"date_id": 19990101},
    )
    assert [tuple(r) for r in reports.monthly_engagement(t).collect()] == [
        (2026, 1, "January", 2, 2.0, 10.0, 10.0, 1),
        (2026, 2, "February", 1, 100.0, 10.0, 10.0, 0),
    ]
    assert [tuple(r) for r in reports.monthly_series(t).collect()] == [
        ("2026-01", 10.0), ("2026-02", 10.0),
    ]


def test_rollup(spark):
    t = warehouse(spark, {}, {"date_id": 20260201}, {"date_id": 20250301})
    got = [tuple(r)[:5] for r in reports.engagement_rollup(t).collect()]
    assert (None, None, None, 7, 3) in got and (2026, None, None, 3, 2) in got
    assert (2026, 1, None, 1, 1) in got and (2026, 1, "January", 0, 1) in got
    weeks = [tuple(r)[:5] for r in reports.engagement_rollup_weekly(t).collect()]
    assert (2026, 1, 2, 0, 1) in weeks


def test_patterns(spark):
    t = warehouse(
        spark,
        {"is_viral": True, "video_duration_sec": 15, "hashtag_count": 1},
        {"is_viral": True, "video_duration_sec": 0, "hashtag_count": 2},
        {"is_viral": True, "video_duration_sec": 61, "play_count": 900},
        {"video_duration_sec": 181},
    )
    assert [tuple(r) for r in reports.viral_patterns(t).collect()] == [
        (True, "Music", "Monday", "Long (<=3m)", 1, 900.0, 10.0, 2.0),
        (True, "Music", "Monday", "Short (<=15s)", 2, 100.0, 10.0, 1.5),
        (False, "Music", "Monday", "Extended (>3m)", 1, 100.0, 10.0, 2.0),
    ]
    assert rows(reports.viral_by_duration(t)) == [("Long (<=3m)", 1), ("Short (<=15s)", 2)]


def test_ranking(spark):
    people = [{"creator_sk": i, "follower_count": 10 ** (i + 3)} for i in range(1, 5)]
    people.append({"creator_sk": 9, "creator_nk": "c1", "is_current": False})
    t = warehouse(
        spark,
        {"creator_sk": 1, "engagement_rate": Decimal("0.2")},
        {"creator_sk": 1, "engagement_rate": Decimal("0.1"), "play_count": 300, "is_viral": True},
        {"creator_sk": 2}, {"creator_sk": 3, "engagement_rate": None},
        {"creator_sk": 9, "engagement_rate": Decimal("0.9")}, {"creator_sk": None},
        creators=people,
    )
    got = [tuple(r) for r in reports.creator_ranking(t).collect()]
    assert [r[0] for r in got] == ["c3", "c1", "c2"]
    assert got[1][4:] == ("Micro (10K-100K)", 2, 200.0, 15.0, 1, 300)
    assert [r[0] for r in reports.creator_ranking(t, 1).collect()] == ["c3"]
    assert reports.creator_ranking_chart(t).columns == ["username", "avg_engagement_rate_pct"]


def test_tiers(spark):
    people = [
        {"creator_sk": 1, "follower_count": 5, "niche_category": "A"},
        {"creator_sk": 2, "follower_count": 6, "niche_category": "B"},
        {"creator_sk": 3, "follower_count": 10**7, "niche_category": "A"},
    ]
    t = warehouse(
        spark,
        {"creator_sk": 1, "positive_comment_pct": Decimal("33.33"), "is_viral": True},
        {"creator_sk": 1, "positive_comment_pct": Decimal("33.34")},
        {"creator_sk": 2}, {"creator_sk": 3},
        creators=people,
    )
    assert [tuple(r) for r in reports.tier_paradox(t).collect()] == [
        ("1. Nano (<10K)", 2, 3, 100.0, 10.0, 33.34, 1, 33.33),
        ("5. Mega (>10M)", 1, 1, 100.0, 10.0, None, 0, 0.0),
    ]
    niches = [tuple(r)[:3] for r in reports.tier_paradox_by_niche(t).collect()]
    assert niches == [("1. Nano (<10K)", "A", 1), ("1. Nano (<10K)", "B", 1),
                      ("5. Mega (>10M)", "A", 1)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 99_999_999), min_size=1, max_size=40))
def test_quartiles(spark, millionths):
    rates = sorted(Decimal(m).scaleb(-6) for m in millionths)
    t = warehouse(
        spark,
        *[{"creator_sk": 1, "engagement_rate": r} for r in rates],
        creators=[{"creator_sk": 1, "follower_count": 5}],
    )
    got = tuple(reports.tier_distribution(t).first())
    want = []
    for p in (Decimal("0.25"), Decimal("0.5"), Decimal("0.75")):
        at = p * (len(rates) - 1)
        lo, hi = rates[math.floor(at)], rates[math.ceil(at)]
        exact = lo + (at - int(at)) * (hi - lo)
        want.append(float(exact.quantize(Decimal("0.000001"), rounding="ROUND_HALF_UP")))
    assert got == ("1. Nano (<10K)", len(rates), float(rates[0]), *want, float(rates[-1]))


def test_categories(spark):
    t = warehouse(
        spark,
        {"primary_brand_safe": 0, "play_count": 50}, {},
        {"primary_category": "Comedy"},
        {"primary_category": "Comedy", "date_id": 20251231, "post_year": 2025},
    )
    got = [tuple(r)[:3] for r in reports.category_trend(t, 2026).collect()]
    assert got == [("Comedy", 1, 100.0), ("Music", 2, 75.0)]
    assert reports.category_trend(t).where("primary_category = 'Comedy'").first()[1] == 2
    safe = [tuple(r)[:3] for r in reports.category_trend_by_safety(t, 2026).collect()]
    assert safe == [("Comedy", True, 1), ("Music", True, 1), ("Music", False, 1)]
    assert rows(reports.category_share(t, 2026)) == [("Comedy", 1, 33.3), ("Music", 2, 66.7)]


def test_sentiment(spark):
    said = {"total_comments_scraped": 1}
    t = warehouse(
        spark,
        {**said, "positive_comment_pct": Decimal("70"), "avg_sentiment_score": Decimal("0.5"),
         "is_viral": True},
        {**said, "positive_comment_pct": Decimal("100"), "avg_sentiment_score": Decimal("0.6")},
        {**said, "positive_comment_pct": Decimal("0"), "engagement_rate": Decimal("0.2")},
        {"positive_comment_pct": Decimal("50")},
    )
    assert [tuple(r) for r in reports.sentiment_engagement(t).collect()] == [
        ("Mostly Negative (<30%)", 1, 100.0, 20.0, None, 0, 0.0),
        ("Highly Positive (>=70%)", 2, 100.0, 10.0, 0.55, 1, 50.0),
    ]
    assert rows(reports.sentiment_viral_heatmap(t)) == [
        ("Highly Positive (>=70%)", 1, 1), ("Mostly Negative (<30%)", 1, 0),
    ]


def test_posting_time(spark):
    t = warehouse(
        spark, {}, {"date_id": 20260106, "play_count": 300}, {"date_id": 20260110},
        {"post_hour": 23, "play_count": 50},
    )
    assert [tuple(r)[:5] for r in reports.weekday_pattern(t).collect()] == [
        ("Monday", 1, False, 2, 75.0), ("Tuesday", 2, False, 1, 300.0),
        ("Saturday", 6, True, 1, 100.0),
    ]
    assert [r.day_kind for r in reports.weekday_chart(t).collect()] == [
        "Weekday", "Weekday", "Weekend",
    ]
    assert tuple(reports.day_hour_pattern(t).first())[:6] == (
        "Tuesday", False, True, 7, 1, 300.0,
    )
    monday = reports.posting_heatmap(t).where("day_name = 'Monday'").first()
    assert (monday.h7, monday.h23, monday.h0) == (100.0, 50.0, None)
    assert rows(reports.holiday_comparison(t)) == [
        ("Holiday", 1, 300.0, 10.0), ("Regular Day", 3, 83.0, 10.0),
    ]


def test_music(spark):
    sounds = [
        {"music_sk": 1, "music_name": "b", "music_author": "x", "is_original": True},
        {"music_sk": 2, "music_name": "a", "music_author": "x", "is_original": False},
        {"music_sk": 3, "music_name": "a", "music_author": None, "is_original": False},
    ]
    t = warehouse(
        spark,
        {"music_sk": 1, "is_viral": True}, {"music_sk": 1, "is_viral": True},
        {"music_sk": 2, "is_viral": True}, {"music_sk": 3, "is_viral": True},
        {"music_sk": 3}, {"music_sk": None, "is_viral": True},
        music=sounds,
    )
    assert rows(reports.music_originality(t)) == [
        (False, 3, 100.0, 10.0, 2), (True, 2, 100.0, 10.0, 2),
    ]
    assert rows(reports.music_originality_chart(t).select("music_kind", "total_videos")) == [
        ("Non-Original", 3), ("Original", 2),
    ]
    assert [tuple(r) for r in reports.top_viral_music(t).collect()] == [
        ("b", "x", True, 2, 100.0), ("a", None, False, 1, 100.0), ("a", "x", False, 1, 100.0),
    ]
    assert [r.viral_videos for r in reports.top_viral_music_detail(t).collect()] == [2, 1, 1]


def test_all_reports(spark):
    t = warehouse(spark, {"creator_sk": 1, "music_sk": 1}, creators=[{"creator_sk": 1}],
                  music=[{"music_sk": 1, "is_original": True}])
    done = reports.run_all_reports(t, min_year=2027)
    assert len(done) == 9
    assert {n for n, df in done.items() if df.isEmpty()} == {
        "category_trend", "sentiment_engagement", "top_viral_music",
    }


@pytest.mark.parametrize("digits", [(0.5, 1.0), (1.5, 2.0)])
def test_averages_round_half_up(spark, digits):
    plays, want = digits
    t = warehouse(spark, {"play_count": int(plays * 2)}, {"play_count": 0})
    assert reports.weekday_pattern(t).select(F.col("avg_play_count")).first()[0] == want


def test_sets_of_creators_merge(spark):
    """By any coarser key, also over the ends of buckets and over tables written apart."""
    rng = random.Random(4)
    posts = [(rng.randrange(1, 100_000), rng.choice("abc"), rng.randrange(3)) for _ in range(5000)]
    df = spark.createDataFrame(posts, "creator_sk long, niche string, period int")
    halves = [df.where("period < 2"), df.where("period >= 2")]
    sets = reports.marts.creator_bitmaps(halves[0], ["niche", "period"])
    sets = sets.unionByName(reports.marts.creator_bitmaps(halves[1], ["niche", "period"]))
    for keys in (["niche"], ["period"], ["niche", "period"], []):
        got = {tuple(r)[:-1]: r["creator_count"] for r in reports.marts.merged_creators(sets, keys).collect()}
        want = df.groupBy(*keys).agg(F.count_distinct("creator_sk").alias("n")).collect()
        assert got == {tuple(r)[:-1]: r["n"] for r in want}
