"""The eight reports and their documented variants.

Each is a function of warehouse tables. The fact is first summed per surrogate key, which
combines in the map tasks and takes the sting out of a day, a creator or a sound that holds a
large part of all videos; the sums are joined to the dimension and summed again. Sums and
counts are exact; rounding comes last.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidmart.functions import labels
from vidmart.functions.measures import exact_mean
from vidmart.operators import marts
from vidmart.operators.keys import Cut, no_cut
from vidmart.operators.lookup import lookup

# Report parameters.
MIN_YEAR = 2025
TOP_CREATORS = 50
TOP_CREATORS_CHART = 20
TOP_MUSIC = 10
QUARTILES = (Decimal("0.25"), Decimal("0.50"), Decimal("0.75"))

Tables = Mapping[str, DataFrame]

_SUMMED = {
    "play": "play_count",
    "like": "like_count",
    "rate": "engagement_rate",
    "tags": "hashtag_count",
    "score": "avg_sentiment_score",
    "positive": "positive_comment_pct",
}


def _sums(*measures: str) -> list[Column]:
    """Video and viral counts, and per measure its sum and count of known values."""
    out = [F.count(F.lit(1)).alias("videos"), F.count_if("is_viral").alias("viral")]
    for m in measures:
        out += [F.sum(_SUMMED[m]).alias(f"sum_{m}"), F.count(_SUMMED[m]).alias(f"n_{m}")]
    return out


def _resums(*measures: str) -> list[Column]:
    """Add up what ``_sums`` gave per surrogate key."""
    names = ["videos", "viral"]
    for m in measures:
        names += [f"sum_{m}", f"n_{m}"]
    return [F.sum(n).alias(n) for n in names]


def _avg(measure: str, digits: int, factor: int = 1) -> Column:
    return exact_mean(F.col(f"sum_{measure}"), F.col(f"n_{measure}"), digits, factor)


def _viral_rate() -> Column:
    return exact_mean(F.col("viral"), F.col("videos"), 2, 100)


def _avg_plays() -> Column:
    return _avg("play", 0).alias("avg_play_count")


def _avg_rate(name: str) -> Column:
    return _avg("rate", 4, 100).alias(name)


# Measures of the daily sums, see ``marts.daily_sums``.
DAILY = ("play", "like", "rate", "tags")


def daily_sums(fact: DataFrame) -> DataFrame:
    return marts.daily_sums(fact, _sums(*DAILY))


def _by_date(t: Tables, measures: tuple, *keys, year_from: int | None = None) -> DataFrame:
    """Sums per day and ``keys`` with the calendar attributes of the day; rows without a
    known date drop out. Days are few, so little is left to join.

    Where the warehouse keeps daily sums by these keys, they are added up and the fact is not
    read. The year is also tested on the partition column, so earlier partitions are never read.
    """
    kept = "daily" in t and set(keys) <= set(marts.DAILY_KEYS) and set(measures) <= set(DAILY)
    rows, days = t["daily"] if kept else t["fact"], t["dim_date"]
    if year_from is not None:
        rows, days = rows.where(F.col("post_year") >= year_from), days.where(F.col("year") >= year_from)
    rows = rows.where(F.col("date_id").isNotNull()).groupBy("date_id", *keys)
    return rows.agg(*(_resums(*measures) if kept else _sums(*measures))).join(days, "date_id")


# Monthly engagement


_MONTHLY = ("play", "like", "rate")


def _monthly_measures() -> list[Column]:
    return [
        F.col("videos").alias("total_videos"),
        _avg_plays(),
        _avg("like", 0).alias("avg_like_count"),
        _avg_rate("avg_engagement_rate_pct"),
        F.col("viral").alias("viral_count"),
    ]


def monthly_engagement(t: Tables) -> DataFrame:
    keys = ["year", "month", "month_name"]
    rows = _by_date(t, _MONTHLY).groupBy(*keys).agg(*_resums(*_MONTHLY))
    return rows.select(*keys, *_monthly_measures()).orderBy("year", "month")


def engagement_rollup(t: Tables, keys: tuple[str, ...] = ("year", "month", "month_name")):
    """Subtotals along ``keys``; ``grouping_level`` tells a subtotal from a NULL key. The
    roll-up multiplies daily sums, not fact rows.
    """
    rows = _by_date(t, _MONTHLY).rollup(*keys)
    rows = rows.agg(*_resums(*_MONTHLY), F.grouping_id().alias("grouping_level"))
    return rows.select(
        *keys, F.col("grouping_level").cast("bigint"), *_monthly_measures()
    ).orderBy(*keys, "grouping_level")


def engagement_rollup_weekly(t: Tables) -> DataFrame:
    """Year, month, week."""
    return engagement_rollup(t, ("year", "month", "week_of_year"))


def monthly_series(t: Tables) -> DataFrame:
    """Chart input: one point per period."""
    return monthly_engagement(t).select(
        labels.period(F.col("year"), F.col("month")).alias("period"), "avg_engagement_rate_pct"
    )


# Viral patterns


def viral_patterns(t: Tables) -> DataFrame:
    keys = ["is_viral", "primary_category", "day_name", "duration_bucket"]
    measures = ("play", "rate", "tags")
    bucket = labels.duration_bucket(F.col("video_duration_sec"), report=True)
    rows = t["fact"].withColumn("duration_bucket", bucket)
    rows = _by_date({**t, "fact": rows}, measures, "is_viral", "primary_category", "duration_bucket")
    rows = rows.groupBy(*keys).agg(*_resums(*measures))
    return rows.select(
        *keys,
        F.col("videos").alias("video_count"),
        _avg_plays(),
        _avg_rate("avg_engagement_pct"),
        _avg("tags", 1).alias("avg_hashtag_count"),
    ).orderBy(F.desc_nulls_first("is_viral"), F.desc_nulls_first("avg_play_count"), *keys[1:])


def viral_by_duration(t: Tables) -> DataFrame:
    """Viral videos per duration, summed from the report above."""
    rows = viral_patterns(t).where("is_viral").groupBy("duration_bucket")
    return rows.agg(F.sum("video_count").alias("video_count")).orderBy("duration_bucket")


# Creators


def _by_creator(t: Tables, *measures: str) -> DataFrame:
    """Sums per creator with the attributes of the current version."""
    fact = t["fact"].where(F.col("creator_sk").isNotNull())
    sums = fact.groupBy("creator_sk").agg(
        *_sums(*measures), F.max("play_count").alias("best_play")
    )
    return sums.join(t["dim_creator"].where("is_current"), "creator_sk")


def creator_ranking(t: Tables, top: int = TOP_CREATORS) -> DataFrame:
    """The ``top`` creators by mean engagement. Sums per creator are already final, as a name
    has one current version. Unknown rates sort first, as DESC does in the warehouse's SQL.
    """
    return (
        _by_creator(t, "play", "rate")
        .select(
            F.col("creator_nk").alias("username"),
            "niche_category",
            "country",
            "is_verified",
            labels.influencer_tier(F.col("follower_count")).alias("influencer_tier"),
            F.col("videos").alias("total_videos"),
            _avg_plays(),
            _avg_rate("avg_engagement_rate_pct"),
            F.col("viral").alias("viral_videos"),
            F.col("best_play").alias("best_video_play_count"),
        )
        .orderBy(F.desc_nulls_first("avg_engagement_rate_pct"), "username")
        .limit(top)
    )


def creator_ranking_chart(t: Tables) -> DataFrame:
    return creator_ranking(t, TOP_CREATORS_CHART).select("username", "avg_engagement_rate_pct")


def _tiers(t: Tables, *more: str) -> DataFrame:
    keys = ["influencer_tier", *more]
    tier = labels.influencer_tier(F.col("follower_count"), numbered=True)
    rows = _by_creator(t, "play", "rate", "positive").withColumn("influencer_tier", tier)
    # A creator is in one bucket of a key, so the buckets' sets add up.
    rows = rows.groupBy(*keys, F.bitmap_bucket_number("creator_sk").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("creator_sk")).alias("creators"),
        *_resums("play", "rate", "positive"),
    )
    rows = rows.groupBy(*keys).agg(
        F.sum(F.bitmap_count("creators")).alias("creator_count"), *_resums("play", "rate", "positive")
    )
    return rows.select(
        *keys,
        "creator_count",
        F.col("videos").alias("total_videos"),
        _avg_plays(),
        _avg_rate("avg_engagement_rate_pct"),
        _avg("positive", 2).alias("avg_positive_sentiment"),
        F.col("viral").alias("total_viral_videos"),
        _viral_rate().alias("viral_rate_pct"),
    )


def creator_sets(t: Tables) -> DataFrame:
    """Sets of creators by tier, niche, year and month of their posts, to be kept and merged."""
    tier = labels.influencer_tier(F.col("follower_count"), numbered=True)
    current = t["dim_creator"].where("is_current").select(
        "creator_sk", tier.alias("influencer_tier"), "niche_category"
    )
    posts = t["fact"].where(F.col("creator_sk").isNotNull()).groupBy("creator_sk", "post_year", "post_month").agg(
        F.count(F.lit(1)).alias("posts")
    )
    keys = ["influencer_tier", "niche_category", "post_year", "post_month"]
    return marts.creator_bitmaps(posts.join(current, "creator_sk"), keys)


def active_creators(sets: DataFrame, keys: tuple[str, ...] = ("influencer_tier", "post_year")) -> DataFrame:
    """Different creators that posted, by any of the sets' keys, from the sets alone."""
    return marts.merged_creators(sets, list(keys)).orderBy(*keys)


def tier_paradox(t: Tables) -> DataFrame:
    return _tiers(t).orderBy("influencer_tier")


def tier_paradox_by_niche(t: Tables) -> DataFrame:
    return _tiers(t, "niche_category").orderBy(
        "influencer_tier", F.desc_nulls_first("avg_engagement_rate_pct"), "niche_category"
    )


def tier_distribution(t: Tables, cut: Cut = no_cut) -> DataFrame:
    """Box-plot numbers of the engagement rate per tier: exact, interpolated quartiles.

    Rates have six decimals, so videos collapse into a count per (tier, rate). The wanted
    ranks are then found in two steps that never line up a whole tier in one task: running
    counts over coarse bins pick the bin of each rank, and only those bins are opened. All three
    steps read the counts; a ``cut`` may write them, so that the fact is read and counted once.
    """
    rated = t["fact"].dropna(subset=["creator_sk", "engagement_rate"])
    tier = labels.influencer_tier(F.col("follower_count"), numbered=True)
    current = t["dim_creator"].where("is_current").select(
        F.col("creator_sk").alias("sk"), tier.alias("influencer_tier")
    )
    own = rated.groupBy("creator_sk", "engagement_rate").agg(F.count(F.lit(1)).alias("n"))
    tiered = lookup(own, current, {"creator_sk": "sk"}, ["creator_sk", "engagement_rate"], "inner")
    # 1,000 rates share a bin, and DECIMAL(8,6) has at most 100,000 bins.
    values = (
        tiered.groupBy("influencer_tier", "engagement_rate")
        .agg(F.sum("n").alias("n"))
        .withColumn("bin", F.floor(F.col("engagement_rate") * 1000).cast("int"))
    )
    values = cut(values)
    tiers = values.groupBy("influencer_tier").agg(
        F.sum("n").alias("videos"),
        F.min("engagement_rate").cast("double").alias("min_rate"),
        F.max("engagement_rate").cast("double").alias("max_rate"),
    )
    # The whole ranks on either side of rank p * (videos - 1), for each quartile p.
    sides = [
        F.struct(F.lit(f"{side}_{i}").alias("side"), at(_quartile_rank(p)).alias("rank"))
        for i, p in enumerate(QUARTILES)
        for side, at in (("lo", F.floor), ("hi", F.ceil))
    ]
    ranks = tiers.select("influencer_tier", F.explode(F.array(*sides)).alias("s")).select(
        "influencer_tier", "s.side", "s.rank"
    )
    by_bin = Window.partitionBy("influencer_tier").orderBy("bin")
    bins = (
        values.groupBy("influencer_tier", "bin")
        .agg(F.sum("n").alias("bin_n"))
        .withColumn("bin_end", F.sum("bin_n").over(by_bin))
        .withColumn("bin_start", F.col("bin_end") - F.col("bin_n"))
    )
    hit = bins.join(ranks, "influencer_tier").where("bin_start <= rank and rank < bin_end")
    opened = values.join(
        hit.select("influencer_tier", "bin", "bin_start").distinct(), ["influencer_tier", "bin"]
    )
    by_value = Window.partitionBy("influencer_tier", "bin").orderBy("engagement_rate")
    opened = opened.withColumn("end", F.col("bin_start") + F.sum("n").over(by_value))
    sought = hit.select("influencer_tier", "bin", "side", "rank")
    at_rank = (
        opened.join(sought, ["influencer_tier", "bin"])
        .where((F.col("end") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("end")))
        .groupBy("influencer_tier")
        .pivot("side", [f"{s}_{i}" for i in range(len(QUARTILES)) for s in ("lo", "hi")])
        .agg(F.first("engagement_rate"))
    )
    quartiles = []
    for i, p in enumerate(QUARTILES):
        rank, lo, hi = _quartile_rank(p), F.col(f"lo_{i}"), F.col(f"hi_{i}")
        value = lo + (rank - F.floor(rank)) * (hi - lo)
        quartiles.append(F.round(value, 6).cast("double").alias(f"p{int(p * 100)}_rate"))
    return (
        tiers.join(at_rank, "influencer_tier")
        .select("influencer_tier", "videos", "min_rate", *quartiles, "max_rate")
        .orderBy("influencer_tier")
    )


def _quartile_rank(p: Decimal) -> Column:
    return (F.col("videos") - 1) * F.lit(p)


# Categories


def _category_measures(t: Tables, min_year: int, keys: list[str]) -> DataFrame:
    """The slice from ``min_year`` on."""
    measures = ("play", "rate", "tags")
    rows = _by_date(t, measures, "primary_category", "primary_brand_safe", year_from=min_year)
    rows = rows.withColumn("is_brand_safe", F.col("primary_brand_safe") == 1)
    rows = rows.groupBy(*keys).agg(*_resums(*measures))
    return rows.select(
        *keys,
        F.col("videos").alias("total_videos"),
        _avg_plays(),
        _avg_rate("avg_engagement_pct"),
        _avg("tags", 1).alias("avg_hashtags_used"),
        F.col("viral").alias("viral_count"),
    ).orderBy(F.desc_nulls_first("avg_play_count"), *keys)


def category_trend(t: Tables, min_year: int = MIN_YEAR) -> DataFrame:
    return _category_measures(t, min_year, ["primary_category"])


def category_trend_by_safety(t: Tables, min_year: int = MIN_YEAR) -> DataFrame:
    """Split by the safety of the video's own primary tag; a join to the hashtag table on the
    category would count each video once per hashtag of that category.
    """
    return _category_measures(t, min_year, ["primary_category", "is_brand_safe"])


def category_share(t: Tables, min_year: int = MIN_YEAR) -> DataFrame:
    """Chart input: share of videos per category, from the finished report's few rows."""
    report = category_trend(t, min_year).select("primary_category", "total_videos")
    share = F.col("total_videos") / F.sum("total_videos").over(Window.partitionBy()) * 100
    return report.withColumn("share_pct", F.round(share, 1))


# Sentiment


def sentiment_engagement(t: Tables) -> DataFrame:
    rows = t["fact"].where(F.col("total_comments_scraped") > 0)
    bucket = labels.sentiment_bucket(F.col("positive_comment_pct"))
    rows = rows.groupBy(bucket.alias("sentiment_bucket")).agg(*_sums("play", "rate", "score"))
    return rows.select(
        "sentiment_bucket",
        F.col("videos").alias("video_count"),
        _avg_plays(),
        _avg_rate("avg_engagement_pct"),
        _avg("score", 4).alias("avg_sentiment_score"),
        F.col("viral").alias("viral_count"),
        _viral_rate().alias("viral_rate_pct"),
    ).orderBy(F.desc_nulls_first("avg_engagement_pct"), "sentiment_bucket")


def sentiment_viral_heatmap(t: Tables) -> DataFrame:
    """Videos per sentiment bucket, viral or not."""
    rows = t["fact"].where(F.col("total_comments_scraped") > 0)
    bucket = labels.sentiment_bucket(F.col("positive_comment_pct"))
    return (
        rows.groupBy(bucket.alias("sentiment_bucket"))
        .agg(
            F.count_if(~F.col("is_viral")).alias("not_viral"),
            F.count_if("is_viral").alias("viral"),
        )
        .orderBy("sentiment_bucket")
    )


# Posting time


def _posting(t: Tables, keys: list[str], own: tuple = ()) -> DataFrame:
    """By ``keys`` of the day and ``own`` columns of the fact."""
    keys = [*keys, *own]
    rows = _by_date(t, ("play", "rate"), *own)
    rows = rows.groupBy(*keys).agg(*_resums("play", "rate"))
    return rows.select(
        *keys,
        F.col("videos").alias("video_count"),
        _avg_plays(),
        _avg_rate("avg_engagement_pct"),
        F.col("viral").alias("viral_count"),
    )


def weekday_pattern(t: Tables) -> DataFrame:
    return _posting(t, ["day_name", "day_of_week", "is_weekend"]).orderBy("day_of_week")


def weekday_chart(t: Tables) -> DataFrame:
    return weekday_pattern(t).select(
        "day_name", labels.day_kind(F.col("is_weekend")).alias("day_kind"), "avg_play_count"
    )


def day_hour_pattern(t: Tables) -> DataFrame:
    """By weekday, holiday and the hour of posting."""
    keys = ["day_name", "is_weekend", "is_holiday"]
    rows = _posting(t, keys, ("post_hour",))
    return rows.orderBy(F.desc_nulls_first("avg_play_count"), *keys, "post_hour")


def posting_heatmap(t: Tables) -> DataFrame:
    """Weekday by hour, the mean of the report's averages; one column per hour, h0 to h23."""
    hours = [f"h{h}" for h in range(24)]
    hour = F.concat(F.lit("h"), F.col("post_hour").cast("string"))
    return (
        day_hour_pattern(t)
        .withColumn("hour", hour)
        .groupBy("day_name")
        .pivot("hour", hours)
        .agg(F.avg("avg_play_count"))
        .orderBy("day_name")
    )


def holiday_comparison(t: Tables) -> DataFrame:
    rows = _by_date(t, ("play", "rate"))
    kind = labels.holiday_kind(F.col("is_holiday"))
    rows = rows.groupBy(kind.alias("day_type")).agg(*_resums("play", "rate"))
    return rows.select(
        "day_type",
        F.col("videos").alias("total_videos"),
        _avg_plays(),
        _avg_rate("avg_engagement_pct"),
    ).orderBy("day_type")


# Music


def music_originality(t: Tables) -> DataFrame:
    fact = t["fact"].where(F.col("music_sk").isNotNull())
    sums = fact.groupBy("music_sk").agg(*_sums("play", "rate"))
    rows = sums.join(t["dim_music"], "music_sk").groupBy("is_original")
    rows = rows.agg(*_resums("play", "rate"))
    return rows.select(
        "is_original",
        F.col("videos").alias("total_videos"),
        _avg_plays(),
        _avg_rate("avg_engagement_pct"),
        F.col("viral").alias("viral_count"),
    ).orderBy("is_original")


def music_originality_chart(t: Tables) -> DataFrame:
    return music_originality(t).select(
        labels.music_kind(F.col("is_original")).alias("music_kind"),
        "total_videos",
        "avg_engagement_pct",
    )


def top_viral_music(t: Tables, top: int = TOP_MUSIC, with_viral: bool = False) -> DataFrame:
    """The sounds viral videos use most; a sound is one row of the dimension, so the sums per
    key are final."""
    fact = t["fact"].where(F.col("is_viral") & F.col("music_sk").isNotNull())
    sums = fact.groupBy("music_sk").agg(*_sums("play"))
    columns = [
        "music_name",
        "music_author",
        "is_original",
        F.col("videos").alias("usage_count"),
        _avg_plays(),
    ]
    if with_viral:
        columns.append(F.col("viral").alias("viral_videos"))
    return (
        sums.join(t["dim_music"], "music_sk")
        .select(*columns)
        .orderBy(F.desc("usage_count"), "music_name", "music_author")
        .limit(top)
    )


def top_viral_music_detail(t: Tables) -> DataFrame:
    return top_viral_music(t, with_viral=True)


REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "monthly_engagement": monthly_engagement,
    "viral_patterns": viral_patterns,
    "creator_ranking": creator_ranking,
    "category_trend": category_trend,
    "sentiment_engagement": sentiment_engagement,
    "weekday_pattern": weekday_pattern,
    "music_originality": music_originality,
    "top_viral_music": top_viral_music,
    "tier_paradox": tier_paradox,
}


def run_all_reports(t: Tables, min_year: int = MIN_YEAR) -> dict[str, DataFrame]:
    out = {name: report(t) for name, report in REPORTS.items()}
    out["category_trend"] = category_trend(t, min_year)
    return out
