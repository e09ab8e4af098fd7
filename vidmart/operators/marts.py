"""Summary tables by creator, category and posting time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidmart.functions import measures


def _avg_plays() -> Column:
    return measures.exact_mean(F.sum("playCount"), F.count("playCount"), 0).alias("avg_play_count")


def _avg_rate() -> Column:
    rate = F.col("engagement_rate").try_cast("decimal(20,6)")
    return measures.exact_mean(F.sum(rate), F.count(rate), 6).alias("avg_engagement_rate")


def creator_stats(final: DataFrame) -> DataFrame:
    return final.groupBy("authorMeta_name").agg(
        F.count("video_id").alias("total_videos_in_period"),
        _avg_plays(),
        _avg_rate(),
        F.count_if("is_viral").alias("viral_video_count"),
        F.max("playCount").alias("max_play_count"),
    )


def category_stats(final: DataFrame) -> DataFrame:
    share = F.col("positive_pct").cast("decimal(5,2)")
    return final.groupBy("primary_category").agg(
        F.count("video_id").alias("total_videos"),
        _avg_plays(),
        _avg_rate(),
        measures.exact_mean(F.sum(share), F.count(share), 2).alias("avg_positive_sentiment_pct"),
    )


def time_stats(final: DataFrame) -> DataFrame:
    return final.groupBy("post_day_of_week", "post_hour").agg(
        F.count("video_id").alias("video_count"), _avg_plays(), _avg_rate()
    )


# What the daily sums are kept by: bounded for a day, however many videos it has.
DAILY_KEYS = ("date_id", "post_year", "primary_category", "primary_brand_safe", "post_hour")


def daily_sums(fact: DataFrame, sums: list[Column]) -> DataFrame:
    """Mergeable sums of the fact by day, category, safety and hour. Rows of several runs may stand
    side by side: reports add them up."""
    return fact.groupBy(*DAILY_KEYS).agg(*sums)


def creator_bitmaps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """For each key and bucket of 32,768 dense creator keys the set of creators that occur, as bits.
    Sets of finer keys, other periods or other runs merge by bitwise or."""
    return rows.groupBy(*keys, F.bitmap_bucket_number("creator_sk").alias("creator_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("creator_sk")).alias("creators")
    )


def merged_creators(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Different creators by key, from sets of finer keys."""
    sets = bitmaps.groupBy(*keys, "creator_bucket").agg(F.bitmap_or_agg("creators").alias("creators"))
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("creators")).alias("creator_count"))
