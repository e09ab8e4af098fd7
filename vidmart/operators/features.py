"""Features of one video row; no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidmart.functions import labels, measures, text


def video_features(df: DataFrame, viral_threshold: int = measures.VIRAL_PLAYS) -> DataFrame:
    """Add rate, viral flag, posting time, hashtags and duration bucket.

    ``post_day_of_week`` counts from 1 = Sunday, unlike ``dim_date.day_of_week``.
    """
    posted = F.col("createTimeISO")
    rate = measures.engagement_rate(
        F.col("diggCount"), F.col("commentCount"), F.col("shareCount"), F.col("playCount")
    )
    return df.withColumns(
        {
            "engagement_rate": rate,
            "is_viral": measures.is_viral(F.col("playCount"), viral_threshold),
            "post_hour": F.hour(posted),
            "post_day_of_week": F.dayofweek(posted),
            "post_month": F.month(posted),
            "post_year": F.year(posted),
            "hashtag_list": text.hashtags(F.col("text")),
            "duration_bucket": labels.duration_bucket(F.col("videoMeta_duration")),
        }
    ).withColumn("hashtag_count", F.size("hashtag_list"))
