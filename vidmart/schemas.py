"""Column layouts of the four sources and of the star schema, and ``conform``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source field names, table and column names, lengths and value sets. Layouts are
# DDL text, which readers take as it is; ``struct`` parses one once a session exists.
VIDEO_FILE = (
    "`authorMeta.avatar` string, `authorMeta.name` string, text string, diggCount bigint, "
    "shareCount bigint, playCount bigint, commentCount bigint, `videoMeta.duration` bigint, "
    "`musicMeta.musicName` string, `musicMeta.musicAuthor` string, "
    "`musicMeta.musicOriginal` boolean, createTimeISO string, webVideoUrl string"
)
VIDEO = (
    "authorMeta_avatar string, authorMeta_name string, text string, diggCount bigint, "
    "shareCount bigint, playCount bigint, commentCount bigint, videoMeta_duration bigint, "
    "musicMeta_musicName string, musicMeta_musicAuthor string, "
    "musicMeta_musicOriginal boolean, createTimeISO string, webVideoUrl string"
)
CREATOR = (
    "influencer_id string, username string, display_name string, follower_count bigint, "
    "following_count int, total_videos int, avg_views_per_video bigint, country string, "
    "niche_category string, is_verified int, account_type string, joined_date date, "
    "bio_length_chars int, has_external_link int"
)
COMMENT = (
    "_id string, video_id string, video_url string, creator_username string, "
    "comment_text string, sentiment_label string, sentiment_score double, like_count int, "
    "is_reply boolean, parent_comment_id string, comment_timestamp string, "
    "user_follower_tier string, language_detected string"
)
TAXONOMY = (
    "hashtag_id string, hashtag string, category string, subcategory string, "
    "is_brand_safe smallint, content_rating string, search_volume_tier string, "
    "language_primary string, created_at date, last_updated date"
)
BRAND_SAFETY = (
    "safety_status smallint, description string, monetization_status string"
)
HOLIDAY = "full_date date, holiday_name string"

DIM_DATE = (
    "date_id int, full_date date, year smallint, quarter smallint, month smallint, "
    "month_name string, week_of_year smallint, day_of_week smallint, day_name string, "
    "is_weekend boolean, is_holiday boolean, holiday_name string"
)
DIM_CREATOR = (
    "creator_sk bigint, creator_nk string, display_name string, follower_count bigint, "
    "following_count int, total_videos int, country string, niche_category string, "
    "is_verified boolean, account_type string, valid_from date, valid_to date, "
    "is_current boolean"
)
DIM_HASHTAG = (
    "hashtag_id string, hashtag string, category string, subcategory string, "
    "is_brand_safe boolean, search_volume_tier string"
)
DIM_MUSIC = (
    "music_sk bigint, music_name string, music_author string, is_original boolean"
)
# post_hour, primary_brand_safe and the partition columns post_year / post_month are ours.
FACT = (
    "video_sk bigint, video_id string, creator_sk bigint, date_id int, music_sk bigint, "
    "play_count bigint, like_count bigint, comment_count int, share_count int, "
    "video_duration_sec int, engagement_rate decimal(8,6), is_viral boolean, "
    "total_comments_scraped int, positive_comment_pct decimal(5,2), "
    "negative_comment_pct decimal(5,2), neutral_comment_pct decimal(5,2), "
    "avg_sentiment_score decimal(5,4), primary_category string, hashtag_count smallint, "
    "loaded_at timestamp, pipeline_run_id string, post_hour int, primary_brand_safe int, "
    "post_year int, post_month int"
)
BRIDGE = "video_sk bigint, hashtag_id string"

# Warehouse tables by the name the code uses, the SQL name, and the layout.
TABLES = {
    "dim_date": ("dim_date", DIM_DATE),
    "dim_music": ("dim_music", DIM_MUSIC),
    "dim_hashtag": ("dim_hashtag", DIM_HASHTAG),
    "dim_creator": ("dim_creator", DIM_CREATOR),
    "fact": ("fact_video_performance", FACT),
    "bridge": ("bridge_video_hashtag", BRIDGE),
}
# Columns of the joined videos that the fact stores in a narrower type.
NARROWED = {
    "engagement_rate": "decimal(8,6)", "commentCount": "int", "shareCount": "int",
    "videoMeta_duration": "int", "total_comments_scraped": "int", "hashtag_count": "smallint",
    "positive_pct": "decimal(5,2)", "negative_pct": "decimal(5,2)", "neutral_pct": "decimal(5,2)",
    "avg_sentiment_score": "decimal(5,4)",
}

# VARCHAR lengths of the warehouse and taxonomy tables, checked as quality rules.
LENGTHS = {
    "dim_date": {"month_name": 15, "day_name": 10, "holiday_name": 100},
    "dim_creator": {
        "creator_nk": 50, "display_name": 100, "country": 5, "niche_category": 50,
        "account_type": 20,
    },
    "dim_hashtag": {
        "hashtag_id": 10, "hashtag": 100, "category": 50, "subcategory": 60,
        "search_volume_tier": 10,
    },
    "dim_music": {"music_name": 200, "music_author": 150},
    "fact_video_performance": {
        "video_id": 50, "primary_category": 50, "pipeline_run_id": 50,
    },
    "taxonomy": {
        "hashtag_id": 10, "hashtag": 100, "category": 50, "subcategory": 60,
        "content_rating": 10, "search_volume_tier": 10, "language_primary": 5,
    },
}
VOLUME_TIERS = ("low", "medium", "high", "viral")
SENTIMENTS = ("positive", "negative", "neutral")


def struct(ddl: str) -> T.StructType:
    return T.DataType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str, defaults: dict | None = None) -> DataFrame:
    """Project to exactly this layout: cast what is there, fill what is not.

    Casts are ``try_cast``: a value that does not fit its declared type becomes NULL, so one
    bad row cannot fail a load; the quality checks count such rows.
    """
    defaults = defaults or {}
    have = set(df.columns)
    out = []
    for f in struct(ddl).fields:
        c = F.col(f"`{f.name}`") if f.name in have else F.lit(defaults.get(f.name))
        out.append(c.try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def misfits(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` plus ``misfits``: name, text and declared type of the values that ``conform`` would lose."""
    have = dict(df.dtypes)
    broken = [
        F.when(
            F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(),
            F.struct(
                F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").cast("string").alias("text"),
                F.lit(f.dataType.simpleString()).alias("wanted"),
            ),
        )
        for f in struct(ddl).fields
        if f.name in have and have[f.name] != f.dataType.simpleString()
    ]
    return df.withColumn("misfits", F.array_compact(F.array(*broken)))
