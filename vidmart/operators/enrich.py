"""Joining the sources: creator, comment sentiment, hashtag categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidmart.functions import text
from vidmart.operators.lookup import fits_broadcast, lookup

# What a video gets when none of its tags is known.
DEFAULT_CATEGORY = "Entertainment"
DEFAULT_BRAND_SAFE = 1
# The profile columns a video row carries.
CREATOR_COLUMNS = (
    "username", "follower_count", "following_count", "country", "niche_category",
    "is_verified", "account_type",
)


def sentiment_by_video(comments: DataFrame) -> DataFrame:
    """Comment count, label shares and mean score per video.

    Pre-aggregates in the map tasks, so a video with very many comments costs one row per
    task. Scores are summed as decimals: the mean does not depend on the order of rows.
    """
    n = F.count(F.lit(1))

    def share(label: str):
        return F.round(F.count_if(F.col("sentiment_label") == label) / n * 100, 2)

    score = F.col("sentiment_score").try_cast("decimal(18,12)")
    mean = F.round(F.try_divide(F.sum(score), F.count(score)), 4)
    return comments.groupBy("video_id").agg(
        n.alias("total_comments_scraped"),
        share("positive").alias("positive_pct"),
        share("negative").alias("negative_pct"),
        share("neutral").alias("neutral_pct"),
        mean.cast("double").alias("avg_sentiment_score"),
    )


def video_tags(videos: DataFrame) -> DataFrame:
    """(video_id, position, tag): only the narrow columns are exploded; empty tags go.

    The outer form is used because for the inner one Catalyst adds a test of the array's size,
    which works out the hashtags of every caption a second time.
    """
    return videos.select(
        "video_id", F.posexplode_outer("hashtag_list").alias("tag_position", "tag")
    ).where(F.col("tag") != "")


def tag_categories(tags: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Every tag with the category, safety flag and id of its taxonomy entry, if any."""
    entries = taxonomy.select("hashtag", "hashtag_id", "category", "is_brand_safe")
    return lookup(tags, entries, {"tag": "hashtag"}, ["video_id", "tag_position"])


def primary_category(tags: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Category of the best tag per video: safe before unsafe before unknown, then the first
    in the caption. A struct minimum, so it aggregates before any shuffle.
    """
    best = F.min(
        F.struct(
            F.coalesce(-F.col("is_brand_safe").cast("int"), F.lit(1)).alias("rank"),
            "tag_position",
            "hashtag_id",
            "category",
            F.col("is_brand_safe").cast("int").alias("brand_safe"),
        )
    )
    return (
        tag_categories(tags, taxonomy)
        .groupBy("video_id")
        .agg(best.alias("b"))
        .select(
            "video_id",
            F.col("b.category").alias("primary_category"),
            F.col("b.brand_safe").alias("primary_brand_safe"),
        )
    )


def bridge_pairs(
    videos: DataFrame, taxonomy: DataFrame, known_unique: bool = False
) -> DataFrame:
    """Distinct (video_id, hashtag_id) of the tags the taxonomy knows.

    Repeats inside a caption go before the tags are exploded. With one row per video and one
    hashtag per id nothing else can repeat; a caller who knows that says so with
    ``known_unique`` and saves the shuffle of all pairs.
    """
    tags = videos.select(
        "video_id", F.explode_outer(F.array_distinct("hashtag_list")).alias("tag")
    ).where(F.col("tag") != "")
    entries = taxonomy.select("hashtag", "hashtag_id")
    pairs = lookup(tags, entries, {"tag": "hashtag"}, ["video_id", "tag"], "inner")
    pairs = pairs.select("video_id", "hashtag_id")
    return pairs if known_unique else pairs.distinct()


def author_names(raw_videos: DataFrame) -> DataFrame:
    """Normalised authors of raw videos: one column to read, good enough for frequencies."""
    return raw_videos.select(
        text.normal_key(F.col("authorMeta_name")).alias("authorMeta_name")
    )


def with_creators(
    videos: DataFrame,
    creators: DataFrame,
    keys_from: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add the profile of the author; every video stays, once. ``hot`` or ``keys_from``: see ``lookup``."""
    profile = creators.select(F.col("username").alias("_name"), *CREATOR_COLUMNS)
    return lookup(
        videos, profile, {"authorMeta_name": "_name"}, ["video_id"], keys_from=keys_from, hot=hot
    )


def with_sentiment(videos: DataFrame, sentiment: DataFrame) -> DataFrame:
    return videos.join(sentiment, "video_id", "left")


def with_category(videos: DataFrame, categories: DataFrame) -> DataFrame:
    return videos.join(categories, "video_id", "left").fillna(
        {"primary_category": DEFAULT_CATEGORY, "primary_brand_safe": DEFAULT_BRAND_SAFE}
    )


def videos_final(
    features: DataFrame,
    creators: DataFrame,
    comments: DataFrame,
    taxonomy: DataFrame,
    names: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """The joined video table, one row per video.

    Cleaning leaves videos partitioned by ``video_id``; the joins on that key come first and reuse
    it. If the profiles are too many to broadcast, only ids and authors go to meet them, and what is
    found comes back by ``video_id``: whole videos would be several times as many bytes. ``hot`` has
    the frequent authors; without it ``names`` is a cheap frame to count them on, see ``lookup``.
    """
    joined = with_sentiment(features, sentiment_by_video(comments))
    joined = with_category(joined, primary_category(video_tags(features), taxonomy))
    if fits_broadcast(creators.select("username", *CREATOR_COLUMNS)):
        return with_creators(joined, creators, names, hot)
    authors = features.select("video_id", "authorMeta_name")
    profile = creators.select(F.col("username").alias("_name"), *CREATOR_COLUMNS)
    found = lookup(
        authors, profile, {"authorMeta_name": "_name"}, ["video_id"], "inner", names, hot=hot
    )
    return joined.join(found.drop("authorMeta_name"), "video_id", "left")
