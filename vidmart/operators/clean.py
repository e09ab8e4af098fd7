"""Cleaning: filters, keys and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidmart.functions import measures, text
from vidmart.operators import quality
from vidmart.schemas import SENTIMENTS, VIDEO


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Catalyst turns ``row_number() = 1`` into a group limit on both sides of the shuffle: each
    map task sends at most one row per key, so a key with very many copies stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def best_first(first: str, columns: list[str]) -> list[Column]:
    """Highest ``first``, ties broken by every other column: rows still tied are identical."""
    return [F.col(c).desc_nulls_last() for c in [first, *(c for c in columns if c != first)]]


def _played(df: DataFrame) -> DataFrame:
    """Rows with at least one play, as they came, with the video id."""
    return df.where(F.col("playCount") > 0).withColumn(
        "video_id", text.video_id(F.col("webVideoUrl"))
    )


def _tidy(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "createTimeISO": F.try_to_timestamp("createTimeISO"),
            "commentCount": measures.zero_if_null(F.col("commentCount")),
            "shareCount": measures.zero_if_null(F.col("shareCount")),
            "authorMeta_name": text.normal_key(F.col("authorMeta_name")),
        }
    )


def videos(df: DataFrame) -> DataFrame:
    """One row per video: the most played copy.

    Filters come before the duplicates go, so an unplayed copy cannot displace a good one;
    parsing comes after, so it is done once per video. The id is a function of the address,
    so keeping the best row per id also keeps at most one row per address: a single shuffle
    does both. Rows without an id are set aside, see ``rejected_videos``.
    """
    good = _played(df).where(F.col("video_id").isNotNull())
    return _tidy(keep_first(good, ["video_id"], best_first("playCount", df.columns)))


def unique_addresses(df: DataFrame) -> DataFrame:
    """One played row per ``webVideoUrl``, the most played; NULL addresses count as one."""
    rows = _played(df)
    return _tidy(keep_first(rows, ["webVideoUrl"], best_first("playCount", df.columns)))


def rejected_videos(df: DataFrame) -> DataFrame:
    """Source rows that cleaning sets aside, with the reason."""
    reason = F.when(
        F.coalesce(F.col("playCount") <= 0, F.lit(True)), "no plays"
    ).when(text.video_id(F.col("webVideoUrl")).isNull(), "no video id")
    return _set_aside(df, reason)


def _set_aside(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("reject_reason", reason).where("reject_reason is not null")


def rejected_creators(df: DataFrame) -> DataFrame:
    """Profiles that cleaning sets aside, with the reason. Spare profiles of a name are no rejects."""
    reason = F.when(F.coalesce(F.col("follower_count") <= 0, F.lit(True)), "no followers").when(
        text.normal_key(F.col("username")).isNull(), "no username"
    )
    return _set_aside(df, reason)


def rejected_comments(df: DataFrame) -> DataFrame:
    """Comments that cleaning sets aside, with the reason."""
    unknown = ~F.coalesce(F.col("sentiment_label").isin(*SENTIMENTS), F.lit(False))
    return _set_aside(df, F.when(unknown, "unknown label").when(F.col("video_id").isNull(), "no video"))


def rejected_taxonomy(df: DataFrame) -> DataFrame:
    """Entries that break a declared constraint, with the names of all they break."""
    _, bad = quality.split_by_constraints(df, quality.taxonomy_rules())
    return bad.withColumn("reject_reason", F.concat_ws("; ", "violations")).drop("violations")


def creators(df: DataFrame) -> DataFrame:
    """One profile per normalised username: the most followed with any followers."""
    rows = df.withColumn("username", text.normal_key(F.col("username"))).where(
        (F.col("follower_count") > 0) & F.col("username").isNotNull()
    )
    return keep_first(rows, ["username"], best_first("follower_count", rows.columns))


def comments(df: DataFrame, unicode: bool = False) -> DataFrame:
    """Comments with a known label and a video, text scrubbed."""
    return df.where(
        F.col("sentiment_label").isin(*SENTIMENTS) & F.col("video_id").isNotNull()
    ).withColumn("comment_text", text.scrub(F.col("comment_text"), unicode))


def taxonomy(df: DataFrame) -> DataFrame:
    """One entry per normalised hashtag, the lowest id. Entries that break a declared constraint are
    among them: the tables that a load writes take ``valid_taxonomy``."""
    rows = df.withColumn("hashtag", text.normal_key(F.col("hashtag")))
    others = [c for c in rows.columns if c not in ("hashtag", "hashtag_id")]
    order = [F.col(c).asc_nulls_last() for c in ["hashtag_id", *others]]
    return keep_first(rows, ["hashtag"], order)


def valid_taxonomy(df: DataFrame) -> DataFrame:
    """``taxonomy`` of the entries that keep the declared constraints, as the warehouse loads them."""
    valid, _ = quality.split_by_constraints(df, quality.taxonomy_rules())
    return taxonomy(valid)


def missing_video_columns(df: DataFrame) -> list[str]:
    """Names a video frame lacks, for a clear error before any work starts."""
    have = set(df.columns)
    return [p.split()[0] for p in VIDEO.split(", ") if p.split()[0] not in have]
