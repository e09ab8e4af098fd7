"""The video fact and the video-hashtag bridge."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidmart import schemas
from vidmart.functions import measures
from vidmart.operators.keys import Cut, assign_keys
from vidmart.operators.lookup import lookup


FITS = "size(misfits) = 0"
MISFITS = "misfits array<struct<column_name: string, text: string, wanted: string>>"


def run_id(started: datetime) -> str:
    return started.strftime("RUN_%Y%m%d_%H%M%S")


def with_creator_key(
    videos: DataFrame, dim_creator: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Add ``creator_sk`` of the author's current version; NULL if there is none."""
    current = dim_creator.where("is_current").select("creator_nk", "creator_sk")
    return lookup(videos, current, {"authorMeta_name": "creator_nk"}, ["video_id"], hot=hot)


def _music_names(videos: DataFrame) -> DataFrame:
    return videos.withColumns(
        {
            "_name": F.coalesce("musicMeta_musicName", F.lit("")),
            "_author": F.coalesce("musicMeta_musicAuthor", F.lit("")),
        }
    )


def with_music_key(
    videos: DataFrame,
    dim_music: DataFrame,
    keys_from: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add ``music_sk`` of (name, author), NULL and empty counting as equal. ``hot`` has frequent
    names; without it ``keys_from`` may be the videos before other joins, so that counting them does
    not repeat those."""
    keyed = _music_names(videos)
    counted = None if keys_from is None else _music_names(keys_from)
    music = dim_music.select(
        F.coalesce("music_name", F.lit("")).alias("name"),
        F.coalesce("music_author", F.lit("")).alias("author"),
        "music_sk",
    )
    on = {"_name": "name", "_author": "author"}
    return lookup(keyed, music, on, ["video_id"], keys_from=counted, hot=hot).drop("_name", "_author")


def fact_rows(
    final: DataFrame,
    dim_creator: DataFrame,
    dim_music: DataFrame,
    run: str,
    loaded_at: datetime,
    hot: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One fact row per video, without its surrogate key yet, with ``misfits``: the values that are no
    value of their column. A row with any is to be set aside, see ``fitting``.

    Missing counts become 0; missing rates and shares stay NULL. Rows keep their tags out:
    the bridge holds those.
    """
    zero = measures.zero_if_null
    hot = hot or {}
    owned = with_creator_key(final, dim_creator, hot.get("authors"))
    rows = with_music_key(owned, dim_music, keys_from=final, hot=hot.get("music")).withColumns(
        {
            "date_id": measures.date_key(F.col("createTimeISO")),
            "play_count": zero(F.col("playCount")),
            "like_count": zero(F.col("diggCount")),
            "comment_count": zero(F.col("commentCount")),
            "share_count": zero(F.col("shareCount")),
            "video_duration_sec": zero(F.col("videoMeta_duration")),
            "is_viral": F.coalesce("is_viral", F.lit(False)),
            "total_comments_scraped": zero(F.col("total_comments_scraped")),
            "positive_comment_pct": F.col("positive_pct"),
            "negative_comment_pct": F.col("negative_pct"),
            "neutral_comment_pct": F.col("neutral_pct"),
            "hashtag_count": zero(F.col("hashtag_count")),
            "loaded_at": F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp"),
            "pipeline_run_id": F.lit(run),
        }
    )
    layout = f"{schemas.FACT}, {MISFITS}"
    return schemas.conform(schemas.misfits(rows, schemas.FACT), layout).drop("video_sk")


def fitting(rows: DataFrame) -> DataFrame:
    """The rows that can be loaded as they are."""
    return rows.where(FITS).drop("misfits")


def rejected(rows: DataFrame) -> DataFrame:
    """The rows that cannot, by video, with the values that do not fit."""
    shown = F.transform("misfits", lambda m: F.concat(m["column_name"], F.lit("="), m["text"], F.lit(" as "), m["wanted"]))
    return rows.where(f"not {FITS}").select("video_id", "pipeline_run_id", shown.alias("misfits"))


def fact_table(
    final: DataFrame,
    dim_creator: DataFrame,
    dim_music: DataFrame,
    run: str,
    loaded_at: datetime,
    cut: Cut = fitting,
    hot: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The fact with its keys. ``cut`` may write the rows, and gives back those that fit. ``hot`` has
    the frequent authors and names of music, see ``frequent``."""
    rows = cut(fact_rows(final, dim_creator, dim_music, run, loaded_at, hot))
    return schemas.conform(assign_keys(rows, ["video_id"], "video_sk"), schemas.FACT)


def bridge_table(fact: DataFrame, pairs: DataFrame) -> DataFrame:
    """(video_sk, hashtag_id) of the pairs whose video is in the fact.

    Pairs are distinct and a video is in the fact once, so the result is distinct as it is.
    """
    return pairs.join(fact.select("video_id", "video_sk"), "video_id").select(
        "video_sk", "hashtag_id"
    )
