from frames import comments, creators, rows, taxonomy, videos
from pyspark.sql import functions as F

from vidmart.operators import clean, features

URL = "https://v.example/@ann/video/"


def test_best_copy_wins_and_unplayed_copies_do_not_count(spark):
    df = videos(
        spark,
        {"playCount": 0, "text": "unplayed"},
        {"playCount": 10, "text": "good"},
        {"playCount": 9, "text": "less"},
        {"playCount": None, "webVideoUrl": URL + "2"},
    )
    assert rows(clean.videos(df).select("text", "playCount")) == [("good", 10)]


def test_two_addresses_of_one_video(spark):
    df = videos(spark, {"webVideoUrl": URL + "7", "playCount": 5},
                {"webVideoUrl": URL + "7?lang=en", "playCount": 6})
    assert rows(clean.videos(df).select("video_id", "playCount")) == [("7", 6)]
    assert clean.unique_addresses(df).count() == 2


def test_one_pass_equals_address_then_id(spark):
    df = videos(
        spark,
        *[
            {"webVideoUrl": URL + f"{v}" + ("?a" if c % 2 else ""), "playCount": 1 + (v * c) % 7,
             "text": f"t{c % 3}", "diggCount": c}
            for v in range(20) for c in range(6)
        ],
    )
    two_steps = clean.unique_addresses(df)
    two_steps = clean.keep_first(
        two_steps, ["video_id"], clean.best_first("playCount", df.columns)
    )
    assert rows(two_steps) == rows(clean.videos(df))


def test_null_addresses_are_one(spark):
    df = videos(spark, {"webVideoUrl": None, "playCount": 1}, {"webVideoUrl": None})
    assert rows(clean.unique_addresses(df).select("playCount")) == [(1000,)]
    assert clean.videos(df).count() == 0


def test_rejected_rows_are_kept_with_a_reason(spark):
    df = videos(
        spark, {}, {"playCount": 0}, {"playCount": None}, {"webVideoUrl": "https://v/live/3"}
    )
    got = rows(clean.rejected_videos(df).groupBy("reject_reason").count())
    assert got == [("no plays", 2), ("no video id", 1)]


def test_video_columns(spark):
    df = videos(spark, {"authorMeta_name": " Ann\t", "shareCount": None, "commentCount": None,
                        "diggCount": None, "createTimeISO": "bad"})
    got = clean.videos(df).select(
        "authorMeta_name", "shareCount", "commentCount", "diggCount", "createTimeISO"
    )
    assert rows(got) == [("ann", 0, 0, None, None)]


def test_result_does_not_depend_on_partitioning(spark):
    df = videos(spark, *[{"text": f"t{i}", "diggCount": i % 5} for i in range(50)])
    once = rows(clean.videos(df.repartition(7)))
    assert once == rows(clean.videos(df.repartition(3, "text"))) and len(once) == 1


def test_creators(spark):
    df = creators(
        spark,
        {"username": "A", "follower_count": 5},
        {"username": "a ", "follower_count": 9},
        {"username": "zero", "follower_count": 0},
        {"username": "null", "follower_count": None},
    )
    assert rows(clean.creators(df).select("username", "follower_count")) == [("a", 9)]


def test_comments(spark):
    df = comments(
        spark,
        {"comment_text": "it's ok!"},
        {"sentiment_label": "unknown"},
        {"sentiment_label": None},
        {"video_id": None},
    )
    assert rows(clean.comments(df).select("comment_text")) == [("its ok!",)]


def test_taxonomy_keeps_entries_that_break_a_rule(spark):
    """Only the entries to be loaded are held against the declared rules."""
    odd = {"hashtag_id": "HT2", "hashtag": "Odd", "search_volume_tier": "huge"}
    df = taxonomy(spark, {}, odd, {**odd, "hashtag_id": "HT3", "search_volume_tier": "low"})
    assert rows(clean.taxonomy(df).select("hashtag", "hashtag_id")) == [("fun", "HT1"), ("odd", "HT2")]
    assert rows(clean.valid_taxonomy(df).select("hashtag", "hashtag_id")) == [("fun", "HT1"), ("odd", "HT3")]


def test_taxonomy(spark):
    df = taxonomy(spark, {"hashtag_id": "HT2", "hashtag": " FUN "}, {"hashtag_id": "HT1"})
    assert rows(clean.taxonomy(df).select("hashtag", "hashtag_id")) == [("fun", "HT1")]


def test_features(spark):
    df = videos(
        spark, {"text": "#A #a #b.", "playCount": 2_000_000, "diggCount": 1_000_000,
                "videoMeta_duration": None, "createTimeISO": "2024-06-02T06:00:00.000Z"}
    )
    got = features.video_features(clean.videos(df)).select(
        "engagement_rate", "is_viral", "post_hour", "post_day_of_week", "post_month",
        "post_year", "hashtag_list", "hashtag_count", "duration_bucket",
    )
    assert rows(got) == [(0.5, True, 6, 1, 6, 2024, ["a", "a", "b"], 3, "extended")]


def test_viral_threshold_is_a_parameter(spark):
    df = clean.videos(videos(spark, {}))
    assert features.video_features(df, 1000).select("is_viral").first()[0] is True


def test_missing_columns_are_named(spark):
    assert clean.missing_video_columns(videos(spark, {})) == []
    assert clean.missing_video_columns(spark.range(1).withColumn("text", F.lit("")))[:1] == [
        "authorMeta_avatar"
    ]
