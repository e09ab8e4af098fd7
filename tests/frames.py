"""Small hand-written frames in source shape."""

from vidmart import schemas


def rows(df):
    """Collected rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _frame(spark, ddl, records, base):
    names = [f.name for f in schemas.struct(ddl).fields]
    unknown = {k for r in records for k in r} - set(names)
    assert not unknown, unknown
    data = [tuple({**base, **r}.get(n) for n in names) for r in records]
    return spark.createDataFrame(data, ddl)


def videos(spark, *records):
    base = {
        "authorMeta_name": "ann", "text": "", "diggCount": 10, "shareCount": 0,
        "playCount": 1000, "commentCount": 0, "videoMeta_duration": 10,
        "musicMeta_musicName": "song", "musicMeta_musicAuthor": "band",
        "musicMeta_musicOriginal": True, "createTimeISO": "2026-05-01T17:09:00.000Z",
        "webVideoUrl": "https://v.example/@ann/video/1",
    }
    return _frame(spark, schemas.VIDEO, records, base)


def creators(spark, *records):
    base = {
        "influencer_id": "INF1", "username": "ann", "display_name": "Ann",
        "follower_count": 100, "following_count": 1, "total_videos": 2, "country": "ID",
        "niche_category": "Comedy", "is_verified": 1, "account_type": "Creator",
    }
    return _frame(spark, schemas.CREATOR, records, base)


def comments(spark, *records):
    base = {"_id": "c", "video_id": "1", "comment_text": "nice", "sentiment_label": "positive",
            "sentiment_score": 0.5}
    return _frame(spark, schemas.COMMENT, records, base)


def taxonomy(spark, *records):
    base = {"hashtag_id": "HT1", "hashtag": "fun", "category": "Comedy", "is_brand_safe": 1,
            "search_volume_tier": "low"}
    return _frame(spark, schemas.TAXONOMY, records, base)
