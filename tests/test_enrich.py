import pytest
from frames import comments, creators, rows, taxonomy, videos
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from vidmart.operators import clean, enrich, features, frequent
from vidmart.operators.lookup import lookup

TAGS = [
    {"hashtag_id": "HT1", "hashtag": "safe", "category": "Music", "is_brand_safe": 1},
    {"hashtag_id": "HT2", "hashtag": "unsafe", "category": "Comedy", "is_brand_safe": 0},
    {"hashtag_id": "HT3", "hashtag": "safe2", "category": "Sports", "is_brand_safe": 1},
]


def featured(spark, *captions):
    df = videos(
        spark,
        *[{"text": c, "webVideoUrl": f"https://v/video/{i}"} for i, c in enumerate(captions, 1)],
    )
    return features.video_features(clean.videos(df))


def final(spark, *captions, people=({},), remarks=({"video_id": "none"},)):
    return enrich.videos_final(
        featured(spark, *captions), clean.creators(creators(spark, *people)),
        clean.comments(comments(spark, *remarks)), clean.taxonomy(taxonomy(spark, *TAGS)),
    )


@pytest.mark.parametrize(
    "caption,want",
    [
        ("#other #unsafe #safe", ("Music", 1)),
        ("#other #unsafe", ("Comedy", 0)),
        ("#safe2 #safe", ("Sports", 1)),
        ("#other", ("Entertainment", 1)),
        ("#!", ("Entertainment", 1)),
        (None, ("Entertainment", 1)),
    ],
)
def test_primary_category(spark, caption, want):
    got = final(spark, caption).select("primary_category", "primary_brand_safe")
    assert rows(got) == [want]


def test_videos_without_known_author_or_comments_stay(spark):
    got = final(spark, "a", "b", people=({"username": "bob"},))
    assert got.count() == 2
    assert rows(got.select("username", "total_comments_scraped").distinct()) == [(None, None)]


def test_sentiment(spark):
    df = comments(
        spark,
        {"sentiment_score": 0.1},
        {"sentiment_label": "negative", "sentiment_score": 0.2},
        {"sentiment_label": "neutral", "sentiment_score": None},
        {"video_id": "2", "sentiment_score": 0.0012},
        {"video_id": "2", "sentiment_score": 0.0013},
    )
    assert rows(enrich.sentiment_by_video(df)) == [
        ("1", 3, 33.33, 33.33, 33.33, 0.15),
        ("2", 2, 100.0, 0.0, 0.0, 0.0013),
    ]


label = st.sampled_from(["positive", "negative", "neutral"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 4), label), min_size=1, max_size=60))
def test_sentiment_shares_add_up(spark, pairs):
    df = comments(spark, *[{"video_id": str(v), "sentiment_label": s} for v, s in pairs])
    for r in enrich.sentiment_by_video(df).collect():
        assert abs(r.positive_pct + r.negative_pct + r.neutral_pct - 100) <= 0.021
        assert r.total_comments_scraped == sum(str(v) == r.video_id for v, _ in pairs)


def test_bridge_pairs_are_distinct_and_known(spark):
    df = featured(spark, "#safe #SAFE #other #!", "#unsafe #safe")
    want = [("1", "HT1"), ("2", "HT1"), ("2", "HT2")]
    entries = taxonomy(spark, *TAGS)
    assert rows(enrich.bridge_pairs(df, entries)) == want
    assert rows(enrich.bridge_pairs(df, entries, known_unique=True)) == want
    twice = entries.withColumn("hashtag_id", F.lit("HT9"))
    assert rows(enrich.bridge_pairs(df, twice)) == [("1", "HT9"), ("2", "HT9")]


def skewed(spark, n=3000):
    """A third of the rows under one key, a third without any, the rest spread."""
    k = F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))
    )
    return spark.range(n).select("id", k.alias("k"))


def dim(spark, hot=True):
    names = [f"k{i}" for i in range(60)] + (["hot"] if hot else [])
    return spark.createDataFrame(
        [(x, len(x) if i % 5 else None, i) for i, x in enumerate(names)],
        "name string, size int, num int",
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_keys", [1, 3, 1000])
@pytest.mark.parametrize("known", [True, False])
def test_split_lookup_equals_plain_join(spark, no_broadcast, how, hot_keys, known):
    left, right = skewed(spark), dim(spark, known)
    want = left.join(right, left.k == right.name, how).select("id", "k", "size", "num")
    got = lookup(left, right, {"k": "name"}, ["id"], how, hot_keys=hot_keys)
    assert got.columns == ["id", "k", "size", "num"]
    assert rows(got) == rows(want)


def test_lookup_on_two_columns(spark, no_broadcast):
    left = skewed(spark, 300).withColumn("k2", (F.col("id") % 4).cast("int"))
    right = dim(spark).withColumn("name2", F.lit(2))
    got = lookup(left, right, {"k": "name", "k2": "name2"}, ["id"], hot_keys=2)
    want = left.join(right, (left.k == right.name) & (left.k2 == right.name2), "left")
    assert rows(got) == rows(want.select("id", "k", "k2", "size", "num"))


def test_lookup_steering_frame_never_changes_the_result(spark, no_broadcast):
    left, right = skewed(spark), dim(spark)
    other = spark.createDataFrame([("nobody",), ("k1",)], "k string")
    want = rows(lookup(left, right, {"k": "name"}, ["id"]))
    assert rows(lookup(left, right, {"k": "name"}, ["id"], keys_from=other)) == want


def test_lookup_shuffle_is_even(spark, no_broadcast):
    """Rows of the hot key and rows without a key are spread over all partitions."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lookup(skewed(spark, 30_000), dim(spark), {"k": "name"}, ["id"], hot_keys=5)
        sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 1.6 * 30_000 / 4


def test_lookup_refuses_clashing_columns(spark):
    left = skewed(spark).withColumn("num", F.lit(1))
    with pytest.raises(ValueError):
        lookup(left, dim(spark), {"k": "name"}, ["id"])
    with pytest.raises(ValueError):
        lookup(skewed(spark), dim(spark), {"k": "name"}, ["id"], how="full")


def test_frequent_keys_from_a_summary(spark):
    names = ["ann"] * 50 + ["Bob "] * 30 + [None] * 20 + [f"n{i}" for i in range(40)]
    posts = videos(spark, *[{"authorMeta_name": n, "musicMeta_musicAuthor": None} for n in names])
    found = posts.agg(*[c.alias(k) for k, c in frequent.of_videos().items()]).first()
    counts = {r["item"]: r["count"] for r in found["authors"] if r["item"] is not None}
    assert (counts["ann"], counts["bob"]) == (50, 30)
    assert rows(frequent.table(spark, "music", found["music"])) == [("song", "")]
    keys = frequent.table(spark, "authors", found["authors"])
    assert keys.columns == ["authorMeta_name"] and {("ann",), ("bob",)} <= set(rows(keys))
    assert frequent.table(spark, "authors", None).count() == 0
    odd = [Row(item="a\x1fb", count=1), Row(item=None, count=3)]
    assert frequent.table(spark, "authors", odd).count() == 0


def test_known_frequent_keys_do_not_change_a_lookup(spark, no_broadcast):
    posts = clean.videos(videos(spark, *[
        {"authorMeta_name": n, "webVideoUrl": f"https://v/video/{i}"}
        for i, n in enumerate(["ann"] * 9 + ["bob", None, "nobody"])
    ]))
    people = clean.creators(creators(spark, {}, {"username": "bob", "follower_count": 7}))
    want = rows(enrich.with_creators(posts, people))
    for hot in (["ann"], ["ann", "bob", "nobody"], ["unknown"], [], [None, "ann", "ann"]):
        keys = spark.createDataFrame([(h,) for h in hot], "authorMeta_name string")
        assert rows(enrich.with_creators(posts, people, hot=keys)) == want
