from datetime import date, datetime

from frames import comments, creators, rows, taxonomy, videos
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vidmart import schemas
from vidmart.operators import clean, dimensions, enrich, fact, features, keys, scd2

DAY1, DAY2, DAY3 = date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 3)
LOADED = datetime(2026, 1, 3, 19)


def day(spark, d):
    got = dimensions.date_table(spark).where(F.col("full_date") == F.lit(d))
    return tuple(got.first())[2:10]


def test_calendar(spark):
    table = dimensions.date_table(spark)
    assert table.count() == 3287
    layout = schemas.struct(schemas.DIM_DATE)
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in layout]
    assert day(spark, date(2027, 1, 1)) == (2027, 1, 1, "January", 53, 5, "Friday", False)
    assert day(spark, date(2024, 12, 30)) == (2024, 4, 12, "December", 1, 1, "Monday", False)
    assert day(spark, date(2024, 6, 2)) == (2024, 2, 6, "June", 22, 7, "Sunday", True)
    first = table.orderBy("date_id").first()
    assert (first.date_id, first.is_holiday, first.holiday_name) == (20190101, False, None)


def test_calendar_with_holidays(spark):
    named = spark.createDataFrame(
        [(date(2024, 12, 25), "Christmas"), (date(2024, 12, 25), "Xmas")], schemas.HOLIDAY
    )
    table = dimensions.date_table(spark, date(2024, 12, 24), date(2024, 12, 26), named)
    assert rows(table.select("date_id", "is_holiday", "holiday_name")) == [
        (20241224, False, None), (20241225, True, "Christmas"), (20241226, False, None),
    ]


def test_calendar_from_data(spark):
    df = spark.sql("select timestamp'2023-05-01 10:00:00' as t union all select null")
    table = dimensions.date_table_for(df, F.col("t"))
    assert table.count() == 365 and table.agg(F.min("date_id")).first()[0] == 20230101


def test_keys_are_dense_stable_and_continue(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(500)], "nk string")
    first = keys.assign_keys(names, ["nk"], "sk")
    assert sorted(r.sk for r in first.collect()) == list(range(1, 501))
    again = keys.assign_keys(names.repartition(13), ["nk"], "sk")
    assert rows(first) == rows(again)
    more = keys.assign_keys(names.withColumn("nk", F.concat("nk", F.lit("x"))), ["nk"], "sk", first)
    assert sorted(r.sk for r in more.collect()) == list(range(501, 1001))


def test_music(spark):
    df = videos(
        spark,
        {"musicMeta_musicOriginal": False},
        {"musicMeta_musicOriginal": True},
        {"musicMeta_musicAuthor": None, "musicMeta_musicOriginal": None},
        {"musicMeta_musicAuthor": "", "musicMeta_musicOriginal": None},
        {"musicMeta_musicName": None, "musicMeta_musicAuthor": None, "playCount": 0},
    )
    got = rows(dimensions.music_table(df).drop("music_sk"))
    assert got == [("song", "", False), ("song", "band", True), (None, None, True)]


def test_hashtags_table(spark):
    df = taxonomy(spark, {}, {"hashtag": "other"}, {"hashtag_id": "HT2", "is_brand_safe": None})
    got = dimensions.hashtag_table(df).select("hashtag_id", "hashtag", "is_brand_safe")
    assert rows(got) == [("HT1", "fun", True), ("HT2", "fun", False)]


def history(spark, *loads):
    dim = scd2.empty_dimension(spark)
    for as_of, people in loads:
        dim = scd2.scd2(dim, creators(spark, *people), as_of)
    return dim


def person(name, followers, **more):
    return {"username": name, "follower_count": followers, **more}


def versions(dim):
    return rows(dim.select("creator_nk", "follower_count", "valid_from", "valid_to", "is_current"))


def test_scd2_edges(spark):
    first = [
        person("same", 100), person("up", 100), person("down", 100), person("zero", 0),
        person("null", None), person("gone", 100), person("moved", 100), person("lost", 100),
    ]
    second = [
        person("same", 105), person("up", 106), person("down", 94), person("zero", 500),
        person("null", 500), person("moved", 100, country="US"), person("lost", None),
        person("new", 7),
    ]
    got = versions(history(spark, (DAY1, first), (DAY2, second)))
    assert got == sorted(
        [
            ("same", 100, DAY1, None, True),
            ("up", 100, DAY1, DAY2, False), ("up", 106, DAY2, None, True),
            ("down", 100, DAY1, DAY2, False), ("down", 94, DAY2, None, True),
            ("zero", 0, DAY1, None, True),
            ("null", 0, DAY1, None, True),
            ("gone", 100, DAY1, None, True),
            ("moved", 100, DAY1, None, True),
            ("lost", 100, DAY1, DAY2, False), ("lost", 0, DAY2, None, True),
            ("new", 7, DAY2, None, True),
        ],
        key=repr,
    )


def test_scd2_attributes_do_not_change_in_place(spark):
    dim = history(spark, (DAY1, [person("a", 100)]), (DAY2, [person("a", 101, country="US")]))
    assert rows(dim.select("country", "follower_count")) == [("ID", 100)]


def test_scd2_one_row_per_normalised_name(spark):
    dim = history(spark, (DAY1, [person("A", 5), person("a ", 9), person(None, 3)]))
    assert versions(dim) == [("a", 9, DAY1, None, True)]


def test_scd2_null_flags_and_counts(spark):
    dim = history(
        spark, (DAY1, [person("a", 5, is_verified=None, following_count=None)])
    )
    assert rows(dim.select("is_verified", "following_count")) == [(False, 0)]


load = st.dictionaries(st.sampled_from("abcde"), st.one_of(st.none(), st.integers(0, 120)),
                       min_size=1, max_size=5)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(load, min_size=1, max_size=3))
def test_scd2_invariants(spark, loads):
    dim, before = scd2.empty_dimension(spark), 0
    for i, people in enumerate(loads):
        df = creators(spark, *[person(n, f) for n, f in people.items()])
        as_of = date(2026, 1, i + 1)
        # Cut the growing plan, as a run that reads the previous table from files does.
        dim = spark.createDataFrame(
            scd2.scd2(dim, df, as_of).collect(), schemas.struct(schemas.DIM_CREATOR)
        )
        found = dim.collect()
        current = [r.creator_nk for r in found if r.is_current]
        assert len(current) == len(set(current)) and set(people) <= set(current)
        assert sorted(r.creator_sk for r in found) == list(range(1, len(found) + 1))
        assert len(found) >= before
        assert rows(scd2.scd2(dim, df, as_of)) == rows(dim)
        before = len(found)


def test_scd2_keys_stay(spark):
    one = history(spark, (DAY1, [person("a", 100), person("b", 100)]))
    two = scd2.scd2(one, creators(spark, person("a", 500), person("c", 1)), DAY2)
    old = {r.creator_nk: r.creator_sk for r in one.collect()}
    first = two.where(F.col("valid_from") == F.lit(DAY1))
    kept = {r.creator_nk: r.creator_sk for r in first.collect()}
    assert kept == old


def build(spark, posts, people=({},), remarks=({"video_id": "none"},)):
    raw = videos(spark, *posts)
    final = enrich.videos_final(
        features.video_features(clean.videos(raw)), clean.creators(creators(spark, *people)),
        clean.comments(comments(spark, *remarks)), clean.taxonomy(taxonomy(spark, {})),
    )
    # Cut the plans where a run would stage the rows.
    final = spark.createDataFrame(final.collect(), final.schema)
    dim_creator = scd2.scd2(scd2.empty_dimension(spark), creators(spark, *people), DAY1)
    music = dimensions.music_table(raw)
    dim_creator = spark.createDataFrame(dim_creator.collect(), dim_creator.schema)
    music = spark.createDataFrame(music.collect(), music.schema)
    return final, fact.fact_table(final, dim_creator, music, fact.run_id(LOADED), LOADED)


def test_fact_defaults(spark):
    post = {"diggCount": None, "videoMeta_duration": None, "text": None,
            "createTimeISO": None, "authorMeta_name": None}
    _, got = build(spark, [post], people=[person("none", 5)])
    r = got.first()
    assert (r.video_sk, r.creator_sk, r.date_id, r.like_count) == (1, None, None, 0)
    assert (r.video_duration_sec, r.engagement_rate, r.hashtag_count) == (0, None, 0)
    assert (r.total_comments_scraped, r.positive_comment_pct) == (0, None)
    assert (r.primary_category, r.pipeline_run_id) == ("Entertainment", "RUN_20260103_190000")
    assert str(r.loaded_at) == "2026-01-03 19:00:00"


def test_fact_lookups(spark):
    posts = [
        {"authorMeta_name": " ANN ", "webVideoUrl": "https://v/video/1",
         "musicMeta_musicAuthor": None},
        {"authorMeta_name": "bob", "webVideoUrl": "https://v/video/2",
         "musicMeta_musicAuthor": ""},
    ]
    _, got = build(spark, posts)
    by_id = {r.video_id: r for r in got.collect()}
    assert by_id["1"].creator_sk == 1 and by_id["2"].creator_sk is None
    assert by_id["1"].music_sk == by_id["2"].music_sk == 1
    assert by_id["1"].date_id == 20260501 and by_id["1"].post_hour == 17


def test_rate_too_large_for_its_column(spark):
    """The row is set aside, with the value."""
    posts = [{"playCount": 1, "diggCount": 500}, {"webVideoUrl": "https://v/video/2"}]
    final, got = build(spark, posts)
    assert [r.video_id for r in got.collect()] == ["2"]
    dims = [spark.createDataFrame([], schemas.DIM_CREATOR), spark.createDataFrame([], schemas.DIM_MUSIC)]
    aside = fact.rejected(fact.fact_rows(final, *dims, "R", LOADED)).collect()
    assert [(r.video_id, r.misfits) for r in aside] == [("1", ["engagement_rate=500.0 as decimal(8,6)"])]


def test_bridge(spark):
    posts = [{"text": "#fun #Fun #other"}, {"text": "#none", "webVideoUrl": "https://v/video/2"}]
    final, facts = build(spark, posts)
    pairs = enrich.bridge_pairs(final, taxonomy(spark, {}))
    extra = spark.createDataFrame([("404", "HT1")], "video_id string, hashtag_id string")
    got = rows(fact.bridge_table(facts, pairs.unionByName(extra)))
    sk = facts.where("video_id = '1'").first().video_sk
    assert got == [(sk, "HT1")]
