from frames import creators, rows, taxonomy
from pyspark.sql import functions as F

from vidmart.operators import quality


def test_validate(spark):
    df = spark.createDataFrame(
        [("1", 5, 0.1), (None, 5, 0.1), ("2", 0, 0.1), ("3", None, -1.0)],
        "video_id string, playCount bigint, engagement_rate double",
    )
    assert rows(quality.validate(df)) == [(4, 1, 2, 1, False)]
    assert quality.validate(df.where("video_id = '1'")).first().passed is True


def test_constraints(spark):
    df = taxonomy(
        spark,
        {},
        {"hashtag": None, "search_volume_tier": "huge"},
        {"is_brand_safe": 2},
        {"is_brand_safe": None, "search_volume_tier": None},
        {"content_rating": "x" * 11},
    )
    good, bad = quality.split_by_constraints(df, quality.taxonomy_rules())
    assert good.count() == 2
    assert rows(bad.select("violations")) == [
        (["content_rating longer than 10"],),
        (["hashtag is null", "search_volume_tier unknown"],),
        (["is_brand_safe not 0 or 1"],),
    ]
    counts = dict(rows(quality.violation_counts(df, quality.taxonomy_rules())))
    assert counts["hashtag is null"] == 1 and counts["category is null"] == 0
    assert len(counts) == 12


def test_keys(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "a"), (None, "a"), (None, "a")], "k int, x string"
    )
    assert rows(quality.duplicate_keys(df, ["k", "x"])) == [(1, "a", 2)]
    assert rows(quality.unique_check("t", df, ["k"])) == [("t(k)", 1, 2)]


def test_references(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (None,)], "fk int")
    parent = spark.createDataFrame([(2,)], "pk int")
    got = quality.reference_check(child, "fk", parent, "pk", "c")
    assert rows(got) == [("c", 2, 4)]
    assert rows(quality.reference_check(child.where("fk = 2"), "fk", parent, "pk", "c")) == [
        ("c", 0, 0)
    ]


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "2020", "a"), (2, "2021", "a"), (None, "2019", None)], "n bigint, t string, w string"
    )
    got = quality.profile(df, ("n",), ("t",), ("w",)).first().asDict()
    assert got == {"records": 3, "mean_n": 2.0, "max_n": 2, "first_t": "2019",
                   "last_t": "2021", "distinct_w": 1}


def test_value_shares(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    assert rows(quality.value_shares(df, "x")) == [("a", 2, 50.0), ("b", 1, 25.0), (None, 1, 25.0)]
    assert [r.value for r in quality.value_shares(df, "x", 1).collect()] == ["a"]


def test_published_profile_shares(spark):
    """37 verified of 221 is 16.7 percent."""
    df = creators(spark, *[{"is_verified": int(i < 37)} for i in range(221)])
    assert rows(quality.value_shares(df, "is_verified").where(F.col("value") == "1")) == [
        ("1", 37, 16.7)
    ]
