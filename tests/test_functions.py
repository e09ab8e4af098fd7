import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vidmart.functions import labels, measures, text


def one(spark, ddl, values, *columns):
    df = spark.createDataFrame([(v,) for v in values], f"x {ddl}")
    return [tuple(r) for r in df.select(*columns).collect()]


HASHTAGS = [
    ("Hi #Foo, #bar! x#no", ["foo", "bar"]),
    ("##A #", ["a"]),
    ("#!", [""]),
    ("##", [""]),
    ("#a#b", ["a#b"]),
    ("#X\t#x\n#Y?", ["x", "x", "y"]),
    (" #nb　#ideo", ["nb", "ideo"]),
    ("?#q", []),
    ("#.a.", ["a"]),
    (None, []),
    ("", []),
]


def test_hashtags(spark):
    got = one(spark, "string", [t for t, _ in HASHTAGS], text.hashtags(F.col("x")))
    assert [r[0] for r in got] == [want for _, want in HASHTAGS]


def plain_hashtags(caption):
    """The rule once more, in words of plain Python."""
    found = []
    for word in (caption or "").split():
        if word[0] == "#" and len(word) >= 2:
            while word.startswith("#"):
                word = word[1:]
            word = word.lower()
            while word and word[0] in ".,!?;:":
                word = word[1:]
            while word and word[-1] in ".,!?;:":
                word = word[:-1]
            found.append(word)
    return found


caption = st.text(
    alphabet=st.sampled_from(list("#aBÉß.,!?;: \t\n\x1c\x1f\x85  　日")), max_size=25
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(caption, min_size=20, max_size=60))
def test_hashtags_equal_plain_rule(spark, captions):
    got = one(spark, "string", captions, text.hashtags(F.col("x")))
    assert [r[0] for r in got] == [plain_hashtags(c) for c in captions]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(caption, min_size=20, max_size=60))
def test_strip_equals_python(spark, names):
    got = one(spark, "string", names, text.strip(F.col("x")))
    assert [r[0] for r in got] == [n.strip() for n in names]


def test_video_id(spark):
    urls = ["https://v/@a/video/12?x=1", "https://v/@a/live/12", "https://v/video/", None]
    assert [r[0] for r in one(spark, "string", urls, text.video_id(F.col("x")))] == [
        "12", None, None, None,
    ]


def test_scrub(spark):
    got = one(
        spark, "string", ["Café 日本 💯 it's ok!"], text.scrub(F.col("x")),
        text.scrub(F.col("x"), True),
    )
    assert got == [("Caf   its ok!", "Café 日本  its ok!")]


def test_duration_buckets(spark):
    seconds = [15, 16, 60, 61, 180, 181, None]
    got = one(
        spark, "bigint", seconds, labels.duration_bucket(F.col("x")),
        labels.duration_bucket(F.col("x"), report=True),
    )
    assert [r[0] for r in got] == [
        "short_15s", "medium_60s", "medium_60s", "long_3m", "long_3m", "extended", "extended",
    ]
    assert got[0][1] == "Short (<=15s)" and got[5][1] == "Extended (>3m)"


def test_tiers(spark):
    followers = [9999, 10000, 99999, 100000, 999999, 1000000, 9999999, 10000000, None]
    got = one(
        spark, "bigint", followers, labels.influencer_tier(F.col("x")),
        labels.influencer_tier(F.col("x"), numbered=True),
    )
    assert [r[0].split()[0] for r in got] == [
        "Nano", "Micro", "Micro", "Mid", "Mid", "Macro", "Macro", "Mega", "Mega",
    ]
    assert got[0][1] == "1. Nano (<10K)"


def test_sentiment_buckets(spark):
    got = one(
        spark, "double", [70.0, 69.99, 50.0, 30.0, 29.99], labels.sentiment_bucket(F.col("x"))
    )
    assert [r[0].split(" (")[0] for r in got] == [
        "Highly Positive", "Mostly Positive", "Mostly Positive", "Mixed", "Mostly Negative",
    ]


def test_small_labels(spark):
    got = one(
        spark, "boolean", [True, False], labels.music_kind(F.col("x")),
        labels.day_kind(F.col("x")), labels.holiday_kind(F.col("x")),
    )
    assert got == [
        ("Original", "Weekend", "Holiday"), ("Non-Original", "Weekday", "Regular Day"),
    ]
    assert one(spark, "int", [2026], labels.period(F.col("x"), F.lit(5))) == [("2026-05",)]


def test_viral(spark):
    got = one(spark, "bigint", [999_999, 1_000_000, None], measures.is_viral(F.col("x")))
    assert [r[0] for r in got] == [False, True, False]


def test_engagement_rate(spark):
    df = spark.createDataFrame(
        [(1, 2, 3, 7), (None, 2, 3, 7), (1, 1, 1, 0)], "l bigint, c bigint, s bigint, p bigint"
    )
    rate = measures.engagement_rate(F.col("l"), F.col("c"), F.col("s"), F.col("p"))
    assert [r[0] for r in df.select(rate).collect()] == [0.857143, None, None]


def test_exact_mean(spark):
    df = spark.createDataFrame(
        [(5, 2), (-5, 2), (10**18 + 1, 1), (7, 0), (None, 3)], "t bigint, n bigint"
    )
    got = [r[0] for r in df.select(measures.exact_mean(F.col("t"), F.col("n"), 0)).collect()]
    assert got == [3.0, -3.0, float(10**18 + 1), None, None]
    cents = spark.sql("select cast(1.005 as decimal(10,3)) as t, 1L as n")
    assert cents.select(measures.exact_mean(F.col("t"), F.col("n"), 2)).first()[0] == 1.01


def test_date_key(spark):
    df = spark.sql("select timestamp'2026-05-01 23:59:59' as a, cast(null as timestamp) as b")
    got = df.select(measures.date_key(F.col("a")), measures.date_key(F.col("b"))).first()
    assert tuple(got) == (20260501, None)


@pytest.mark.parametrize(
    "old,new,want",
    [(100, 105, False), (100, 106, True), (100, 95, False), (100, 94, True), (420, 441, False),
     (0, 500, False), (None, 500, False), (100, 0, True)],
)
def test_relative_change(spark, old, new, want):
    df = spark.createDataFrame([(old, new)], "o bigint, n bigint")
    got = df.select(measures.relative_change_exceeds(F.col("n"), F.col("o"), 0.05)).first()[0]
    assert got is want
