"""Date, music, hashtag and brand-safety tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidmart import schemas
from vidmart.functions import measures
from vidmart.operators.keys import Cut, assign_keys, no_cut

# Calendar range, and the lookup of safety states.
DATE_RANGE = (date(2019, 1, 1), date(2027, 12, 31))
BRAND_SAFETY_ROWS = (
    (1, "Safe for all advertisers and general audience", "Eligible"),
    (0, "Sensitive content, restricted audience", "Not Eligible"),
)


def date_table(
    spark: SparkSession,
    start: date = DATE_RANGE[0],
    end: date = DATE_RANGE[1],
    holidays: DataFrame | None = None,
) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    days = spark.range((end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date")
    )
    return _calendar(days, holidays)


def date_table_for(
    rows: DataFrame, posted: Column, holidays: DataFrame | None = None
) -> DataFrame:
    """One row per day of every calendar year the data touches."""
    span = rows.agg(F.min(posted).alias("lo"), F.max(posted).alias("hi"))
    days = span.select(
        F.explode(
            F.sequence(
                F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
                F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
            )
        ).alias("full_date")
    )
    return _calendar(days, holidays)


def date_table_covering(
    rows: DataFrame,
    posted: Column,
    start: date = DATE_RANGE[0],
    end: date = DATE_RANGE[1],
    holidays: DataFrame | None = None,
) -> DataFrame:
    """One row per day from ``start`` to ``end`` and of every other calendar year up to the
    first and the last that the data touches, so that no dated row lacks its day."""
    span = rows.agg(F.min(posted).alias("lo"), F.max(posted).alias("hi"))
    days = span.select(
        F.explode(
            F.sequence(
                F.least(F.lit(start), F.make_date(F.year("lo"), F.lit(1), F.lit(1))),
                F.greatest(F.lit(end), F.make_date(F.year("hi"), F.lit(12), F.lit(31))),
            )
        ).alias("full_date")
    )
    return _calendar(days, holidays)


def _calendar(days: DataFrame, holidays: DataFrame | None) -> DataFrame:
    """Week numbers are ISO; ``day_of_week`` counts from 1 = Monday to 7 = Sunday."""
    if holidays is None:
        days = days.withColumn("holiday_name", F.lit(None).cast("string"))
    else:
        named = holidays.groupBy("full_date").agg(F.min("holiday_name").alias("holiday_name"))
        days = days.join(named, "full_date", "left")
    d = F.col("full_date")
    out = days.withColumns(
        {
            "date_id": measures.date_key(d),
            "year": F.year(d),
            "quarter": F.quarter(d),
            "month": F.month(d),
            "month_name": F.date_format(d, "MMMM"),
            "week_of_year": F.weekofyear(d),
            "day_of_week": F.weekday(d) + 1,
            "day_name": F.date_format(d, "EEEE"),
            "is_weekend": F.weekday(d) >= 5,
            "is_holiday": F.col("holiday_name").isNotNull(),
        }
    )
    return schemas.conform(out, schemas.DIM_DATE)


def music_table(raw_videos: DataFrame, cut: Cut = no_cut) -> DataFrame:
    """One row per (name, author) of the raw videos, NULL and empty counting as equal.

    Original if any post says so. Posts are grouped by the names as they are first, by hashing: the
    maximum of a text, which tells NULL from empty, would sort every post. That combines in the
    map tasks, so a sound that a third of all posts use is no burden.
    """
    name, author = F.col("musicMeta_musicName"), F.col("musicMeta_musicAuthor")
    named = raw_videos.groupBy(name, author).agg(
        F.max("musicMeta_musicOriginal").alias("musicMeta_musicOriginal")
    )
    music = named.groupBy(
        F.coalesce(name, F.lit("")).alias("_name"), F.coalesce(author, F.lit("")).alias("_author")
    ).agg(
        F.max(name).alias("music_name"),
        F.max(author).alias("music_author"),
        measures.as_bool(F.max("musicMeta_musicOriginal")).alias("is_original"),
    )
    return schemas.conform(
        assign_keys(cut(music), ["_name", "_author"], "music_sk"), schemas.DIM_MUSIC
    )


def hashtag_table(taxonomy: DataFrame) -> DataFrame:
    """The clean taxonomy with the safety flag as a boolean, one row per id."""
    safe = F.coalesce(F.col("is_brand_safe") == 1, F.lit(False))
    rows = taxonomy.withColumn("is_brand_safe", safe)
    columns = [f.name for f in schemas.struct(schemas.DIM_HASHTAG).fields]
    first = F.min(F.struct(*columns[1:])).alias("r")
    return rows.groupBy("hashtag_id").agg(first).select("hashtag_id", "r.*")


def brand_safety_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(BRAND_SAFETY_ROWS), schemas.BRAND_SAFETY)
