"""Creator history: a new version when the follower count moves enough."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidmart import schemas
from vidmart.functions import measures, text
from vidmart.operators.clean import best_first, keep_first
from vidmart.operators.keys import Cut, assign_keys, no_cut


def empty_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.DIM_CREATOR)


def incoming_versions(profiles: DataFrame, as_of: date) -> DataFrame:
    """Profiles in the shape of new dimension rows, one per normalised username."""
    rows = profiles.withColumns(
        {
            "creator_nk": text.normal_key(F.col("username")),
            "follower_count": measures.zero_if_null(F.col("follower_count")),
            "following_count": measures.zero_if_null(F.col("following_count")),
            "total_videos": measures.zero_if_null(F.col("total_videos")),
            "is_verified": measures.as_bool(F.col("is_verified")),
            "valid_from": F.lit(as_of),
            "is_current": F.lit(True),
        }
    ).where(F.col("creator_nk").isNotNull())
    rows = schemas.conform(rows, schemas.DIM_CREATOR)
    return keep_first(rows, ["creator_nk"], best_first("follower_count", rows.columns))


def version_changes(
    old: DataFrame, profiles: DataFrame, as_of: date, threshold: float = measures.SCD2_CHANGE
) -> DataFrame:
    """Current versions after the load: kept, closed, and opened (``creator_sk`` NULL).

    One join of two sides that are unique on the name. A creator whose follower count moved
    by more than ``threshold`` gives two rows, the closed version and the opened one; other
    attributes alone change nothing; a creator missing from the load stays.
    """
    columns = old.columns
    current = old.where("is_current").select(F.col("creator_nk"), F.struct(*columns).alias("o"))
    new = incoming_versions(profiles, as_of).select(
        F.col("creator_nk"), F.struct(*columns).alias("n")
    )
    both = current.join(new, "creator_nk", "full_outer")
    moved = F.col("o").isNotNull() & F.col("n").isNotNull()
    moved = moved & measures.relative_change_exceeds(
        F.col("n.follower_count"), F.col("o.follower_count"), threshold
    )
    closed = (
        F.col("o")
        .withField("valid_to", F.when(moved, F.lit(as_of)).otherwise(F.col("o.valid_to")))
        .withField("is_current", ~moved)
    )
    versions = F.array(
        F.when(F.col("o").isNotNull(), closed),
        F.when(F.col("n").isNotNull() & (F.col("o").isNull() | moved), F.col("n")),
    )
    return both.select(F.inline(F.array_compact(versions)))


def scd2(
    old: DataFrame,
    profiles: DataFrame,
    as_of: date,
    threshold: float = measures.SCD2_CHANGE,
    cut: Cut = no_cut,
    last: int | None = None,
) -> DataFrame:
    """The whole dimension after one load: history, kept, closed and opened versions. ``last`` is the
    largest key given so far; without it ``old`` is all there is, and has it.

    A pure function of its inputs; the caller writes the result to a new path, never over the
    one being read. Running it again with the same profiles changes nothing.
    """
    rows = cut(version_changes(old, profiles, as_of, threshold))
    after = old if last is None else old.sparkSession.createDataFrame([(last,)], "creator_sk bigint")
    opened = assign_keys(
        rows.where("creator_sk is null").drop("creator_sk"), ["creator_nk"], "creator_sk", after
    )
    return schemas.conform(
        old.where("not is_current")
        .unionByName(rows.where("creator_sk is not null"))
        .unionByName(opened),
        schemas.DIM_CREATOR,
    )
