"""Dense surrogate keys without sorting the whole table in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows are numbered inside buckets named by this many hex digits of the key's md5: 65,536
# buckets of nearly equal size, as keys are unique.
BUCKET_DIGITS = 4

# Numbering reads its input twice, to count and to number. Builders of keyed tables therefore
# take a ``cut``, which may write the rows and return the written copy; a batch run stages
# them, and without it the rows are simply worked out twice.
Cut = Callable[[DataFrame], DataFrame]


def no_cut(df: DataFrame) -> DataFrame:
    return df


def bucket(keys: list[str]):
    return F.substring(F.md5(F.concat_ws("\x1f", *keys).cast("binary")), 1, BUCKET_DIGITS)


def assign_keys(
    df: DataFrame, keys: list[str], name: str, after: DataFrame | None = None
) -> DataFrame:
    """Add ``name`` = 1, 2, 3, ... to rows with unique, non-NULL ``keys``.

    ``after`` is a table that already has the column: numbering goes on from its maximum. The
    number depends only on the set of keys (bucket, then key order), never on partitioning,
    so a task run again after a lost executor gives the same numbers. Row counts per bucket,
    at most 65,536 rows, give each bucket its start.
    """
    rows = df.withColumn("_bucket", bucket(keys))
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    if after is not None:
        base = after.agg(F.coalesce(F.max(name), F.lit(0)).alias("n"))
        counts = counts.unionByName(base.select(F.lit("").alias("_bucket"), "n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_bucket").orderBy(*keys)
    return (
        rows.withColumn("_rn", F.row_number().over(inside))
        .join(F.broadcast(starts), "_bucket")
        .withColumn(name, (F.col("_start") + F.col("_rn")).cast("bigint"))
        .drop("_bucket", "_rn", "_start")
    )
