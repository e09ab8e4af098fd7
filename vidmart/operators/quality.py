"""Checks: each is one aggregation, not one job per rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidmart.functions.measures import exact_mean
from vidmart.schemas import LENGTHS, VOLUME_TIERS


def validate(df: DataFrame) -> DataFrame:
    """One row: counts of what must be zero in the joined video table, and the verdict."""
    bad_plays = F.col("playCount").isNull() | (F.col("playCount") <= 0)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("video_id").isNull()).alias("null_video_id"),
        F.count_if(bad_plays).alias("invalid_play_count"),
        F.count_if(F.col("engagement_rate") < 0).alias("negative_engagement_rate"),
    )
    bad = F.col("null_video_id") + F.col("invalid_play_count") + F.col("negative_engagement_rate")
    return counts.withColumn("passed", bad == 0)


def length_rules(table: str) -> dict[str, Column]:
    return {
        f"{c} longer than {n}": F.coalesce(F.length(c) <= n, F.lit(True))
        for c, n in LENGTHS[table].items()
    }


def taxonomy_rules() -> dict[str, Column]:
    """Declared constraints of the taxonomy; NULL passes a value-set check, as in SQL."""
    rules = {f"{c} is null": F.col(c).isNotNull() for c in ("hashtag_id", "hashtag", "category")}
    rules["is_brand_safe not 0 or 1"] = F.coalesce(
        F.col("is_brand_safe").isin(0, 1), F.lit(True)
    )
    rules["search_volume_tier unknown"] = F.coalesce(
        F.col("search_volume_tier").isin(*VOLUME_TIERS), F.lit(True)
    )
    return rules | length_rules("taxonomy")


def check_constraints(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` plus ``violations``, the names of the rules a row breaks (empty if none)."""
    broken = [F.when(~ok, F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def split_by_constraints(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and quarantined rows with their reasons."""
    checked = check_constraints(df, rules)
    good = checked.where(F.size("violations") == 0).drop("violations")
    return good, checked.where(F.size("violations") > 0)


def violation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations) with one row per rule, zero included, from one pass."""
    counts = df.agg(*[F.count_if(~ok).alias(name) for name, ok in rules.items()])
    return _unpivot(counts, "rule", "violations")


def unfit_values(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """(column_name, unfit_rows): values a load would lose because they do not fit the declared
    type of their table column; one pass, zero included.
    """
    counts = df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"{c} as {t}")
            for c, t in types.items()
        ]
    )
    return _unpivot(counts, "column_name", "unfit_rows")


def _unpivot(row: DataFrame, name: str, value: str) -> DataFrame:
    return row.unpivot([], [F.col(f"`{c}`") for c in row.columns], name, value)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; NULL keys do not count."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique_check(table: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many keys are repeated and how many rows have a NULL in the key."""
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.withColumn("_null", null).groupBy(*keys, "_null").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_key.agg(
        F.count_if(~F.col("_null") & (F.col("n") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("n"))), F.lit(0)).alias("null_keys"),
    ).select(F.lit(f"{table}({', '.join(keys)})").alias("constraint_name"), "*")


def reference_check(
    child: DataFrame, column: str, parent: DataFrame, key: str, name: str
) -> DataFrame:
    """One row: distinct values and rows of ``child`` that ``parent`` lacks; NULL is allowed.

    The child is counted per value first, so a frequent value crosses the shuffle once per
    task and the anti join sees distinct values only.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(key))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    missing = values.join(parent.select(key), key, "left_anti")
    return missing.agg(
        F.count(F.lit(1)).alias("missing_values"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
    ).select(F.lit(name).alias("constraint_name"), "*")


def profile(
    df: DataFrame,
    numeric: tuple[str, ...] = (),
    ranges: tuple[str, ...] = (),
    distinct: tuple[str, ...] = (),
) -> DataFrame:
    """One row of source statistics: row count, mean and maximum, first and last, distinct."""
    aggs = [F.count(F.lit(1)).alias("records")]
    for c in numeric:
        aggs.append(exact_mean(F.sum(c), F.count(c), 0).alias(f"mean_{c}"))
        aggs.append(F.max(c).alias(f"max_{c}"))
    for c in ranges:
        aggs.append(F.min(c).alias(f"first_{c}"))
        aggs.append(F.max(c).alias(f"last_{c}"))
    for c in distinct:
        aggs.append(F.count_distinct(c).alias(f"distinct_{c}"))
    return df.agg(*aggs)


def value_shares(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, records, share_pct) per value of a column, of all rows; the ``top`` most
    frequent if given. The total sums the counts again, from the same shuffle.
    """
    value = F.col(column).cast("string").alias("value")
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("records"))
    total = counts.agg(F.sum("records")).scalar()
    out = counts.withColumn("share_pct", F.round(F.col("records") / total * 100, 1))
    if top is not None:
        out = out.orderBy(F.desc("records"), "value").limit(top)
    return out
