"""The creator history in buckets, of which a run reads and writes only those that it touches.

A run's folder holds the buckets that changed, and a small file that says in which run's folder
each bucket was written last; folders of earlier runs are read and never changed. Bucket and key
depend on the name alone, so buckets are loaded independently of each other.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidmart import schemas
from vidmart.sources.staging import LAYOUT, exists, read_staged, read_text, remove, write_text

BUCKETS = 64
POINTERS = "_buckets.json"


def bucket(name: str = "creator_nk") -> Column:
    return F.pmod(F.xxhash64(name), F.lit(BUCKETS)).cast("int")


def numbers(rows: DataFrame, name: str = "creator_nk") -> list[int]:
    """The buckets that rows fall in, at most BUCKETS."""
    return sorted(r[0] for r in rows.select(bucket(name)).distinct().collect())


def _layout(spark: SparkSession, folder: str) -> dict | None:
    text = read_text(spark, f"{folder}/{POINTERS}")
    return None if text is None else json.loads(text)


def read(spark: SparkSession, folder: str, only: Iterable[int] | None = None) -> DataFrame:
    """The dimension as the run of ``folder`` left it, or some of its buckets. A folder without
    buckets is a plain table."""
    layout = _layout(spark, folder)
    if layout is None:
        whole = read_staged(spark, folder, schemas.DIM_CREATOR)
        return whole if only is None else whole.where(bucket().isin(list(only)))
    wanted = layout["folders"].items() if only is None else [(str(b), layout["folders"].get(str(b))) for b in only]
    paths = [f"{at}/bucket={b}" for b, at in wanted if at]
    if not paths:
        return spark.createDataFrame([], schemas.DIM_CREATOR)
    return spark.read.schema(schemas.DIM_CREATOR).parquet(*paths)


def last_key(spark: SparkSession, folder: str) -> int:
    """The largest surrogate key given so far."""
    layout = _layout(spark, folder)
    if layout is not None:
        return layout["last_key"]
    return read_staged(spark, folder, schemas.DIM_CREATOR).agg(F.coalesce(F.max("creator_sk"), F.lit(0))).first()[0]


def newest(spark: SparkSession, folder: str):
    """The day of the newest version, as text; None without any."""
    layout = _layout(spark, folder)
    if layout is not None:
        return layout["newest"]
    day = read_staged(spark, folder, schemas.DIM_CREATOR).agg(F.max("valid_from")).first()[0]
    return None if day is None else str(day)


def parted(spark: SparkSession, folder: str) -> bool:
    return _layout(spark, folder) is not None


def write(
    versions: DataFrame, folder: str, previous: str | None, changed: Iterable[int], last: int, as_of: str
) -> None:
    """Write the ``changed`` buckets of ``versions``; the others stay where ``previous`` has them.

    ``versions`` holds every version of those buckets. A previous table without buckets is
    written whole, so ``changed`` must name all its buckets then.
    """
    spark, changed = versions.sparkSession, sorted(changed)
    old = (_layout(spark, previous) if previous else None) or {"folders": {}}
    if changed:
        rows = versions.withColumn("bucket", bucket()).where(F.col("bucket").isin(changed))
        rows.hint("rebalance", F.col("bucket")).write.mode("overwrite").options(**LAYOUT).partitionBy("bucket").parquet(folder)
    else:
        remove(spark, folder)
    kept = {b for b in changed if exists(spark, f"{folder}/bucket={b}")}
    folders = old["folders"] | {str(b): folder for b in kept}
    days = [d for d in (old.get("newest"), as_of if changed else None) if d]
    body = {"folders": folders, "last_key": last, "newest": max(days, default=None)}
    write_text(spark, f"{folder}/{POINTERS}", json.dumps(body, indent=1, sort_keys=True))
