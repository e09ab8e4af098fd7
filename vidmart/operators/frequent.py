"""Frequent keys of a large table, from a summary that is collected while the table is staged.

``approx_top_k`` keeps a bounded number of items a task and merges them, so no second scan, shuffle
or sort is needed to learn which keys are frequent. The counts are estimates; ``lookup`` uses the
keys to split a join, which changes its speed and never its result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from vidmart.functions import text

# Every task's summary passes through the driver, where they are merged one by one: some 200 KB
# each, at most. A key beyond these holds about 1/KEYS of the rows or less, which AQE can split.
KEYS = 1_000
TRACKED = 4 * KEYS  # items that a task keeps
MARK = "\x1f"  # between the parts of a key


def summary(*parts: Column) -> Column:
    """Aggregate: the most frequent keys. Keys with a NULL part do not count."""
    key = F.concat_ws(MARK, *parts)
    whole = F.lit(True)
    for p in parts:
        whole = whole & p.isNotNull()
    return F.call_function("approx_top_k", F.when(whole, key), F.lit(KEYS), F.lit(TRACKED))


def of_videos() -> dict[str, Column]:
    """Summaries of what raw videos are looked up by: the author, and the name and author of a song."""
    return {
        "authors": summary(text.normal_key(F.col("authorMeta_name"))),
        "music": summary(
            F.coalesce("musicMeta_musicName", F.lit("")), F.coalesce("musicMeta_musicAuthor", F.lit(""))
        ),
    }


NAMES = {"authors": ("authorMeta_name",), "music": ("_name", "_author")}


def table(spark: SparkSession, kind: str, found: list[Row] | None) -> DataFrame:
    """The keys as rows, at most KEYS."""
    names = NAMES[kind]
    keys = [r["item"].split(MARK) for r in found or () if r["item"] is not None]
    rows = [tuple(k) for k in keys if len(k) == len(names)]  # a name that holds the mark is not split by
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
