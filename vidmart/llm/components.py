"""Connected components of a large graph, each node labelled with its least member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidmart.llm.tables import cut


def _star(edges: DataFrame, large: bool, name: str) -> DataFrame:
    """Hang neighbours of each node on the least of them and itself.

    Minima are summed up before they are joined back, so a node with very many neighbours is
    a hot key of a join that can be split, not a group in one task.
    """
    if large:  # both directions; larger neighbours go to the least
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # every node with its smaller neighbours
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = cut(least.select("u", F.least("u", "m").alias("m")), f"{name}-least")
    met = both.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select("v", "m").unionByName(met.select(F.col("u").alias("v"), "m")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
    return cut(out.where("u <> v").distinct(), name)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every u hangs on one smaller v that hangs on nothing, so that nothing can change."""
    ends = edges.select("u", F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("up")))
    seen = ends.groupBy("u").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return seen.where("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node and least, the smallest node it is connected with, for every node of an edge (u, v).

    Alternates large and small stars until all edges are stars; each round at least halves the
    distance in a chain, and is written to the shared folder. Stars are not worked on again.
    """
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    while not _are_stars(now):
        now = _star(_star(now, True, "cc-large"), False, "cc-small")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("least"))
    return stars.unionByName(stars.select(F.col("least").alias("node"), "least").distinct())
