"""Shards of near equal bytes by a k-d tree over document metadata.

A node of the tree with several shards is split at the weighted median (for an odd number, at
the weighted quantile that leaves whole shards on both sides) along the dimension that is
widest in it. Cuts are found by narrowing a histogram: each pass sums bytes in at most
``BINS`` bins a node, for all nodes of a level together, and goes on inside the bin that
holds the median. Only the bins come to the driver. Documents with equal texts have equal
positions in all dimensions and differ in the last key alone, so a cut divides at most the one
group that lies on it, however large that group is.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidmart.llm.tables import cut, small_table

BINS = 4096
SHARDS = 24
TOP = 1 << 62
ROWS_A_BUCKET = 4000
DIMENSIONS = ("d_size", "d_lang", "d_source")
CLOSE = 1 / 1024  # of a shard: what may be left undecided at a cut


@dataclass
class Node:
    shards: int
    first: int
    weight: int = 0
    rows: int = 0
    spans: dict = field(default_factory=dict)
    dim: str = ""
    cut: tuple | None = None  # keys up to and including these go left
    low: "Node | None" = None
    high: "Node | None" = None


def _position(c: Column) -> Column:
    """0 to TOP - 1 from a hash, so that no histogram bin overflows."""
    return F.shiftrightunsigned(F.xxhash64(c), 2)


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the keys of the tree, without the text.

    Dimensions: size, language and source (names by hash). A group of equal texts has the least
    language and source of its rows.
    """
    names = set(docs.columns)
    pick = [
        F.col(n).cast("string").alias(n) if n in names else F.lit(None).cast("string").alias(n)
        for n in ("lang", "source")
    ]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 2).alias("g"),
        *pick,
    )
    groups = rows.groupBy("g").agg(F.min("lang").alias("g_lang"), F.min("source").alias("g_source"))
    return rows.join(groups, "g").select(
        "doc_id", "size", "text_crc32", "g",
        F.col("size").alias("d_size"),
        _position(F.col("g_lang")).alias("d_lang"),
        _position(F.col("g_source")).alias("d_source"),
        _position(F.struct("doc_id", "text_crc32")).alias("r"),
    )


def _go(node: Node) -> Column:
    """True for rows of the left child."""
    value, g, r = (F.col(c) for c in (node.dim, "g", "r"))
    v0, g0, r0 = node.cut
    return (value < v0) | ((value == v0) & ((g < g0) | ((g == g0) & (r <= r0))))


def _leaf(node: Node, name) -> Column:
    if node.cut is None:
        return F.lit(name(node))
    return F.when(_go(node), _leaf(node.low, name)).otherwise(_leaf(node.high, name))


STATE = "node int, dim int, level int, f0 bigint, f1 bigint, low bigint, high bigint, wide bigint"


def _bins(rows: DataFrame, searches: list[dict]) -> list:
    """Bytes in the bins of every search. The searches, one for a node, are a small table."""
    state = [
        (s["node"].first, DIMENSIONS.index(s["node"].dim) + 1, len(s["fixed"]), *(s["fixed"] + [0, 0])[:2],
         s["low"], s["high"], (s["high"] - s["low"]) // BINS + 1)
        for s in searches
    ]
    value = F.element_at(F.array(*DIMENSIONS), F.col("dim"))
    key = F.when(F.col("level") == 0, F.col("value")).when(F.col("level") == 1, F.col("g")).otherwise(F.col("r"))
    here = ((F.col("level") < 1) | (F.col("value") == F.col("f0"))) & ((F.col("level") < 2) | (F.col("g") == F.col("f1")))
    offset = F.col("key") - F.col("low")
    bin_ = F.round((offset - offset % F.col("wide")) / F.col("wide")).cast("bigint")
    return (
        rows.join(F.broadcast(small_table(rows.sparkSession, state, STATE)), "node")
        .withColumn("value", value)
        .withColumn("key", key)
        .where(here & F.col("key").between(F.col("low"), F.col("high")))
        .groupBy("node", bin_.alias("bin"))
        .agg(F.sum("size").alias("w"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        .collect()
    )


def _cuts(rows: DataFrame, nodes: list[Node], shard_bytes: float) -> None:
    """Find the cut of each of ``nodes``; ``rows`` have the number of their node."""
    open_ = [
        {
            "node": n, "fixed": [], "before": 0, "goal": n.weight * (n.shards // 2) / n.shards,
            "low": n.spans[n.dim][0], "high": n.spans[n.dim][1],
        }
        for n in nodes
    ]
    while open_:
        bins, left = _bins(rows, open_), []
        for s in open_:
            mine = sorted((b["bin"], b["w"], b["lo"], b["hi"]) for b in bins if b["node"] == s["node"].first)
            for _, w, lo, hi in mine:
                if s["before"] + w > s["goal"]:
                    break
                s["before"] += w
            if w > shard_bytes * CLOSE and lo < hi:
                s["low"], s["high"] = lo, hi
                left.append(s)
            elif w > shard_bytes * CLOSE and len(s["fixed"]) < 2:
                s["fixed"].append(lo)
                s["low"], s["high"] = 0, TOP - 1
                left.append(s)
            else:  # a bin of no weight or a single row: it goes to the nearer side
                take = s["goal"] - s["before"] > s["before"] + w - s["goal"]
                s["node"].cut = tuple([*s["fixed"], hi if take else lo - 1, TOP, TOP][:3])
        open_ = left


def grow(meta: DataFrame, shards: int) -> Node | None:
    """The tree for ``meta``; None without rows."""
    root = Node(shards, 0)
    level = [root]
    total = None
    while level:
        rows = meta.withColumn("node", _leaf(root, lambda n: n.first))
        stats = (
            rows.groupBy("node")
            .agg(
                F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"),
                *[f(d).alias(f"{d}_{k}") for d in DIMENSIONS for k, f in (("lo", F.min), ("hi", F.max))],
            )
            .collect()
        )
        if not stats:
            return None
        if total is None:
            total = stats[0]
            root.rows = total["n"]
        found = {s["node"]: s for s in stats}
        ready = []
        for n in level:
            if (s := found.get(n.first)) is None:
                continue
            n.weight = s["w"]
            n.spans = {d: (s[f"{d}_lo"], s[f"{d}_hi"]) for d in DIMENSIONS}
            share = {
                d: (s[f"{d}_hi"] - s[f"{d}_lo"]) / max(1, total[f"{d}_hi"] - total[f"{d}_lo"])
                for d in DIMENSIONS
            }
            n.dim = max(DIMENSIONS, key=lambda d: share[d])
            ready.append(n)
        _cuts(rows, ready, total["w"] / shards)
        level = []
        for n in ready:
            half = n.shards // 2
            n.low, n.high = Node(half, n.first), Node(n.shards - half, n.first + half)
            level += [c for c in (n.low, n.high) if c.shards > 1]
    return root


def numbered(rows: DataFrame, n_rows: int) -> DataFrame:
    """Slots 0, 1, 2, ... in every shard, in the order of a hash and the id.

    Rows are numbered inside buckets of some thousand rows, and the buckets' counts say where
    each begins.
    """
    buckets = max(1, min(1 << 20, n_rows // ROWS_A_BUCKET))
    rows = rows.withColumn("bucket", F.pmod(F.col("r"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("r", "doc_id", "g")
    return (
        rows.withColumn("i", F.row_number().over(inside))
        .join(starts, ["shard", "bucket"])
        .withColumn("slot", (F.col("start") + F.col("i") - 1).cast("bigint"))
    )


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 8), text_crc32, law, shard, slot and grown_shard.

    The law is ``bytes``: shards have near equal sizes, so grown_shard is null. Every row gets
    one place, rows without an id or text included; repeated rows are rows of their own. No
    rows give no rows. A tree needs several passes, so the metadata is written once.
    """
    meta = cut(metadata(docs), "shard-metadata")
    tree = grow(meta, shards)
    place = _leaf(tree, lambda n: n.first) if tree else F.lit(0)
    rows = numbered(meta.withColumn("shard", place.cast("int")), tree.rows if tree else 0)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
