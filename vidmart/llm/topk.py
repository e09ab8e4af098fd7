"""Exact top-k inner products over integer vectors.

Vectors are rotated so that the first coordinates carry most of their length (the eigenvectors
of the sum of x x', i.e. the right singular vectors of the table) and dealt to bands by length,
bands to blocks by a hash of the row. Bands are met in rounds, the longest vectors first: a small share
of the table, then ever larger ones. After each round a query's k-th best score of all rounds so far is
written with it, and bounds what is left twice: a band whose longest vector times the query's
length is lower is never sent the query, and inside a block the partial sum over the first
coordinates plus the product of both remainders' lengths (Cauchy-Schwarz) has to reach it before a
score is worked out. Scores are exact integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidmart.llm.tables import cut

SCALE = 1024
BLOCK = 4096  # vectors, about, in a block of either side
ROUNDS = (1 / 64, 1 / 8)  # of the table, longest first, met by the end of each round but the last
BANDS = 2048  # classes of length at most
CHUNK = 512  # vectors scored between two updates of the bound
SLACK = 1e-9  # relative error allowed for in float bounds


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * component) as longs, where every component is finite.

    Rows without an id or a vector, or with a null, NaN or infinite component, are left out. Rows
    that repeat an id stay rows of their own; a vector without components is all zeros.
    """
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("embedding"))
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
        .select("vec_id", F.transform("embedding", lambda v: F.floor(v * scale)).alias("v"))
    )


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of longs, short ones filled up with zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def packed(ints: DataFrame, dim: int) -> DataFrame:
    """vec_id, vec (bytes of longs) and norm."""

    def run(batches):
        for b in batches:
            m = _matrix(b.column(1), dim)
            norm = np.sqrt((m.astype(np.float64) ** 2).sum(1))
            vec = pa.array([r.tobytes() for r in m], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), vec, pa.array(norm)], names=["vec_id", "vec", "norm"])

    return ints.mapInArrow(run, "vec_id bigint, vec binary, norm double")


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Orthonormal columns in descending order of the length they carry.

    Sums of products are added up in Spark; dim x dim numbers reach the driver.
    """

    def run(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            m = np.frombuffer(b"".join(b.column(0).to_pylist()), np.int64).reshape(-1, dim)
            total += m.astype(np.float64).T @ m.astype(np.float64)
        i, j = np.indices((dim, dim))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.ravel()) for x in (i, j, total)], names=["i", "j", "s"]
        )

    sums = vectors.select("vec").mapInArrow(run, "i bigint, j bigint, s double")
    rows = sums.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    gram = np.zeros((dim, dim))
    for r in rows:
        gram[r["i"], r["j"]] = r["s"]
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of all pairs; exact through doubles where those suffice."""
    most = np.abs(q).max(initial=0) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = SCALE, block: int = BLOCK,
    worked_out: Accumulator | None = None,
) -> DataFrame:
    """For every row with ``is_query`` its k highest inner products with the other rows.

    query_id, rank from 1, vec_id, score; ties go to the smaller vec_id; a query with fewer than
    k others gets all of them. Rows that repeat an id are candidates, and queries, of their own.
    Vectors of different lengths are filled up with zeros. An empty table gives no rows. Products must
    fit in 64 bits. ``block`` is how many vectors a task holds of either side, about; to ``worked_out``
    the number of scores that no bound ruled out is added.
    """
    spark = vectors.sparkSession
    ints = cut(integers(vectors, scale), "topk-integers")
    facts = ints.agg(F.max(F.size("v")).alias("dim"), F.count(F.lit(1)).alias("n")).first()
    out = "query bigint, query_id bigint, row bigint, vec_id bigint, score bigint"
    if not facts["n"]:
        return _ranked(spark.createDataFrame([], out), k)
    dim, n = max(1, facts["dim"]), facts["n"]
    # numbered once and written, so the numbers hold whatever is run again
    rows = cut(packed(ints, dim).withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    turn = rotation(rows, dim)
    head = max(1, dim // 4)

    many = max(1, min(BANDS, n // block))
    edges = rows.agg(
        F.percentile_approx("norm", [i / many for i in range(1, many)] or [0.5], 100 * many).alias("e")
    ).first()["e"]
    edges = np.array(sorted(set(edges)) if many > 1 else [])
    shared = spark.sparkContext.broadcast((turn, edges))

    def banded(batches):
        """Band 0 holds the longest vectors."""
        edges = shared.value[1]
        for b in batches:
            band = len(edges) - np.searchsorted(edges, b.column(2).to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(band.astype(np.int64))], names=[*b.schema.names, "band"])

    layout = "vec_id bigint, vec binary, norm double, row bigint"
    rows = rows.mapInArrow(banded, f"{layout}, band bigint")
    counts = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("most")).orderBy("band").collect()
    # a crowd of equal lengths is one band, cut into parts by a hash of the row
    parts = {c["band"]: -(-c["n"] // block) for c in counts}
    sizes = spark.createDataFrame(list(parts.items()), "band bigint, parts bigint")  # BANDS rows at most
    queries = cut(rows.where(is_query).select("row", "vec_id", "vec", "norm"), "topk-queries")
    groups = max(1, -(-queries.count() // block))
    blocks = rows.join(F.broadcast(sizes), "band").select(
        "band",
        F.pmod(F.xxhash64("row"), "parts").alias("part"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("group"),
        "row", "vec_id", "vec", "norm",
    )

    def meet(_, xs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        turn = shared.value[0]
        names = ["query", "query_id", "row", "vec_id", "score"]
        empty = pd.DataFrame({name: [] for name in names}, dtype="int64")
        if xs.empty or qs.empty:
            return empty
        xs = xs.sort_values(["norm", "row"], ascending=[False, True])
        x = np.frombuffer(b"".join(xs["vec"]), np.int64).reshape(-1, dim)
        q = np.frombuffer(b"".join(qs["vec"]), np.int64).reshape(-1, dim)
        x_rows, q_rows, bound = xs["row"].to_numpy(), qs["query"].to_numpy(), qs["bound"].to_numpy().copy()
        xr, qr = x @ turn, q @ turn
        x_rest = np.sqrt((xr[:, head:] ** 2).sum(1))
        q_rest = np.sqrt((qr[:, head:] ** 2).sum(1))
        slack = 1e-6 + SLACK * np.sqrt((qr**2).sum(1)) * np.sqrt((xr**2).sum(1).max())
        at, to, scores = [], [], []
        best = np.full((len(q), k), -np.inf)
        for start in range(0, len(x), CHUNK):
            part = slice(start, start + CHUNK)
            most = qr[:, :head] @ xr[part, :head].T + q_rest[:, None] * x_rest[part] + slack[:, None]
            open_ = (most >= bound[:, None]) & (q_rows[:, None] != x_rows[part])
            rows_, cols = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
            if not len(rows_):
                continue
            if worked_out is not None:
                worked_out.add(int(open_.sum()))
            s = _scores(q[rows_], x[part][cols])
            use = open_[np.ix_(rows_, cols)] & (s >= bound[rows_, None])
            i, j = np.nonzero(use)
            at.append(rows_[i])
            to.append(cols[j] + start)
            scores.append(s[i, j])
            seen = np.concatenate([best[rows_], np.where(use, s, -np.inf)], 1)
            best[rows_] = -np.partition(-seen, k - 1, axis=1)[:, :k]
            bound = np.maximum(bound, best.min(1))
        if not at:
            return empty
        at, to = np.concatenate(at), np.concatenate(to)
        columns = [q_rows[at], qs["query_id"].to_numpy()[at], x_rows[to], xs["vec_id"].to_numpy()[to], np.concatenate(scores)]
        found = pd.DataFrame(dict(zip(names, columns, strict=True)))
        found = found.sort_values(["query", "score", "vec_id", "row"], ascending=[True, False, True, True])
        return found.groupby("query").head(k)

    found, keys = None, ["band", "part", "group"]
    for bands in _rounds({c["band"]: c["n"] for c in counts}):
        most = {c["band"]: c["most"] for c in counts if c["band"] in bands}
        bounded = queries.withColumn("bound", F.lit(float("-inf")))
        if found is not None:
            reached = found.groupBy("query").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("found"))
            reached = reached.where(F.col("found") >= k).select(F.col("query").alias("row"), "least")
            least = F.coalesce(F.col("least").cast("double"), F.lit(float("-inf")))
            bounded = queries.join(reached, "row", "left").withColumn("bound", least).drop("least")

        def routed(batches, most=most):
            """Each query with its bound, once for every block of this round that it has to meet."""
            for b in batches:
                norm, bound = b.column(2).to_numpy(), b.column(4).to_numpy()
                for band, longest in most.items():
                    meets = pa.array(np.flatnonzero(norm * longest * (1 + SLACK) + SLACK >= bound))
                    for p in range(parts[band]):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(meets), band)), pa.array(np.full(len(meets), p)),
                                *[b.column(c).take(meets) for c in (0, 1, 3, 4)],
                            ],
                            names=["band", "part", "query_id", "vec", "query", "bound"],
                        )

        sent = (
            bounded.select("vec_id", "vec", "norm", "row", "bound")
            .mapInArrow(routed, "band bigint, part bigint, query_id bigint, vec binary, query bigint, bound double")
            .withColumn("group", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("bigint"))
        )
        own = blocks.where(F.col("band").between(min(bands), max(bands)))
        new = own.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(meet, out)
        found = cut(_best(new if found is None else found.unionByName(new), k), "topk-found")
    return _ranked(found, k)


def _rounds(counts: dict[int, int]) -> list[list[int]]:
    """Bands in descending order of length, in rounds that end at the shares of ROUNDS."""
    total, done, out = sum(counts.values()), 0, [[]]
    left = list(ROUNDS)
    for band in sorted(counts):
        out[-1].append(band)
        done += counts[band]
        if left and done >= left[0] * total:
            left = [share for share in left if share * total > done]
            out.append([])
    return [bands for bands in out if bands]


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
