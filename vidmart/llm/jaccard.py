"""Exact Jaccard join of documents over word shingles.

1. Every document becomes its set of 64-bit shingle hashes; equal sets are one class.
2. A document can only be linked if at least THRESHOLD of its shingles occur in others. The
   shingles of a slice of documents go to buckets as packed arrays, those that repeat inside
   the slice once; buckets send back how many of each document's shingles others have. The
   sets of documents that pass are kept.
3. Shingles are ordered by how many sets have them. Two linked sets of n shingles share at
   least k of the first n - ceil(THRESHOLD * n) + k. Each document chooses its own k: the
   dearer its shortest prefix, by the lengths of the lists it would meet, the more shingles it
   adds and the more it asks to be shared (the smaller k of a pair holds).
4. In each list the documents are first held against one of them, the least, then one chosen by
   a hash: each document is verified against the one it shares most lists with. Most groups
   become one component by that, whatever their size.
5. All pairs of a list that are still in different components are met once, at the first list
   they share, unless a bound on what they can share refutes them: their places in both sets,
   or what each shares with the document of step 4, where that is the same one. Pairs with
   enough shared lists are verified.

Verification compares whole sets in integers, so no link is lost and none is added.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidmart.llm.bytewords import mix, shingles, text_slices, words
from vidmart.llm.components import components
from vidmart.llm.tables import cut, width
from vidmart.session import bound_batches

WORDS = 5
THRESHOLD = 75  # per cent
SLICE = 2 << 20  # bytes of text packed together; a task's arrays take some 30 times that
BEFORE = 16  # earlier lists that a posting remembers; a pair met at one of them is not met again
PACKED = "bucket bigint, batch bigint, sizes binary, tokens binary, many binary, docs binary"


def needed(n):
    """Shingles that a partner of a set of n must share: ceil(n * THRESHOLD / 100)."""
    return (n * THRESHOLD + 99) // 100


def _sets(column: pa.Array):
    """(first row, bounds, sorted distinct hashes) of slices of texts."""
    for first, data, offsets in text_slices(column, SLICE):
        n_rows = len(offsets) - 1
        hashes, rows = words(data, offsets)
        keys, bounds = shingles(hashes, rows, n_rows, WORDS)
        yield first, bounds, keys


def _digests(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set, independent of order."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(keys + np.uint64(salt)), dtype=np.uint64)])
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).where("doc_id is not null").withColumn("h", F.xxhash64("text"))


def described(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), n (size of the set), d1 and d2 (its hashes) and common: shingles that
    some other document has, or a few more where 32-bit keys of a bucket meet. One row for each text of
    an id."""
    spark = docs.sparkSession
    buckets = 4 * width(spark)

    def pack(batches):
        task, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            for first, bounds, keys in _sets(batch.column(1)):
                n_rows = len(bounds) - 1
                sizes = np.diff(bounds)
                of = np.repeat(np.arange(n_rows), sizes)
                own, h = ids[first : first + n_rows], texts[first : first + n_rows]
                d1, d2 = _digests(keys, bounds)
                order = np.argsort(keys, kind="stable")
                same = keys[order][1:] == keys[order][:-1]
                shared = np.zeros(len(keys), bool)
                shared[order[1:][same]] = True
                shared[order[:-1][same]] = True
                local = np.bincount(of[shared], minlength=n_rows)
                batch_id = task << 32 | nth  # slices with the same ids and texts stay apart
                nth += 1
                table = np.stack([own, h, sizes, d1, d2, local], 1).astype(np.int64)
                out = [(-1 - batch_id % buckets, batch_id, b"", b"", b"", table.tobytes())]
                bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                short = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                once = np.flatnonzero(~shared)
                once = once[np.argsort(bucket[once], kind="stable")]  # by bucket, then document
                edges = np.searchsorted(bucket[once], np.arange(buckets + 1))
                lead = order[:-1][same]
                lead = lead[np.argsort(bucket[lead], kind="stable")]
                lead_edges = np.searchsorted(bucket[lead], np.arange(buckets + 1))
                for b in range(buckets):
                    part, more = once[edges[b] : edges[b + 1]], lead[lead_edges[b] : lead_edges[b + 1]]
                    if len(part) or len(more):
                        out.append((
                            b, batch_id, np.bincount(of[part], minlength=n_rows).astype(np.uint32).tobytes(),
                            short[part].tobytes(), np.unique(short[more]).tobytes(), b"",
                        ))
                cols = list(zip(*out))
                kinds = [pa.int64()] * 2 + [pa.binary()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                    names=["bucket", "batch", "sizes", "tokens", "many", "docs"],
                )

    def count(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """For each slice, the documents with hits and their numbers, packed; its table as it came."""
        if key[0] < 0:
            return pd.DataFrame({"batch": group["batch"], "hits": [b""] * len(group), "docs": group["docs"]})
        tokens = [np.frombuffer(x, np.uint32) for x in group["tokens"]]
        many = [np.frombuffer(x, np.uint32) for x in group["many"]]
        flat = np.concatenate(tokens)
        every = np.concatenate([flat, *many])
        order = np.argsort(every, kind="stable")
        same = every[order][1:] == every[order][:-1]
        dup = np.zeros(len(every), bool)
        dup[order[1:][same]] = True
        dup[order[:-1][same]] = True
        out, at = [], 0
        for batch, packed, t in zip(group["batch"], group["sizes"], tokens):
            per = np.frombuffer(packed, np.uint32)
            of = np.repeat(np.arange(len(per)), per)
            hits = np.bincount(of[dup[at : at + len(t)]], minlength=len(per))
            at += len(t)
            row = np.flatnonzero(hits)
            if len(row):
                out.append((batch, np.stack([row, hits[row]]).astype(np.uint32).tobytes()))
        return pd.DataFrame({"batch": [x for x, _ in out], "hits": [x for _, x in out], "docs": [b""] * len(out)})

    def total(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """The documents of a slice with the hits of all buckets added to its own."""
        table = np.frombuffer(max(group["docs"], key=len), np.int64).reshape(-1, 6).copy()
        for packed in group["hits"]:
            row, hits = np.frombuffer(packed, np.uint32).reshape(2, -1)
            table[row, 5] += hits
        return pd.DataFrame(table, columns=["doc_id", "h", "n", "d1", "d2", "common"])

    packed = _rows(docs).mapInArrow(pack, PACKED)
    counted = packed.groupBy("bucket").applyInPandas(count, "batch bigint, hits binary, docs binary")
    schema = "doc_id bigint, h bigint, n bigint, d1 bigint, d2 bigint, common bigint"
    rows = counted.groupBy("batch").applyInPandas(total, schema)
    # rows that repeat an id and a text count once
    return cut(rows.groupBy("doc_id", "h", "n", "d1", "d2").agg(F.max("common").alias("common")), "join-described")


def token_sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """rep, o (the id), n and tokens (sorted) of the documents in ``chosen`` (rep, doc_id, h, n, d1, d2).
    Of rows that repeat an id and a text one will do."""

    def run(batches):
        for batch in batches:
            rep, o, n, d1, d2 = (batch.column(k).to_numpy() for k in range(5))
            for first, bounds, keys in _sets(batch.column(5)):
                at = np.arange(first, first + len(bounds) - 1)
                h1, h2 = _digests(keys, bounds)
                sizes = np.diff(bounds)
                ok = (sizes == n[at]) & (h1 == d1[at]) & (h2 == d2[at])
                flat = keys.view(np.int64)[np.repeat(ok, sizes)]
                ends = np.concatenate([[0], np.cumsum(sizes[ok])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[at][ok]), pa.array(o[at][ok]), pa.array(n[at][ok].astype(np.int32)), lists],
                    names=["rep", "o", "n", "tokens"],
                )

    met = _rows(docs).join(chosen, ["doc_id", "h"])
    return cut(
        met.select("rep", F.col("doc_id").alias("o"), "n", "d1", "d2", "text").mapInArrow(
            run, "rep bigint, o bigint, n int, tokens array<bigint>"
        ),
        "join-tokens",
    )


def postings(sets: DataFrame) -> DataFrame:
    """tok, rep, o, n, k, place and m: the lists that each set's prefix is in, how many it asks to
    share, where in the set's order the list is, and how many shingles others have too."""
    flat = sets.select("rep", "o", "n", F.explode("tokens").alias("tok"))
    often = cut(flat.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "join-df")
    lists = (
        flat.join(often, "tok")
        .groupBy("rep", "o", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("own"))
    )
    least = F.floor((F.col("n") * THRESHOLD + 99) / 100).cast("int")
    base = (F.size("own") - least + 1).alias("base")  # shingles of one set alone come first
    short = lists.select("rep", "o", "n", "own", F.size("own").alias("m"), base, least.alias("least")).where("base > 0")
    first = F.greatest(F.col("base"), F.lit(0))  # also where a filter above runs later
    cost = F.aggregate(F.slice("own", 1, first), F.lit(0).cast("bigint"), lambda a, x: a + x["df"] - 1)
    k = F.least(F.col("least"), 1 + F.floor(F.log2(1 + cost / F.greatest(F.col("base"), F.lit(1)))).cast("int"))
    chosen = short.withColumn("k", k).withColumn("own", F.slice("own", 1, F.greatest(F.col("base") + F.col("k") - 1, F.lit(0))))
    flat = chosen.select(F.posexplode("own.tok").alias("place", "tok"), "rep", "o", "n", "k", "m")
    return cut(flat.select("tok", "rep", "o", "n", "k", "place", "m"), "join-postings")


def _near(n: Column, m: Column) -> Column:
    """Sizes that allow a link at all."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * THRESHOLD


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) with the number of shingles in both, and whether that makes a link."""
    a = sets.select(F.col("rep").alias("u"), F.col("tokens").alias("a"))
    b = sets.select(F.col("rep").alias("v"), F.col("tokens").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    linked = F.col("both") * 100 >= (F.size("a") + F.size("b") - F.col("both")) * THRESHOLD
    met = pairs.select("u", "v").join(a, "u").join(b, "v").withColumn("both", both)
    return met.select("u", "v", "both", linked.alias("linked"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough."""
    return compared(pairs, sets).where("linked").select("u", "v")


def _joined_up(label: DataFrame | None, more: DataFrame, name: str) -> DataFrame:
    """Components by node of the links ``more`` and of those that gave ``label``, whose stars stand for
    them; ``label`` itself if there are no more."""
    if label is not None:
        if more.isEmpty():
            return label
        more = more.select("u", "v").unionByName(label.select(F.col("node").alias("u"), F.col("least").alias("v")))
    return cut(components(more), name)


def _labelled(lists: DataFrame, label: DataFrame) -> DataFrame:
    """Postings with their component so far, of lists that still hold several."""
    rows = (
        lists.join(label.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("comp", F.coalesce("least", "rep")).drop("least")
    )
    open_ = (
        rows.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        .where("lo < hi").select("tok")
    )
    return cut(rows.join(cut(open_, "join-open"), "tok", "left_semi"), "join-labelled")


def _against_one(lists: DataFrame, by: Column, name: str) -> DataFrame:
    """Each document with the one of its lists' heads that it shares most lists with. The head
    of a list is the document with the least ``by``; heads in its own component do not count."""
    heads = cut(
        lists.groupBy("tok").agg(F.min(F.struct(by.alias("by"), "rep", "comp", "n", "k")).alias("h"), F.count(F.lit(1)).alias("c"))
        .where("c > 1").select("tok", F.col("h.rep").alias("v"), F.col("h.comp").alias("vc"), F.col("h.n").alias("vn"), F.col("h.k").alias("vk")),
        f"join-heads-{name}",
    )
    met = lists.join(heads, "tok").where((F.col("comp") != F.col("vc")) & _near(F.col("n"), F.col("vn")))
    votes = met.groupBy("rep", "v").agg(F.count(F.lit(1)).alias("votes"), F.min(F.least("k", "vk")).alias("k")).where("votes >= k")
    best = votes.groupBy("rep").agg(F.max(F.struct("votes", "v")).alias("b"))
    return cut(best.select(F.col("rep").alias("u"), F.col("b.v").alias("v")), f"join-pairs-{name}")


def _possible() -> Column:
    """False for pairs a, b of one list that cannot be linked.

    What two sets share is at most what both have before this list and from it on; and, for the
    document both were held against, what both share with it and what both have besides.
    """
    def bound(x: str, rest: Column, other: Column) -> Column:
        return F.least(f"a_{x}", f"b_{x}") + F.least(rest, other)

    ask = (F.col("a_n") + F.col("b_n")) * THRESHOLD  # of a link: shared * (100 + THRESHOLD) at least
    here = bound("place", F.col("a_m") - F.col("a_place"), F.col("b_m") - F.col("b_place"))
    by_head = bound("both", F.col("a_m") - F.col("a_both"), F.col("b_m") - F.col("b_both"))
    refuted = (F.col("a_v") == F.col("b_v")) & (by_head * (100 + THRESHOLD) < ask)
    return (here * (100 + THRESHOLD) >= ask) & ~F.coalesce(refuted, F.lit(False))


def _all_left(lists: DataFrame, heads: DataFrame) -> DataFrame:
    """Pairs of different components that share enough lists and that no bound refutes.

    ``heads`` has what a document u shares (both) with the one it was held against (v). A row of
    the join goes if the two meet in one of the BEFORE lists before it, so the first list that
    they share always stays.
    """
    earlier = Window.partitionBy("rep").orderBy("place").rowsBetween(-BEFORE, -1)
    rows = cut(
        lists.join(heads.select(F.col("u").alias("rep"), "v", "both"), "rep", "left")
        .withColumn("earlier", F.collect_list("tok").over(earlier)),
        "join-open-rows",
    )
    names = ("rep", "comp", "n", "m", "place", "v", "both", "earlier")
    a, b = (rows.select("tok", *[F.col(c).alias(f"{side}_{c}") for c in names]) for side in "ab")
    new = ~F.arrays_overlap("a_earlier", "b_earlier")
    met = a.join(b, "tok").where(
        (F.col("a_comp") < F.col("b_comp")) & _near(F.col("a_n"), F.col("b_n")) & _possible() & new
    )
    pairs = met.select(F.col("a_rep").alias("u"), F.col("b_rep").alias("v")).distinct()
    own = lists.groupBy("rep").agg(F.collect_list("tok").alias("own"), F.min("k").alias("k"))
    u, v = (own.select(F.col("rep").alias(s), F.col("own").alias(f"{s}_own"), F.col("k").alias(f"{s}_k")) for s in "uv")
    votes = F.size(F.array_intersect("u_own", "v_own"))
    return pairs.join(u, "u").join(v, "v").where(votes >= F.least("u_k", "v_k")).select("u", "v")


def linked(sets: DataFrame) -> DataFrame:
    """node and least of every set that has a link, the least set that its links reach."""
    lists = postings(sets)
    heads = cut(compared(_against_one(lists.withColumn("comp", F.col("rep")), F.col("o"), "least"), sets), "join-links-1")
    label = _joined_up(None, heads.where("linked"), "join-components-1")
    more = _against_one(_labelled(lists, label), F.xxhash64("rep", "tok"), "hash")
    label = _joined_up(label, cut(verified(more, sets), "join-links-2"), "join-components-2")
    rest = cut(_all_left(_labelled(lists, label), heads), "join-rest")
    return _joined_up(label, cut(verified(rest, sets), "join-links-3"), "join-components-3")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, h, n, and first: the least (doc_id, h) of the texts that its text reaches by links."""
    bound_batches(docs.sparkSession)
    docs_ = described(docs)
    classes = docs_.where("n > 0").groupBy("n", "d1", "d2").agg(
        F.min(F.struct("doc_id", "h")).alias("first"), F.max("common").alias("common")
    )
    # The written number of a class is its node: ids may repeat, and name several sets.
    classes = cut(classes.withColumn("rep", F.monotonically_increasing_id()), "join-classes")
    chosen = classes.where(F.col("common") * 100 >= F.col("n") * THRESHOLD)
    sets = token_sets(docs, chosen.select("rep", "first.*", "n", "d1", "d2"))
    label = linked(sets)
    known = cut(
        classes.join(label.withColumnRenamed("node", "rep"), "rep", "left").select("n", "d1", "d2", "first", "least"),
        "join-labels",
    )
    met = known.where("least is not null")
    least = met.groupBy("least").agg(F.min("first").alias("of_all"))
    met = met.drop("first").join(least, "least").select("n", "d1", "d2", F.col("of_all").alias("first"))
    known = known.where("least is null").select("n", "d1", "d2", "first").unionByName(met)
    own = F.struct("doc_id", "h")
    return docs_.join(known, ["n", "d1", "d2"], "left").select("doc_id", "h", "n", F.coalesce("first", own).alias("first"))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document with an id.

    component_id is the smallest doc_id reachable by links, itself included; two documents link
    when their sets have a Jaccard similarity of 0.75 or more. A text with fewer words than a
    shingle is one shingle; null and empty texts, and those without words, have none and link
    with nothing. Rows with a null id are left out; an id with several texts has one row, with
    the least of its texts' sizes and components.
    """
    rows = grouped(docs).select("doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"))
    return rows.groupBy("doc_id").agg(F.min("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))


def unique(docs: DataFrame) -> DataFrame:
    """One document of each component, the first by id, with its columns.

    A row goes if its own text is in a component with an earlier document; rows that share its id
    but not its text are judged by theirs. Rows that repeat an id and a text stay or go together.
    Rows without an id stay.
    """
    own = F.struct("doc_id", "h")
    others = grouped(docs).where(own != F.col("first")).select(F.col("doc_id").alias("other"), F.col("h").alias("other_h"))
    text = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(others, (docs["doc_id"].cast("bigint") == F.col("other")) & (text == F.col("other_h")), "left_anti")
