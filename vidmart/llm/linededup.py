"""Removal of line runs that an earlier text already has.

Texts are sequences of line ids. Lines that occur once break the sequences; the rest go through
prefix doubling: the rank of a suffix by its first 2h lines is its rank by its first h lines,
refined by the rank of the suffix that starts h lines on. A rank is the place where the suffix's
class begins in the suffix array, so a class at depth h is an interval of suffixes whose longest
common prefix is h lines or more; suffixes alone in their class leave. Then every suffix walks
down the same intervals, from the deepest doubling on, and takes as many lines as it still
shares an interval with an earlier suffix: the length of the longest run that begins there and
was seen before. Runs that are no part of a longer one and have enough words are deleted.

Every round counts ranks before it shuffles them, sums over counted rows instead of sorting
a class, and ends in a written table. A line that a third of all texts hold has as many counted
rows as it has different successors, whatever the number of its copies; these are dealt to
ranges of their own ranks, each summed apart, and the ranges' totals are summed by line, so that neither
sum takes more rows than about the square root of the number of places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidmart.llm.tables import cut

LEAST_WORDS = 50
BUCKET_BITS = 16
PLACE = ["did", "k", "pos"]


def _keyed(docs: DataFrame) -> DataFrame:
    """did and k name a text: its id (nulls first) and its hash. Rows equal in both are one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn(
        "did", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    ).withColumn("k", F.xxhash64(text))


BLANK = " \t\n\x0b\f\r"


def lines(docs: DataFrame, over_blank: bool = False) -> DataFrame:
    """One row for each line with words: its place, its number (at) among the lines of the text,
    two hashes and its words. With ``over_blank`` places count lines with words only."""
    own = F.transform(
        F.split(F.coalesce(F.col("text"), F.lit("")), "\n"),
        lambda x, i: F.struct(i.cast("int").alias("at"), x.alias("line")),
    )
    if over_blank:
        own = F.filter(own, lambda x: F.ltrim(x["line"], F.lit(BLANK)) != "")
    rows = _keyed(docs).select("did", "k", F.posexplode(own).alias("pos", "own")).select("did", "k", "pos", "own.*")
    if not over_blank:
        rows = rows.where(F.ltrim(F.col("line"), F.lit(BLANK)) != "")
    words = F.size(F.array_remove(F.split(F.translate("line", BLANK, " " * len(BLANK)), " "), ""))
    return rows.select(
        "did", "k", F.col("pos").cast("int").alias("pos"), "at",
        F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"),
        words.alias("words"),
    )


def repeated_lines(docs: DataFrame, over_blank: bool = False) -> DataFrame:
    """Places of lines with words that occur more than once, with rank r and their words.

    Ranks are places in the order of the lines' hashes: lines are counted in buckets of the
    first hash, and the buckets' totals, at most 65,536, say where each begins.
    """
    rows = lines(docs, over_blank)
    counted = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = cut(counted.withColumn("bucket", F.shiftrightunsigned("a", 64 - BUCKET_BITS)), "lines-counted")
    totals = counted.groupBy("bucket").agg(F.sum("n").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("bucket").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        counted.withColumn("lower", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(F.broadcast(starts), "bucket")
        .select("a", "b", (F.col("start") + F.col("lower")).alias("r"))
    )
    return rows.join(ranks, ["a", "b"]).select(*PLACE, "at", "words", "r").dropDuplicates(PLACE)


def _ahead(rows: DataFrame, other: DataFrame, by, names: dict[str, str]) -> DataFrame:
    """``rows`` with columns of the row ``by`` lines further in the same text; null if none."""
    there = other.select(
        F.col("did").alias("did2"), F.col("k").alias("k2"), F.col("pos").alias("pos2"),
        *[F.col(c).alias(n) for c, n in names.items()],
    )
    on = (F.col("did") == F.col("did2")) & (F.col("k") == F.col("k2")) & (F.col("pos") + by == F.col("pos2"))
    return rows.join(there, on, "left").drop("did2", "k2", "pos2")


def doubled(rows: DataFrame, h: int, beyond: int = 0) -> DataFrame:
    """Ranks by 2h lines of the places in ``rows``, which have ranks r by h lines; places alone
    in their class are left out. Ranks that agree but for the last ``beyond`` bits are summed in one task."""
    pairs = cut(
        _ahead(rows.select(*PLACE, "r"), rows, F.lit(h), {"r": "r2"}).where("r2 is not null"),
        f"lines-pairs-{h}",
    )
    counted = pairs.groupBy("r", "r2").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("range", F.shiftright("r2", beyond))
    inside = Window.partitionBy("r", "range").orderBy("r2").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("r").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.groupBy("r", "range").agg(F.sum("n").alias("n"))
        .select("r", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    ranks = (
        counted.withColumn("lower", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .where("n > 1")
        .join(starts, ["r", "range"])
        .select("r", "r2", (F.col("r") + F.col("start") + F.col("lower")).alias("rank"))
    )
    return pairs.join(ranks, ["r", "r2"]).select(*PLACE, F.col("rank").alias("r"))


def seen_before(first: DataFrame) -> DataFrame:
    """Places with length: lines of the longest run that begins there and begins earlier too.

    An interval is known by its depth (length) and two hashes (i, j) of the ranks that led to
    it. It holds all its suffixes as long as one of them still seeks in it. With each halving
    of the step, a seeker moves on to the interval of the suffixes that share a step's lines more
    if the first of those is not itself, and stays where it is if it is.
    """
    depths = [first]
    top = first.agg(F.max("r")).first()[0] or 0
    beyond = int(top).bit_length() // 2  # as many ranges as there are ranks in one
    while depths[-1].take(1):
        h = 1 << (len(depths) - 1)
        depths.append(cut(doubled(depths[-1], h, beyond), f"lines-rank-{2 * h}"))
    zero = F.lit(0).cast("bigint")
    state = first.select(*PLACE, F.lit(True).alias("seek"), F.lit(0).alias("length"), zero.alias("i"), zero.alias("j"))
    here, place = ["length", "i", "j"], F.struct(*PLACE)
    for d in range(len(depths) - 2, -1, -1):
        step = cut(_ahead(state, depths[d], F.col("length"), {"r": "r"}), f"lines-step-{d}")
        heads = cut(
            step.where("r is not null")
            .groupBy(*here, "r")
            .agg(F.min(place).alias("head"), F.max(F.when(F.col("seek"), place)).alias("last"))
            .where("last > head")
            .select(*here, "r", "head"),
            f"lines-heads-{d}",
        )
        met = step.join(heads, [*here, "r"], "left")
        met = cut(
            met.withColumn("inside", F.col("head").isNotNull()).withColumn(
                "take", F.col("seek") & F.col("inside") & (F.col("head") < place)
            ).drop("head"),
            f"lines-met-{d}",
        )
        deeper = met.where("inside").select(
            *PLACE, F.col("take").alias("seek"), (F.col("length") + (1 << d)).alias("length"),
            F.xxhash64("i", "j", "r").alias("i"), F.xxhash64(F.lit(1), "i", "j", "r").alias("j"),
        )
        rest = met.select(*PLACE, (F.col("seek") & ~F.col("take")).alias("seek"), *here)
        live = cut(rest.where("seek and length > 0").select(*here).distinct(), f"lines-live-{d}")
        state = (
            deeper.unionByName(rest.where("length = 0"))  # all suffixes share no lines
            .unionByName(rest.where("length > 0").join(live, here, "left_semi"))
        )
    return cut(state.where("seek and length > 0").select(*PLACE, "length"), "lines-seen")


def runs(docs: DataFrame, least_words: int = LEAST_WORDS, over_blank: bool = False) -> DataFrame:
    """did, k, pos, length and words of the maximal runs to delete, and the numbers of the lines
    that they begin with (start) and end before (stop)."""
    first = cut(repeated_lines(docs, over_blank), "lines-repeated")
    seen = seen_before(first)
    behind = seen.select("did", "k", (F.col("pos") + 1).alias("pos"), F.col("length").alias("longer"))
    most = (
        seen.join(behind, PLACE, "left")
        .where("longer is null or longer <= length")
        .drop("longer")
    )
    # the words up to each place of a text; the texts' own lines bound the window
    upto = Window.partitionBy("did", "k").orderBy("pos")
    sums = first.select(*PLACE, "at", F.sum("words").over(upto).alias("total"), "words")
    begin = most.join(
        sums.select(*PLACE, F.col("at").alias("start"), (F.col("total") - F.col("words")).alias("before")), PLACE
    )
    whole = _ahead(begin, sums, F.col("length") - 1, {"total": "total", "at": "last"})
    return (
        whole.withColumn("words", F.col("total") - F.col("before")).where(F.col("words") >= least_words)
        .withColumn("stop", F.col("last") + 1).drop("last")
    )


def dedup(docs: DataFrame, least_words: int = LEAST_WORDS, over_blank: bool = False) -> DataFrame:
    """``docs`` with removed (lines deleted) and text without the lines of runs of at least
    ``least_words`` words that begin earlier in the order of doc_id and place as well.

    Lines are parts between line feeds. Lines without words end a run; with ``over_blank`` runs go
    on over them, whatever their number, and those inside a run go with it. Every row stays, also
    one whose text becomes empty; a null text stays null. Rows that repeat an id and a text count
    as one text and are treated alike; a null id comes before all others. Other columns stay.
    """
    found = runs(docs, least_words, over_blank).groupBy("did", "k").agg(
        F.collect_list(F.struct("start", "stop")).alias("gone")
    )
    names = [c for c in docs.columns if c not in ("text", "removed")]
    rows = docs.select("text", *names)
    joined = (
        _keyed(rows).select(*[F.col(c).alias(f"o_{i}") for i, c in enumerate(rows.columns)], "did", "k")
        .join(found, ["did", "k"], "left")
    )
    parts = F.split("o_0", "\n")
    kept = F.filter(
        parts, lambda x, i: ~F.exists("gone", lambda g: (g["start"] <= i) & (i < g["stop"]))
    )
    text = F.when(F.col("gone").isNull(), F.col("o_0")).otherwise(F.array_join(kept, "\n"))
    removed = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size(parts) - F.size(kept))
    own = [F.col(f"o_{i}").alias(c) for i, c in enumerate(rows.columns) if c != "text"]
    out = joined.select(*own, text.alias("text"), removed.cast("bigint").alias("removed"))
    order = [c for c in docs.columns if c != "removed"]
    return out.select(*order, "removed")
