"""What the queries write, shuffle and sort on the way to their results."""

import os

import pytest
from pyspark.sql import functions as F

from frames import comments, creators, rows, taxonomy, videos
from vidmart import proxies, queries, session
from vidmart.operators import clean, dimensions, enrich, features
from vidmart.sources.staging import stage

SF_DIR = "/root/testdata/sf0.001"
REGISTERED = queries.registered()
with_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@with_tables
def test_json_lines_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(queries, "JSON_RECORDS", 500)
    df = REGISTERED["source_videos_json"](spark, SF_DIR)
    files = df.inputFiles()
    assert all(f.endswith(".json.gz") for f in files)
    assert len(files) >= 6000 / 500
    assert df.exceptAll(queries.plain(proxies.videos(spark, SF_DIR))).isEmpty() and df.count() == 6000


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_staged_files_can_be_read_in_bounded_pieces(spark, tmp_path):
    """One file of 32 MB that nothing compresses: a task reads a part of it, not the file."""
    old = spark.conf.get(session.SPLIT)
    noise = F.xxhash64("id").alias("noise")
    staged = stage(spark.range(4_000_000, numPartitions=1).select(noise), str(tmp_path / "noise"))
    assert len(staged.inputFiles()) == 1 and staged.inputFiles()[0].endswith(".zstd.parquet")
    try:
        spark.conf.set(session.SPLIT, "128m")
        session.bound_splits(spark)
        assert int(spark.conf.get(session.SPLIT)) == session.SPLIT_BYTES
        pieces = staged.groupBy(F.spark_partition_id()).count().collect()
        assert len(pieces) > 1 and max(r["count"] for r in pieces) * 8 <= 1.5 * session.SPLIT_BYTES
        spark.conf.set(session.SPLIT, "1m")
        session.bound_splits(spark)
        assert spark.conf.get(session.SPLIT) == "1m"
    finally:
        spark.conf.set(session.SPLIT, old)


def test_music_is_grouped_by_hashing(spark):
    """The aggregate next to the posts needs no sort: it has no maximum of a text."""
    posts = videos(
        spark, {"musicMeta_musicAuthor": None}, {"musicMeta_musicAuthor": ""}, {"musicMeta_musicOriginal": None}
    )
    music = dimensions.music_table(posts.repartition(2))
    lines = [x for x in music._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate(" in x]
    assert any("HashAggregate(keys=[musicMeta_musicName" in x and "partial_max(musicMeta_musicOriginal" in x for x in lines)
    got = {(r.music_name, r.music_author, r.is_original) for r in music.collect()}
    assert got == {("song", "", True), ("song", "band", False)}


@with_tables
def test_line_items_are_not_shuffled_for_customers(spark):
    """Customers meet their orders, fewer rows than line items, before they meet anything else."""
    lines = plan(proxies.videos(spark, SF_DIR)).splitlines()
    joins = [i for i, x in enumerate(lines) if "Join Inner" in x]
    customers = next(i for i in joins if "o_custkey" in lines[i])
    below = lines[customers + 1 :]
    inner = len(lines[customers]) - len(lines[customers].lstrip(" +-:"))
    own = [x for x in below if len(x) - len(x.lstrip(" +-:")) > inner]
    assert own and not any("l_orderkey" in x for x in own)


def indent(line):
    return len(line) - len(line.lstrip(" +-:"))


def below(lines, i):
    """The lines of a plan under one of its steps."""
    out = []
    for x in lines[i + 1 :]:
        if indent(x) <= indent(lines[i]):
            break
        out.append(x)
    return out


@with_tables
def test_line_items_are_shuffled_as_few_numbers(spark):
    """What line items and parts alone decide is worked out below the joins, not carried through."""
    lines = plan(proxies.videos(spark, SF_DIR)).splitlines()
    top = next(i for i, x in enumerate(lines) if "Join Inner" in x)
    over = "\n".join(x for x in lines[:top])
    assert not any(c in over for c in ("l_extendedprice", "l_discount", "l_returnflag", "p_type", "p_size"))
    assert "item_flags" in over and "part_flags" in over


def old_flags(r):
    """The columns that flags decide, from the columns of the tables."""
    na = "n/a" if (r.l_tax, r.l_discount) == (0.08, 0.1) else None
    live = (r.l_linestatus, r.l_returnflag, r.l_discount) == ("O", "A", 0)
    text = "null" if r.p_size == 1 else {"LARGE": "name", "MEDIUM": "brand"}.get(r.p_type, "watch")
    author = r.p_brand if r.p_size is not None and r.p_size <= 45 else None
    original = None if r.p_type is None else r.p_type in ("PROMO", "ECONOMY")
    lang = r.l_linestatus == "O"
    comments_ = None if r.l_linenumber == 7 else r.l_linenumber
    return na, live, text, author, original, lang, comments_


@with_tables
def test_flags_keep_missing_values(spark, tmp_path):
    """Rows with NULL in the columns that flags are made of give the videos that they gave before."""
    def holes(df, names):
        n = F.pmod(F.xxhash64(*df.columns), F.lit(4 * len(names)))
        return df.withColumns({c: F.when(n != i, F.col(c)) for i, c in enumerate(names)})

    read = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("lineitem", "part", "orders", "customer")}
    read["lineitem"] = holes(read["lineitem"], ["l_tax", "l_discount", "l_linestatus", "l_returnflag", "l_linenumber"])
    read["part"] = holes(read["part"], ["p_size", "p_type"])
    for t, df in read.items():
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
    src = {t: spark.read.parquet(str(tmp_path / f"{t}.parquet")) for t in read}
    joined = src["lineitem"].join(src["part"], F.expr("l_partkey = p_partkey")).join(
        src["orders"], F.expr("l_orderkey = o_orderkey")).join(src["customer"], F.expr("o_custkey = c_custkey"))
    want = sorted(((r.o_orderkey, *old_flags(r)) for r in joined.collect()), key=repr)

    def shown(r):
        name, text = r.musicMeta_musicName, r.text
        kind = "null" if text is None else "name" if text == name else "watch" if text.startswith("Watch #") else "brand"
        url = r.webVideoUrl.partition("?")
        key = int(url[0].rpartition("/")[2])
        na = r.createTimeISO if r.createTimeISO == "n/a" else None
        return key, na, "/live/" in url[0], kind, r.musicMeta_musicAuthor, r.musicMeta_musicOriginal, bool(url[1]), r.commentCount

    got = sorted((shown(r) for r in proxies.videos(spark, str(tmp_path)).collect()), key=repr)
    assert got == want and len(got) > 5000


def test_only_ids_and_authors_meet_the_profiles(spark, tmp_path, no_broadcast):
    """Whole videos are not shuffled by their author, and results are those of a broadcast."""
    def written(df, name):
        return stage(df, str(tmp_path / name))

    posts = written(videos(
        spark,
        *[{"authorMeta_name": n, "webVideoUrl": f"https://v/video/{i}", "text": "#fun x"}
          for i, n in enumerate(["ann", " ANN", "bob", None, "nobody", "ann"])],
    ), "v")
    people = written(clean.creators(creators(spark, {}, {"username": "bob", "country": None})), "c")
    said, entries = written(comments(spark, {}, {"video_id": "2"}), "s"), written(clean.taxonomy(taxonomy(spark, {})), "t")

    def final(hot=None):
        return enrich.videos_final(features.video_features(clean.videos(posts)), people, clean.comments(said), entries, hot=hot)

    lines = plan(final()).splitlines()
    by_author = [i for i, x in enumerate(lines) if "Join" in x and "_slot" in x]
    assert by_author
    for i in by_author:
        first = below(lines, i)[0]
        assert not any(c in first for c in ("hashtag_list", "total_comments_scraped", "engagement_rate"))
    got = rows(final())
    hot = spark.createDataFrame([("ann",)], "authorMeta_name string")
    assert rows(final(hot)) == got
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert rows(final()) == got and len(got) == 6
    found = {r.video_id: r.follower_count for r in final().collect()}
    assert [found[str(i)] for i in range(6)] == [100, 100, 100, None, None, 100]


def test_a_run_asked_for_by_itself_reads_bounded_pieces(spark, monkeypatch):
    """As bench.py asks for it: not through a registered query, which bounds them too."""
    old = spark.conf.get(session.SPLIT)
    monkeypatch.setattr(queries, "_built", {(spark.sparkContext.applicationId, SF_DIR): "built"})
    try:
        spark.conf.set(session.SPLIT, "128m")
        assert queries.run(spark, SF_DIR) == "built"
        assert int(spark.conf.get(session.SPLIT)) == session.SPLIT_BYTES
    finally:
        spark.conf.set(session.SPLIT, old)
