"""Shape of the physical plans: what is shuffled, pushed down, broadcast."""

import pytest
from frames import comments, creators, taxonomy, videos
from pyspark.sql import functions as F

from vidmart import queries
from vidmart.operators import clean, enrich, fact, features
from vidmart.plans import batch, reports

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan after adaptive execution, once it has run."""
    rows = df._jdf.queryExecution()
    rows.executedPlan().executeCollect()
    return rows.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_python_and_no_products(spark, name):
    text = plan(queries.registered()[name](spark, SF_DIR))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in text


def files(spark, tmp_path, df, name):
    path = str(tmp_path / name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_duplicates_are_cut_before_the_shuffle(spark, tmp_path):
    df = clean.videos(files(spark, tmp_path, videos(spark, {}, {}), "v"))
    text = plan(df)
    before, after = text.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
    assert "PushedFilters: [IsNotNull(playCount), GreaterThan(playCount,0)" in text


def test_joins_on_video_id_reuse_one_shuffle(spark, tmp_path, no_broadcast):
    featured = features.video_features(
        clean.videos(files(spark, tmp_path, videos(spark, *[{"text": "#fun"}] * 5), "v"))
    )
    tags = enrich.video_tags(featured)
    entries = clean.taxonomy(files(spark, tmp_path, taxonomy(spark, {}), "t"))
    said = enrich.sentiment_by_video(
        clean.comments(files(spark, tmp_path, comments(spark, {}), "c"))
    )
    joined = enrich.with_category(
        enrich.with_sentiment(featured, said), enrich.primary_category(tags, entries)
    )
    text = plan(joined)
    # Left side: straight from the shuffle that removed the duplicates to both joins.
    left = text[text.index("SortMergeJoin"):]
    assert left.count("SortMergeJoin [video_id") == 2
    assert "ReusedExchange" in final_plan(joined)


def test_small_taxonomy_is_broadcast_without_a_hint(spark, tmp_path):
    featured = features.video_features(
        clean.videos(files(spark, tmp_path, videos(spark, {"text": "#fun"}), "v"))
    )
    entries = files(spark, tmp_path, taxonomy(spark, {}), "t")
    text = plan(enrich.tag_categories(enrich.video_tags(featured), entries))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_unread_columns_are_not_scanned(spark, tmp_path):
    df = files(spark, tmp_path, creators(spark, {}), "c")
    text = plan(enrich.with_creators(
        clean.videos(files(spark, tmp_path, videos(spark, {}), "v")), df
    ))
    assert "bio_length_chars" not in text and "joined_date" not in text


def test_reports_read_few_columns(spark):
    t = batch.warehouse(spark, queries.run(spark, SF_DIR).out)
    text = plan(reports.weekday_pattern(t))
    assert "video_id" not in text and "BroadcastHashJoin" in text
    text = plan(reports.category_trend(t, 2000))
    assert "PartitionFilters: [isnotnull(post_year" in text


def test_creators_are_summed_before_they_are_joined(spark, no_broadcast):
    t = batch.warehouse(spark, queries.run(spark, SF_DIR).out)
    text = plan(reports.tier_paradox(t))
    join = text.index("SortMergeJoin")
    assert "partial_sum(play_count" in text[join:]


def test_rollup_expands_daily_sums_only(spark):
    t = batch.warehouse(spark, queries.run(spark, SF_DIR).out)
    text = plan(reports.engagement_rollup(t))
    assert "Exchange" in text[text.index("Expand"):]


def test_results_do_not_depend_on_shuffle_width(spark):
    t = batch.warehouse(spark, queries.run(spark, SF_DIR).out)
    want = {n: df.collect() for n, df in reports.run_all_reports(t, 2000).items()}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = {
            n: df.collect()
            for n, df in reports.run_all_reports(
                {k: v.repartition(5) for k, v in t.items()}, 2000
            ).items()
        }
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert want == again
    assert t["fact"].agg(F.count("*")).first()[0] > 0


def test_fact_counts_frequent_music_before_the_creator_lookup(spark, tmp_path, no_broadcast):
    ddl = "video_id long, authorMeta_name string, musicMeta_musicName string, musicMeta_musicAuthor string"
    final = files(spark, tmp_path, spark.createDataFrame([(1, "a", "m", "n"), (2, "b", None, "")], ddl), "f")
    creator = files(spark, tmp_path, spark.createDataFrame(
        [("a", 7, True)], "creator_nk string, creator_sk long, is_current boolean"), "c")
    music = files(spark, tmp_path, spark.createDataFrame(
        [("m", "n", 1), (None, None, 2)], "music_name string, music_author string, music_sk long"), "m")
    met = fact.with_music_key(fact.with_creator_key(final, creator), music, keys_from=final)
    assert plan(met).count("SortMergeJoin") == 2
    got = {r["video_id"]: (r["creator_sk"], r["music_sk"]) for r in met.collect()}
    assert got == {1: (7, 1), 2: (None, 2)}


def scans(df, column):
    """File scans, after adaptive execution, that read a column."""
    return [line for line in final_plan(df).splitlines() if "FileScan" in line and column in line]


def test_raw_videos_are_scanned_once(spark, no_broadcast):
    """Which authors are frequent was noted while the videos were staged."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        joined = queries.videos_final(spark, SF_DIR)
        assert len(scans(joined, "/raw_videos]")) == 1
        assert "ReusedExchange" in final_plan(joined)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_reports_by_date_do_not_read_the_fact(spark):
    t = batch.warehouse(spark, queries.run(spark, SF_DIR).out)
    for report in (reports.monthly_engagement, reports.weekday_pattern, reports.posting_heatmap):
        assert "sum_play" in plan(report(t)) and "play_count" not in plan(report(t)).replace("avg_play_count", "")
    assert "play_count" in plan(reports.monthly_engagement({k: v for k, v in t.items() if k != "daily"}))


def test_daily_sums_give_the_same_reports(spark):
    t = batch.warehouse(spark, queries.run(spark, SF_DIR).out)
    without = {k: v for k, v in t.items() if k != "daily"}
    for report in (reports.monthly_engagement, reports.engagement_rollup, reports.category_trend_by_safety,
                   reports.day_hour_pattern, reports.holiday_comparison):
        assert report(t).collect() == report(without).collect()


def test_tiers_are_looked_up_for_sums_only(spark, no_broadcast):
    t = batch.warehouse(spark, queries.run(spark, SF_DIR).out)
    text = plan(reports.tier_distribution(t))
    assert "video_sk" not in text and "partial_count" in text[text.index("SortMergeJoin"):]


def test_rates_are_counted_once(spark):
    """With a cut the fact is read by one written table alone, and the numbers stay the same."""
    t = batch.warehouse(spark, queries.run(spark, SF_DIR).out)
    report = queries.olap8_tier_distribution(spark, SF_DIR)
    assert "creator_sk" not in plan(report) and "rate-counts" in plan(report)
    assert report.collect() == reports.tier_distribution(t).collect()
