"""The whole run from files, and its stages one by one."""

import json
from datetime import date, datetime

import pytest
from frames import creators, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vidmart.__main__ import main
from vidmart.plans import batch
from vidmart.sources import readers

POSTS = [
    {"authorMeta.name": " Ann", "text": "#Fun #fun #other", "diggCount": 100, "shareCount": 1,
     "playCount": 2_000_000, "commentCount": 2, "videoMeta.duration": 12,
     "musicMeta.musicName": "s", "musicMeta.musicAuthor": "b", "musicMeta.musicOriginal": True,
     "createTimeISO": "2026-05-01T17:09:00.000Z", "webVideoUrl": "https://v/@ann/video/1"},
    {"authorMeta.name": "bob", "text": "none", "diggCount": 5, "playCount": 10,
     "createTimeISO": "2026-05-02T03:00:00.000Z", "webVideoUrl": "https://v/@bob/video/2"},
    {"authorMeta.name": "bob", "text": "none", "diggCount": 5, "playCount": 0,
     "webVideoUrl": "https://v/@bob/video/3"},
]
PROFILES = "influencer_id,username,display_name,follower_count,following_count,total_videos," \
    "avg_views_per_video,country,niche_category,is_verified,account_type,joined_date," \
    "bio_length_chars,has_external_link\n" \
    "INF1,Ann,Ann,{followers},1,2,3,DE,Comedy,1,Creator,2018-05-11,7,0\n"
REMARKS = [
    {"_id": "1", "video_id": "1", "comment_text": "ok!", "sentiment_label": "positive",
     "sentiment_score": 0.7},
    {"_id": "2", "video_id": "1", "comment_text": "meh", "sentiment_label": "odd"},
]
TAGS = "hashtag_id,hashtag,category,subcategory,is_brand_safe,content_rating," \
    "search_volume_tier,language_primary,created_at,last_updated\n" \
    "HT1,fun,Comedy,,1,PG,low,en,2025-01-01,2025-01-01\n"


def sources(spark, folder, followers):
    (folder / "videos.json").write_text(json.dumps(POSTS))
    (folder / "creators.csv").write_text(PROFILES.format(followers=followers))
    (folder / "comments.json").write_text(json.dumps(REMARKS))
    (folder / "taxonomy.csv").write_text(TAGS)
    return {
        "videos": readers.videos_json(spark, str(folder / "videos.json")),
        "creators": readers.creators_csv(spark, str(folder / "creators.csv")),
        "comments": readers.comments_json(spark, str(folder / "comments.json")),
        "taxonomy": readers.taxonomy_csv(spark, str(folder / "taxonomy.csv")),
    }


def config(folder, day, previous=None):
    return batch.BatchConfig(
        out=str(folder / f"run{day}"), as_of=date(2026, 5, day),
        loaded_at=datetime(2026, 5, day, 19), previous=previous,
    )


def test_two_days(spark, tmp_path):
    first = config(tmp_path, 3)
    counts = batch.run_batch(spark, first, sources(spark, tmp_path, 100))
    assert counts["raw_videos"] == 3 and counts["fact"] == 2 and counts["bridge"] == 1
    assert counts["dim_date"] == 3287 and counts["report_tier_paradox"] == 1

    second = config(tmp_path, 4, previous=first.out)
    batch.run_batch(spark, second, sources(spark, tmp_path, 200))
    t = batch.warehouse(spark, second.out)
    versions = t["dim_creator"].select("creator_sk", "follower_count", "valid_to", "is_current")
    assert rows(versions) == [(1, 100, date(2026, 5, 4), False), (2, 200, None, True)]
    fact = {r.video_id: r for r in t["fact"].collect()}
    assert fact["1"].creator_sk == 2 and fact["2"].creator_sk is None
    assert (fact["1"].primary_category, fact["1"].hashtag_count) == ("Comedy", 3)
    assert fact["1"].total_comments_scraped == 1 and fact["2"].music_sk is not None
    assert rows(t["bridge"]) == [(fact["1"].video_sk, "HT1")]
    # The first run's tables were read, not written.
    assert batch.warehouse(spark, first.out)["dim_creator"].count() == 1
    validation = spark.read.parquet(second.mart("validation")).first()
    assert validation.passed and validation.total_records == 2


def test_stages_resume_from_staging(spark, tmp_path):
    cfg = config(tmp_path, 3)
    batch.run_batch(spark, cfg, sources(spark, tmp_path, 100), stop="extract")
    again = config(tmp_path, 3)
    batch.run_batch(spark, again, start="transform", stop="transform")
    assert "raw_videos" not in again.metrics and again.metrics["transformed_final"] == 2
    load = config(tmp_path, 3)
    batch.run_batch(spark, load, start="load", stop="load")
    assert load.metrics["fact"] == 2
    report = config(tmp_path, 3)
    batch.run_batch(spark, report, start="reports")
    assert set(report.metrics) == {f"report_{n}" for n in batch.reports.REPORTS}


def test_bridge_is_empty_without_staged_pairs(spark, tmp_path):
    cfg = config(tmp_path, 3)
    raw = batch.run_extract(cfg, sources(spark, tmp_path, 100))
    done = batch.run_transform(cfg, raw)
    cfg.staged = lambda name: str(
        tmp_path / ("absent" if name == "bridge_hashtag" else f"run3/staging/{name}")
    )
    assert batch.run_load(cfg, raw["videos"], done)["bridge"].count() == 0


def test_wrong_sources_fail_early(spark, tmp_path):
    cfg = config(tmp_path, 3)
    with pytest.raises(ValueError, match="sources"):
        batch.run_batch(spark, cfg)
    with pytest.raises(ValueError, match="videos lack"):
        batch.run_extract(cfg, {"videos": spark.range(1)})


def test_command_line(spark, tmp_path, capsys):
    sources(spark, tmp_path, 100)
    done = main([
        "--out", str(tmp_path / "cli"), "--as-of", "2026-05-03", "--show",
        "--videos", str(tmp_path / "videos.json"), "--creators", str(tmp_path / "creators.csv"),
        "--comments", str(tmp_path / "comments.json"),
        "--taxonomy", str(tmp_path / "taxonomy.csv"),
        "--comments-store", "mongodb://localhost:1", "d", "c",
    ])
    assert done["read_from"] == {"comments": "fallback", "taxonomy": "files"}
    assert done["rows"]["fact"] == 2 and done["rows"]["rejected_videos"] == 1
    printed = capsys.readouterr().out
    assert "tier_paradox" in printed and '"seconds"' in printed


def test_failed_validation_only_warns(spark, tmp_path, caplog):
    cfg = config(tmp_path, 3)
    given = sources(spark, tmp_path, 100)
    given["videos"] = given["videos"].withColumn("diggCount", -F.col("diggCount"))
    batch.run_batch(spark, cfg, given, stop="transform")
    assert "failed validation" in caplog.text


def test_repeated_tag_ids_still_give_distinct_pairs(spark, tmp_path):
    given = sources(spark, tmp_path, 100)
    other = given["taxonomy"].withColumn("hashtag", F.lit("other"))
    given["taxonomy"] = given["taxonomy"].unionByName(other)
    cfg = config(tmp_path, 3)
    assert batch.run_batch(spark, cfg, given, stop="load")["bridge"] == 1


def test_previous_history_must_exist(spark, tmp_path):
    cfg = config(tmp_path, 3, previous=str(tmp_path / "nowhere"))
    with pytest.raises(AnalysisException):
        batch.run_batch(spark, cfg, sources(spark, tmp_path, 100), stop="load")


def test_views_hold_the_warehouse(spark, tmp_path):
    """Every table under its SQL name, and a join that no report makes: tags of a song's posts."""
    cfg = config(tmp_path, 3)
    batch.run_batch(spark, cfg, sources(spark, tmp_path, 100), stop="load")
    batch.register_views(batch.warehouse(spark, cfg.out))
    counts = {"dim_date": 3287, "dim_music": 2, "dim_hashtag": 1, "dim_creator": 1,
              "fact_video_performance": 2, "bridge_video_hashtag": 1}
    assert {view: spark.table(view).count() for view in counts} == counts
    tagged = spark.sql("""
        select music_name, collect_set(hashtag) as tags
        from bridge_video_hashtag b, dim_hashtag h, fact_video_performance f, dim_music m
        where b.hashtag_id = h.hashtag_id and b.video_sk = f.video_sk and f.music_sk = m.music_sk
        group by music_name
    """)
    assert rows(tagged) == [("s", ["fun"])]


def test_calendar_covers_every_post(spark, tmp_path):
    """Posts outside the configured years reach the reports."""
    given = sources(spark, tmp_path, 100)
    videos = given["videos"]
    years = videos.sparkSession.createDataFrame([(2018,), (2026,), (2028,)], "y int")
    one = videos.where("playCount > 0").limit(1)
    posts = one.crossJoin(years).withColumn(
        "webVideoUrl", F.concat(F.lit("https://x/@a/video/77"), F.col("y"))
    ).withColumn("createTimeISO", F.concat(F.col("y"), F.lit("-03-04T05:06:07.000Z")))
    cfg = config(tmp_path, 3)
    given["videos"] = posts.select(*videos.columns)
    batch.run_batch(spark, cfg, given, stop="load")
    tables = batch.warehouse(spark, cfg.out)
    dated = tables["fact"].where("date_id is not null").count()
    monthly = batch.reports.monthly_engagement(tables)
    assert dated == 3 and monthly.agg(F.sum("total_videos")).first()[0] == 3
    missing = spark.read.parquet(cfg.mart("fk_violations"))
    assert missing.where("constraint_name = 'fact to date'").first()["orphan_rows"] == 0


def test_stage_control(spark, tmp_path):
    cfg = config(tmp_path, 3)
    with pytest.raises(ValueError, match="comes after"):
        batch.run_batch(spark, cfg, start="load", stop="extract")
    batch.run_batch(spark, cfg, sources(spark, tmp_path, 100), stop="extract")
    with pytest.raises(FileNotFoundError, match="transform, which has not finished"):
        batch.run_batch(spark, cfg, start="load")


def test_back_dated_load_is_refused(spark, tmp_path):
    first = config(tmp_path, 3)
    batch.run_batch(spark, first, sources(spark, tmp_path, 100), stop="load")
    late = config(tmp_path, 1)
    late.previous = first.out
    with pytest.raises(ValueError, match="newest version"):
        batch.run_batch(spark, late, sources(spark, tmp_path, 100))


def test_records_that_cannot_be_read_are_kept(spark, tmp_path):
    given = sources(spark, tmp_path, 100)
    (tmp_path / "comments.jsonl").write_text(
        "\n".join([*map(json.dumps, REMARKS), "{broken", '{"_id": "9", "like_count": "lots"}'])
    )
    given["comments"] = readers.comments_json(
        spark, str(tmp_path / "comments.jsonl"), multi_line=False, checked=True
    )
    cfg = config(tmp_path, 3)
    counts = batch.run_batch(spark, cfg, given, stop="load")
    assert (counts["raw_comments"], counts["raw_comments_rejected"]) == (3, 1)
    assert rows(batch.unreadable_records(spark, cfg, "comments").select("raw_text")) == [("{broken",)]
    assert rows(batch.unfit_cells(spark, cfg, "comments").drop("source_file")) == [("like_count", "lots", "int")]
    aside = spark.read.parquet(cfg.staged("rejected_comments")).select("_id", "reject_reason")
    assert rows(aside) == [("2", "unknown label"), ("9", "unknown label")]
    again = config(tmp_path, 3)
    assert batch.staged_sources(spark, again)["comments"].columns == given["comments"].columns[:-4]
    assert batch.run_batch(spark, again, start="transform", stop="load")["fact"] == 2


def test_rejects_of_every_source(spark, tmp_path):
    given = sources(spark, tmp_path, 100)
    none = given["creators"].withColumn("follower_count", F.lit(0).cast("bigint"))
    nameless = given["creators"].withColumn("username", F.lit(None).cast("string"))
    given["creators"] = given["creators"].unionByName(none).unionByName(nameless)
    unknown = given["taxonomy"].withColumns({"search_volume_tier": F.lit("huge"), "hashtag": F.lit("other")})
    given["taxonomy"] = given["taxonomy"].unionByName(unknown.withColumn("hashtag_id", F.lit("HT2")))
    cfg = config(tmp_path, 3)
    batch.run_batch(spark, cfg, given, stop="load")
    read = lambda n: spark.read.parquet(cfg.staged(f"rejected_{n}"))
    assert rows(read("creators").select("reject_reason")) == [("no followers",), ("no username",)]
    assert rows(read("taxonomy").select("hashtag_id", "reject_reason")) == [("HT2", "search_volume_tier unknown")]
    assert rows(batch.warehouse(spark, cfg.out)["dim_hashtag"].select("hashtag_id")) == [("HT1",)]


def test_fact_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    given = sources(spark, tmp_path, 100)
    liked = F.when(F.col("playCount") == 10, F.lit(10_000_000)).otherwise(F.col("diggCount"))
    given["videos"] = given["videos"].withColumn("diggCount", liked.cast("bigint"))
    cfg = config(tmp_path, 3)
    counts = batch.run_batch(spark, cfg, given, stop="load")
    assert (counts["fact"], counts["fact_rows"], counts["fact_rows_rejected"]) == (1, 1, 1)
    aside = batch.rejected_fact_rows(spark, cfg).collect()
    assert [(r.video_id, r.misfits) for r in aside] == [("2", ["engagement_rate=1000000.0 as decimal(8,6)"])]


def test_a_stage_that_broke_off_is_not_taken(spark, tmp_path, monkeypatch):
    """Its files are there, its manifest is not; run again, it is whole and the next one goes on."""
    cfg = config(tmp_path, 3)
    batch.run_batch(spark, cfg, sources(spark, tmp_path, 100), stop="extract")
    monkeypatch.setattr(batch.enrich, "bridge_pairs", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        batch.run_batch(spark, cfg, start="transform")
    assert spark.read.parquet(cfg.staged("transformed_final")).count() == 2
    with pytest.raises(FileNotFoundError, match="transform, which has not finished"):
        batch.run_batch(spark, cfg, start="load")
    monkeypatch.undo()
    batch.run_batch(spark, cfg, start="transform", stop="transform")
    assert batch.run_batch(spark, cfg, start="load", stop="load")["bridge"] == 1


def test_a_broken_second_run_of_a_stage_does_not_leave_the_first(spark, tmp_path, monkeypatch):
    cfg = config(tmp_path, 3)
    batch.run_batch(spark, cfg, sources(spark, tmp_path, 100), stop="load")
    monkeypatch.setattr(batch.enrich, "videos_final", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        batch.run_batch(spark, cfg, start="transform")
    with pytest.raises(FileNotFoundError, match="transform"):
        batch.run_batch(spark, cfg, start="reports")


def test_stages_of_other_settings_or_files_are_refused(spark, tmp_path):
    cfg = config(tmp_path, 3)
    batch.run_batch(spark, cfg, sources(spark, tmp_path, 100), stop="load")
    other = config(tmp_path, 3)
    other.viral_threshold = 5
    with pytest.raises(ValueError, match="viral_threshold was 1000000, is 5"):
        batch.run_batch(spark, other, start="load")
    batch.run_batch(spark, config(tmp_path, 3), start="transform", stop="transform")
    with pytest.raises(FileNotFoundError, match="load, which has not finished"):
        batch.run_batch(spark, config(tmp_path, 3), start="reports")
    batch.run_batch(spark, config(tmp_path, 3), start="load", stop="load")
    found = batch.manifest.read(spark, cfg.out, "load")
    assert found["rows"]["fact"] == 2 and found["folders"]["warehouse/fact"]["files"] >= 1
    spark.range(1).write.mode("append").parquet(cfg.table("bridge"))
    with pytest.raises(ValueError, match="other files in warehouse/bridge"):
        batch.run_batch(spark, config(tmp_path, 3), start="reports")


PEOPLE = [f"person{i}" for i in range(12)]


def profiles(spark, counts):
    return creators(spark, *[
        {"influencer_id": n, "username": n, "follower_count": c} for n, c in counts.items()
    ])


def test_only_touched_buckets_of_the_history_are_read_and_written(spark, tmp_path):
    given = sources(spark, tmp_path, 100)
    first = config(tmp_path, 3)
    given["creators"] = profiles(spark, dict.fromkeys(PEOPLE, 100))
    batch.run_batch(spark, first, given, stop="load")
    before = batch.warehouse(spark, first.out)["dim_creator"]
    assert sorted(r.creator_sk for r in before.collect()) == list(range(1, 13))

    second = config(tmp_path, 4, previous=first.out)
    given["creators"] = profiles(spark, {PEOPLE[0]: 300, PEOPLE[1]: 101, "late": 5})
    batch.run_batch(spark, second, given, stop="load")
    dim = batch.warehouse(spark, second.out)["dim_creator"]
    changed = {r.creator_nk for r in dim.where("valid_from = '2026-05-04'").collect()}
    assert changed == {PEOPLE[0], "late"} and dim.count() == 14
    assert sorted(r.creator_sk for r in dim.collect()) == list(range(1, 15))
    assert {r.creator_nk: r.creator_sk for r in dim.where("valid_from < '2026-05-04'").collect()} == {
        r.creator_nk: r.creator_sk for r in before.collect()
    }
    named = spark.createDataFrame([(n,) for n in [PEOPLE[0], PEOPLE[1], "late"]], "creator_nk string")
    touched = batch.history.numbers(named)
    read = batch.history.read(spark, first.table("dim_creator"), touched)
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in read.inputFiles()} <= set(touched)
    written = {f.split("/")[0] for f in batch.manifest.files_below(spark, second.table("dim_creator"))}
    moved = named.where(F.col("creator_nk") != PEOPLE[1])
    assert written == {f"bucket={b}" for b in batch.history.numbers(moved)}

    third = config(tmp_path, 5, previous=second.out)
    given["creators"] = profiles(spark, {PEOPLE[5]: 900})
    batch.run_batch(spark, third, given, stop="load")
    dim = batch.warehouse(spark, third.out)["dim_creator"]
    assert dim.count() == 15 and dim.where("is_current").count() == 13
    again = config(tmp_path, 6, previous=third.out)
    batch.run_batch(spark, again, given, stop="load")
    assert rows(batch.warehouse(spark, again.out)["dim_creator"]) == rows(dim)
    late = config(tmp_path, 4, previous=third.out)
    with pytest.raises(ValueError, match="newest version"):
        batch.run_batch(spark, late, given)


def test_history_goes_on_from_a_plain_table(spark, tmp_path):
    plain = batch.scd2.scd2(
        batch.scd2.empty_dimension(spark), profiles(spark, {"ann": 100, "bob": 100}), date(2026, 5, 1)
    )
    plain.write.parquet(str(tmp_path / "old" / "warehouse" / "dim_creator"))
    cfg = config(tmp_path, 3, previous=str(tmp_path / "old"))
    given = sources(spark, tmp_path, 100)
    given["creators"] = profiles(spark, {"bob": 200, "cy": 1})
    batch.run_batch(spark, cfg, given, stop="load")
    got = rows(batch.warehouse(spark, cfg.out)["dim_creator"].select("creator_nk", "creator_sk", "is_current"))
    assert [(n, c) for n, _, c in got] == [("ann", True), ("bob", False), ("bob", True), ("cy", True)]
    assert sorted(k for _, k, _ in got) == [1, 2, 3, 4]


def test_runs_add_their_days_to_the_kept_sums(spark, tmp_path):
    kept = str(tmp_path / "kept")
    given, cfgs = sources(spark, tmp_path, 100), []
    for day, posted in ((3, "2026-05-01"), (4, "2026-06-07")):
        cfg = config(tmp_path, day)
        cfg.kept = kept
        cfgs.append(cfg)
        own = dict(given, videos=given["videos"].withColumn("createTimeISO", F.lit(f"{posted}T10:00:00.000Z")))
        before = batch.manifest.files_below(spark, f"{kept}/daily_sums") if day == 4 else {}
        batch.run_batch(spark, cfg, own, stop="load")
        assert before.items() <= batch.manifest.files_below(spark, f"{kept}/daily_sums").items()
    tables = batch.warehouse(spark, cfgs[1].out)
    months = batch.reports.monthly_engagement(batch.kept_tables(spark, kept, tables))
    assert rows(months.select("month", "total_videos")) == [(5, 2), (6, 2)]
    assert rows(batch.reports.monthly_engagement(tables).select("month", "total_videos")) == [(6, 2)]
    batch.run_batch(spark, cfgs[1], start="load", stop="load")  # a run loaded again counts once
    tables = batch.warehouse(spark, cfgs[1].out)
    months = batch.reports.monthly_engagement(batch.kept_tables(spark, kept, tables))
    assert rows(months.select("month", "total_videos")) == [(5, 2), (6, 2)]
