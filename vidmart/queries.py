"""Every operator and report as a query over a folder of benchmark tables.

Cleaning and enrichment queries run on the source-shaped frames directly. Reports and table
queries read the warehouse that one batch run derives from those frames; it is built the
first time a session asks for it and written to the session's shared checkpoint folder.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidmart import proxies, schemas
from vidmart.functions import labels, text
from vidmart.operators import (
    clean, dimensions, enrich, features, keys, marts, quality, scd2,
)
from vidmart.plans import batch, reports
from vidmart.session import bound_splits, pin_utc
from vidmart.sources import readers, sinks
from vidmart.sources.staging import new_folder, read_optional, read_staged, stage

LOADED_AT = datetime(2001, 8, 2, 19, 0, 0)
JSON_RECORDS = 500_000  # in a compressed file, some 200 MB as text

Query = Callable[[SparkSession, str], DataFrame]
_built: dict[tuple[str, str], batch.BatchConfig] = {}
_lock = threading.Lock()


def plain(df: DataFrame) -> DataFrame:
    """Same values in types every engine prints alike: bigint, double, boolean, string."""
    out = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        elif kind == "decimal":
            c = c.cast("double")
        elif kind == "date":
            c = c.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "array":
            c = F.concat_ws("|", c)
        out.append(c.alias(f.name))
    return df.select(*out)


def run(spark: SparkSession, sf_dir: str) -> batch.BatchConfig:
    """The finished batch run for these tables: first profiles, then a full run a day later."""
    key = (spark.sparkContext.applicationId, sf_dir)
    pin_utc(spark)
    bound_splits(spark)
    with _lock:
        if key not in _built:
            first = new_folder(spark, "first")
            profiles = clean.creators(proxies.creators_first(spark, sf_dir))
            history = scd2.scd2(scd2.empty_dimension(spark), profiles, proxies.AS_OF_FIRST)
            sinks.write_table(history, f"{first}/warehouse/dim_creator")
            cfg = batch.BatchConfig(
                out=new_folder(spark, "run"),
                as_of=proxies.AS_OF,
                loaded_at=LOADED_AT,
                previous=first,
                date_range=None,
                min_year=proxies.MIN_YEAR,
                holidays=proxies.holidays(spark, sf_dir),
            )
            sources = {n: getattr(proxies, n)(spark, sf_dir) for n in batch.SOURCES}
            batch.run_batch(spark, cfg, sources, stop="load")
            _built[key] = cfg
        return _built[key]


def _table(name: str) -> Query:
    return lambda s, d: batch.warehouse(s, run(s, d).out)[name]


def _staged(name: str) -> Query:
    return lambda s, d: read_staged(s, run(s, d).staged(name))


def _mart(name: str) -> Query:
    return lambda s, d: read_staged(s, run(s, d).mart(name))


def _report(report: Callable, **kw) -> Query:
    return lambda s, d: report(batch.warehouse(s, run(s, d).out), **kw)


def olap8_tier_distribution(s: SparkSession, d: str) -> DataFrame:
    """The counted rates are written once, for the three steps that read them."""
    def cut(counted: DataFrame) -> DataFrame:
        return stage(counted, new_folder(s, "rate-counts"))

    return reports.tier_distribution(batch.warehouse(s, run(s, d).out), cut)


# Sources


def videos_json(s: SparkSession, d: str) -> DataFrame:
    """Raw videos through JSON Lines files with the source's dotted names, compressed: names of fields
    are most of a line. A compressed file is read by one task, so its rows are bounded."""
    raw = proxies.videos(s, d)
    dotted = raw.toDF(*[f.name for f in schemas.struct(schemas.VIDEO_FILE).fields])
    path = new_folder(s, "videos-json")
    dotted.write.options(compression="gzip", maxRecordsPerFile=JSON_RECORDS).json(path)
    return readers.videos_json(s, path, multi_line=False)


def creators_csv(s: SparkSession, d: str) -> DataFrame:
    path = new_folder(s, "creators-csv")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    proxies.creators(s, d).write.options(header=True, **keep).csv(path)
    return readers.creators_csv(s, path)


def comments_fallback(s: SparkSession, d: str) -> DataFrame:
    """The document-store connector is not installed here, so the JSON files are read."""
    path = new_folder(s, "comments-json")
    proxies.comments(s, d).write.json(path)
    options = readers.document_options("mongodb://localhost:1", "raw", "comments")
    df, used = readers.read_with_fallback(
        lambda: readers.connector(s, "mongodb", options),
        lambda: readers.comments_json(s, path, multi_line=False),
    )
    return df.withColumn("source_used", F.lit(used))


def taxonomy_fallback(s: SparkSession, d: str) -> DataFrame:
    """The JDBC driver is not installed here, so the CSV files are read."""
    path = new_folder(s, "taxonomy-csv")
    proxies.taxonomy(s, d).write.options(header=True, ignoreTrailingWhiteSpace=False).csv(path)
    options = readers.jdbc_options("jdbc:postgresql://localhost:1/raw", "taxonomy")
    df, used = readers.read_with_fallback(
        lambda: readers.connector(s, "jdbc", options), lambda: readers.taxonomy_csv(s, path)
    )
    return df.withColumn("source_used", F.lit(used))


def taxonomy_seed(s: SparkSession, d: str) -> DataFrame:
    """Checked taxonomy rows inserted twice into an empty table: the second time adds none."""
    path = new_folder(s, "taxonomy-seed")
    good, _ = quality.split_by_constraints(proxies.taxonomy(s, d), quality.taxonomy_rules())
    sinks.insert_if_absent(good, path, ["hashtag_id"])
    sinks.insert_if_absent(good, path, ["hashtag_id"])
    return read_staged(s, path)


def load_once(s: SparkSession, d: str) -> DataFrame:
    """The second load finds rows and is skipped, so the table keeps the first snapshot."""
    path = new_folder(s, "load-once")
    sinks.load_once(proxies.creators_first(s, d), path)
    sinks.load_once(proxies.creators(s, d), path)
    return read_staged(s, path)


def append_runs(s: SparkSession, d: str) -> DataFrame:
    """Fact rows of two runs in one partitioned table, counted per run and year. The first run is
    loaded twice, the first time under years that its rows are not of: one copy stays."""
    fact = _table("fact")(s, d).drop("pipeline_run_id")
    path = new_folder(s, "fact-append")
    mistaken = fact.withColumn("post_year", F.col("post_year") - 100)
    for run_id, rows in (("RUN_1", mistaken), ("RUN_2", fact), ("RUN_1", fact)):
        sinks.write_run(rows, path, run_id, partition_by=("post_year", "post_month"))
    return (
        read_staged(s, path)
        .groupBy("pipeline_run_id", "post_year")
        .agg(F.count(F.lit(1)).alias("videos"), F.sum("play_count").alias("plays"))
    )


def unreadable_rows(s: SparkSession, d: str) -> DataFrame:
    """A JSON Lines feed with broken lines and a CSV feed with too many cells: the text of each record
    that cannot be read, and how many of a feed can. One routed write parts them."""
    lines, tags = new_folder(s, "broken-json"), new_folder(s, "broken-csv")
    end = F.when(F.col("like_count") % 7 == 3, "").otherwise("}")
    proxies.comments(s, d).select(
        F.concat(
            F.lit('{"_id": "'), "_id", F.lit('", "sentiment_label": "'), "sentiment_label",
            F.lit('", "like_count": '), "like_count", end,
        )
    ).write.text(lines)
    language = F.when(F.col("hashtag_id").endswith("7"), "en,xx").otherwise("en")
    entries = proxies.taxonomy(s, d).withColumn("language_primary", language)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in entries.columns]
    # whole lines as the only cell, so that none is quoted
    entries.select(F.concat_ws(",", *cells).alias(",".join(entries.columns))).write.options(
        header=True, sep="\x01", ignoreTrailingWhiteSpace=False
    ).csv(tags)
    feeds = {
        "comments": readers.comments_json(s, lines, multi_line=False, checked=True),
        "taxonomy": readers.taxonomy_csv(s, tags, checked=True),
    }
    out = None
    for feed, checked in feeds.items():
        whole = F.col(readers.RAW_TEXT).isNull()
        good, bad = sinks.write_routed(checked, new_folder(s, f"routed-{feed}"), whole)
        kept = good.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(feed).alias("feed"), F.lit("read").alias("reject_reason"), F.lit(None).cast("string").alias("raw_text"), "records"
        )
        texts = readers.unreadable(bad).select(F.lit(feed).alias("feed"), "reject_reason", "raw_text", F.lit(1).alias("records"))
        both = kept.unionByName(texts)
        out = both if out is None else out.unionByName(both)
    return out


def unfit_source_cells(s: SparkSession, d: str) -> DataFrame:
    """Cells of every layout whose text is no value of their column, with the text, counted."""
    odd = {
        "creators": {
            "follower_count": ("influencer_id", "3", F.concat("follower_count", F.lit(" approx"))),
            "total_videos": ("influencer_id", "5", F.lit("1.5")),
            "joined_date": ("influencer_id", "7", F.lit("unknown")),
        },
        "taxonomy": {
            "is_brand_safe": ("hashtag_id", "4", F.lit("yes")),
            "created_at": ("hashtag_id", "8", F.lit("1995-13-01")),
        },
        "holidays": {"full_date": ("holiday_name", "New Year", F.concat("full_date", F.lit("?")))},
        "comments": {
            "like_count": ("_id", "1", F.lit("many")),
            "sentiment_score": ("_id", "2", F.lit("n/a")),
        },
    }
    layouts = {"creators": schemas.CREATOR, "taxonomy": schemas.TAXONOMY, "holidays": schemas.HOLIDAY}
    out = None
    for feed, cells in odd.items():
        source = getattr(proxies, feed)(s, d)
        texts = source.select(*[F.col(c).cast("string").alias(c) for c in source.columns])
        for c, (key, ending, text_) in cells.items():
            texts = texts.withColumn(c, F.when(F.col(key).endswith(ending), text_).otherwise(F.col(c)))
        path = new_folder(s, f"odd-{feed}")
        if feed == "comments":
            texts.write.json(path)
            checked = readers.comments_json(s, path, multi_line=False, checked=True)
        else:
            texts.write.options(header=True, ignoreTrailingWhiteSpace=False).csv(path)
            checked = readers.checked_csv(s, path, layouts[feed])
        found = readers.unfit_cells(checked).groupBy("column_name", "text", "wanted").agg(F.count(F.lit(1)).alias("cells"))
        found = found.select(F.lit(feed).alias("feed"), "*")
        out = found if out is None else out.unionByName(found)
    return out


def optional_input(s: SparkSession, d: str) -> DataFrame:
    """Bridge rows with the pairs staged, and with the pairs never written."""
    cfg = run(s, d)
    fact = read_staged(s, cfg.table("fact"))
    ddl = "video_id string, hashtag_id string"
    counts = []
    for name in ("bridge_hashtag", "never_written"):
        pairs = read_optional(s, cfg.staged(name), ddl)
        rows = batch.fact.bridge_table(fact, pairs).agg(F.count(F.lit(1)).alias("bridge_rows"))
        counts.append(rows.select(F.lit(name).alias("staged_pairs"), "bridge_rows"))
    return counts[0].unionByName(counts[1])


# Cleaning and features


def scrub_documents(s: SparkSession, d: str) -> DataFrame:
    docs = readers.spread(s.read.parquet(f"{d}/documents.parquet"))
    ascii_only, any_script = text.scrub(F.col("text")), text.scrub(F.col("text"), True)
    return docs.select(
        "doc_id",
        F.md5(ascii_only.cast("binary")).alias("ascii_md5"),
        F.length(ascii_only).alias("ascii_chars"),
        F.length(any_script).alias("unicode_chars"),
    )


def document_hashtags(s: SparkSession, d: str) -> DataFrame:
    docs = readers.spread(s.read.parquet(f"{d}/documents.parquet"))
    tags = text.hashtags(F.col("text"))
    return docs.select(
        "doc_id", F.size(tags).alias("hashtag_count"), F.concat_ws(" ", tags).alias("hashtags")
    )


def hashtag_extract(s: SparkSession, d: str) -> DataFrame:
    tags = text.hashtags(F.col("text"))
    return (
        proxies.videos(s, d)
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("videos"))
        .select("text", "videos", tags.alias("hashtag_list"), F.size(tags).alias("hashtag_count"))
    )


def video_features(s: SparkSession, d: str) -> DataFrame:
    return features.video_features(clean.videos(proxies.videos(s, d)))


def duration_bucket_counts(s: SparkSession, d: str) -> DataFrame:
    seconds = F.col("videoMeta_duration")
    return (
        proxies.videos(s, d)
        .groupBy(
            labels.duration_bucket(seconds).alias("duration_bucket"),
            labels.duration_bucket(seconds, report=True).alias("duration_label"),
        )
        .agg(F.count(F.lit(1)).alias("videos"))
    )


def tier_counts(s: SparkSession, d: str) -> DataFrame:
    followers = F.col("follower_count")
    return (
        proxies.creators(s, d)
        .groupBy(
            labels.influencer_tier(followers).alias("tier"),
            labels.influencer_tier(followers, numbered=True).alias("numbered_tier"),
        )
        .agg(F.count(F.lit(1)).alias("creators"))
    )


def rejected_videos(s: SparkSession, d: str) -> DataFrame:
    rows = clean.rejected_videos(proxies.videos(s, d))
    return rows.groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("videos"), F.sum("playCount").alias("plays")
    )


# Joins


def _extracted(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw videos and clean profiles as staged, and the frequent authors noted meanwhile."""
    cfg = run(s, d)
    raw = batch.staged_sources(s, cfg)["videos"]
    return raw, read_staged(s, cfg.staged("creators")), batch.frequent_keys(s, cfg)["authors"]


def videos_with_creator(s: SparkSession, d: str) -> DataFrame:
    raw, creators, authors = _extracted(s, d)
    rows = clean.videos(raw).select("video_id", "authorMeta_name", "playCount")
    return enrich.with_creators(rows, creators, hot=authors)


def sentiment_by_video(s: SparkSession, d: str) -> DataFrame:
    return enrich.sentiment_by_video(clean.comments(proxies.comments(s, d)))


def videos_with_sentiment(s: SparkSession, d: str) -> DataFrame:
    rows = clean.videos(proxies.videos(s, d)).select("video_id", "playCount")
    return enrich.with_sentiment(rows, sentiment_by_video(s, d))


def tag_categories(s: SparkSession, d: str) -> DataFrame:
    """Of every entry, those that the warehouse refuses to load too."""
    entries = clean.taxonomy(_staged("raw_taxonomy")(s, d))
    return enrich.tag_categories(enrich.video_tags(_staged("transformed_final")(s, d)), entries)


def primary_category(s: SparkSession, d: str) -> DataFrame:
    tags = enrich.video_tags(video_features(s, d))
    return enrich.primary_category(tags, clean.valid_taxonomy(proxies.taxonomy(s, d)))


def videos_final(s: SparkSession, d: str) -> DataFrame:
    raw, creators, authors = _extracted(s, d)
    return enrich.videos_final(
        features.video_features(clean.videos(raw)),
        creators,
        clean.comments(proxies.comments(s, d)),
        _staged("taxonomy")(s, d),
        hot=authors,
    )


# Quality


def constraint_violations(s: SparkSession, d: str) -> DataFrame:
    return quality.violation_counts(proxies.taxonomy(s, d), quality.taxonomy_rules())


def length_violations(s: SparkSession, d: str) -> DataFrame:
    """Rows of the warehouse tables too long for their declared columns."""
    names = {
        "dim_date": "dim_date", "dim_creator": "dim_creator", "dim_hashtag": "dim_hashtag",
        "dim_music": "dim_music", "fact": "fact_video_performance",
    }
    out = None
    for name, declared in names.items():
        counts = quality.violation_counts(_table(name)(s, d), quality.length_rules(declared))
        counts = counts.select(F.lit(declared).alias("table_name"), "*")
        out = counts if out is None else out.unionByName(counts)
    return out


def unfit_values(s: SparkSession, d: str) -> DataFrame:
    return quality.unfit_values(_staged("transformed_final")(s, d), schemas.NARROWED)


def quarantined_taxonomy(s: SparkSession, d: str) -> DataFrame:
    _, bad = quality.split_by_constraints(proxies.taxonomy(s, d), quality.taxonomy_rules())
    return bad.select("hashtag_id", "hashtag", "violations")


def fk_violations(s: SparkSession, d: str) -> DataFrame:
    t = batch.warehouse(s, run(s, d).out)
    comments = clean.comments(proxies.comments(s, d))
    safety = dimensions.brand_safety_table(s)
    checks = [
        (t["fact"], "creator_sk", t["dim_creator"], "creator_sk", "fact to creator"),
        (t["fact"], "date_id", t["dim_date"], "date_id", "fact to date"),
        (t["fact"], "music_sk", t["dim_music"], "music_sk", "fact to music"),
        (t["bridge"], "video_sk", t["fact"], "video_sk", "bridge to fact"),
        (t["bridge"], "hashtag_id", t["dim_hashtag"], "hashtag_id", "bridge to hashtag"),
        (proxies.taxonomy(s, d), "is_brand_safe", safety, "safety_status", "taxonomy to safety"),
        (comments, "video_id", t["fact"], "video_id", "comment to fact"),
        (proxies.comments(s, d), "sentiment_label", _labels(s), "label", "comment to label"),
    ]
    out = None
    for check in checks:
        row = quality.reference_check(*check)
        out = row if out is None else out.unionByName(row)
    return out


def _labels(s: SparkSession) -> DataFrame:
    return s.createDataFrame([(x,) for x in schemas.SENTIMENTS], "label string")


def unique_violations(s: SparkSession, d: str) -> DataFrame:
    t = batch.warehouse(s, run(s, d).out)
    names = proxies.creators(s, d).withColumn("username", text.normal_key(F.col("username")))
    checks = [
        ("dim_date", t["dim_date"], ["date_id"]),
        ("dim_creator", t["dim_creator"], ["creator_sk"]),
        ("current dim_creator", t["dim_creator"].where("is_current"), ["creator_nk"]),
        ("dim_hashtag", t["dim_hashtag"], ["hashtag_id"]),
        ("dim_music", t["dim_music"], ["music_sk"]),
        ("fact", t["fact"], ["video_sk"]),
        ("fact", t["fact"], ["video_id"]),
        ("bridge", t["bridge"], ["video_sk", "hashtag_id"]),
        ("raw creators", names, ["username"]),
        ("raw videos", proxies.videos(s, d), ["webVideoUrl"]),
    ]
    out = None
    for check in checks:
        row = quality.unique_check(*check)
        out = row if out is None else out.unionByName(row)
    return out


def calendar_coverage(s: SparkSession, d: str) -> DataFrame:
    """Dated fact rows of each year, and those that reach the monthly report, with a calendar
    configured for a single year that no post is in."""
    t = batch.warehouse(s, run(s, d).out)
    posted = F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")
    narrow = dimensions.date_table_covering(t["fact"], posted, date(2000, 1, 1), date(2000, 12, 31))
    days = schemas.conform(narrow, schemas.TABLES["dim_date"][1])
    monthly = reports.monthly_engagement({**t, "dim_date": days})
    reported = monthly.groupBy("year").agg(F.sum("total_videos").alias("reported_rows"))
    dated = (
        t["fact"].where("date_id is not null")
        .groupBy(F.floor(F.col("date_id") / 10000).cast("int").alias("year"))
        .agg(F.count(F.lit(1)).alias("dated_rows"))
    )
    return plain(dated.join(reported, "year", "left"))


def source_creators_csv_reordered(s: SparkSession, d: str) -> DataFrame:
    """The profiles through a CSV file whose columns come in another order."""
    profiles = proxies.creators(s, d)
    path = new_folder(s, "creators-reordered")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    profiles.select(*reversed(profiles.columns)).write.options(header=True, **keep).csv(path)
    return plain(readers.creators_csv(s, path))


def source_profile(s: SparkSession, d: str) -> DataFrame:
    parsed = proxies.videos(s, d).withColumn("posted", F.try_to_timestamp("createTimeISO"))
    return quality.profile(
        parsed, ("playCount", "videoMeta_duration"), ("posted",), ("authorMeta_name",)
    )


def source_value_shares(s: SparkSession, d: str) -> DataFrame:
    """Shares per flag, category and label of the four sources; the five top countries."""
    creators = proxies.creators(s, d)
    parts = [
        ("videos.original", proxies.videos(s, d), "musicMeta_musicOriginal", None),
        ("creators.verified", creators, "is_verified", None),
        ("creators.account", creators, "account_type", None),
        ("creators.niche", creators, "niche_category", None),
        ("creators.country", creators, "country", 5),
        ("comments.label", proxies.comments(s, d), "sentiment_label", None),
        ("taxonomy.category", proxies.taxonomy(s, d), "category", None),
        ("taxonomy.safe", proxies.taxonomy(s, d), "is_brand_safe", None),
    ]
    out = None
    for name, df, column, top in parts:
        rows = quality.value_shares(df, column, top).select(F.lit(name).alias("attribute"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


# Warehouse


def scd2_summary(s: SparkSession, d: str) -> DataFrame:
    return (
        _table("dim_creator")(s, d)
        .groupBy("valid_from", "valid_to", "is_current")
        .agg(F.count(F.lit(1)).alias("versions"), F.sum("follower_count").alias("followers"))
    )


def scd2_rerun(s: SparkSession, d: str) -> DataFrame:
    """The same profiles loaded once more: the dimension comes out as it went in."""
    dim = _table("dim_creator")(s, d)
    return scd2.scd2(dim, _staged("creators")(s, d), proxies.AS_OF)


def brand_safety_usage(s: SparkSession, d: str) -> DataFrame:
    """Taxonomy entries per safety state with its description."""
    states = dimensions.brand_safety_table(s)
    rows = clean.taxonomy(proxies.taxonomy(s, d)).join(
        states, F.col("is_brand_safe") == F.col("safety_status"), "left"
    )
    return rows.groupBy("safety_status", "description", "monetization_status").agg(
        F.count(F.lit(1)).alias("hashtags")
    )


def surrogate_keys(s: SparkSession, d: str) -> DataFrame:
    """Dense keys for all customers, numbered after those of all suppliers."""
    suppliers = s.read.parquet(f"{d}/supplier.parquet").select(F.col("s_name").alias("nk"))
    customers = s.read.parquet(f"{d}/customer.parquet").select(F.col("c_name").alias("nk"))
    old = keys.assign_keys(suppliers, ["nk"], "sk")
    return old.unionByName(keys.assign_keys(customers, ["nk"], "sk", old))


def _kept(report: Callable, **kw) -> Query:
    """A report over the daily sums that two runs have added to one kept table: the facts of even and
    of odd years, the second loaded twice. The fact is not read."""

    def query(s: SparkSession, d: str) -> DataFrame:
        t = batch.warehouse(s, run(s, d).out)
        kept = new_folder(s, "kept")
        for run_id, odd in (("RUN_1", 0), ("RUN_2", 1), ("RUN_2", 1)):
            # the year of an undated post is unknown; such rows are in neither the calendar nor a report
            own = t["fact"].where(F.pmod("post_year", F.lit(2)) == odd)
            sinks.write_run(reports.daily_sums(own), f"{kept}/daily_sums", run_id, partition_by=("post_year",))
        return report(batch.kept_tables(s, kept, {"dim_date": t["dim_date"]}), **kw)

    return query


def active_creators(s: SparkSession, d: str) -> DataFrame:
    """Different creators by tier and year, merged from kept sets by tier, niche and month."""
    sets = reports.creator_sets(batch.warehouse(s, run(s, d).out))
    path = new_folder(s, "creator-sets")
    sinks.write_table(sets, path)
    return reports.active_creators(read_staged(s, path))


def monthly_in_sql(s: SparkSession, d: str) -> DataFrame:
    """The monthly report as SQL text over the table views."""
    batch.register_views(batch.warehouse(s, run(s, d).out))
    return s.sql(
        """
        select year, month, month_name, count(*) as total_videos,
          cast(round(avg(cast(play_count as decimal(20,0)))) as double) as avg_play_count,
          cast(round(avg(cast(like_count as decimal(20,0)))) as double) as avg_like_count,
          cast(round(avg(engagement_rate) * 100, 4) as double) as avg_engagement_rate_pct,
          count_if(is_viral) as viral_count
        from fact_video_performance join dim_date using (date_id)
        group by all
        """
    )


QUERIES: dict[str, Query] = {
    # sources and sinks
    "source_videos_json": videos_json,
    "source_creators_csv": creators_csv,
    "source_comments_fallback": comments_fallback,
    "source_taxonomy_fallback": taxonomy_fallback,
    "staged_videos": _staged("raw_videos"),
    "sink_insert_if_absent": taxonomy_seed,
    "sink_load_once": load_once,
    "sink_append": append_runs,
    "unreadable_rows": unreadable_rows,
    "unfit_source_cells": unfit_source_cells,
    "optional_input": optional_input,
    # cleaning and features
    "clean_videos": lambda s, d: clean.videos(proxies.videos(s, d)),
    "unique_addresses": lambda s, d: clean.unique_addresses(proxies.videos(s, d)),
    "rejected_videos": rejected_videos,
    "clean_creators": lambda s, d: clean.creators(proxies.creators(s, d)),
    "clean_comments": lambda s, d: clean.comments(proxies.comments(s, d)),
    "clean_taxonomy": lambda s, d: clean.taxonomy(proxies.taxonomy(s, d)),
    "scrub_documents": scrub_documents,
    "video_features": video_features,
    "hashtag_extract": hashtag_extract,
    "document_hashtags": document_hashtags,
    "duration_bucket_counts": duration_bucket_counts,
    "tier_counts": tier_counts,
    # joins
    "videos_with_creator": videos_with_creator,
    "sentiment_by_video": sentiment_by_video,
    "videos_with_sentiment": videos_with_sentiment,
    "tag_categories": tag_categories,
    "primary_category": primary_category,
    "videos_final": videos_final,
    "bridge_pairs": lambda s, d: enrich.bridge_pairs(
        video_features(s, d), clean.taxonomy(proxies.taxonomy(s, d))
    ),
    # marts
    "creator_stats": lambda s, d: marts.creator_stats(_staged("transformed_final")(s, d)),
    "category_stats": lambda s, d: marts.category_stats(_staged("transformed_final")(s, d)),
    "time_stats": lambda s, d: marts.time_stats(_staged("transformed_final")(s, d)),
    "mart_creator_stats": _mart("creator_stats"),
    # quality
    "validate_videos": lambda s, d: quality.validate(_staged("transformed_final")(s, d)),
    "constraint_violations": constraint_violations,
    "length_violations": length_violations,
    "unfit_values": unfit_values,
    "quarantined_taxonomy": quarantined_taxonomy,
    "quarantined_videos": _staged("rejected_videos"),
    "quarantined_creators": _staged("rejected_creators"),
    "quarantined_comments": _staged("rejected_comments"),
    "quarantined_fact_rows": lambda s, d: batch.rejected_fact_rows(s, run(s, d)),
    "fk_violations": fk_violations,
    "unique_violations": unique_violations,
    "mart_fk_violations": _mart("fk_violations"),
    "mart_unique_violations": _mart("unique_violations"),
    "calendar_coverage": calendar_coverage,
    "source_creators_csv_reordered": source_creators_csv_reordered,
    "source_profile": source_profile,
    "source_value_shares": source_value_shares,
    # warehouse
    "dim_date": _table("dim_date"),
    "dim_music": _table("dim_music"),
    "dim_hashtag": _table("dim_hashtag"),
    "scd2_creator": _table("dim_creator"),
    "scd2_summary": scd2_summary,
    "scd2_rerun": scd2_rerun,
    "fact_video": _table("fact"),
    "bridge_video_hashtag": _table("bridge"),
    "brand_safety_usage": brand_safety_usage,
    "surrogate_keys": surrogate_keys,
    # reports
    "olap1_monthly": _report(reports.monthly_engagement),
    "olap1_monthly_sql": monthly_in_sql,
    "olap1_monthly_kept": _kept(reports.monthly_engagement),
    "olap4_category_kept": _kept(reports.category_trend, min_year=proxies.MIN_YEAR),
    "olap6_weekday_kept": _kept(reports.weekday_pattern),
    "olap8_active_creators": active_creators,
    "olap1_rollup": _report(reports.engagement_rollup),
    "olap1_weekly": _report(reports.engagement_rollup_weekly),
    "olap1_series": _report(reports.monthly_series),
    "olap2_viral_patterns": _report(reports.viral_patterns),
    "olap2_viral_by_duration": _report(reports.viral_by_duration),
    "olap3_creator_ranking": _report(reports.creator_ranking),
    "olap3_ranking_chart": _report(reports.creator_ranking_chart),
    "olap4_category_trend": _report(reports.category_trend, min_year=proxies.MIN_YEAR),
    "olap4_brand_safe": _report(reports.category_trend_by_safety, min_year=proxies.MIN_YEAR),
    "olap4_category_share": _report(reports.category_share, min_year=proxies.MIN_YEAR),
    "olap5_sentiment": _report(reports.sentiment_engagement),
    "olap5_viral_crosstab": _report(reports.sentiment_viral_heatmap),
    "olap6_weekday": _report(reports.weekday_pattern),
    "olap6_weekday_chart": _report(reports.weekday_chart),
    "olap6_day_hour": _report(reports.day_hour_pattern),
    "olap6_heatmap": _report(reports.posting_heatmap),
    "olap6_holiday": _report(reports.holiday_comparison),
    "olap7_music_original": _report(reports.music_originality),
    "olap7_original_chart": _report(reports.music_originality_chart),
    "olap7_top_music": _report(reports.top_viral_music),
    "olap7_top_music_detail": _report(reports.top_viral_music_detail),
    "olap8_tier": _report(reports.tier_paradox),
    "olap8_tier_niche": _report(reports.tier_paradox_by_niche),
    "olap8_tier_distribution": olap8_tier_distribution,
}


def registered() -> dict[str, Query]:
    """The queries, with the session pinned to UTC, bounded splits, and plain result types."""

    def wrap(query: Query) -> Query:
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            bound_splits(spark)
            return plain(query(spark, sf_dir))

        return call

    return {name: wrap(query) for name, query in QUERIES.items()}
