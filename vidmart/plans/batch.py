"""The batch run: extract, transform, load, reports. Stages hand over staged tables, so any
stage can be run again on its own from what the one before it wrote.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from vidmart import schemas
from vidmart.functions import measures
from vidmart.operators import (
    clean, dimensions, enrich, fact, features, frequent, marts, quality, scd2,
)
from vidmart.plans import history, manifest, reports
from vidmart.session import require_utc
from vidmart.sources import readers, sinks
from vidmart.sources.staging import exists, read_optional, read_staged, stage

log = logging.getLogger(__name__)

STAGES = ("extract", "transform", "load", "reports")
SOURCES = ("videos", "creators", "comments", "taxonomy")


@dataclass
class BatchConfig:
    """Where a run reads and writes, and the values that would otherwise be "now".

    ``out`` is a folder of this run alone. ``previous`` is an earlier run's folder: its creator
    history is carried on, and its tables are read, never written. ``kept`` is a folder of all runs,
    to whose daily sums a run adds its own.
    """

    out: str
    as_of: date
    loaded_at: datetime
    previous: str | None = None
    kept: str | None = None
    run_id: str | None = None
    viral_threshold: int = measures.VIRAL_PLAYS
    change_threshold: float = measures.SCD2_CHANGE
    date_range: tuple[date, date] | None = dimensions.DATE_RANGE
    min_year: int = reports.MIN_YEAR
    holidays: DataFrame | None = None
    metrics: dict[str, int] = field(default_factory=dict)
    written: list[tuple[str, str]] = field(default_factory=list)  # name and folder, by the stage at work

    def settings(self, stage_: str) -> dict[str, str]:
        """What a stage's result depends on, besides what it reads."""
        names = {
            "transform": ("viral_threshold",),
            "load": ("as_of", "loaded_at", "previous", "kept", "run_id", "change_threshold", "date_range"),
            "reports": ("min_year",),
        }
        out = {n: str(getattr(self, n)) for n in names.get(stage_, ())}
        return out | ({"holidays": str(self.holidays is not None)} if stage_ == "load" else {})

    def staged(self, name: str) -> str:
        return f"{self.out}/staging/{name}"

    def table(self, name: str) -> str:
        return f"{self.out}/warehouse/{name}"

    def mart(self, name: str) -> str:
        return f"{self.out}/marts/{name}"


def _together(spark: SparkSession, works: Mapping[str, Callable[[], DataFrame]]) -> dict:
    """Submit independent jobs at once, so small ones do not wait for large ones."""
    with ThreadPoolExecutor(len(works)) as pool:
        jobs = {n: pool.submit(inheritable_thread_target(spark)(w)) for n, w in works.items()}
        return {n: job.result() for n, job in jobs.items()}


def _counted(df: DataFrame, name: str, cfg: BatchConfig, path: str, write, also: Mapping[str, Column] | None = None) -> dict:
    """Write ``df`` and note its row count, counted while the rows go by, with other sums ``also``."""
    seen, sums = Observation(name), [c.alias(n) for n, c in (also or {}).items()]
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *sums))
    cfg.metrics[name] = seen.get["rows"]
    cfg.written.append((name, path))
    return seen.get


def _stage(df: DataFrame, name: str, cfg: BatchConfig) -> DataFrame:
    path = cfg.staged(name)
    _counted(df, name, cfg, path, lambda d: stage(d, path))
    return read_staged(df.sparkSession, path)


def _routed(
    df: DataFrame, name: str, cfg: BatchConfig, good: Column, also: Mapping[str, Column] | None = None
) -> tuple[DataFrame, dict]:
    """Stage good rows and rejects in one pass; return the good ones, and what was summed up."""
    rejects, path = F.count_if(~F.coalesce(good, F.lit(False))), cfg.staged(name)
    seen = _counted(
        df, name, cfg, path, lambda d: sinks.write_routed(d, path, good), {"rejects": rejects, **(also or {})}
    )
    cfg.metrics[name] = seen["rows"] - seen["rejects"]
    cfg.metrics[f"{name}_rejected"] = seen["rejects"]
    return sinks.side(read_staged(df.sparkSession, path), sinks.GOOD), seen


def _table(df: DataFrame, name: str, cfg: BatchConfig, **layout) -> DataFrame:
    path = cfg.table(name)
    _counted(df, name, cfg, path, lambda d: sinks.write_table(d, path, **layout))
    return read_staged(df.sparkSession, path, schemas.TABLES[name][1])


def _mart(df: DataFrame, name: str, cfg: BatchConfig) -> DataFrame:
    _counted(df, name, cfg, cfg.mart(name), lambda d: sinks.write_table(d, cfg.mart(name)))
    return read_staged(df.sparkSession, cfg.mart(name))


def run_extract(cfg: BatchConfig, sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage the four sources as they are and return the staged copies. Of a checked read the
    records that could not be read are set aside in the same pass."""
    missing = clean.missing_video_columns(sources["videos"])
    if missing:
        raise ValueError(f"videos lack {missing}")

    def land(name: str) -> DataFrame:
        df, staged = sources[name], f"raw_{name}"
        sums = frequent.of_videos() if name == "videos" else {}
        if readers.RAW_TEXT not in df.columns:
            path = cfg.staged(staged)
            seen = _counted(df, staged, cfg, path, lambda d: stage(d, path), sums)
            out = read_staged(df.sparkSession, path)
        else:
            out, seen = _routed(df, staged, cfg, F.col(readers.RAW_TEXT).isNull(), sums)
            out = out.drop(*readers.CHECKS)
        for kind in sums:
            _stage(frequent.table(df.sparkSession, kind, seen[kind]), f"frequent_{kind}", cfg)
        return out

    return _together(
        sources["videos"].sparkSession, {n: lambda n=n: land(n) for n in SOURCES}
    )


def staged_sources(spark: SparkSession, cfg: BatchConfig) -> dict[str, DataFrame]:
    """The sources as staged, without the records that could not be read."""
    staged = {name: read_staged(spark, cfg.staged(f"raw_{name}")) for name in SOURCES}
    return {
        name: sinks.side(df, sinks.GOOD).drop(*readers.CHECKS) if sinks.VERDICT in df.columns else df
        for name, df in staged.items()
    }


def frequent_keys(spark: SparkSession, cfg: BatchConfig) -> dict[str, DataFrame]:
    """Frequent authors and names of music, as the extract noted them."""
    return {kind: read_staged(spark, cfg.staged(f"frequent_{kind}")) for kind in frequent.NAMES}


def unreadable_records(spark: SparkSession, cfg: BatchConfig, name: str) -> DataFrame:
    """Text, reason and file of the records of a checked source that could not be read."""
    return readers.unreadable(sinks.side(read_staged(spark, cfg.staged(f"raw_{name}")), sinks.REJECT))


def unfit_cells(spark: SparkSession, cfg: BatchConfig, name: str) -> DataFrame:
    """The cells of a checked source that were no value of their column."""
    return readers.unfit_cells(sinks.side(read_staged(spark, cfg.staged(f"raw_{name}")), sinks.GOOD))


def rejected_fact_rows(spark: SparkSession, cfg: BatchConfig) -> DataFrame:
    """Videos that the load set aside, with the values that are no value of their column."""
    rows = read_staged(spark, cfg.staged("fact_rows"))
    return fact.rejected(sinks.side(rows, sinks.REJECT))


def clean_sources(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "videos": clean.videos(raw["videos"]),
        "creators": clean.creators(raw["creators"]),
        "comments": clean.comments(raw["comments"]),
        "taxonomy": clean.valid_taxonomy(raw["taxonomy"]),
    }


def run_transform(cfg: BatchConfig, raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Clean, derive, join; stage the joined videos and the hashtag pairs; write the marts."""
    spark = raw["videos"].sparkSession
    tidy = clean_sources(raw)
    small = _together(
        spark,
        {n: lambda n=n: _stage(tidy[n], n, cfg) for n in ("creators", "taxonomy")},
    )
    final = enrich.videos_final(
        features.video_features(tidy["videos"], cfg.viral_threshold),
        small["creators"],
        tidy["comments"],
        small["taxonomy"],
        hot=frequent_keys(spark, cfg)["authors"],
    )
    final = _stage(final, "transformed_final", cfg)

    def pairs() -> DataFrame:
        # Videos are unique by now; whether tag ids are is quickly seen in the small taxonomy.
        unique = quality.duplicate_keys(small["taxonomy"], ["hashtag_id"]).isEmpty()
        rows = enrich.bridge_pairs(final, small["taxonomy"], known_unique=unique)
        return _stage(rows, "bridge_hashtag", cfg)

    summaries = {
        "creator_stats": marts.creator_stats,
        "category_stats": marts.category_stats,
        "time_stats": marts.time_stats,
        "validation": quality.validate,
        "unfit_values": lambda df: quality.unfit_values(df, schemas.NARROWED),
    }
    works = {n: lambda n=n, m=m: _mart(m(final), n, cfg) for n, m in summaries.items()}
    works["pairs"] = pairs
    aside = {n: getattr(clean, f"rejected_{n}") for n in SOURCES}
    works |= {
        f"rejected_{n}": lambda n=n, f=f: _stage(f(raw[n]), f"rejected_{n}", cfg) for n, f in aside.items()
    }
    checked = _together(spark, works)["validation"].first()
    if not checked.passed:
        log.warning("joined videos failed validation, loading anyway: %s", checked.asDict())
    return {"final": final, **small}


def staged_transform(spark: SparkSession, cfg: BatchConfig) -> dict[str, DataFrame]:
    return {
        "final": read_staged(spark, cfg.staged("transformed_final")),
        "creators": read_staged(spark, cfg.staged("creators")),
        "taxonomy": read_staged(spark, cfg.staged("taxonomy")),
    }


def run_load(
    cfg: BatchConfig, raw_videos: DataFrame, done: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Build the dimensions, then the fact, then the bridge. Everything is written anew in this
    run's folder; only the creator history continues from the previous run's.
    """
    spark = raw_videos.sparkSession
    final = done["final"]

    def dim_date() -> DataFrame:
        if cfg.date_range is None:
            days = dimensions.date_table_for(final, F.col("createTimeISO"), cfg.holidays)
        else:
            days = dimensions.date_table_covering(
                final, F.col("createTimeISO"), *cfg.date_range, cfg.holidays
            )
        return _table(days, "dim_date", cfg)

    def dim_music() -> DataFrame:
        music = dimensions.music_table(raw_videos, lambda d: _stage(d, "music_rows", cfg))
        return _table(music, "dim_music", cfg)

    def dim_hashtag() -> DataFrame:
        return _table(dimensions.hashtag_table(done["taxonomy"]), "dim_hashtag", cfg)

    def dim_creator() -> DataFrame:
        return _creator_history(cfg, done["creators"])

    dims = _together(
        spark,
        {
            "dim_date": dim_date,
            "dim_music": dim_music,
            "dim_hashtag": dim_hashtag,
            "dim_creator": dim_creator,
        },
    )
    run = cfg.run_id or fact.run_id(cfg.loaded_at)
    keyed = fact.fact_table(
        final, dims["dim_creator"], dims["dim_music"], run, cfg.loaded_at,
        lambda d: _routed(d, "fact_rows", cfg, F.expr(fact.FITS))[0].drop("misfits"),
        frequent_keys(spark, cfg),
    )
    facts = _table(
        keyed, "fact", cfg, partition_by=("post_year", "post_month"), sort_by=("date_id",)
    )
    pairs = read_optional(
        spark, cfg.staged("bridge_hashtag"), "video_id string, hashtag_id string"
    )
    bridge = _table(fact.bridge_table(facts, pairs), "bridge", cfg)
    path = cfg.mart("daily_sums")
    sums = reports.daily_sums(facts)
    _counted(sums, "daily_sums", cfg, path, lambda d: sinks.write_table(d, path, partition_by=("post_year",)))
    daily = read_staged(spark, path)
    if cfg.kept:
        sinks.write_run(daily, f"{cfg.kept}/daily_sums", run, partition_by=("post_year",))
    tables = {**dims, "fact": facts, "bridge": bridge, "daily": daily}
    _check_load(cfg, tables)
    return tables


def _creator_history(cfg: BatchConfig, creators: DataFrame) -> DataFrame:
    """Load the profiles into the buckets of the history that they fall in; write those in which a
    version was closed or opened."""
    spark, folder = creators.sparkSession, cfg.table("dim_creator")
    before = f"{cfg.previous}/warehouse/dim_creator" if cfg.previous else None
    old, last = scd2.empty_dimension(spark), 0
    if before:
        names = scd2.incoming_versions(creators, cfg.as_of)
        touched = history.numbers(names) if history.parted(spark, before) else None
        old, last = history.read(spark, before, touched), history.last_key(spark, before)
    versions = scd2.scd2(
        old, creators, cfg.as_of, cfg.change_threshold,
        lambda d: _stage(d, "creator_versions", cfg), last,
    )
    opened = F.col("creator_sk").isNull()
    closed = (F.col("valid_to") == F.lit(cfg.as_of)) & ~F.col("is_current")
    moved = read_staged(spark, cfg.staged("creator_versions")).where(opened | closed).groupBy(
        history.bucket().alias("bucket")
    ).agg(F.count_if(opened).alias("opened")).collect()  # a row a bucket
    changed = {r["bucket"] for r in moved}
    if before and not history.parted(spark, before):
        changed = set(range(history.BUCKETS))
    last += sum(r["opened"] for r in moved)

    def written(rows: DataFrame) -> None:
        history.write(rows, folder, before, changed, last, str(cfg.as_of))

    if changed:
        _counted(versions, "dim_creator", cfg, folder, written)
    else:
        written(versions)
        cfg.metrics["dim_creator"] = 0
        cfg.written.append(("dim_creator", folder))
    return history.read(spark, folder)


def load_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values and rows of the loaded tables that lack their dimension row, by constraint."""
    checks = [
        ("fact", "creator_sk", "dim_creator", "creator_sk", "fact to creator"),
        ("fact", "date_id", "dim_date", "date_id", "fact to date"),
        ("fact", "music_sk", "dim_music", "music_sk", "fact to music"),
        ("bridge", "video_sk", "fact", "video_sk", "bridge to fact"),
        ("bridge", "hashtag_id", "dim_hashtag", "hashtag_id", "bridge to hashtag"),
    ]
    return _all(quality.reference_check(tables[c], k, tables[p], q, n) for c, k, p, q, n in checks)


def load_uniqueness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys of the loaded tables that occur twice or are NULL, by constraint."""
    current = tables["dim_creator"].where("is_current")
    checks = [
        ("dim_date", tables["dim_date"], ["date_id"]),
        ("dim_creator", tables["dim_creator"], ["creator_sk"]),
        ("current dim_creator", current, ["creator_nk"]),
        ("dim_hashtag", tables["dim_hashtag"], ["hashtag_id"]),
        ("dim_music", tables["dim_music"], ["music_sk"]),
        ("fact", tables["fact"], ["video_sk"]),
        ("fact", tables["fact"], ["video_id"]),
        ("bridge", tables["bridge"], ["video_sk", "hashtag_id"]),
    ]
    return _all(quality.unique_check(*c) for c in checks)


def _all(rows: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def _check_load(cfg: BatchConfig, tables: Mapping[str, DataFrame]) -> None:
    """Write what the loaded tables violate, one row for a constraint, and warn of it."""
    marts_ = {"fk_violations": load_references, "unique_violations": load_uniqueness}
    written = _together(
        tables["fact"].sparkSession,
        {n: lambda n=n, f=f: _mart(f(tables), n, cfg) for n, f in marts_.items()},
    )
    for name, rows in written.items():  # one row for each of the constraints above
        counts = [c for c in rows.columns if c != "constraint_name"]
        for row in rows.where(" or ".join(f"{c} > 0" for c in counts)).collect():
            log.warning("%s: %s", name, row.asDict())


def refuse_back_dated(spark: SparkSession, cfg: BatchConfig) -> None:
    """A load dated before the newest version it would close is an error, raised before
    anything is written. A second load of one day goes on from the first."""
    if not cfg.previous:
        return
    newest = history.newest(spark, f"{cfg.previous}/warehouse/dim_creator")
    if newest is not None and str(cfg.as_of) < newest:
        raise ValueError(f"as_of {cfg.as_of} is before {newest}, the newest version in {cfg.previous}")


def warehouse(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables a run wrote, with its daily sums if there are any."""
    tables = {
        name: read_staged(spark, f"{out}/warehouse/{name}", ddl)
        for name, (_, ddl) in schemas.TABLES.items()
        if name != "dim_creator"
    }
    tables["dim_creator"] = history.read(spark, f"{out}/warehouse/dim_creator")
    daily = f"{out}/marts/daily_sums"
    return tables | ({"daily": read_staged(spark, daily)} if exists(spark, daily) else {})


def kept_tables(spark: SparkSession, kept: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """A warehouse whose reports by date add up the daily sums of all runs in ``kept``."""
    return {**tables, "daily": read_staged(spark, f"{kept}/daily_sums")}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Temporary views under the tables' SQL names, for reports written in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(schemas.TABLES.get(name, ("daily_sums",))[0])


def run_reports(cfg: BatchConfig, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All reports as DataFrames, and written below ``out/reports``."""
    spark = tables["fact"].sparkSession

    def written(name: str, report: DataFrame) -> DataFrame:
        path = f"{cfg.out}/reports/{name}"
        _counted(report, f"report_{name}", cfg, path, lambda d: sinks.write_report(d, path))
        return read_staged(spark, path)

    all_reports = reports.run_all_reports(tables, cfg.min_year)
    return _together(
        spark, {n: lambda n=n, r=r: written(n, r) for n, r in all_reports.items()}
    )


def run_batch(
    spark: SparkSession,
    cfg: BatchConfig,
    sources: Mapping[str, DataFrame] | None = None,
    start: str = "extract",
    stop: str = "reports",
) -> dict[str, int]:
    """Run the stages from ``start`` to ``stop``; earlier ones are taken from staging if their
    manifests say that they are whole and were run with these settings. Returns the row count of
    everything written.
    """
    require_utc(spark)
    first, last = STAGES.index(start), STAGES.index(stop)
    if first > last:
        raise ValueError(f"start {start} comes after stop {stop}")
    if first <= 2 <= last:
        refuse_back_dated(spark, cfg)
    if first == 0 and sources is None:
        raise ValueError("extract needs sources")
    after = None
    for name in STAGES[:first]:
        after = manifest.require(spark, cfg.out, name, cfg.settings(name), after, start)
    raw = done = tables = None
    for name in STAGES[first : last + 1]:
        manifest.begin(spark, cfg.out, STAGES[STAGES.index(name) :])
        cfg.written.clear()
        if name == "extract":
            raw = run_extract(cfg, sources)
        elif name == "transform":
            raw = raw or staged_sources(spark, cfg)
            done = run_transform(cfg, raw)
        elif name == "load":
            raw, done = raw or staged_sources(spark, cfg), done or staged_transform(spark, cfg)
            tables = run_load(cfg, raw["videos"], done)
        else:
            run_reports(cfg, tables or warehouse(spark, cfg.out))
        rows = {n: cfg.metrics[n] for n, _ in cfg.written}
        after = manifest.commit(
            spark, cfg.out, name, cfg.settings(name), after, rows, {folder for _, folder in cfg.written}
        )
    return cfg.metrics
