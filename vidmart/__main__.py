"""Command line of the batch run: ``python -m vidmart --help``, or through spark-submit."""

from __future__ import annotations

import argparse
import json
import os
import time
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from vidmart.plans import batch
from vidmart.session import create_session
from vidmart.sources import readers


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vidmart", description=__doc__)
    p.add_argument("--out", required=True, help="folder of this run")
    p.add_argument("--previous", help="folder of the run whose creator history goes on")
    p.add_argument("--kept", help="folder of all runs, to whose daily sums this one adds its own")
    p.add_argument("--as-of", type=date.fromisoformat, required=True)
    p.add_argument("--loaded-at", type=datetime.fromisoformat, help="default: --as-of")
    p.add_argument("--start", choices=batch.STAGES, default="extract")
    p.add_argument("--stop", choices=batch.STAGES, default="reports")
    p.add_argument("--videos", help="JSON array files")
    p.add_argument("--creators", help="CSV files with a header")
    p.add_argument("--comments", help="JSON array files, read if the document store is not")
    p.add_argument("--taxonomy", help="CSV files with a header, read if the database is not")
    p.add_argument("--json-lines", action="store_true", help="JSON files hold one row a line")
    p.add_argument("--comments-store", nargs=3, metavar=("URI", "DATABASE", "COLLECTION"))
    p.add_argument("--taxonomy-table", nargs=2, metavar=("JDBC_URL", "TABLE"))
    p.add_argument("--taxonomy-user", help="its password is taken from VIDMART_DB_PASSWORD")
    p.add_argument(
        "--date-range", nargs=2, type=date.fromisoformat, metavar=("START", "END"),
        default=batch.dimensions.DATE_RANGE, help="days the calendar has at least",
    )
    p.add_argument("--holidays", help="CSV files with full_date and holiday_name")
    p.add_argument("--min-year", type=int, default=batch.reports.MIN_YEAR)
    p.add_argument("--viral-plays", type=int, default=batch.measures.VIRAL_PLAYS)
    p.add_argument("--show", action="store_true", help="print the first rows of each report")
    return p


def sources(spark: SparkSession, args: argparse.Namespace) -> tuple[dict, dict]:
    """The four frames, and for the two with a fallback which source was read."""
    multi_line = not args.json_lines

    def comment_files() -> DataFrame:
        return readers.comments_json(spark, args.comments, multi_line, checked=True)

    def taxonomy_files() -> DataFrame:
        return readers.taxonomy_csv(spark, args.taxonomy, checked=True)

    if args.comments_store:
        options = readers.document_options(*args.comments_store)
        comments, comments_from = readers.read_with_fallback(
            lambda: readers.connector(spark, "mongodb", options), comment_files
        )
    else:
        comments, comments_from = comment_files(), "files"
    if args.taxonomy_table:
        password = os.environ.get("VIDMART_DB_PASSWORD")
        options = readers.jdbc_options(*args.taxonomy_table, args.taxonomy_user, password)
        taxonomy, taxonomy_from = readers.read_with_fallback(
            lambda: readers.connector(spark, "jdbc", options), taxonomy_files
        )
    else:
        taxonomy, taxonomy_from = taxonomy_files(), "files"
    frames = {
        "videos": readers.videos_json(spark, args.videos, multi_line, checked=True),
        "creators": readers.creators_csv(spark, args.creators, checked=True),
        "comments": comments,
        "taxonomy": taxonomy,
    }
    return frames, {"comments": comments_from, "taxonomy": taxonomy_from}


def main(argv: list[str] | None = None) -> dict:
    args = arguments().parse_args(argv)
    began = time.monotonic()
    spark = create_session()
    cfg = batch.BatchConfig(
        out=args.out,
        previous=args.previous,
        kept=args.kept,
        as_of=args.as_of,
        loaded_at=args.loaded_at or datetime.combine(args.as_of, datetime.min.time()),
        min_year=args.min_year,
        date_range=tuple(args.date_range),
        holidays=readers.holidays_csv(spark, args.holidays) if args.holidays else None,
        viral_threshold=args.viral_plays,
    )
    given, read_from = sources(spark, args) if args.start == "extract" else (None, {})
    rows = batch.run_batch(spark, cfg, given, args.start, args.stop)
    if args.show and args.stop == "reports":
        for name in batch.reports.REPORTS:
            print(name)
            spark.read.parquet(f"{cfg.out}/reports/{name}").show(20, truncate=False)
    result = {"read_from": read_from, "rows": rows, "seconds": round(time.monotonic() - began, 1)}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
