"""Table sinks: overwrite, append, insert-if-absent, load-once, report files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vidmart.operators.clean import keep_first
from vidmart.sources.staging import LAYOUT, exists, files_below, read_staged, remove

VERDICT = "verdict"
GOOD, REJECT = "good", "reject"


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
) -> None:
    """Parquet table. With partition columns, rows are first gathered by partition value so
    each task writes few files; AQE splits a partition value that is too large for one task.
    ``sort_by`` orders rows inside the files, so that their statistics let readers skip.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode).options(**LAYOUT)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_routed(df: DataFrame, path: str, good: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects from one pass: a single write with the verdict as partition column, read
    back as two tables, so setting rows aside costs no second scan. NULL counts as a reject."""
    verdict = F.when(good, F.lit(GOOD)).otherwise(F.lit(REJECT))
    df.withColumn(VERDICT, verdict).write.mode("overwrite").options(**LAYOUT).partitionBy(VERDICT).parquet(path)
    written = df.sparkSession.read.schema(StructType([*df.schema, StructField(VERDICT, StringType())])).parquet(path)
    return side(written, GOOD), side(written, REJECT)


def side(written: DataFrame, verdict: str) -> DataFrame:
    """One side of a routed table; files of the other side are not read."""
    return written.where(F.col(VERDICT) == verdict).drop(VERDICT)


def write_run(
    df: DataFrame, path: str, run_id: str, run_column: str = "pipeline_run_id", partition_by: tuple[str, ...] = ()
) -> None:
    """Add a run's rows to a table of many runs; a run that is loaded again replaces its own rows.

    The run is the first partition column and partitions are overwritten as they come, so other
    runs are neither read nor written, and the old rows stay until the new ones are committed.
    Then partitions that only the run's earlier load had are removed: those with its files left.
    """
    spark, own = df.sparkSession, f"{path}/{run_column}={run_id}"
    before = files_below(spark, own) if exists(spark, own) else {}
    df = df.withColumn(run_column, F.lit(run_id))
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **LAYOUT).partitionBy(
        run_column, *partition_by
    ).parquet(path)
    after = files_below(spark, own) if before else {}
    for stale in sorted({name.rpartition("/")[0] for name in before.keys() & after.keys()}):
        remove(spark, f"{own}/{stale}" if stale else own)


def write_jdbc(
    df: DataFrame, options: dict[str, str], mode: str = "append", connections: int = 16
) -> None:
    """Batched inserts from ``connections`` tasks, so the database is not swamped. The rows are
    dealt out anew for that; what comes before keeps its own width."""
    df.repartition(connections).write.format("jdbc").mode(mode).options(
        **{"batchsize": "10000", "truncate": "true", **options}
    ).save()


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    return keep_first(df, keys, [F.col(c).asc_nulls_last() for c in others or keys])


def absent_rows(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target does not have yet, one per key."""
    return one_per_key(df, keys).join(target.select(*keys), keys, "left_anti").select(*df.columns)


def insert_if_absent(df: DataFrame, path: str, keys: list[str]) -> None:
    """Append the rows whose key is new; conflicts are ignored, so a re-run adds nothing."""
    spark = df.sparkSession
    if exists(spark, path):
        new = absent_rows(df, read_staged(spark, path), keys)
    else:
        new = one_per_key(df, keys)
    write_table(new, path, mode="append")


def load_once(df: DataFrame, path: str) -> bool:
    """Write only if the table is missing or empty; say whether anything was written."""
    spark = df.sparkSession
    if exists(spark, path) and not spark.read.schema(df.schema).parquet(path).isEmpty():
        return False
    write_table(df, path)
    return True


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
