"""Staging: tables written between stages, in a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# A file is split between its row groups only, so these are no larger than half of what a task is to
# read (``session.SPLIT_BYTES``).
LAYOUT = {"compression": "zstd", "parquet.block.size": str(8 << 20)}
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    On a local master with no such setting a temporary folder stands in, one per application;
    on a cluster a missing setting is an error, as executors share no local disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="vidmart-")
    return _local[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/vidmart/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet, replacing what is there, and return the written copy.

    Reading back is the point: what follows starts from files instead of recomputing the
    sources, and reads only the columns it needs.
    """
    writer = df.write.mode("overwrite").options(**LAYOUT)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_staged(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    reader = spark.read.schema(ddl) if ddl else spark.read
    return reader.parquet(path)


def _on_disk(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path as it knows it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    files, p = _on_disk(spark, path)
    return files.exists(p)


def remove(spark: SparkSession, path: str) -> bool:
    files, p = _on_disk(spark, path)
    return files.delete(p, True)


def files_below(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of each data file below ``path``, by its path relative to it."""
    files, p = _on_disk(spark, path)
    root, out = len(files.makeQualified(p).toString()) + 1, {}
    found = files.listFiles(p, True)
    while found.hasNext():
        one = found.next()
        name = files.makeQualified(one.getPath()).toString()[root:]
        if not name.rpartition("/")[2].startswith(("_", ".")):
            out[name] = one.getLen()
    return out


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written beside its place, then renamed."""
    files, p = _on_disk(spark, path)
    _, beside = _on_disk(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(p, False)
    if not files.rename(beside, p):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is not there."""
    files, p = _on_disk(spark, path)
    if not files.exists(p):
        return None
    source = files.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def read_optional(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A staged table, or an empty frame of the same layout if it was never written."""
    if exists(spark, path):
        return read_staged(spark, path, ddl)
    return spark.createDataFrame([], ddl)
