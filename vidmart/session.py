"""Session settings the results rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

TIME_ZONE = "spark.sql.session.timeZone"
SPLIT = "spark.sql.files.maxPartitionBytes"
# Bytes of a file that one task reads, at most. What is sorted before a shuffle is a task's rows, many
# times as large in memory as in a compressed file, so by the default of 128 MB they would spill.
SPLIT_BYTES = 16 << 20
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
# Bytes of the rows that go to a Python worker at once. The default allows 10,000 rows of any size: 33 MB of
# common texts, held by the executor and by the worker, which keeps the memory it once had while it waits.
BATCH_BYTES = 4 << 20


def create_session(
    app_name: str = "vidmart", packages: tuple[str, ...] = (), **settings: str
) -> SparkSession:
    """A session for a batch run. ``packages`` names connector artefacts to fetch; everything
    else, memory and shuffle width included, is the cluster's business or given in
    ``settings`` (dots written as ``__``).
    """
    builder = SparkSession.builder.appName(app_name).config(TIME_ZONE, "UTC").config(SPLIT, SPLIT_BYTES)
    if packages:
        builder = builder.config("spark.jars.packages", ",".join(packages))
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Posting hours and dates are UTC whatever zone the session came with."""
    spark.conf.set(TIME_ZONE, "UTC")


def bound_splits(spark: SparkSession) -> None:
    """No task reads more than ``SPLIT_BYTES`` of a file; a smaller setting stays."""
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > SPLIT_BYTES:
        spark.conf.set(SPLIT, str(SPLIT_BYTES))


def bound_batches(spark: SparkSession) -> None:
    """No batch of rows for Python workers is larger than ``BATCH_BYTES`` by more than its last row; a
    smaller setting stays."""
    if not 0 < spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() <= BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get(TIME_ZONE)
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z"):
        raise ValueError(f"session time zone is {zone}; dates and hours are defined in UTC")
