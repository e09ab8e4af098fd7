"""Readers for the four sources. Every reader takes an explicit layout unless told not to."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructType
from py4j.protocol import Py4JJavaError

from vidmart import schemas

log = logging.getLogger(__name__)

# What a checked read adds to the columns of the layout.
RAW_TEXT = "raw_text"
REASON = "reject_reason"
MISFITS = "misfits"
FILE = "source_file"
CHECKS = (RAW_TEXT, REASON, MISFITS, FILE)
_CORRUPT = "_corrupt_record"


def flatten_columns(df: DataFrame) -> DataFrame:
    """Replace literal dots in column names by underscores."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a plain scan out to all cores if it has fewer splits than cores.

    A file that cannot be split, or has one row group, is read by one task, which would then
    also do all that follows up to the next shuffle. A scan with enough splits, as any large
    table has, is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_json(
    spark: SparkSession, path: str, ddl: str | None, multi_line: bool = True
) -> DataFrame:
    """JSON array files (``multi_line``) or JSON Lines.

    A file holding one JSON array cannot be split, so one task reads it whole; large feeds
    should arrive as many files or as JSON Lines, which split by byte range.
    """
    reader = spark.read.option("multiLine", multi_line)
    return spread((reader.schema(ddl) if ddl else reader).json(path))


def read_csv(spark: SparkSession, path: str, ddl: str | None) -> DataFrame:
    """CSV with a header. With a layout, columns are found by their names in the header, in any
    order; a missing one is an error, others are left out. Values that are not of the column's
    type become NULL, whole numbers may be written with a decimal point.
    """
    reader = spark.read.option("header", True)
    if not ddl:
        return reader.option("inferSchema", True).csv(path)
    text = reader.csv(path)
    names = {c.strip().lstrip("\ufeff"): c for c in text.columns}
    wanted = StructType.fromDDL(ddl).fields
    if missing := [f.name for f in wanted if f.name not in names]:
        raise ValueError(f"{path} lacks the columns {missing}; it has {list(names)}")
    return text.select(*[_typed(F.col(f"`{names[f.name]}`"), f.dataType).alias(f.name) for f in wanted])


def _typed(c: Column, kind: DataType) -> Column:
    if isinstance(kind, IntegralType):
        number = F.trim(c).try_cast("decimal(38, 6)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    return c if isinstance(kind, StringType) else F.trim(c).try_cast(kind)


def checked_json(spark: SparkSession, path: str, ddl: str, multi_line: bool = True) -> DataFrame:
    """``read_json`` that loses nothing: see ``_checked``. Records that are no JSON objects are rejected;
    with ``multi_line`` the record is the whole file. Numbers and flags may be quoted."""
    names = [f.name for f in StructType.fromDDL(ddl).fields]
    layout = ", ".join(f"`{n}` string" for n in [*names, _CORRUPT])
    reader = spark.read.schema(layout).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, multiLine=multi_line
    )
    return _checked(reader.json(path), {n: n for n in names}, ddl, "not a JSON object")


def checked_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """``read_csv`` that loses nothing: see ``_checked``. Lines with more or fewer cells than the header
    are rejected."""
    header = spark.read.option("header", True).csv(path).columns
    names = {c.strip().lstrip("\ufeff"): c for c in header}
    wanted = [f.name for f in StructType.fromDDL(ddl).fields]
    if missing := [n for n in wanted if n not in names]:
        raise ValueError(f"{path} lacks the columns {missing}; it has {list(names)}")
    layout = ", ".join(f"`{n}` string" for n in [*header, _CORRUPT])
    # Without pruning every line is cut into all its cells, so whether it is whole does not depend
    # on the columns that a query asks for.
    reader = spark.read.schema(layout).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, header=True, columnPruning=False
    )
    return _checked(reader.csv(path), {n: names[n] for n in wanted}, ddl, "wrong number of cells")


def _checked(scan: DataFrame, names: dict[str, str], ddl: str, reason: str) -> DataFrame:
    """The columns of the layout, and for each record

    * ``raw_text``: the text of a record that could not be read, with ``reject_reason``; else NULL.
      ``sinks.write_routed`` or ``readable`` and ``unreadable`` part such records from the others;
    * ``misfits``: name, text and wanted type of the cells whose value is not of their column's
      type. The cell itself is NULL. An empty cell is no misfit;
    * ``source_file``.
    """
    fields = StructType.fromDDL(ddl).fields
    rows = spread(scan.select("*", F.col("_metadata.file_path").alias(FILE)))
    cells = {f.name: F.col(f"`{names[f.name]}`") for f in fields}
    # Spark refuses to read the text of broken records alone; with a cell beside it, it never is.
    broken = F.col(_CORRUPT).isNotNull() & (F.coalesce(F.length(cells[fields[0].name]), F.lit(0)) >= 0)
    unfit = [
        F.when(
            (F.trim(cells[f.name]) != "") & _typed(cells[f.name], f.dataType).isNull(),
            F.struct(
                F.lit(f.name).alias("column_name"), cells[f.name].alias("text"),
                F.lit(f.dataType.simpleString()).alias("wanted"),
            ),
        )
        for f in fields
        if not isinstance(f.dataType, StringType)
    ]
    misfits = F.array_compact(F.array(*unfit)) if unfit else F.expr(_NO_MISFITS)
    return rows.select(
        *[_typed(cells[f.name], f.dataType).alias(f.name) for f in fields],
        F.when(broken, F.col(_CORRUPT)).alias(RAW_TEXT),
        F.when(broken, F.lit(reason)).alias(REASON),
        F.when(broken, F.expr(_NO_MISFITS)).otherwise(misfits).alias(MISFITS),
        FILE,
    )


_NO_MISFITS = "cast(array() as array<struct<column_name: string, text: string, wanted: string>>)"


def readable(checked: DataFrame) -> DataFrame:
    """The records that could be read, in the layout's columns."""
    return checked.where(F.col(RAW_TEXT).isNull()).drop(*CHECKS)


def unreadable(checked: DataFrame) -> DataFrame:
    """Text, reason and file of the records that could not."""
    return checked.where(F.col(RAW_TEXT).isNotNull()).select(RAW_TEXT, REASON, FILE)


def unfit_cells(checked: DataFrame) -> DataFrame:
    """A row for each cell of a readable record that is not of its column's type."""
    cells = checked.where(F.size(MISFITS) > 0).select(F.explode(MISFITS).alias("m"), FILE)
    return cells.select("m.*", FILE)


def holidays_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, "full_date date, holiday_name string")


def videos_json(spark: SparkSession, path: str, multi_line: bool = True, checked: bool = False) -> DataFrame:
    read = checked_json if checked else read_json
    return flatten_columns(read(spark, path, schemas.VIDEO_FILE, multi_line))


def creators_csv(spark: SparkSession, path: str, checked: bool = False) -> DataFrame:
    return (checked_csv if checked else read_csv)(spark, path, schemas.CREATOR)


def comments_json(spark: SparkSession, path: str, multi_line: bool = True, checked: bool = False) -> DataFrame:
    return (checked_json if checked else read_json)(spark, path, schemas.COMMENT, multi_line)


def taxonomy_csv(spark: SparkSession, path: str, checked: bool = False) -> DataFrame:
    return (checked_csv if checked else read_csv)(spark, path, schemas.TAXONOMY)


def connector(
    spark: SparkSession, fmt: str, options: dict[str, str], ddl: str | None = None
) -> DataFrame:
    """Any Spark data source by name: a document store, JDBC, or a table format."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(ddl) if ddl else reader).load()


def document_options(uri: str, database: str, collection: str) -> dict[str, str]:
    """Options of the public document-store connector for one collection."""
    prefix = "spark.mongodb.read."
    return {
        prefix + "connection.uri": uri,
        prefix + "database": database,
        prefix + "collection": collection,
    }


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str = "org.postgresql.Driver",
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """JDBC options; with a partition column the table is read by ``partitions`` tasks."""
    out = {"url": url, "dbtable": table, "driver": driver, "fetchsize": str(fetch_size)}
    if user is not None:
        out["user"] = user
    if password is not None:
        out["password"] = password
    if partition_column:
        if bounds is None or not partitions:
            raise ValueError("a partitioned read needs bounds and a partition count")
        out |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return out


def range_predicates(column: str, cuts: list[str]) -> list[str]:
    """Conditions that deal a table with a text key to ``len(cuts) + 1`` tasks.

    Each row meets exactly one of them, NULL keys the last, in whatever order the database
    sorts: a row goes to the first cut that it is less than.
    """
    quoted = ["'" + c.replace("'", "''") + "'" for c in cuts]
    passed = [f"{column} >= {c}" for c in quoted]
    parts = [" AND ".join([*passed[:i], f"{column} < {c}"]) for i, c in enumerate(quoted)]
    rest = " AND ".join(passed) or f"{column} IS NOT NULL"
    return [*parts, f"({rest}) OR {column} IS NULL"]


def jdbc_by_predicates(
    spark: SparkSession, options: dict[str, str], predicates: list[str]
) -> DataFrame:
    """A table read by one task for each condition, for keys that are not numbers or dates."""
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=rest)


def unavailable(error: BaseException) -> str | None:
    """Why a source cannot be reached now: no such provider is installed, its server does not answer,
    or it took too long. None for all other errors, as of a wrong option, name or password."""
    cause = error.java_exception if isinstance(error, Py4JJavaError) else getattr(error, "_origin", None)
    seen = 0
    while cause is not None and seen < 32:  # causes may go round in a circle
        name, message, seen = cause.getClass().getName(), str(cause.getMessage()), seen + 1
        if message.startswith("[DATA_SOURCE_NOT_FOUND]") or name in _NO_CLASS and _is_provider(message):
            return "no provider"
        if name in _NO_SERVER or name.startswith("java.sql.SQL") and _refused(cause.getSQLState(), message):
            return "no connection"
        if name in _TOO_LATE:
            return "timeout"
        cause = cause.getCause()
    return None


_NO_CLASS = ("java.lang.ClassNotFoundException", "java.lang.NoClassDefFoundError")
_NO_SERVER = (
    "java.net.ConnectException", "java.net.UnknownHostException", "java.net.NoRouteToHostException",
    "com.mongodb.MongoSocketOpenException",
)
_TOO_LATE = (
    "java.net.SocketTimeoutException", "java.util.concurrent.TimeoutException", "java.sql.SQLTimeoutException",
    "com.mongodb.MongoTimeoutException",
)


def _is_provider(name: str) -> bool:
    """Whether a class that was not found belongs to a known driver or connector, rather than being
    a word that somebody mistyped."""
    return name.replace("/", ".").startswith(_DRIVERS)


def _refused(state: str | None, message: str) -> bool:
    """Whether an SQL error is of the connection class; an address that no driver takes is not."""
    return str(state or "").startswith("08") and "No suitable driver" not in message


_DRIVERS = (
    "org.postgresql.", "com.mongodb.", "com.mysql.", "org.mariadb.", "oracle.jdbc.", "com.microsoft.sqlserver.",
)


def read_with_fallback(
    primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]
) -> tuple[DataFrame, str]:
    """The primary source if it answers a one-row probe, else the fallback, and which it was.

    Reading is lazy, so a missing connector shows at load but an unreachable server only
    when a row is asked for; the probe covers both. Only a source that is ``unavailable`` is
    replaced: a wrong setting, like an unknown table or a refused password, is raised.
    """
    try:
        df = primary()
        df.limit(1).count()
        return df, "primary"
    except (PySparkException, Py4JJavaError) as error:
        why = unavailable(error)
        if why is None:
            raise
        log.warning("falling back (%s): %s", why, str(error).split("\n")[0])
        return fallback(), "fallback"
