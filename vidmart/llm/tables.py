"""Reading the tables and cutting lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidmart.sources.staging import new_folder, stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    return stage(df, new_folder(df.sparkSession, name))


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns the operators read; a null text is empty. Other columns cannot clash."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session has it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A table of literals that the optimizer sees as such; for a few rows of numbers or text."""

    def shown(v) -> str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)

    fields = [f.strip().split() for f in ddl.split(",")]
    values = ", ".join(f"({', '.join(map(shown, r))})" for r in rows)
    frame = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(f[0] for f in fields)})")
    return frame.select(*[F.col(n).cast(t).alias(n) for n, t in fields])
