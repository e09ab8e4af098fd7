"""Folds and labels, shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(by: int) -> Column:
    """crc32 of doc_id as text, modulo ``by``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % by


def training_labels(labels: DataFrame, name: str, held_out: int = 1, folds: int = 3) -> DataFrame:
    """doc_id and y (0 or 1) outside the held-out fold. Null ids and labels are left out; of
    rows that repeat an id the smallest label counts."""
    return (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(name).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (remainder(folds) != held_out))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
    )
