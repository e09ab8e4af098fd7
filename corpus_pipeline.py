"""Raw documents to training tokens, in five stages.

Each stage takes the documents that the one before it kept, as a table read back from Parquet,
and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidmart.llm import bpe, decontaminate, jaccard, linededup, quality
from vidmart.llm.tables import cut, table
from vidmart.session import bound_batches

VOCABULARY = "byte_bpe_50k.tiktoken"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    bound_batches(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the line runs that an earlier one has; n_chars follows the text. A
    document all of whose words went is a copy of earlier ones and goes."""
    out = linededup.dedup(docs, over_blank=True)
    left = F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    out = out.where((F.col("removed") == 0) | left)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        n = F.when(F.col("removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n.cast(kind))
    return out.select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.unique(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    bound_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the hash of what they decode to."""
    bound_batches(spark)
    tokens = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    decoded = bpe.decode(bpe.encode(docs, tokens, public_tokenizers.PATTERN), tokens)
    return decoded.select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2("bytes", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_bpe),
]

ORACLE_SQL = None  # a classifier, recursive classes and merges; tested against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
