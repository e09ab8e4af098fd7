"""The operators as queries over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidmart.llm import (
    bpe, decontaminate, fillmiddle, fingerprint, jaccard, kneserney, linededup, quality, secretscan, sharding, topk, toxicity,
    whitening,
)
from vidmart.llm.tables import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digests(secretscan.scan(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.decided(scored, 0.7)


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), tokens, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(encoded, tokens))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text after the deletion, with the number of lines that went."""
    return linededup.dedup(table(spark, sf_dir, "documents"), over_blank=True).select("doc_id", "removed", "text")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.decided(scored, 0.5)


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneserney.score(table(spark, sf_dir, "documents"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text beside its edited form, whose last half is the beginning of the next document."""
    rows = fingerprint.with_next(table(spark, sf_dir, "documents"))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2)
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars") - half), F.substr("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2("edited", 256))
    prints = fingerprint.fingerprints(
        rows, {"text": "fingerprint", "edited": "edited_fingerprint", "next_text": "next_fingerprint"},
        ["doc_id", "n_chars", "edited_sha256"],
    )
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        fingerprint.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        fingerprint.likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fillmiddle.digests(fillmiddle.transform(table(spark, sf_dir, "documents")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.by_component(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("bigint"))


TOPK_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS own, vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), i AS MATERIALIZED (SELECT own, vec_id, list_transform(e, lambda x: floor(1024 * x)::BIGINT) AS e FROM v),
s AS (
  SELECT q.own, q.vec_id AS query_id, c.vec_id, coalesce(
    list_sum(list_transform(list_zip(q.e, c.e), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0)::BIGINT AS score
  FROM i q JOIN i c ON q.own <> c.own WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _secrets_sql() -> str:
    """Spans from matches and the pieces between them, rule by rule."""
    parts = []
    for number, r in enumerate(secretscan.BASE + secretscan.MORE):
        pattern = r.java.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {number} AS number, '{r.kind}' AS kind,
    unnest(regexp_extract_all(t, '{pattern}')) AS m, unnest(regexp_extract_all(t, '{pattern}', {r.part})) AS g,
    unnest(string_split_regex(t, '{pattern}')) AS gap, generate_subscripts(string_split_regex(t, '{pattern}'), 1) AS k,
    {r.least} AS least
  FROM d""")
    union = " UNION ALL ".join(parts)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), p AS ({union}),
s AS (
  SELECT *, sum(length(gap) + coalesce(length(m), 0)) OVER (PARTITION BY doc_id, number ORDER BY k) AS stop FROM p
), h AS (
  SELECT doc_id, number, kind, (stop - length(m))::BIGINT AS a, stop::BIGINT AS b FROM s WHERE length(g) >= least
), c AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, number) FILTER (number < {len(secretscan.BASE)}) AS base,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, number) AS spans
  FROM h GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN c USING (doc_id)
"""


SECRETS_SQL = _secrets_sql()


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return own | {"pipeline": corpus_pipeline.run}


def sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express on whole tables."""
    own = {"op2_exact_topk": TOPK_SQL, "op3_secret_scan": SECRETS_SQL}
    return own | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
