"""Cuts and forms against plain string slicing, for all units."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidmart.llm import fillmiddle, queries


def draws(doc_id, seed="1"):
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def units(text, unit):
    """Where the units of a text begin."""
    if unit == "chars":
        return list(range(len(text)))
    if unit == "words":
        return [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return [0, *[m.end() for m in re.finditer("\n", text) if m.end() < len(text)]] if text else []


def plain(doc_id, text, unit):
    text = text or ""
    h1, h2, h3, h4 = draws(doc_id)
    begins = units(text, unit)
    n = len(begins)
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    i, j = (0 if k == 0 else len(text) if k == n else begins[k] for k in (one, two))
    a, m, b = text[:i], text[i:j], text[j:]
    if not text or h3 % 100 >= 90 or any(x in text for x in fillmiddle.MARKS):
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(a), len(m), f"<S>{b}<P>{a}<M>{m}"
    return n, "psm", len(a), len(m), f"<P>{a}<S>{b}<M>{m}"


TEXTS = [
    None, "", " ", "\n", "\n\n\n", "a", "one two  three\tfour\n", "  lead and tail  ", "é🙂日本語 text\nnaïve\n\nline",
    "has <P> inside", "<S", "ends with <", "<M", "x<M>", "a\r\nb", "<P", "🙂", "long " * 9000,
]


@pytest.mark.parametrize("unit", ["chars", "words", "lines"])
def test_forms_equal_slicing(spark, unit):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab \né🙂<") for _ in range(rng.randrange(200))) for _ in range(150)]
    rows = [(i, t, "clash", 5) for i, t in enumerate(texts * 2)] + [(None, "no id at all", "clash", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, kept int")
    out = fillmiddle.transform(docs, unit)
    assert out.columns == ["doc_id", "kept", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = out.withColumn("again", fillmiddle.restored()).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        want = plain(r["doc_id"], text[r["doc_id"]], unit)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["again"] == (text[r["doc_id"]] or "") and r["kept"] == 5
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_ranks_of_the_wavelet_matrix():
    rng = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1000):
        codes = rng.integers(0, 8, size).astype(np.uint8)
        matrix, at = fillmiddle.WaveletMatrix(codes), np.arange(size + 1)
        for code in range(8):
            assert matrix.rank(code, at).tolist() == [0, *np.cumsum(codes == code).tolist()]


def test_shares_and_seed(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some words of a text").alias("text"))
    forms = {r["form"]: r["count"] for r in fillmiddle.transform(docs, plain=50, suffix_first=50).groupBy("form").count().collect()}
    assert 150 < forms["plain"] < 250 and 60 < forms["spm"] < 140
    other = fillmiddle.transform(docs, seed="2").select("doc_id", F.col("output").alias("other"))
    assert fillmiddle.transform(docs).join(other, "doc_id").where("output <> other").count() > 300


def test_odd_tables(odd, none):
    out = fillmiddle.transform(odd)
    assert out.count() == odd.count()
    assert sorted(r[0] for r in out.select(fillmiddle.restored()).collect()) == sorted(
        r["text"] or "" for r in odd.collect()
    )
    assert fillmiddle.transform(none).count() == 0


def test_query_against_plain(spark, tmp_path):
    rows = list(enumerate(TEXTS * 3))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r["doc_id"]: r for r in queries.op12_fill_middle(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        n, form, prefix, middle, output = plain(i, text, "chars")
        assert tuple(got[i]) == (i, n, form, prefix, middle, sha(output), sha(text or ""))
