"""Prefix hashes, fingerprints and the row that comes next, against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidmart.llm import fingerprint, queries

WORDS = "alpha beta gamma naïve delta 日本 epsilon zeta 🙂 eta theta iota kappa lambda".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(99)) for _ in range(n))


def array(text):
    return np.frombuffer(text.encode(), np.uint8)


def whole(text):
    data = array(text)
    return fingerprint.prints(data, np.array([0, len(data)]))[0]


def test_spans_and_extensions():
    rng = random.Random(1)
    for _ in range(60):
        x = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 60)))
        y = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 60)))
        p, q = fingerprint.Prefix(array(x)), fingerprint.Prefix(array(y))
        i, j = rng.randrange(len(x) + 1), rng.randrange(len(y) + 1)
        n = rng.randrange(1 + min(len(x) - i, len(y) - j))
        assert (p.span(i, i + n) == q.span(j, j + n)) == (x[i : i + n] == y[j : j + n])
        ahead = next((k for k in range(60) if i + k >= len(x) or j + k >= len(y) or x[i + k] != y[j + k]))
        assert p.extension(i, q, j) == ahead
        back = next(k for k in range(60) if i - k <= 0 or j - k <= 0 or x[i - k - 1] != y[j - k - 1])
        assert p.extension_back(i, q, j) == back


def test_prefix_array_over_blocks(monkeypatch):
    text = prose(random.Random(2), 300)
    long_way = fingerprint.Prefix(array(text)).span(7, 2000), whole(text)
    monkeypatch.setattr(fingerprint, "BLOCK", 64)
    assert (fingerprint.Prefix(array(text)).span(7, 2000), whole(text)) == long_way


def test_a_fingerprint_holds_prefix_hashes():
    """Recomputed one byte at a time."""
    text = prose(random.Random(3), 200)
    marks = fingerprint.Marks(whole(text))

    def hashed(n):
        out = [sum((c + 1) * pow(b, i, p) for i, c in enumerate(text.encode()[:n])) % p for b, p in
               zip(fingerprint.BASES, fingerprint.PRIMES, strict=True)]
        return out[0] << 31 | out[1]

    assert marks.size == len(text.encode()) and marks.whole == hashed(marks.size)
    assert 8 <= len(marks.anchors) <= fingerprint.ANCHORS and 8 <= len(marks.evenly) <= fingerprint.STEPS
    assert all(h == hashed(p) for p, _, h in marks.anchors)
    assert all(int(h, 16) == hashed((i + 1) << marks.step) for i, h in enumerate(marks.evenly))


def test_prints_do_not_depend_on_neighbours():
    rng = random.Random(4)
    texts = [prose(rng, n) for n in (0, 1, 3, 40, 400, 2000)] + ["", "a" * 5000, "ab" * 900]
    data = np.concatenate([array(t) for t in texts])
    offsets = np.concatenate([[0], np.cumsum([len(array(t)) for t in texts])])
    assert fingerprint.prints(data, offsets) == [whole(t) for t in texts]
    assert len({whole(t) for t in texts}) == len(set(texts))
    assert fingerprint.prints(np.zeros(0, np.uint8), np.array([0])) == []


def test_likeness_follows_what_is_shared():
    rng = random.Random(5)
    for n in (6, 30, 300, 3000):
        x, y = prose(rng, n), prose(rng, n)
        half = x[: len(x) // 2] + y[: len(y) // 2]
        moved = y[: len(y) // 3] + x[len(x) // 2 :]
        assert fingerprint.likeness_of(whole(x), whole(x)) == 1
        assert fingerprint.likeness_of(whole(x), whole(y)) < 0.15
        assert 0.35 <= fingerprint.likeness_of(whole(x), whole(half)) <= 0.7
        if n > 30:
            assert fingerprint.likeness_of(whole(x), whole(moved)) >= 0.35
            assert fingerprint.likeness_of(whole(x), whole(x[:100] + "!" + x[100:])) >= 0.85
            far = whole(x * 9)  # another level
            assert fingerprint.likeness_of(whole(x), far) == fingerprint.likeness_of(far, whole(x)) > 0.3
    assert fingerprint.likeness_of(whole(""), whole("")) == 1
    assert fingerprint.likeness_of(whole(""), whole("a")) == 0


def test_common_spans(spark):
    rng = random.Random(6)
    shared, a, b, c = (prose(rng, 60) for _ in range(4))
    rows = [(1, a + "|é" + shared + "|" + b, c + "|é" + shared + "|"), (2, a, b), (3, None, a), (4, "", ""), (5, a, a)]
    got = fingerprint.common_spans(spark.createDataFrame(rows, "spans long, a string, b string"), "a", "b")
    by = {r["a"]: [tuple(s) for s in r["spans"]] for r in got.collect()}
    assert (len(a), len(c), len(shared) + 3) in by[rows[0][1]]
    assert by[None] == by[""] == []
    assert {r["b"]: [tuple(s) for s in r["spans"]] for r in got.collect()}[a] in ([], [(0, 0, len(a))])
    assert got.columns == ["a", "b", "spans"]


def plain_next(rows):
    """Each row with the text that follows by descending id, nulls last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return sorted(((r[0], r[1], order[(i + 1) % len(order)][1]) for i, r in enumerate(order)), key=str)


@pytest.mark.parametrize("ids", [range(200), [5], [7, 9], [*range(0, 10_000, 97), None], [-(1 << 63), (1 << 63) - 1, 0]])
def test_next_row(spark, ids):
    rng = random.Random(7)
    rows = [(i, prose(rng, 3) + str(k)) for k, i in enumerate(ids)]
    rng.shuffle(rows)
    out = fingerprint.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, out.collect()), key=str) == plain_next(rows)


def test_next_row_on_odd_tables(spark, odd, none):
    out = fingerprint.with_next(odd).collect()
    assert len(out) == odd.count()
    # as a cycle, every row's text is the next of one row
    assert sorted(r["text"] for r in out) == sorted(r["next_text"] for r in out)
    assert fingerprint.with_next(none).count() == 0
    repeated = spark.createDataFrame([(1, "same")] * 40 + [(2, "two"), (0, "zero")], "doc_id long, text string")
    got = sorted((r["text"], r["next_text"]) for r in fingerprint.with_next(repeated.repartition(4)).collect())
    assert got == sorted([("same", "same")] * 39 + [("same", "zero"), ("two", "same"), ("zero", "two")])


def test_fingerprints_of_odd_tables(odd, none):
    out = fingerprint.fingerprints(odd, {"text": "fp"}, ["doc_id", "size", "score"])
    assert out.columns == ["doc_id", "size", "score", "fp"] and out.count() == odd.count()
    assert out.where("fp is null").count() == 0
    assert fingerprint.fingerprints(none, {"text": "fp"}, []).count() == 0


def test_query_against_plain(spark, tmp_path):
    rng = random.Random(8)
    texts = [prose(rng, n % 50) for n in range(90)] + [None, "", "🙂", "é" * 33]
    texts[20] = texts[21] = texts[22]
    ids = rng.sample(range(1000), len(texts))
    spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = {r["doc_id"]: r for r in queries.op11_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(zip(ids, texts, strict=True), reverse=True)
    assert len(got) == len(order)
    for k, (i, text) in enumerate(order):
        x, y = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(x) // 2
        edited = x[: len(x) - half] + y[:half]
        assert got[i]["n_chars"] == len(x)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (whole(x), whole(edited))
        assert got[i]["near_next"] == fingerprint.likeness_of(whole(x), whole(y))
        assert got[i]["near_edited"] == fingerprint.likeness_of(whole(x), whole(edited))
    assert 0 <= min(r["near_next"] for r in got.values()) and max(r["near_edited"] for r in got.values()) <= 1


def test_likeness_of_nulls(spark):
    rows = spark.createDataFrame([("0.0.0000000000000000.0.", None)], "a string, b string")
    assert rows.select(fingerprint.likeness("a", "b").alias("x")).first()["x"] is None
    assert rows.select(fingerprint.likeness("a", "a").alias("x")).where(F.col("x") == 1).count() == 1
