"""Work and memory of the operators."""

import tracemalloc

import numpy as np
import pyarrow as pa

from vidmart import session
from vidmart.llm import bytewords, components, jaccard, kneserney, toxicity


def test_stars_are_not_worked_on_again(spark, monkeypatch):
    rounds, star = [], components._star
    monkeypatch.setattr(components, "_star", lambda *a: rounds.append(a[2]) or star(*a))

    def found(edges):
        rounds.clear()
        rows = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
        assert len({r["node"] for r in rows}) == len(rows)
        return {r["node"]: r["least"] for r in rows}, len(rounds)

    assert found([(5, 1), (1, 6), (7, 1), (9, 8), (3, 3)]) == ({1: 1, 5: 1, 6: 1, 7: 1, 8: 8, 9: 8}, 0)
    got, stars = found([(1, 2), (2, 3), (3, 4), (4, 5)])
    assert got == {k: 1 for k in range(1, 6)} and stars >= 2
    got, stars = found([(9, 1), (9, 2)])  # hangs on two
    assert got == {1: 1, 2: 1, 9: 1} and stars == 2
    assert found([]) == ({}, 0)


def test_tasks_hold_bounded_arrays():
    """Hashing words takes few arrays of the size of a slice, and slices are small."""
    data = np.frombuffer(b"some words " * (1 << 16), np.uint8)
    starts, stops, _ = bytewords.word_spans(data, np.array([0, len(data)]))
    bytewords.span_hashes(data, starts, stops)  # powers are kept
    tracemalloc.start()
    try:
        bytewords.span_hashes(data, starts, stops)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak <= 14 * len(data)  # 17 if not worked out in place
    assert jaccard.SLICE <= 2 << 20 and kneserney.SLICE <= 1 << 20 and kneserney.FLUSH <= 1_000_000


def test_words_are_valued_once_for_many_texts():
    """Texts are scored as by their definition, each plain word of them once."""
    rng = np.random.default_rng(3)
    machine = toxicity.Machine(rng.standard_normal(toxicity.LETTERS**3), -0.4)
    odd = ["", " \x1c\x85 ", "w i c k e d wicked", "a\u2003b  c word", "x y", "\u00dcber \u00fcber \u0130x", "-- ...", "q" * 90, "a-b A.B. ab"]
    texts = odd + [" ".join(rng.choice(["Some", "some,", "(some)", "w\u00f6rds", "like", "these", "z" * 30], 40)) for _ in range(50)]

    def value(word):
        return max(machine.values(toxicity._pieces(toxicity.plain(word))), default=toxicity.NOTHING)

    want = [
        sorted([value(w) for w in set(toxicity.instances(t))] + [toxicity.NOTHING] * toxicity.WORST, reverse=True)[: toxicity.WORST]
        for t in texts
    ]
    column = pa.array(["left out", *texts]).slice(1)
    seen, values = [], machine.values
    machine.values = lambda words: seen.extend(words) or values(words)
    got = toxicity._worst(machine)(column)
    assert np.array_equal(got, want)
    machine.values = values
    repeated = pa.array(texts[len(odd):] * 40)
    seen.clear()
    machine.values = lambda words: seen.extend(words) or values(words)
    assert len(toxicity._worst(machine)(repeated)) == 2000
    assert len(seen) == 6  # four words and two pieces of the long one
    assert toxicity._worst(machine)(repeated.slice(0, 0)).shape == (0, toxicity.WORST)


def test_workers_get_bounded_batches(spark):
    """Many long rows go to Python workers in batches of a few MB; a smaller setting stays."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 1000) AS text").coalesce(1)

    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    def largest():
        return max(r["n"] for r in docs.mapInArrow(size, "n long").collect())

    spark.conf.unset(session.BATCH)
    assert largest() > 20_000_000
    try:
        assert jaccard.join(docs).count() == 3000
        assert largest() <= session.BATCH_BYTES + 20_000
        spark.conf.set(session.BATCH, "1m")
        session.bound_batches(spark)
        assert largest() <= (1 << 20) + 20_000
    finally:
        spark.conf.unset(session.BATCH)
