"""The exact spectrum and the whitened vectors against plain linear algebra."""

import math
from fractions import Fraction

import numpy as np

from vidmart.llm import queries, whitening


def vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(2, 0.2, d)).astype(np.float32)


def frame(spark, x, ddl="vec_id long, embedding array<float>"):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(x)], ddl)


def times(a, b):
    return [x + y for x, y in zip([0, *a], [-b * x for x in [*a, 0]], strict=True)]


def test_characteristic_polynomial(spark):
    rng = np.random.default_rng(2)
    for d in (1, 2, 3, 7):
        y = rng.integers(-50, 50, (d + 2, d))
        m = (y.T @ y).tolist()
        c = whitening.polynomial(spark, m)
        assert c[-1] == 1 and c[-2] == -sum(m[i][i] for i in range(d))
        # Faddeev and Le Verrier in whole numbers
        a, power, want = np.array(m, object), np.identity(d, dtype=int).astype(object), [1]
        for k in range(1, d + 1):
            step = a.dot(power)
            want.append(-int(np.trace(step)) // k)
            power = step + want[-1] * np.identity(d, dtype=int).astype(object)
        assert c == want[::-1]


def test_remainders_with_zero_pivots():
    m = [[2, 0, 0, 1], [0, 2, 0, 0], [0, 0, 2, 0], [1, 0, 0, 2]]
    poly = [1]
    for root in (1, 2, 2, 3):
        poly = times(poly, root)
    p = whitening.primes(1)[0]
    assert whitening.remainders(m, p) == [x % p for x in poly]


def test_roots_are_isolated_and_counted():
    roots = [1, 5, 5, 5, 1000, 1001, 1 << 40]
    poly = [1]
    for r in roots:
        poly = times(poly, r)
    assert [whitening.roots_beyond(poly, m, 0) for m in (0, 1, 5, 999, 1000)] == [7, 6, 3, 3, 2]
    found = whitening.isolated(poly, 7)
    assert [n for *_, n in found] == [1, 1, 1, 3, 1]
    got = [whitening.refined(poly, *f) for f in found]
    for x, want in zip(got, [1 << 40, 1001, 1000, 5, 1], strict=True):
        assert abs(x / want - 1) < Fraction(1, 1 << 90)
    assert len(whitening.isolated(poly, 2)) == 2
    big = whitening.refined([2, -4, 1], *whitening.isolated([2, -4, 1], 1)[0])  # 2 + sqrt(2)
    assert abs(float(big) - (2 + math.sqrt(2))) < 1e-15 and abs((big - 2) ** 2 - 2) < Fraction(1, 1 << 150)


def test_fit_equals_linear_algebra(spark):
    x = vectors(300, 12)
    model = whitening.fit(frame(spark, x), components=8)
    y = np.floor(x.astype(float) * 64)
    values, own = np.linalg.eigh(np.cov(y.T, bias=True))
    values, own = values[::-1][:8], own[:, ::-1].T[:8]
    assert np.allclose(model.values, values, rtol=1e-12)
    assert np.allclose(np.abs((model.vectors * own).sum(1)), 1, atol=1e-12)
    assert np.allclose(model.vectors @ model.vectors.T, np.identity(8), atol=1e-15)
    assert np.allclose(model.explained, values / np.trace(np.cov(y.T, bias=True)), rtol=1e-12)


def test_equal_eigenvalues_and_lost_rank(spark):
    """Vectors on the axes have a covariance with one eigenvalue many times."""
    d = 6
    x = [s * 3 * np.eye(d)[k] for k in range(d) for s in (1, -1)]
    model = whitening.fit(frame(spark, x))
    assert len(model.values) == d and np.allclose(model.values, model.values[0], rtol=1e-15)
    assert np.allclose(model.vectors @ model.vectors.T, np.identity(d), atol=1e-15)
    assert whitening.identity_error(frame(spark, x), model) < 1e-12
    flat = [[a, b, a + b, 0.0] for a, b in np.random.default_rng(3).integers(-9, 9, (50, 2)).tolist()]
    model = whitening.fit(frame(spark, flat))
    assert len(model.values) == 2 and whitening.identity_error(frame(spark, flat), model) < 1e-12


def test_near_equal_eigenvalues(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([np.eye(5), -np.eye(5)]) * 1000 + rng.integers(-1, 2, (10, 5)) / 64
    model = whitening.fit(frame(spark, x))
    assert len(set(model.values.tolist())) > 1
    assert whitening.identity_error(frame(spark, x), model) < 1e-9


def test_sums_of_large_entries_are_exact(spark):
    x = [[1e13, -3.5], [-1e13, 2.25], [7e12, 0.0]] * 30
    n, sums, total = whitening.moments(frame(spark, x, "vec_id long, embedding array<double>").repartition(4))
    y = [[math.floor(64 * c) for c in v] for v in x]
    assert n == 90 and sums == [sum(v[j] for v in y) for j in range(2)]
    assert total == [[sum(v[i] * v[j] for v in y) for j in range(2)] for i in range(2)]


def test_odd_vectors(spark):
    rows = [[1.0, 2.0], None, [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], [], [3.0], [0.5, -1.0], [0.5, -1.0]]
    out = whitening.by_component(frame(spark, rows)).collect()
    assert {r["vec_id"] for r in out} == {0, 5, 6, 7, 8} and {r["n"] for r in out} == {5}
    y = {0: (64, 128), 5: (0, 0), 6: (192, 0), 7: (32, -64), 8: (32, -64)}
    s = [sum(v[j] for v in y.values()) for j in range(2)]
    for r in out:
        assert r["deviation"] == sum((5 * y[r["vec_id"]][j] - s[j]) ** 2 for j in range(2))
    one = {r["component"]: r["whitened"] for r in out if r["vec_id"] == 7}
    assert one == {r["component"]: r["whitened"] for r in out if r["vec_id"] == 8}
    assert max(r["identity_error"] for r in out) < 1e-12
    extra = frame(spark, vectors(9, 3)).selectExpr("vec_id", "embedding", "1 as n", "2 as whitened", "3 as component")
    assert whitening.by_component(extra).count() == 27
    model = whitening.fit(extra)
    assert whitening.whiten(extra, model).columns == ["vec_id", "n", "component", "whitened", "deviation"]


def test_no_variance_and_empty_tables(spark):
    assert whitening.by_component(frame(spark, [[1.0, 2.0]])).count() == 0
    assert whitening.by_component(frame(spark, [[1.0, 2.0]] * 5)).count() == 0
    none = frame(spark, [[1.0]]).where("false")
    assert whitening.fit(none) is None and whitening.by_component(none).count() == 0
    assert whitening.by_component(frame(spark, [None, []])).count() == 0


def test_query_against_plain(spark, tmp_path):
    x = vectors(500, 40, 7)
    frame(spark, x).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op13_whitening(spark, str(tmp_path)).collect()
    assert len(got) == 500 * 32
    y = np.floor(x.astype(float) * 64) + 1_000_000
    cov = np.cov(y.T, bias=True)
    values, own = np.linalg.eigh(cov)
    values, own = values[::-1][:32], own[:, ::-1][:, :32]
    want = (y - y.mean(0)) @ own / np.sqrt(values)
    out = np.zeros((500, 32))
    for r in got:
        out[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == 500 and abs(r["explained"] / (values[r["component"] - 1] / np.trace(cov)) - 1) < 1e-9
        assert r["identity_error"] < 1e-10
    assert np.allclose(out * np.sign((out * want).sum(0)), want, atol=1e-6)
    ints = y.astype(np.int64)
    squares = ((500 * ints - ints.sum(0)) ** 2).sum(1)
    assert all(r["deviation"] == squares[r["vec_id"]] for r in got)
