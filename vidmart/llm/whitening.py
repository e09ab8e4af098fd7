"""Whitening of embeddings along the exact spectrum of their covariance.

Entries become integers, so counts, sums and products of the vectors are exact and do not depend on
how Spark deals the rows out. n times the sum of products less the product of sums is the scatter
matrix C, n squared times the covariance, in integers. Its characteristic polynomial is worked out
modulo one prime a row: similarity transforms bring C to Hessenberg form, whose polynomial
follows by a recurrence; the remainders are put together by the Chinese remainder theorem, with
as many primes as the largest possible coefficient asks for. All roots are real, so the signs of the
polynomial moved to a point tell exactly how many roots lie beyond it (Descartes): halving isolates
them, and signs of exact values refine them. For each root, inverse iteration in long fixed-point
numbers finds the null space of C less the root; equal roots are one task with as many vectors.

What reaches the driver is bounded by the dimension: products, remainders and components.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64  # an entry c counts as floor(SCALE * c)
COMPONENTS = 32
MOST = 1 << 50  # entries beyond this have no integer and are treated as not finite
ROOT_BITS = 160  # of a root that is alone
EQUAL_BITS = 96  # roots that share so many leading bits are one root with several vectors
WORK_BITS = 224  # of the numbers in the inverse iteration
TURNS = 3


@dataclass
class Fit:
    """n vectors with integer sums; eigenvalues of the covariance and unit eigenvectors, largest
    first; the share of the variance that each explains."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray  # component, dimension
    explained: np.ndarray


def usable(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and has finite entries only."""
    fits = F.forall(column, lambda x: x.isNotNull() & (F.abs(x.cast("double")) * SCALE <= F.lit(float(MOST))) & ~F.isnan(x))
    return rows.where(F.col(column).isNotNull() & fits)


def integers(column: pa.Array, dims: int | None = None) -> np.ndarray:
    """A row of integers for each vector; entries that a shorter vector lacks are 0."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    many = np.diff(offsets)
    dims = int(many.max(initial=0)) if dims is None else dims
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE).astype(np.int64)
    out = np.zeros((len(many), dims), np.int64)
    row = np.repeat(np.arange(len(many)), many)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], many)] = flat
    return out


def products(y: np.ndarray) -> np.ndarray:
    """y' y, exactly: by floats while these hold every sum, else by long integers."""
    most = int(np.abs(y).max(initial=0))
    rows = max(1, (1 << 53) // max(1, most * most))
    if rows < 64:
        y = y.astype(object)
        return y.T.dot(y)
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for k in range(0, len(y), rows):
        part = y[k : k + rows].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def moments(rows: DataFrame, column: str = "embedding") -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, their sums and their sums of products. One scan; each task sends a
    triangle of numbers, and the sums of the triangles are all that is collected."""

    def run(batches):
        n, total, sums = 0, np.zeros((0, 0), object), np.zeros(0, object)
        for batch in batches:
            y = integers(batch.column(0))
            n += len(y)
            if y.shape[1] > len(sums):  # vectors longer than any before
                known, had = len(sums), (total, sums)
                total, sums = np.zeros((y.shape[1],) * 2, object), np.zeros(y.shape[1], object)
                total[:known, :known], sums[:known] = had
            total[: y.shape[1], : y.shape[1]] += products(y)
            sums[: y.shape[1]] += y.astype(object).sum(0) if len(y) else 0
        if n:
            i, j = np.triu_indices(len(sums))
            ints = [n, *sums.tolist(), *total[i, j].tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([-1, *[-1] * len(sums), *i.tolist()], pa.int32()),
                    pa.array([-1, *range(len(sums)), *j.tolist()], pa.int32()),
                    pa.array([Decimal(int(v)) for v in ints], pa.decimal128(38, 0)),
                ],
                names=["i", "j", "v"],
            )

    parts = usable(rows, column).select(column).mapInArrow(run, "i int, j int, v decimal(38,0)")
    found = {(r["i"], r["j"]): int(r["v"]) for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    d = 1 + max((j for _, j in found), default=-1)
    sums = [found[-1, j] for j in range(d)]
    return found.get((-1, -1), 0), sums, [[found[min(i, j), max(i, j)] for j in range(d)] for i in range(d)]


def primes(count: int) -> list[int]:
    """The largest primes below 2**31."""

    def prime(p: int) -> bool:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for a in (2, 3, 5, 7):  # enough below 3,215,031,751
            x = pow(a, odd, p)
            if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(twos - 1)):
                return False
        return True

    out, p = [], (1 << 31) - 1
    while len(out) < count:
        if prime(p):
            out.append(p)
        p -= 2
    return out


def remainders(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of the characteristic polynomial modulo ``p``, constant first."""
    h = np.array([[x % p for x in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(1, d - 1):  # column k - 1 gets zeros below row k
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % p) % p
        for r in np.flatnonzero(factor):
            h[:, k] = (h[:, k] + int(factor[r]) * h[:, k + 1 + r]) % p
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for k in range(1, d + 1):
        now = -h[k - 1, k - 1] * poly[k - 1] % p
        now[1:] += poly[k - 1, :-1]
        path = 1
        for i in range(1, k):
            path = path * int(h[k - i, k - i - 1]) % p
            if not path:
                break
            now = (now - int(h[k - 1 - i, k - 1]) * path % p * poly[k - 1 - i]) % p
        poly[k] = now % p
    return poly[d].tolist()


def polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Characteristic polynomial of a positive semidefinite integer matrix, constant first."""
    d, trace = len(matrix), sum(row[i] for i, row in enumerate(matrix))
    # the k-th coefficient is a sum of products of k of d roots whose sum is the trace
    bound = max(math.comb(d, k) * (trace**k // d**k + 1) for k in range(d + 1))
    wanted = primes(bound.bit_length() // 30 + 2)

    def run(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int64()), pa.array([remainders(matrix, p)], pa.list_(pa.int64()))], names=["p", "c"]
                )

    rows = spark.createDataFrame([(p,) for p in wanted], "p long").repartition(-(-len(wanted) // 8))
    left = {r["p"]: r["c"] for r in rows.mapInArrow(run, "p long, c array<long>").collect()}
    whole = math.prod(left)
    out = [0] * (d + 1)
    for p, c in left.items():
        rest = whole // p
        unit = rest * pow(rest, -1, p)
        out = [x + unit * y for x, y in zip(out, c, strict=True)]
    return [x - whole if x > whole // 2 else x for x in (y % whole for y in out)]


def _moved(c: list[int], m: int, k: int) -> list[int]:
    """Coefficients, up to a positive factor, of the polynomial moved to m / 2**k."""
    d = len(c) - 1
    c = [x << k * (d - i) for i, x in enumerate(c)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += m * c[j + 1]
    return c


def roots_beyond(c: list[int], m: int, k: int) -> int:
    """Roots beyond m / 2**k of a polynomial whose roots are all real, with multiplicity."""
    signs = [x > 0 for x in _moved(c, m, k) if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(c: list[int], m: int, k: int) -> int:
    """Sign of the polynomial at m / 2**k."""
    value, scale = 0, 1
    for x in reversed(c):
        value = value * m + x * scale
        scale <<= k
    return (value > 0) - (value < 0)


def isolated(c: list[int], most: int) -> list[tuple[int, int, int, int]]:
    """(low, k, number, halvings) of the intervals that hold the ``most`` largest roots, largest
    first: low / 2**k < root <= (low + 1) / 2**k. A number over 1 stands for equal roots."""
    d = len(c) - 1
    top = abs(c[d - 1]).bit_length() + 1  # roots add up to the last but one
    out, missing = [], min(most, d)
    # a stack of intervals (low, low + 1] / 2**k, k may be negative, with roots beyond either end
    todo = [(0, -top, d, 0)]
    while todo and missing > 0:
        low, k, beyond_low, beyond_high = todo.pop()
        number = beyond_low - beyond_high
        if not number:
            continue
        if number == 1 or low.bit_length() > EQUAL_BITS:
            out.append((low, k, number))
            missing -= number
            continue
        m, k = 2 * low + 1, k + 1
        middle = roots_beyond(c, m, k) if k >= 0 else roots_beyond(c, m << -k, 0)
        todo += [(m - 1, k, beyond_low, middle), (m, k, middle, beyond_high)]
    return out


def refined(c: list[int], low: int, k: int, number: int) -> Fraction:
    """The root of an isolated interval, from its lower end on, to ROOT_BITS."""
    if k < 0:
        low, high, k = low << -k, (low + 1) << -k, 0
    else:
        high = low + 1
    if number > 1:
        return Fraction(low + high, 2 << k)
    at_high = _sign(c, high, k)
    if at_high == 0:
        return Fraction(high, 1 << k)
    while (high - low) << ROOT_BITS > high:
        if high - low == 1:
            low, high, k = 2 * low, 2 * high, k + 1
        m = (low + high) // 2
        s = _sign(c, m, k)
        if s == 0:
            return Fraction(m, 1 << k)
        low, high = (low, m) if s == at_high else (m, high)
    return Fraction(low + high, 2 << k)


def null_space(matrix: list[list[int]], root: Fraction, number: int) -> np.ndarray:
    """Unit vectors, ``number`` of them and orthogonal, that the matrix only stretches by ``root``:
    elimination with pivots and inverse iteration in numbers of WORK_BITS binary places."""
    d, one = len(matrix), 1 << WORK_BITS
    norm = max(1, max(abs(x) for row in matrix for x in row))
    a = np.array([[x * one // norm for x in row] for row in matrix], object)
    shift = (root.numerator << WORK_BITS) // (root.denominator * norm)
    a[range(d), range(d)] = a[range(d), range(d)] - shift
    order, factors = list(range(d)), []
    for k in range(d):
        best = k + max(range(d - k), key=lambda r: abs(a[k + r, k]))
        if best != k:
            a[[k, best]] = a[[best, k]]
        order[k] = best
        if a[k, k] == 0:
            a[k, k] = 1  # exactly singular: a step of the last place
        f = (a[k + 1 :, k] << WORK_BITS) // a[k, k]
        factors.append(f)
        if len(f):
            a[k + 1 :, k:] = a[k + 1 :, k:] - ((f[:, None] * a[k, k:]) >> WORK_BITS)

    def unit(v: np.ndarray) -> np.ndarray:
        v = (v << WORK_BITS) // max(1, max(abs(x) for x in v))
        return (v << WORK_BITS) // max(1, math.isqrt(int((v * v).sum())))

    rng = np.random.default_rng(13)
    space = [unit(np.array([int(x) << 160 for x in rng.integers(1 << 20, 1 << 40, d)], object)) for _ in range(number)]
    for _ in range(TURNS):
        done: list[np.ndarray] = []
        for v in space:
            v = v.copy()
            for k in range(d):
                v[[k, order[k]]] = v[[order[k], k]]
                v[k + 1 :] = v[k + 1 :] - ((factors[k] * v[k]) >> WORK_BITS)
            for k in range(d - 1, -1, -1):
                v[k] = ((v[k] - (int((a[k, k + 1 :] * v[k + 1 :]).sum()) >> WORK_BITS)) << WORK_BITS) // a[k, k]
            v = unit(v)
            for _ in range(2):  # the second time takes what rounding left
                for u in done:
                    v = v - ((u * (int((u * v).sum()) >> WORK_BITS)) >> WORK_BITS)
                v = unit(v)
            done.append(v)
        space = done
    out = np.array([[float(Fraction(int(x), one)) for x in v] for v in space])
    for v in out:
        if v[np.abs(v).argmax()] < 0:
            v *= -1
    return out


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """The spectrum of all usable vectors, up to ``components`` components with an eigenvalue over
    0. None if there are no vectors; without variance there are no components."""
    n, sums, total = moments(rows, column)
    if not n:
        return None
    d = len(sums)
    scatter = [[n * total[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(scatter[i][i] for i in range(d))
    if not trace:
        return Fit(n, sums, np.zeros(0), np.zeros((0, d)), np.zeros(0))
    spark = rows.sparkSession
    c = polynomial(spark, scatter)
    c = c[next(i for i, x in enumerate(c) if x) :]  # without the roots that are 0
    found = isolated(c, components)

    def run(batches):
        for batch in batches:
            for at in batch.column(0).to_pylist():
                low, k, number = found[at]
                root = refined(c, low, k, number)
                space = null_space(scatter, root, number)
                value, share = float(root / (n * n)), float(root / trace)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([at] * number, pa.int32()), pa.array([value] * number, pa.float64()),
                        pa.array([share] * number, pa.float64()), pa.array(space.tolist(), pa.list_(pa.float64())),
                    ],
                    names=["at", "value", "share", "vector"],
                )

    tasks = spark.createDataFrame([(i,) for i in range(len(found))], "at int").repartition(-(-len(found) // 4))
    got = tasks.mapInArrow(run, "at int, value double, share double, vector array<double>").collect()
    got = sorted(got, key=lambda r: r["at"])[:components]
    values, vectors, share = ([r[k] for r in got] for k in ("value", "vector", "share"))
    return Fit(n, sums, np.array(values), np.array(vectors), np.array(share))


def _whitened(y: np.ndarray, model: Fit) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Distances n * y - S as whole numbers, sums of their squares, and whitened vectors."""
    most = max(int(np.abs(y).max(initial=0)) * model.n, *(abs(s) for s in model.sums), 1)
    kind = np.int64 if most < 1 << 61 else object
    away = y.astype(kind) * model.n - np.array(model.sums, kind)
    if 4 * most * most * max(1, y.shape[1]) < 1 << 63:
        squares = (away * away).sum(1).tolist()
    else:
        far = away.astype(object)
        squares = (far * far).sum(1).tolist()
    centred = (away / model.n).astype(np.float64)
    return away, squares, centred @ model.vectors.T / np.sqrt(model.values)


def whiten(rows: DataFrame, model: Fit, column: str = "embedding") -> DataFrame:
    """The usable rows with their other columns, whitened (array of doubles, a component each) and
    deviation: the sum over dimensions of (n * x - S) squared, exact, as decimal(38,0).

    Vectors that are null or hold null or non-finite entries are left out, as are entries beyond
    MOST / SCALE. A vector shorter than the longest lacks entries, which count as 0; an empty one
    lacks all. Rows that repeat count each. Columns named whitened or deviation are replaced.
    """
    others = [c for c in rows.columns if c not in (column, "whitened", "deviation")]
    kept = usable(rows, column).select(column, *others)
    dims = len(model.sums)

    def run(batches):
        for batch in batches:
            _, squares, w = _whitened(integers(batch.column(0), dims), model)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:], pa.array(w.tolist(), pa.list_(pa.float64())),
                    pa.array([Decimal(int(v)) for v in squares], pa.decimal128(38, 0)),
                ],
                names=[*others, "whitened", "deviation"],
            )

    from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructType

    schema = StructType([rows.schema[c] for c in others])
    schema = schema.add("whitened", ArrayType(DoubleType())).add("deviation", DecimalType(38, 0))
    return kept.mapInArrow(run, schema)


def identity_error(rows: DataFrame, model: Fit, column: str = "embedding") -> float:
    """The largest entry, as an absolute value, of the covariance of the whitened vectors, measured on
    all of them, less the identity. 0 without components."""
    k, dims = len(model.values), len(model.sums)

    def run(batches):
        total, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            _, _, w = _whitened(integers(batch.column(0), dims), model)
            total += w.T @ w
            sums += w.sum(0)
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*[-1] * k, *i.tolist()], pa.int32()), pa.array([*range(k), *j.tolist()], pa.int32()),
                pa.array([*sums.tolist(), *total[i, j].tolist()], pa.float64()),
            ],
            names=["i", "j", "v"],
        )

    if not k:
        return 0.0
    parts = usable(rows, column).select(column).mapInArrow(run, "i int, j int, v double")
    got = {(r["i"], r["j"]): r["v"] for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    mean = np.array([got[-1, j] for j in range(k)]) / model.n
    return max(abs(v / model.n - mean[i] * mean[j] - (i == j)) for (i, j), v in got.items() if i >= 0)


def by_component(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: vec_id, component (from 1), n, deviation,
    whitened, explained and identity_error. No rows without variance."""
    model = fit(rows, column, components)
    ddl = (
        "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double"
    )
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], ddl)
    error = identity_error(rows, model, column)
    own = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), column)
    shares = F.array(*[F.lit(float(x)) for x in model.explained])
    return whiten(own, model, column).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
