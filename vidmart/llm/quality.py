"""Quality scores: ridge regression on random Fourier features of document statistics.

The features approximate a Gaussian kernel over some thirty statistics of a text. Every
partition adds up its share of the normal equations, for two halves of the training rows; the
sums are added in Spark, and only a matrix of the features' number reaches the driver. Each
half is scored by the other half's model, and an isotonic fit to those scores, from a histogram
of fixed size, turns scores of the joint model into probabilities.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidmart.llm.labelled import remainder, training_labels
from vidmart.llm.tables import cut, id_and_text

FEATURES = 192
WIDTH = 4.0  # of the kernel, in standard deviations of a statistic
RIDGE = 1e-3  # times the number of training rows
STEPS = 2048  # bins of the calibration
PRIOR = 2.0  # rows added to each end of the calibration
SYMBOLS = b"!|*$#%&@.,;:?\"'()[]{}<>/\\=+-_~^`"


def statistics(text: str) -> list[float]:
    """Shape of one whole text: sizes, shares of kinds of characters, repetition."""
    raw = text.encode()
    n = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / max(n, 1)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    tally: dict[str, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    m = max(len(words), 1)
    positive = share[share > 0]
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)),
        min(n / m, 40.0), len(tally) / m, max(tally.values(), default=0) / m,
        np.log1p(len(words) / max(len(tally), 1)),
        len(set(lines)) / max(len(lines), 1), np.log1p(len(words) / max(len(lines), 1)),
        float(-(positive * np.log(positive)).sum()),
        share[65:91].sum(), share[97:123].sum(), share[48:58].sum(), share[128:].sum(),
        share[32], share[10], share[9], share[list(SYMBOLS)].sum(),
        *(np.sqrt(share[c]) for c in b"!|*$#%&@.,<"),
    ]


N_STATISTICS = len(statistics(""))


def described(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of the whole text; one row for each row."""

    def run(batches):
        for b in batches:
            x = np.array([statistics(t) for t in b.column(1).to_pylist()], np.float32).reshape(-1, N_STATISTICS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_STATISTICS).cast(pa.list_(pa.float32()))],
                names=["doc_id", "x"],
            )

    return id_and_text(docs).mapInArrow(run, "doc_id bigint, x array<float>")


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS).astype(np.float64)


class Fourier:
    """The random features; the same for the same seed."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.standard_normal((len(mean), FEATURES)) / WIDTH
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.cos(z @ self.w + self.b) * np.sqrt(2 / FEATURES), np.ones((len(z), 1))], 1)


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every statistic over all rows."""

    def run(batches):
        n, s, ss = 0, np.zeros(N_STATISTICS), np.zeros(N_STATISTICS)
        for b in batches:
            x = _matrix(b.column(0))
            n, s, ss = n + len(x), s + x.sum(0), ss + (x**2).sum(0)
        j = np.arange(N_STATISTICS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(j), pa.array(np.full(len(j), float(n))), pa.array(s), pa.array(ss)], names=["j", "n", "s", "ss"]
        )

    sums = rows.select("x").mapInArrow(run, "j bigint, n double, s double, ss double")
    got = sums.groupBy("j").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")]).toPandas().sort_values("j")
    n = max(got["n"].iloc[0], 1.0) if len(got) else 1.0
    mean = got["s"].to_numpy() / n if len(got) else np.zeros(N_STATISTICS)
    var = got["ss"].to_numpy() / n - mean**2 if len(got) else np.ones(N_STATISTICS)
    return mean, np.sqrt(np.maximum(var, 1e-12)) + 1e-6


def _normal_equations(train: DataFrame, features: Fourier) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of both halves: sums of z z', of z y, and the number of rows."""
    size = FEATURES + 1

    def run(batches):
        total = np.zeros((2, size, size + 1))
        for b in batches:
            z = features(_matrix(b.column(0)))
            zy = np.concatenate([z, b.column(1).to_numpy(zero_copy_only=False)[:, None]], 1)
            half = b.column(2).to_numpy(zero_copy_only=False)
            for h in (0, 1):
                total[h] += z[half == h].T @ zy[half == h]
        rows = total.reshape(-1, size + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(rows))), pa.array([r.tobytes() for r in rows], pa.binary())], names=["i", "v"]
        )

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        v = np.sum([np.frombuffer(x) for x in group["v"]], axis=0)
        return pd.DataFrame({"i": [key[0]], "v": [v.tobytes()]})

    sums = train.select("x", "y", "half").mapInArrow(run, "i bigint, v binary")
    rows = sums.groupBy("i").applyInPandas(add, "i bigint, v binary").collect()
    total = np.zeros((2 * size, size + 1))
    for r in rows:
        total[r["i"]] = np.frombuffer(r["v"])
    total = total.reshape(2, size, size + 1)
    return total[:, :, :-1], total[:, :, -1], total[:, -1, -2]


def _ridge(a: np.ndarray, b: np.ndarray, n: float) -> np.ndarray:
    penalty = np.full(len(b), RIDGE * max(n, 1.0) / FEATURES + 1e-9)
    penalty[-1] = 1e-9
    return np.linalg.solve(a + np.diag(penalty), b)


def isotonic(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The non-decreasing values nearest to ``mean`` by weighted squares, by pooling."""
    blocks: list[list[float]] = []
    for w, m in zip(weight, mean, strict=True):
        blocks.append([m, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, c2 = blocks.pop()
            m1, w1, c1 = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, c1 + c2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


class Model:
    """Scores by statistics: the ridge model of the random features, then the calibration."""

    def __init__(self, features: Fourier, weights: np.ndarray, at: np.ndarray, level: np.ndarray):
        self.features, self.weights, self.at, self.level = features, weights, at, level

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = self.features(x) @ self.weights
        p = np.interp(s, self.at, self.level)
        if len(self.at) > 1:  # so that rows of one step keep their order
            p = 0.999 * p + 0.001 * np.clip((s + 1) / 3, 0, 1)
        return p


def fit(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """The model for described rows. Labels of the fold with crc32(doc_id) mod 3 = 1 are not read.
    Without training rows every score is 0.5, with one class only that class's."""
    known = rows.join(training_labels(labels, label), "doc_id")
    train = cut(known.select("x", "y", (remainder(6) % 2).cast("int").alias("half")), "quality-train")
    features = Fourier(*_moments(rows))
    a, b, n = _normal_equations(train, features)
    both = _ridge(a.sum(0), b.sum(0), n.sum())
    other = np.stack([_ridge(a[1], b[1], n[1]), _ridge(a[0], b[0], n[0])])

    def binned(batches):
        for batch in batches:
            z = features(_matrix(batch.column(0)))
            s = (z * other[batch.column(2).to_numpy(zero_copy_only=False)]).sum(1)
            step = np.clip(np.floor((s + 1) / 3 * STEPS), 0, STEPS - 1).astype(np.int64)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            n_ = np.bincount(step, minlength=STEPS)
            y_ = np.bincount(step, weights=y, minlength=STEPS)
            at = np.flatnonzero(n_)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(n_[at].astype(np.float64)), pa.array(y_[at])], names=["step", "n", "y"]
            )

    counts = train.select("x", "y", "half").mapInArrow(binned, "step bigint, n double, y double")
    table = counts.groupBy("step").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).toPandas().sort_values("step")
    if not len(table):
        return Model(features, both, np.array([0.0]), np.array([0.5]))
    weight, hits = table["n"].to_numpy().copy(), table["y"].to_numpy().copy()
    rate = hits.sum() / weight.sum()
    weight[[0, -1]] += PRIOR
    hits[[0, -1]] += PRIOR * rate
    at = (table["step"].to_numpy() + 0.5) / STEPS * 3 - 1
    return Model(features, both, at, isotonic(weight, hits / weight))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out and score, the probability of label 1, of every whole text.

    One row for each row; null and empty texts are scored like other texts, null and repeated ids
    are kept. See ``fit`` for the labels used.
    """
    rows = cut(described(docs), "quality-statistics")
    model = fit(rows, labels, label)

    def run(batches):
        for batch in batches:
            p = model.scores(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])

    scored = rows.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", (remainder(3) == 1).alias("held_out"), "score")


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5, label: str = "quality") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, with all their columns. Texts are
    described a second time where they are read, so none is shuffled."""
    model = fit(cut(described(docs), "quality-statistics"), labels, label)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            x = np.array([statistics(t) for t in texts], np.float64).reshape(-1, N_STATISTICS)
            yield batch.filter(pa.array(model.scores(x) >= least))

    return docs.mapInArrow(run, docs.schema)


def decided(scored: DataFrame, least: float) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= least).cast("int"))
