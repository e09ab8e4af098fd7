"""Toxicity scores: a support vector machine over a subsequence string kernel.

The kernel compares two words by the character triples they share, gaps allowed: a triple that
spans s characters weighs DECAY ** s, up to SPAN, and words are compared by the cosine. Inserted
characters therefore lower the similarity of an insult a little, not to nothing. A Nystroem map
over landmark words turns the kernel into features, and a linear machine with hinge loss is
trained on them. As the machine is linear, its landmarks fold into one weight for each triple,
and a text's words are scored by table lookups. A text is judged by its worst few words.

Labels are given for whole texts, so the words that tell toxic sentences from clean ones are
found first: those that occur in toxic texts more often than in others. Each weighs by its evidence,
so that a few labels, which prove no word, still rank the texts. The machine is trained on these words,
not on whole sentences: toxic ones, also with characters inserted, against words of clean texts.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidmart.llm.labelled import remainder, training_labels
from vidmart.llm.tables import cut, id_and_text

DECAY = 0.75
SPAN = 7  # characters from the first to the last of a triple
LETTERS = 64  # classes of characters
SHORT = 10  # characters of short words, which begin triples at eight places at most
LONGEST = 26  # longer words are scored in overlapping pieces
TRAINING_TEXTS = 20_000  # the classifier is fitted on at most so many labelled texts
WITNESSES = 2_000  # toxic words, clean words of each choice, and hard clean words, at most
LANDMARKS = 256
EVIDENCE = 9.5  # log likelihood ratio at which a word has half its full weight
STEEP = 2  # of the curve from evidence to weight
PENALTY = 0.01
ROWS = 2048  # texts scored at once
NOTHING = -1.5  # the least value of a word, and that of none
WORST = 3  # distinct words that decide on a text
SINGLE = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
EDGES = ".,!?;:\"'()[]{}<>-_*#"
PLAIN = np.array([ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else 0 for c in range(256)], np.uint8)
STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def plain(token: str) -> str:
    """Lower case, letters and digits only."""
    low = token.lower()
    if low.isalnum() or (low := low.strip(EDGES)).isalnum():  # most tokens
        return low
    return "".join(filter(str.isalnum, low))


def _plain(words: pa.StringArray) -> pa.StringArray:
    """plain() of every word; those of ASCII characters all at once."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    low = PLAIN[data]
    ends = np.concatenate([[0], np.cumsum(low > 0)])[offsets - offsets[0]].astype(np.int32)
    out = pa.StringArray.from_buffers(len(words), pa.py_buffer(ends), pa.py_buffer(low[low > 0]))
    other = pc.invert(pc.string_is_ascii(words))
    rest = [plain(w) for w in words.filter(other).to_pylist()]
    return pc.replace_with_mask(out, other, pa.array(rest, pa.string()))


def instances(text: str) -> list[str]:
    """What of a text is scored: its tokens, and runs of three or more single characters, joined."""
    runs = ["".join(m.split()) for m in SINGLE.findall(text)]
    return text.split() + runs


def _pieces(word: str) -> list[str]:
    """The word between marks of its start and end, which count as characters; a long one in
    overlapping pieces; nothing for an empty one."""
    marked = f"<{word}>" if word else ""
    if len(marked) <= LONGEST:
        return [marked] if marked else []
    return [marked[i : i + LONGEST] for i in range(0, len(marked) - LONGEST // 2, LONGEST // 2)]


def codes(words: list[str], width: int = LONGEST) -> np.ndarray:
    """Class of every character, 0 beyond the end: a-z have one each, others share the rest."""
    wide = np.zeros((len(words), width), np.int32)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.array([len(w) for w in words], np.int64)
    inside = np.arange(width) < sizes[:, None]
    rest = 29 + points * 2654435761 % (1 << 32) % (LETTERS - 29)
    rest = np.where(points == 60, 27, np.where(points == 62, 28, rest))
    wide[inside] = np.where((points >= 97) & (points <= 122), points - 96, rest)
    return wide


def _starts(wide: np.ndarray, b: int) -> int:
    """At how many places a triple of b + 1 characters can begin. Short words have eight for each b, so
    that sums over them are added up in the order of those over the first eight of more."""
    return 8 if wide.shape[1] == SHORT + SPAN - 3 else wide.shape[1] - b


def triples(wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and weight of every triple of every word; weight 0 where there is none."""
    code, weight = [], []
    for a, b in STEPS:
        n = _starts(wide, b)
        x, y, z = wide[:, :n], wide[:, a : a + n], wide[:, b : b + n]
        code.append((x * LETTERS + y) * LETTERS + z)
        weight.append(np.where(z > 0, DECAY ** (b + 1), 0.0))
    return np.concatenate(code, 1), np.concatenate(weight, 1)


def _length(code: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Length of each word's vector of triples; equal triples add up."""
    order = np.argsort(code, axis=1, kind="stable")
    code, weight = np.take_along_axis(code, order, 1), np.take_along_axis(weight, order, 1)
    new = np.ones(code.shape, bool)
    new[:, 1:] = code[:, 1:] != code[:, :-1]
    group = np.cumsum(new.ravel()) - 1
    sums = np.bincount(group, weights=weight.ravel())
    owner = np.repeat(np.arange(len(code)), new.sum(1))
    return np.sqrt(np.bincount(owner, weights=sums**2, minlength=len(code)))


def vectors(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse unit vectors of words: codes and values. For training sets."""
    out = []
    for k in range(0, len(words), 1024):
        for c, w in zip(*triples(codes(words[k : k + 1024])), strict=True):
            at, inverse = np.unique(c[w > 0], return_inverse=True)
            v = np.bincount(inverse, weights=w[w > 0], minlength=len(at))
            out.append((at, v / max(np.sqrt((v**2).sum()), 1e-12)))
    return out


def _most() -> np.ndarray:
    """By characters of a word the length of its vector if all its triples differ."""
    sizes = np.arange(LONGEST + 1)
    return np.sqrt(sum(np.maximum(sizes - b, 0) * DECAY ** (2 * (b + 1)) for _, b in STEPS))


class Machine:
    """Weights by triple and an offset."""

    def __init__(self, weights: np.ndarray, offset: float):
        self.weights, self.offset = weights.astype(np.float32), offset

    def sums(self, wide: np.ndarray) -> np.ndarray:
        """Weights of the triples of each word, added up step by step. A triple that ends beyond its
        word ends with class 0, which no triple of a training word does, so its weight is 0."""
        total = np.zeros(len(wide), np.float32)
        for a in range(1, SPAN - 1):
            pair = wide[:, : wide.shape[1] - a] * np.int32(LETTERS) + wide[:, a:]
            pair *= np.int32(LETTERS)
            for b in range(a + 1, SPAN):
                n = _starts(wide, b)
                total += self.weights.take(pair[:, :n] + wide[:, b : b + n]).sum(1) * np.float32(DECAY ** (b + 1))
        return total

    def values(self, words: list[str]) -> np.ndarray:
        """Decision value of each word of at most LONGEST characters; those of at most SHORT take less work."""
        short = np.array([len(w) <= SHORT for w in words], bool)
        out = np.empty(len(words))
        for rows, width in ((np.flatnonzero(short), SHORT + SPAN - 3), (np.flatnonzero(~short), LONGEST)):
            out[rows] = self._values([words[i] for i in rows.tolist()], width)
        return out

    def _values(self, words: list[str], width: int) -> np.ndarray:
        out, most = np.full(len(words), NOTHING), _most()
        for k in range(0, len(words), 4096):
            wide = codes(words[k : k + 4096], width)
            total = self.sums(wide).astype(np.float64)
            size = most[(wide > 0).sum(1)]
            near = np.flatnonzero(total > 0.1 * size)
            if len(near):
                size[near] = _length(*triples(wide[near]))
            value = total / np.maximum(size, 1e-12) + self.offset
            out[k : k + 4096] = np.where(size > 0, np.maximum(value, NOTHING), NOTHING)
        return out


def _chosen(own: list, many: int) -> list[int]:
    """Words that the others are least like: greedy pivots of their kernel matrix."""
    left, rows, picks = np.ones(len(own)), [], []
    dense = np.zeros(LETTERS**3)
    while len(picks) < min(many, len(own)) and left.max() > 1e-3:
        k = int(left.argmax())
        dense[own[k][0]] = own[k][1]
        row = np.array([dense[at] @ v for at, v in own])
        dense[own[k][0]] = 0
        for r in rows:
            row -= r[k] * r
        row /= np.sqrt(max(left[k], 1e-12))
        rows.append(row)
        picks.append(k)
        left = np.maximum(left - row**2, 0)
        left[picks] = 0
    return picks


def train_machine(toxic: list[str], weight: np.ndarray, clean: list[str], landmarks: int = LANDMARKS) -> Machine:
    """A linear machine on Nystroem features: squared hinge loss, by Newton's method."""
    own = vectors(toxic + clean)
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    cost = np.concatenate([weight * (weight.sum() / (weight**2).sum()), np.ones(len(clean))])
    heavy = np.argsort(-weight, kind="stable")[: 4 * landmarks]
    marks = [int(heavy[k]) for k in _chosen([own[k] for k in heavy], landmarks * 2 // 3)]
    marks += [len(toxic) + k for k in _chosen(own[len(toxic) :][: 4 * landmarks], landmarks - len(marks))]
    used = np.unique(np.concatenate([own[m][0] for m in marks]))  # triples of the landmarks
    dense = np.zeros((len(used), len(marks)), np.float32)
    for k, m in enumerate(marks):
        dense[np.searchsorted(used, own[m][0]), k] = own[m][1]
    kernel = np.zeros((len(own), len(marks)))
    for row, (at, v) in zip(kernel, own, strict=True):
        place = np.minimum(np.searchsorted(used, at), len(used) - 1)
        hit = used[place] == at
        row[:] = v[hit] @ dense[place[hit]]
    values, basis = np.linalg.eigh((kernel[marks] + kernel[marks].T) / 2)
    keep = values > 1e-6
    root = basis[:, keep] / np.sqrt(values[keep])
    x = np.concatenate([kernel @ root, np.ones((len(own), 1))], 1)
    penalty = np.diag([PENALTY] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = (x @ w) * y < 1
        xa = x[active] * cost[active][:, None]
        new = np.linalg.solve(xa.T @ x[active] + penalty, xa.T @ y[active])
        if np.abs(new - w).max() < 1e-8:
            break
        w = (w + new) / 2 if _ > 10 else new
    weights = np.zeros(LETTERS**3)
    weights[used] = dense @ (root @ w[:-1])
    return Machine(weights, float(w[-1]))


def _loosened(words: list[str]) -> list[str]:
    """Each word with one character inserted, at its middle, third and two thirds, marks kept."""
    places = ((1 / 2, "x"), (1 / 3, "0"), (2 / 3, "q"))
    return [w[: int(len(w) * p)] + c + w[int(len(w) * p) :] for w in words if len(w) < LONGEST for p, c in places]


def _words(texts: DataFrame) -> DataFrame:
    """For each training text its distinct plain pieces, with its label, counted by word."""

    def run(batches):
        for b in batches:
            words, ys = [], []
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = {p for t in instances(text) for p in _pieces(plain(t)) if len(p) > 4}
                words += own
                ys += [y] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(ys, pa.int64())], names=["word", "y"])

    return (
        texts.select("text", "y").mapInArrow(run, "word string, y bigint")
        .groupBy("word").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    )


def fit(texts: DataFrame) -> Machine | None:
    """The machine for labelled texts (text, y); None if one class has no texts or no word."""
    share = texts.agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not share["t"] or share["t"] == share["n"]:
        return None
    rate = share["t"] / share["n"]
    words = cut(_words(texts), "toxicity-words")
    n, t = F.col("t") + F.col("c"), F.col("t")
    ratio = t * F.log(t / (n * rate)) + F.when(n > t, (n - t) * F.log((n - t) / (n * (1 - rate)))).otherwise(0.0)
    bound = min(max(0.5, 2 * rate), (1 + rate) / 2)
    found = (
        words.where((t > 0) & (t / n > bound)).withColumn("g", ratio)
        .orderBy(F.desc("g"), "word").limit(WITNESSES).collect()
    )
    if not found:
        return None
    toxic = [r["word"] for r in found]
    evidence = np.array([r["g"] for r in found])
    weight = np.sqrt([float(r["t"]) for r in found]) / (1 + np.exp(np.clip(STEEP * (EVIDENCE - evidence), -30, 30)))
    usual = words.where(t / n <= bound)
    clean = [r["word"] for r in usual.orderBy(F.desc("c"), "word").limit(WITNESSES).collect()]
    clean += [r["word"] for r in usual.orderBy(F.xxhash64("word"), "word").limit(WITNESSES).collect()]
    clean = list(dict.fromkeys(clean))
    more = _loosened(toxic)
    short = np.array([len(w) < LONGEST for w in toxic])
    more_weight = np.concatenate([weight, np.repeat(weight[short], 3) / 6])
    for _ in range(2):  # then with the clean words that look most like toxic ones
        machine = train_machine(toxic + more, more_weight, clean)

        def valued(batches, machine=machine):
            for b in batches:
                v = machine.values(b.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(v)], names=["word", "v"])

        near = (
            usual.select("word").mapInArrow(valued, "word string, v double")
            .orderBy(F.desc("v"), "word").limit(WITNESSES).collect()
        )
        clean = list(dict.fromkeys([r["word"] for r in near] + clean))
    return train_machine(toxic + more, more_weight, clean)


def _worst(machine: Machine):
    """The values of the WORST worst words of every text, in descending order."""

    def valued(words: pa.StringArray) -> np.ndarray:
        """Value of every word, that of its worst piece. Words that are equal when plain are worked out once."""
        own = _plain(words).dictionary_encode()
        size = pc.utf8_length(own.dictionary).to_numpy()
        one, more = np.flatnonzero((size > 0) & (size <= LONGEST - 2)), np.flatnonzero(size > LONGEST - 2)
        best = np.full(len(size), NOTHING)
        marked = pc.binary_join_element_wise("<", own.dictionary.take(pa.array(one)), ">", "")
        best[one] = machine.values(marked.to_pylist())
        long = own.dictionary.take(pa.array(more)).to_pylist()
        parts = [(i, p) for i, w in zip(more.tolist(), long, strict=True) for p in _pieces(w)]
        if parts:
            np.maximum.at(best, [i for i, _ in parts], machine.values([p for _, p in parts]))
        return best[own.indices.to_numpy()]

    def run(texts: pa.Array) -> np.ndarray:
        split = pc.utf8_split_whitespace(texts)  # at what str.split() splits at; also empty words at the ends
        bounds = split.offsets.to_numpy()
        words = split.flatten().dictionary_encode()
        of, single = words.indices.to_numpy(), pc.utf8_length(words.dictionary).to_numpy() == 1
        value = valued(words.dictionary)
        order = np.argsort(-value, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        value = np.append(value[order], NOTHING)  # by rank; that of no word comes last
        # rank of the worst word of each text, then of the worst of the others; every text ends with no word
        ends = bounds[1:] - bounds[0] + np.arange(len(texts))
        left = np.full(len(of) + len(texts), len(order))
        inside = np.ones(len(left), bool)
        inside[ends] = False
        left[inside] = rank[of]
        first = np.concatenate([[0], ends[:-1] + 1])
        out = np.empty((len(texts), WORST))
        for k in range(WORST if len(texts) else 0):
            least = np.minimum.reduceat(left, first)
            out[:, k] = value[least]
            left[left == np.repeat(least, np.diff(ends, prepend=-1))] = len(order)
        # texts with three single characters in a row have their runs as words besides
        alone = np.zeros(len(left), bool)
        alone[inside] = single[of]
        rows = np.unique(np.searchsorted(ends, np.flatnonzero(alone[:-2] & alone[1:-1] & alone[2:])))
        spaced = [list(set(instances(t))) for t in texts.take(pa.array(rows, pa.int64())).to_pylist()]
        each = valued(pa.array(list(chain.from_iterable(spaced)), pa.string())).tolist()
        at = 0
        for i, words in zip(rows, spaced, strict=True):
            out[i] = sorted(each[at : at + len(words)] + [NOTHING] * WORST, reverse=True)[:WORST]
            at += len(words)
        return out

    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights, none negative, and offset of a logistic curve, by Newton's method."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.array([1.0] + [0.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.eye(x.shape[1]) * 0.3
        step = np.linalg.solve(h, x.T @ (p - y) + 0.3 * w * (np.arange(len(w)) < len(w) - 1))
        w = w - np.clip(step, -2, 2)
    w[:-1] = np.maximum(w[:-1], 0)
    w[0] = max(w[0], 0.1)
    return w


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAINING_TEXTS) -> DataFrame:
    """doc_id, held_out and score, the probability that the label is 1, of every whole text.

    Labels of the fold with crc32(doc_id) mod 3 = 1 are not read. The machine is fitted on at
    most ``most`` labelled texts, chosen by a hash of their ids, and then scores all. One row for
    each row; null and empty texts get the score of a text without words; null and repeated
    ids are kept. If a class has no training texts or no telling word, every score is the share of
    label 1, or 0 without labels.
    """
    chosen = training_labels(labels, label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = id_and_text(docs)
    texts = cut(rows.join(F.broadcast(chosen), "doc_id").select("text", "y"), "toxicity-texts")
    machine = fit(texts)
    if machine is None:
        share = texts.agg(F.coalesce(F.avg("y"), F.lit(0.0)).alias("s")).first()["s"]
        scored = rows.select("doc_id", F.lit(float(share)).alias("score"))
    else:
        worst = _worst(machine)

        def valued(batches):
            for b in batches:
                for k in range(0, len(b), ROWS):
                    part = b.slice(k, ROWS)
                    v = worst(part.column(0))
                    yield pa.RecordBatch.from_arrays([pa.array(v.tolist(), pa.list_(pa.float64())), part.column(1)], names=["v", "y"])

        fitted = texts.mapInArrow(valued, "v array<double>, y int").collect()
        curve = _logistic(np.array([r["v"] for r in fitted]), np.array([float(r["y"]) for r in fitted]))

        def run(batches):
            for b in batches:
                for k in range(0, len(b), ROWS):
                    part = b.slice(k, ROWS)
                    v = worst(part.column(1))
                    p = 1 / (1 + np.exp(-np.clip(v @ curve[:-1] + curve[-1], -30, 30)))
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p)], names=["doc_id", "score"])

        scored = rows.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", (remainder(3) == 1).alias("held_out"), "score")
