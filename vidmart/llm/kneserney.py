"""Interpolated modified Kneser-Ney language model over word pairs.

Counting is Spark's work: tasks sum up the words and pairs of their texts, shards add up what
tasks found, each shard being a range of word hashes, or the pairs of some left words (those of
a very frequent left word are spread by the right word, too). Every shard becomes a file in the
shared checkpoint folder: sorted 64-bit hashes with counts for words, sorted 40-bit hashes with
counts for pairs, and plain columns by word number for what a word adds up to as a left or right
neighbour. Scoring tasks map the files into memory, look their texts' words and pairs up by
binary search, and need no shuffle. The folder must be a path that all workers can open.

p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v) + g(v) * p(w), where p(w) is the same over the
number of different left neighbours of w, with 1 / (V + 1) below it, for unknown words too.
Discounts D follow from the numbers of pairs (left neighbours) counted one to four times.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidmart.llm.bytewords import mix, text_slices, words
from vidmart.llm.labelled import remainder
from vidmart.llm.tables import cut, width
from vidmart.sources.staging import new_folder

END = np.uint64(0x6A09E667F3BCC909)  # hash of the end of a text
BLOCK_BITS = 18  # words of one file of columns
WIDE = 4  # flag of sums that need 64 bits
SLICE = 1 << 20  # bytes of text worked on at once
FLUSH = 1_000_000  # entries a task adds up before it passes them on
PART = "shard bigint, hashes binary, counts binary"


def _open_path(folder: str) -> str:
    """The folder as a path of the file system."""
    for scheme in ("file://", "file:"):
        if folder.startswith(scheme):
            return folder[len(scheme) :]
    if "://" in folder:
        raise ValueError(f"{folder}: the model's files are mapped into memory, which needs a mounted folder")
    return folder


def _write(path: str, array: np.ndarray) -> None:
    """Whole or not at all, so that a task that runs twice leaves one good file."""
    part = f"{path}.{os.getpid()}"
    array.tofile(part)
    os.replace(part, path)


def _map(path: str, kind) -> np.ndarray:
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


def _sums(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts added up."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def tokens(column: pa.Array):
    """(first row, hashes, rows) of slices of texts: words, and an end after each text."""
    for first, data, offsets in text_slices(column, SLICE):
        hashes, rows = words(data, offsets)
        n = len(offsets) - 1
        ends = np.cumsum(np.bincount(rows, minlength=n)) if n else np.zeros(0, np.int64)
        yield first, np.insert(hashes, ends, END), np.insert(rows, ends, np.arange(n))


def _packed(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray):
    """Rows of PART for keys in order within each shard."""
    order = np.argsort(shard, kind="stable")
    names, begins = np.unique(shard[order], return_index=True)
    edges = np.append(begins, len(order))
    rows = [
        (int(s), keys[order[a:b]].tobytes(), counts[order[a:b]].astype(np.int64).tobytes())
        for s, a, b in zip(names, edges, edges[1:])
    ]
    cols = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
        names=["shard", "hashes", "counts"],
    )


def _split(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as runs of equal upper halves and the lower halves."""
    upper, at = np.unique((keys >> np.uint64(32)).astype(np.uint32), return_index=True)
    head = np.array([len(upper), len(keys)], np.uint32)
    return b"".join(x.astype(np.uint32).tobytes() for x in (head, upper, at)) + (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()


def _joined(packed: bytes) -> np.ndarray:
    x = np.frombuffer(packed, np.uint32)
    n, m = int(x[0]), int(x[1])
    upper, at = x[2 : 2 + n].astype(np.uint64), x[2 + n : 2 + 2 * n].astype(np.int64)
    return np.repeat(upper << np.uint64(32), np.diff(np.append(at, m))) | x[2 + 2 * n :].astype(np.uint64)


class Words:
    """Word numbers by hash, from the mapped files. Shard s holds the hashes with upper bits s."""

    def __init__(self, folder: str, sizes: list[int], bits: int):
        self.shift = np.uint64(64 - bits)
        self.hashes = [_map(f"{folder}/words-{s}", np.uint64) for s in range(len(sizes))]
        self.first = np.concatenate([[0], np.cumsum(sizes)])

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 if unknown."""
        some, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(some), -1, np.int64)
        edges = np.searchsorted(some >> self.shift, np.arange(len(self.hashes) + 1, dtype=np.uint64))
        for s, (a, b) in enumerate(zip(edges, edges[1:])):
            own = self.hashes[s]
            if a < b and len(own):
                at = np.minimum(np.searchsorted(own, some[a:b]), len(own) - 1)
                out[a:b] = np.where(own[at] == some[a:b], at + self.first[s], -1)
        return out[back]


def _lefts(numbers: np.ndarray, rows: np.ndarray, start: int) -> np.ndarray:
    """Number of the word before each token; ``start`` at the beginning of a text."""
    left = np.empty_like(numbers)
    left[1:] = numbers[:-1]
    left[np.concatenate([[True], rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, bool)] = start
    return left


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left.astype(np.uint64) + np.uint64(1)) + right.astype(np.uint64))


def _discounts(n: list[float]) -> np.ndarray:
    """D(0) to D(3), the last for all counts from three on."""
    n1, n2, n3, n4 = (max(x, 1) for x in n)
    y = n1 / (n1 + 2 * n2)
    d = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(d, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.95, 2.95])


def count_words(texts: DataFrame, folder: str, bits: int) -> DataFrame:
    """Files of word hashes and counts; a row (shard, n, total) for each."""

    def run(batches):
        keys, counts = [], []
        for b in batches:
            for _, hashes, _ in tokens(b.column(0)):
                k, c = _sums(hashes)
                keys.append(k)
                counts.append(c)
                if sum(map(len, keys)) > FLUSH:
                    k, c = _sums(np.concatenate(keys), np.concatenate(counts))
                    yield _packed((k >> np.uint64(64 - bits)).astype(np.int64), k, c)
                    keys, counts = [], []
        if keys:
            k, c = _sums(np.concatenate(keys), np.concatenate(counts))
            yield _packed((k >> np.uint64(64 - bits)).astype(np.int64), k, c)

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in group["hashes"]])
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in group["counts"]])
        keys, counts = _sums(keys, counts)
        _write(f"{folder}/words-{key[0]}", keys)
        _write(f"{folder}/counts-{key[0]}", counts)
        most = np.argsort(-counts)[:64]
        return pd.DataFrame({
            "shard": [key[0]], "n": [len(keys)], "total": [int(counts.sum())],
            "top": [np.stack([most, counts[most]]).tobytes()],
        })

    return texts.mapInArrow(run, PART).groupBy("shard").applyInPandas(add, "shard bigint, n bigint, total bigint, top binary")


def count_pairs(texts: DataFrame, folder: str, sizes: list[int], bits: int, hot: np.ndarray) -> DataFrame:
    """Files of pairs, and rows (block, kind, ids, values) of what they add up to by word: as a
    left word its pairs, and those counted once, twice and more; as a right word its left
    neighbours. Kind 2 holds the numbers of pairs counted one to four times."""
    start = sum(sizes)

    def shard_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        spread = np.isin(left, hot)
        return (mix(left.astype(np.uint64) * np.uint64(3) + np.where(spread, right, 0).astype(np.uint64) * np.uint64(5)) >> np.uint64(64 - bits)).astype(np.int64)

    def ready(keys, counts):
        k, c = _sums(np.concatenate(keys), np.concatenate(counts))
        shard = shard_of((k >> np.uint64(32)).astype(np.int64), (k & np.uint64(0xFFFFFFFF)).astype(np.int64))
        order = np.argsort(shard, kind="stable")
        names, begins = np.unique(shard[order], return_index=True)
        edges = np.append(begins, len(order))
        rows = []
        for s, a, b in zip(names, edges, edges[1:]):
            own = c[order[a:b]]
            big = np.flatnonzero(own > 255)
            rows.append((
                int(s), _split(k[order[a:b]]),
                np.minimum(own, 255).astype(np.uint8).tobytes() + np.concatenate([big, own[big], [len(big)]]).astype(np.int64).tobytes(),
            ))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
            names=["shard", "hashes", "counts"],
        )

    def run(batches):
        known = Words(folder, sizes, bits)
        keys, counts = [], []
        for b in batches:
            for _, hashes, rows in tokens(b.column(0)):
                right = known.numbers(hashes)
                left = _lefts(right, rows, start)
                k, c = _sums(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64))
                keys.append(k)
                counts.append(c)
                if sum(map(len, keys)) > FLUSH:
                    yield ready(keys, counts)
                    keys, counts = [], []
        if keys:
            yield ready(keys, counts)

    def unpacked(x: bytes) -> np.ndarray:
        n = int(np.frombuffer(x[-8:], np.int64)[0])
        big = np.frombuffer(x[len(x) - 8 - 16 * n : len(x) - 8], np.int64)
        out = np.frombuffer(x[: len(x) - 8 - 16 * n], np.uint8).astype(np.int64)
        out[big[:n]] = big[n:]
        return out

    def by_block(kind: int, ids: np.ndarray, values: np.ndarray):
        block = ids >> BLOCK_BITS
        names, begins = np.unique(block, return_index=True)
        edges = np.append(begins, len(ids))
        for n, a, b in zip(names, edges, edges[1:]):
            part = values[:, a:b]
            wide = int(part.max()) >= 1 << 32
            packed = part.astype(np.int64 if wide else np.uint32).tobytes()
            yield int(n), kind | WIDE * wide, ids[a:b].astype(np.uint32).tobytes(), packed

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _sums(
            np.concatenate([_joined(x) for x in group["hashes"]]),
            np.concatenate([unpacked(x) for x in group["counts"]]),
        )
        left, right = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        out = [(-1, 2, np.array([key[0]], np.int64).tobytes(), np.array([(counts == c).sum() for c in (1, 2, 3, 4)], np.int64).tobytes())]
        first = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]]))
        values = np.stack([np.add.reduceat(x, first) for x in (counts, counts == 1, counts == 2, counts > 2)])
        out += by_block(0, left[first], values)
        ids, n = np.unique(right, return_counts=True)
        out += by_block(1, ids, n[None])
        hashes = _pair_hash(left, right) >> np.uint64(24)
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
        _write(f"{folder}/pairs-{key[0]}", (hashes >> np.uint64(8)).astype(np.uint32))
        _write(f"{folder}/rest-{key[0]}", (hashes & np.uint64(255)).astype(np.uint8))
        _write(f"{folder}/small-{key[0]}", np.minimum(counts, 255).astype(np.uint8))
        big = np.flatnonzero(counts > 254)
        _write(f"{folder}/big-{key[0]}", np.stack([big, counts[big]]).astype(np.int64))
        return pd.DataFrame(out, columns=["block", "kind", "ids", "values"])

    return texts.mapInArrow(run, PART).groupBy("shard").applyInPandas(
        add, "block bigint, kind int, ids binary, values binary"
    )


def sum_columns(parts: DataFrame, folder: str, n_words: int) -> DataFrame:
    """Files of columns by word; a row with the numbers of words with one to four left
    neighbours, and with all left neighbours, for each."""

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        low = key[0] << BLOCK_BITS
        size = min(1 << BLOCK_BITS, n_words + 1 - low)  # the start of a text is the last
        columns = np.zeros((5, size), np.int64)
        for kind, ids, values in zip(group["kind"], group["ids"], group["values"]):
            at = np.frombuffer(ids, np.uint32).astype(np.int64) - low
            v = np.frombuffer(values, np.int64 if kind & WIDE else np.uint32).reshape(-1, len(at))
            if kind & 1 == 0:
                columns[:4, at] += v
            else:
                columns[4, at] += v[0]
        _write(f"{folder}/columns-{key[0]}", columns)
        near = columns[4]
        counts = [int((near == c).sum()) for c in (1, 2, 3, 4)] + [int((near > 2).sum()), int(near.sum())]
        return pd.DataFrame([[key[0], *counts]], columns=["block", "n1", "n2", "n3", "n4", "more", "total"])

    ddl = "block bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint, more bigint, total bigint"
    return parts.where("block >= 0").groupBy("block").applyInPandas(add, ddl)


def _there(folder: str, names: list[str]) -> None:
    """An error if a file that a task wrote is not in the folder as this machine sees it."""
    missing = [x for x in names if not os.path.exists(f"{folder}/{x}")]
    if missing:
        raise FileNotFoundError(
            f"{len(missing)} files of the model, like {missing[0]}, are not in {folder}: it is not shared by all machines"
        )


class Model:
    """The mapped files and a few constants."""

    def __init__(self, folder: str, facts: dict):
        self.facts = facts
        self.words = Words(folder, facts["sizes"], facts["bits"])
        self.counts = [_map(f"{folder}/counts-{s}", np.int64) for s in range(len(facts["sizes"]))]
        shards = 1 << facts["bits"]
        have = set(facts["pairs"])
        self.pairs = [
            [_map(f"{folder}/{n}-{s}", k) for n, k in (("pairs", np.uint32), ("rest", np.uint8), ("small", np.uint8), ("big", np.int64))]
            if s in have else None
            for s in range(shards)
        ]
        blocks = (facts["n_words"] >> BLOCK_BITS) + 1
        have = set(facts["blocks"])
        self.columns = [_map(f"{folder}/columns-{b}", np.int64).reshape(5, -1) if b in have else None for b in range(blocks)]

    def word_counts(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), np.int64)
        shard = np.searchsorted(self.words.first, numbers, "right") - 1
        for s in np.unique(shard[numbers >= 0]):
            at = np.flatnonzero((shard == s) & (numbers >= 0))
            out[at] = self.counts[s][numbers[at] - self.words.first[s]]
        return out

    def by_word(self, numbers: np.ndarray, rows: list[int]) -> np.ndarray:
        out = np.zeros((len(rows), len(numbers)), np.int64)
        block = numbers >> BLOCK_BITS
        for b in np.unique(block[numbers >= 0]):
            if self.columns[b] is not None:
                at = np.flatnonzero((block == b) & (numbers >= 0))
                for k, r in enumerate(rows):
                    out[k, at] = self.columns[b][r][numbers[at] - (b << BLOCK_BITS)]
        return out

    def pair_counts(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Counts of pairs of known words, 0 for others."""
        bits = np.uint64(64 - self.facts["bits"])
        hot = np.isin(left, self.facts["hot"])
        shard = (mix(left.astype(np.uint64) * np.uint64(3) + np.where(hot, right, 0).astype(np.uint64) * np.uint64(5)) >> bits).astype(np.int64)
        hashes = _pair_hash(left, right) >> np.uint64(24)
        order = np.argsort((shard.astype(np.uint64) << np.uint64(40)) | hashes, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(len(self.pairs) + 1))
        out = np.zeros(len(left), np.int64)
        for s, (a, b) in enumerate(zip(edges, edges[1:])):
            if a == b or self.pairs[s] is None:
                continue
            upper, rest, small, big = self.pairs[s]
            want = hashes[order[a:b]]
            at = np.searchsorted(upper, (want >> np.uint64(8)).astype(np.uint32))
            end = np.searchsorted(upper, (want >> np.uint64(8)).astype(np.uint32), "right")
            found = np.full(b - a, -1, np.int64)
            for step in range(int((end - at).max(initial=0))):  # all hashes that are equal in their upper 32 bits
                here = np.minimum(at + step, len(upper) - 1)
                same = (at + step < end) & (rest[here] == (want & np.uint64(255)))
                found = np.where(same & (found < 0), here, found)
            c = np.where(found >= 0, small[np.maximum(found, 0)], 0).astype(np.int64)
            full = np.flatnonzero(c == 255)
            if len(full):
                table = big.reshape(2, -1)
                c[full] = table[1][np.searchsorted(table[0], found[full])]
            out[order[a:b]] = c
        return out

    def scores(self, hashes: np.ndarray, rows: np.ndarray, n_rows: int):
        """n_tokens, n_known, base score and score of each row."""
        f = self.facts
        some, back = np.unique(hashes, return_inverse=True)
        numbers = self.words.numbers(some)
        counts = self.word_counts(numbers)
        base = np.log10((counts + 1) / (f["total"] + f["n_words"] + 1))
        near = self.by_word(numbers, [4])[0]
        d, e = np.array(f["pair_discounts"]), np.array(f["word_discounts"])
        t = max(f["near"], 1)
        left_over = (e[1] * f["near_n"][0] + e[2] * f["near_n"][1] + e[3] * f["near_n"][2]) / t if f["near"] else 1.0
        lower = np.maximum(near - e[np.minimum(near, 3)], 0) / t + left_over / (f["n_words"] + 1)
        right, p = numbers[back], lower[back]
        left = _lefts(right, rows, f["n_words"])
        lefts, left_back = np.unique(left, return_inverse=True)
        sums = self.by_word(lefts, [0, 1, 2, 3]).astype(np.float64)
        c_left = sums[0]
        gamma = np.where(c_left > 0, (d[1] * sums[1] + d[2] * sums[2] + d[3] * sums[3]) / np.maximum(c_left, 1), 1.0)
        pair = np.zeros(len(right), np.int64)
        both = np.flatnonzero((left >= 0) & (right >= 0))
        pair[both] = self.pair_counts(left[both], right[both])
        upper = np.maximum(pair - d[np.minimum(pair, 3)], 0) / np.maximum(c_left, 1)[left_back]
        p = upper + gamma[left_back] * p
        add = lambda v: np.bincount(rows, weights=v, minlength=n_rows)
        return add(np.ones(len(rows))), add((counts > 0)[back]), add(base[back]), add(np.log10(p))


def score(docs: DataFrame, held_out: int = 2, folds: int = 7) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    The model learns from the rows whose crc32(doc_id) mod 7 is not 2. Tokens are words, A-Z as
    a-z, and an end for each text. base_score adds one to word counts; score is the model's log10
    probability. One row for each row; null texts are empty and have one token, null ids count
    as empty text. Without training rows all probabilities are 1. Counts have 64 bits; 2**32 - 1
    different words or more are an error, as is a folder that not all machines share.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    out = remainder(folds) == held_out
    train = rows.where(~out).select("text")
    folder = _open_path(new_folder(spark, "language-model"))
    os.makedirs(folder, exist_ok=True)
    bits = max(2, int(width(spark)).bit_length())
    found = count_words(train, folder, bits).collect()
    sizes = [0] * (1 << bits)
    for r in found:
        sizes[r["shard"]] = r["n"]
    for s, n in enumerate(sizes):
        if not n:
            for kind in ("words", "counts"):
                _write(f"{folder}/{kind}-{s}", np.zeros(0, np.int64))
    n_words, total = sum(sizes), sum(r["total"] for r in found)
    if n_words >= (1 << 32) - 1:
        raise ValueError(f"{n_words} different words; pairs are numbered for less than 2**32 - 1")
    _there(folder, [f"{kind}-{r['shard']}" for r in found for kind in ("words", "counts")])
    first = np.concatenate([[0], np.cumsum(sizes)])
    hot = [n_words]
    for r in found:  # left words with more than a part of a shard
        at, c = np.frombuffer(r["top"], np.int64).reshape(2, -1)
        hot += (at[c > total / (8 << bits)] + first[r["shard"]]).tolist()
    facts = {
        "sizes": sizes, "bits": bits, "n_words": n_words, "total": total, "hot": np.array(sorted(hot)),
        "pairs": [], "blocks": [], "near": 0, "near_n": [0, 0, 0],
        "pair_discounts": _discounts([0] * 4), "word_discounts": _discounts([0] * 4),
    }
    if total:
        parts = cut(count_pairs(train, folder, sizes, bits, facts["hot"]), "language-model-parts")
        kinds = parts.where("kind = 2").select("ids", "values").collect()  # one a shard
        seen = np.sum([np.frombuffer(r["values"], np.int64) for r in kinds], axis=0)
        blocks = sum_columns(parts, folder, n_words).toPandas()
        sums = blocks.drop(columns="block").sum()
        facts["pair_discounts"] = _discounts(list(seen))
        facts["word_discounts"] = _discounts([sums[f"n{k}"] for k in (1, 2, 3, 4)])
        facts["near"], facts["near_n"] = int(sums["total"]), [int(sums["n1"]), int(sums["n2"]), int(sums["more"])]
        facts["pairs"] = sorted(int(np.frombuffer(r["ids"], np.int64)[0]) for r in kinds)
        facts["blocks"] = sorted(int(b) for b in blocks["block"])
        files = [f"{kind}-{s}" for s in facts["pairs"] for kind in ("pairs", "rest", "small", "big")]
        _there(folder, files + [f"columns-{b}" for b in facts["blocks"]])
    shared = spark.sparkContext.broadcast((folder, facts))

    def run(batches):
        model = Model(*shared.value)
        for b in batches:
            for first_, hashes, of in tokens(b.column(1)):
                n = int(of[-1]) + 1 if len(of) else 0
                n_tokens, known, base, value = model.scores(hashes, of, n)
                ids, held = (b.column(k).slice(first_, n) for k in (0, 2))
                yield pa.RecordBatch.from_arrays(
                    [ids, held, *(pa.array(x.astype(np.int64)) for x in (n_tokens, known)),
                     pa.array(np.full(n, shared.value[1]["total"], np.int64)), pa.array(base), pa.array(value)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return rows.select("doc_id", "text", out.alias("held_out")).mapInArrow(
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
