"""Byte-level BPE: text to token ids and back, by the ranks of a vocabulary file.

Each match of the split pattern is a piece. The distinct pieces of a batch are put into padded
matrices by length, one row each, and every round merges in every row the leftmost pair of
minimum rank. Pairs are looked up in a hash table held in two arrays; rows without a pair to
merge leave the matrix. Pieces over ``LONG`` bytes, which would need that many rounds, are
merged one at a time in the same order from a heap.
"""

from __future__ import annotations

import base64
import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidmart.llm.tables import id_and_text

LONG = 192
MEMO = 200_000  # pieces a task remembers; beyond, it forgets them all and goes on
ROWS = 512  # rows of one output batch
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank. Ranks must be 0, 1, 2, ... and contain every single byte."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class Codec:
    """Tables for merging; built once per task from the tokens in rank order."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        rank = {t: i for i, t in enumerate(tokens)}
        self.byte_ids = np.array([rank[bytes([b])] for b in range(256)], np.int32)
        keys, ids = [], []
        for i, t in enumerate(tokens):
            for k in range(1, len(t)):
                a, b = rank.get(t[:k]), rank.get(t[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ids.append(i)
        self._hash(np.array(keys, np.int64), np.array(ids, np.int32))

    def _hash(self, keys: np.ndarray, ids: np.ndarray) -> None:
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ids = np.full(1 << bits, NONE, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            at, winner = np.unique(slot[free], return_index=True)
            self.keys[at], self.ids[at] = keys[free[winner]], ids[free[winner]]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two neighbours make, NONE if they make none."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ids[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0) & (right >= 0) & (left >= 0))
        slot, keys = slot[open_], keys[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            found = self.keys[slot]
            hit = found == keys
            out[open_[hit]] = self.ids[slot[hit]]
            more = ~hit & (found >= 0)
            open_, slot, keys = open_[more], slot[more], keys[more]
        return out

    def merge_rows(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of one length class."""
        out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        lengths = np.array([len(p) for p in pieces])
        wide = int(lengths.max())
        ids = np.full((len(pieces), wide), -1, np.int32)
        inside = np.arange(wide) < lengths[:, None]
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((len(pieces), wide), NONE, np.int32)
        two = inside[:, 1:]
        ranks[:, :-1][two] = self.pair_ranks(ids[:, :-1][two], ids[:, 1:][two])
        row = np.arange(len(pieces))
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(row)), at]
            done = best == NONE
            for r, line, n in zip(row[done], ids[done], lengths[done], strict=True):
                out[r] = line[:n].copy()
            if done.all():
                return out
            if done.any():
                keep = ~done
                row, ids, ranks, lengths, at, best = (
                    x[keep] for x in (row, ids, ranks, lengths, at, best)
                )
                wide = int(lengths.max())
                ids, ranks = ids[:, :wide], ranks[:, :wide]
            every = np.arange(len(row))
            ids[every, at] = best
            cols = np.arange(wide - 1)
            from_ = np.minimum(cols + (cols > at[:, None]), wide - 1)
            from_rank = np.minimum(cols + (cols >= at[:, None]), wide - 1)
            ids = np.concatenate(
                [np.take_along_axis(ids, from_, 1), np.full((len(row), 1), -1, np.int32)], 1
            )
            ranks = np.concatenate(
                [np.take_along_axis(ranks, from_rank, 1), np.full((len(row), 1), NONE, np.int32)], 1
            )
            lengths = lengths - 1
            ranks[every, at] = NONE
            for step in (-1, 0):
                left = at + step
                ok = np.flatnonzero((left >= 0) & (left + 1 < lengths))
                ranks[ok, left[ok]] = self.pair_ranks(ids[ok, left[ok]], ids[ok, left[ok] + 1])

    def merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def rank(a: int, b: int) -> int:
            return int(self.pair_ranks(np.array([ids[a]]), np.array([ids[b]]))[0])

        first = self.pair_ranks(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (new := rank(x, y)) != NONE:
                    heapq.heappush(heap, (new, x, ids[x], ids[y]))
        return np.array([i for i in ids if i >= 0], np.int32)

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        classes: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if len(p) > LONG:
                out[i] = self.merge_long(p)
            else:
                classes.setdefault((len(p) + 3) // 4, []).append(i)
        for members in classes.values():
            for k in range(0, len(members), 8192):
                part = members[k : k + 8192]
                for i, ids in zip(part, self.merge_rows([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        return out


def ragged(flat: np.ndarray, bounds: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[bounds[i]:bounds[i + 1]]`` for each i in ``pick``, in a row; their sizes."""
    sizes = bounds[pick + 1] - bounds[pick]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(bounds[pick] - (ends - sizes), sizes)
    return flat[at], sizes


class Memory(dict):
    """Piece to its number; the ids of piece i are ``ids[bounds[i]:bounds[i + 1]]``."""

    def __init__(self) -> None:
        self.fresh: list[str] = []
        self.ids, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number

    def learn(self, codec: Codec) -> None:
        if self.fresh:
            new = codec.encode([p.encode() for p in self.fresh])
            self.fresh = []
            self.ids = np.concatenate([self.ids, *new])
            self.bounds = np.concatenate(
                [self.bounds, self.bounds[-1] + np.cumsum([len(x) for x in new])]
            )


def _encoded(texts: list[str], codec: Codec, find, memo: Memory) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and the bounds of each text."""
    split = [find(t) for t in texts]
    pick = np.fromiter(map(memo.__getitem__, chain.from_iterable(split)), np.int64)
    memo.learn(codec)
    ids, sizes = ragged(memo.ids, memo.bounds, pick)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return ids, ends[np.concatenate([[0], np.cumsum([len(x) for x in split])])]


def _lists(kind: pa.DataType, values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(bounds.astype(np.int32)), pa.array(values, kind)
    )


def encode(docs: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text, without special tokens.

    One row for each row; null and empty texts have no ids; null and repeated doc_ids pass
    through. ``tokens`` is the vocabulary, whose size is fixed, and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokens)

    def run(batches):
        import regex

        codec, find, memo = Codec(shared.value), regex.compile(pattern).findall, Memory()
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                if len(memo) > MEMO:
                    memo = Memory()
                ids, bounds = _encoded(part.column(1).to_pylist(), codec, find, memo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _lists(pa.int32(), ids, bounds)], names=["doc_id", "ids"]
                )

    return id_and_text(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, tokens: list[bytes]) -> DataFrame:
    """doc_id, ids and bytes, what the ids stand for. Null ids give null bytes; an id outside
    the vocabulary is an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)

    def run(batches):
        own = shared.value
        flat = np.frombuffer(b"".join(own), np.uint8)
        limits = np.concatenate([[0], np.cumsum([len(t) for t in own])])
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                lists = part.column(1)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                out, sizes = ragged(flat, limits, ids.astype(np.int64))
                ends = np.concatenate([[0], np.cumsum(sizes)])
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                bounds = ends[np.concatenate([[0], np.cumsum(counts)])]
                missing = lists.is_null()
                cells = pa.Array.from_buffers(
                    pa.large_binary(), len(part), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)]
                ).cast(pa.binary())
                cells = pc.if_else(missing, pa.scalar(None, pa.binary()), cells)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, cells], names=["doc_id", "ids", "bytes"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, bytes binary")


def digests(decoded: DataFrame) -> DataFrame:
    """n_tokens and the hashes of ids (decimal, joined by a space) and of decoded bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
