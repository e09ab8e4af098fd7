"""Benchmark passages in documents, by edit distance.

The CGK walk reads a string from its start, writes the byte it is at, and goes on or stays by a
random bit for that step and byte: strings a few edits apart give outputs a few places apart, so
edit distance becomes Hamming distance. Bit sampling then hashes some of the places: equal keys
make a candidate. Windows begin at every word of a document, and every few bytes inside long runs
without white space; items are looked up from each of their bytes on, so wherever a window begins
inside a copy, the item has a key for it, whether the text is spaced or not. All plans share the
walks; their reach, their number and the places sampled go by the item's size (PLANS), so that
TARGET of the items with SHARE edits are found. Of a candidate the piece of the item around the key is compared first, by bit vectors,
with room for more edits than SHARE; if it is near, item and text are aligned, exactly. Items of
up to WORD bytes are compared with all of every text, so none is lost.

Edit distances count bytes of UTF-8, with A-Z as a-z and white space as one space each.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidmart.llm.bytewords import folding, mix, spaces, text_slices, word_spans
from vidmart.llm.tables import id_and_text

SHARE = 0.2  # edits by length of the item, at most
TARGET = 0.95  # items found of those with SHARE random edits, at least
WORD = 64  # bytes of a piece that is compared by bit vectors
PLANS = ((65, 5, 17, 14), (128, 2, 24, 20), (256, 2, 28, 23))  # bytes of an item, from; walks, steps, places
ROOM = 0.1  # edits by length that a piece may have beyond those of its item
LANE = 256  # bytes of text compared with a short item at once
LANES = 4096  # comparisons side by side
GLANCE = 8  # bytes of text after which a comparison looks at its edits
STARTS = 16384  # windows walked together
HELD = 6  # steps of a walk in one word, a byte each; its top byte counts how far they went
LONG, EVERY = 12, 6  # bytes of a run without white space after which windows begin, and how often
BLOCK_BYTES = 1 << 20  # of items looked up together; their tables, some 60 bytes for each, are broadcast
PREFIX_BITS = 21  # at most
NO_BYTE = 255  # in no UTF-8 text
REACH = max(p[2] for p in PLANS)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def fold(data: np.ndarray) -> np.ndarray:
    table = folding()
    table[spaces()] = 32
    return table[data]


@dataclass
class Views:
    """Keys of the items of one size from each of their bytes on, for every walk."""

    samples: np.ndarray  # walk, word of the walk -> bits of the places
    prefixes: list  # walk -> first bits of keys that occur
    keys: list  # walk -> sorted keys, each once
    bounds: list  # walk -> where the views of each key begin, and their end
    views: list  # walk -> views by key
    item: np.ndarray  # view -> item
    offset: np.ndarray  # view -> byte of the item
    piece: np.ndarray  # view -> piece that it begins in


@dataclass
class Items:
    """What is looked up of a block of items."""

    items: list  # folded bytes
    short: list  # pieces that are a whole item
    plans: list  # Views
    owner: np.ndarray  # piece -> item
    begin: np.ndarray  # piece -> its first byte in the item
    size: np.ndarray  # piece -> bytes, WORD at most
    seed: int  # of the walks' bits


@lru_cache(maxsize=2)
def _bits(seed: int) -> np.ndarray:
    """walk, step, byte -> 0 or 1."""
    steps = -(-REACH // 2) * 2
    return np.random.default_rng(seed).integers(0, 2, (max(p[1] for p in PLANS), steps, 256))


@lru_cache(maxsize=max(p[1] for p in PLANS))
def _strides(seed: int, walk: int) -> list[np.ndarray]:
    """For each two steps of a walk, by two bytes of text: what the steps write, at their places in
    a word, and in its top byte how far they go."""
    bits, out = _bits(seed)[walk], []
    after, first = np.indices((256, 256))
    for s in range(0, max(p[2] for p in PLANS if walk < p[1]), 2):
        far = bits[s][first]
        second = np.where(far, after, first)
        written = (first | second << 8) << 8 * (s % HELD)
        out.append((written | (far + bits[s + 1][second]) << 56).astype(np.uint64).ravel())
    return out


def _pairs(data: np.ndarray) -> np.ndarray:
    """Each byte and the one after it, as one number."""
    out = data.astype(np.uint16)
    out[:-1] |= out[1:] << np.uint16(8)
    return out


def _walk(pairs: np.ndarray, at: np.ndarray, strides: list[np.ndarray], samples: list[np.ndarray]) -> list[np.ndarray]:
    """For each array of places the hash of the bytes that the walks from positions ``at`` write at
    them. ``pairs`` reaches as many bytes beyond every position as there are steps."""
    at, here = at.astype(np.int64), at.astype(np.int64)
    two, which = np.empty(len(at), np.uint16), np.empty(len(at), np.int64)
    word, more = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
    keys = [np.zeros(len(at), np.uint64) for _ in samples]
    for w in range(max(int(np.flatnonzero(x)[-1]) for x in samples) + 1):
        word[:] = 0
        for table in strides[w * HELD // 2 : (w + 1) * HELD // 2]:
            pairs.take(here, out=two, mode="clip")
            which[:] = two
            table.take(which, out=more, mode="clip")
            word += more
            np.right_shift(word, np.uint64(56), out=more)
            np.add(at, more.view(np.int64), out=here)
        at[:] = here
        for key, places in zip(keys, samples, strict=True):
            if places[w]:
                np.bitwise_and(word, places[w], out=more)
                key += more
                key *= SPREAD
                np.right_shift(key, np.uint64(32), out=more)
                key ^= more
    return [mix(key) for key in keys]


def _views(folded: list, chosen: list[int], first_piece: dict, begin: np.ndarray, plan: tuple, seed: int) -> Views:
    _, walks, steps, places = plan
    rng = np.random.default_rng([seed, steps])
    samples = np.zeros((walks, -(-REACH // HELD)), np.uint64)
    for w in range(walks):
        for s in rng.choice(steps, places, replace=False).tolist():
            samples[w, s // HELD] |= np.uint64(255 << 8 * (s % HELD))
    item, offset, piece, starts, parts, at = [], [], [], [], [], 0
    for i in chosen:
        x = folded[i]
        own = np.flatnonzero(x[: max(len(x) - steps, 0) + 1] != 32)  # windows never begin at white space
        item.append(np.full(len(own), i, np.int32))
        offset.append(own.astype(np.int32))
        lo, hi = first_piece[i]
        piece.append((lo + np.searchsorted(begin[lo:hi], own, "right") - 1).astype(np.int32))
        starts.append(at + own)
        parts += [x, np.zeros(steps, np.uint8)]
        at += len(x) + steps
    pairs, starts = _pairs(np.concatenate(parts)), np.concatenate(starts)
    v = Views(samples, [], [], [], [], *(np.concatenate(c) for c in (item, offset, piece)))
    for w in range(walks):
        key = _walk(pairs, starts, _strides(seed, w), [samples[w]])[0]
        bits = min(len(key).bit_length() + 6, PREFIX_BITS)
        there = np.zeros(1 << bits, bool)
        there[(key >> np.uint64(64 - bits)).astype(np.int64)] = True
        order = np.argsort(key, kind="stable")
        v.prefixes.append(there)
        keys, first = np.unique(key[order], return_index=True)
        v.keys.append(keys)
        v.bounds.append(np.append(first, len(order)))
        v.views.append(order.astype(np.int32))
    return v


def views(items: list[bytes], seed: int = 11) -> Items:
    folded = [fold(np.frombuffer(x, np.uint8)) if x else np.zeros(0, np.uint8) for x in items]
    owner, begin, size, pieces = [], [], [], {}
    for i, x in enumerate(folded):
        edges = np.linspace(0, len(x), -(-len(x) // WORD) + 1).astype(np.int64)
        pieces[i] = (len(owner), len(owner) + len(edges) - 1)
        owner += [i] * (len(edges) - 1)
        begin += edges[:-1].tolist()
        size += np.diff(edges).tolist()
    out = Items(folded, [], [], *(np.array(c, np.int64) for c in (owner, begin, size)), seed)
    out.short = [pieces[i][0] for i, x in enumerate(folded) if 0 < len(x) <= WORD]
    for plan, after in zip(PLANS, [*[p[0] for p in PLANS[1:]], 1 << 62], strict=True):
        chosen = [i for i, x in enumerate(folded) if plan[0] <= len(x) < after]
        if chosen:
            out.plans.append(_views(folded, chosen, pieces, out.begin, plan, seed))
    return out


def windows(folded: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position and row of every window: at the words, and inside runs of more than LONG bytes."""
    starts, stops, rows = word_spans(folded, offsets)
    many = np.maximum(0, -(-(stops - starts - LONG) // EVERY))
    if not many.any():
        return starts, rows
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    inside = np.repeat(starts, many) + LONG + nth * EVERY
    at, of = np.concatenate([starts, inside]), np.concatenate([rows, np.repeat(rows, many)])
    order = np.argsort(at, kind="stable")
    return at[order], of[order]


def candidates(data: np.ndarray, starts: np.ndarray, v: Items) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each plan numbers of window starts, and views, with equal keys in some walk."""
    found, pairs = [([], []) for _ in v.plans], _pairs(data)
    for k in range(0, len(starts), STARTS):
        part = starts[k : k + STARTS]
        for w in range(max(len(p.keys) for p in v.plans)):
            own = [i for i, p in enumerate(v.plans) if w < len(p.keys)]
            keys = _walk(pairs, part, _strides(v.seed, w), [v.plans[i].samples[w] for i in own])
            for i, key in zip(own, keys, strict=True):
                p = v.plans[i]
                first = key >> np.uint64(65 - len(p.prefixes[w]).bit_length())
                left = np.flatnonzero(p.prefixes[w].take(first.view(np.int64)))
                key = key[left]
                same = np.searchsorted(p.keys[w], key)
                there = np.flatnonzero(p.keys[w].take(same, mode="clip") == key)
                left, same = left[there], same[there]
                low = p.bounds[w][same]
                many = p.bounds[w][same + 1] - low
                nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                found[i][0].append(k + np.repeat(left, many))
                found[i][1].append(p.views[w][np.repeat(low, many) + nth])
    return [(np.concatenate(a), np.concatenate(b)) for a, b in found]


def _masks(items: Items, pieces: np.ndarray) -> np.ndarray:
    """For every piece and byte the places of the piece that hold it, as bits."""
    out = np.zeros((len(pieces), 256), np.uint64)
    for k, p in enumerate(pieces):
        x = items.items[items.owner[p]][items.begin[p] : items.begin[p] + items.size[p]]
        np.bitwise_or.at(out[k], x, np.uint64(1) << np.arange(len(x), dtype=np.uint64))
    return out


def least_edits(data: np.ndarray, low: np.ndarray, high: np.ndarray, masks: np.ndarray, which: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Least edits between a piece and any part of data[low:high], for many side by side: Myers'
    bit vectors. ``masks`` has a row for each piece, ``which`` and ``size`` its number and bytes."""
    out = np.zeros(len(low), np.int64)
    one = np.uint64(1)
    for k in range(0, len(low), LANES):
        lo, hi, row, m = (x[k : k + LANES] for x in (low, high, which * 256, size))
        top = (m - 1).astype(np.uint64)
        pv, mv = np.full(len(lo), ~np.uint64(0)), np.zeros(len(lo), np.uint64)
        cost, best, flat = m.copy(), m.copy(), masks.ravel()
        for t in range(int((hi - lo).max())):
            at = lo + t
            c = np.where(at < hi, data.take(at, mode="clip"), NO_BYTE)
            eq = flat.take(row + c)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv), pv & xh
            cost += ((ph >> top) & one).view(np.int64)
            cost -= ((mh >> top) & one).view(np.int64)
            np.minimum(best, cost, out=best)
            ph, mh = ph << one, mh << one
            pv, mv = mh | ~(xv | ph), ph & xv
        out[k : k + LANES] = best
    return out


def may_be_near(
    data: np.ndarray, low: np.ndarray, high: np.ndarray, masks: np.ndarray, which: np.ndarray, size: np.ndarray, most: np.ndarray
) -> np.ndarray:
    """Whether ``least_edits`` may be ``most`` or less: True wherever it is, False for nearly all others.

    The same bit vectors, but the edits are summed up from them after every GLANCE bytes only: a byte
    changes them by one at most. Bytes after ``high`` are read too, which can but lower them.
    """
    out = np.zeros(len(low), bool)
    span = -(-int((high - low).max(initial=0)) // GLANCE) * GLANCE
    padded, flat, one, byte = np.append(data, np.full(span, NO_BYTE, np.uint8)), masks.ravel(), np.uint64(1), np.uint64(255)
    for k in range(0, len(low) if span else 0, LANES):
        lo, row, m, limit = (x[k : k + LANES] for x in (low, which * 256, size, most + GLANCE - 1))
        texts = np.lib.stride_tricks.sliding_window_view(padded, span)[lo].view("<u8")
        row, beyond = row.astype(np.uint64), (WORD - m).astype(np.uint64)
        pv, mv = np.full(len(lo), ~np.uint64(0)), np.zeros(len(lo), np.uint64)
        text, eq, xv, ph, mh = (np.empty(len(lo), np.uint64) for _ in range(5))
        for eight in texts.T:
            text[:] = eight
            for _ in range(GLANCE):
                np.bitwise_and(text, byte, out=mh)
                mh += row
                flat.take(mh.view(np.int64), out=eq, mode="clip")
                text >>= np.uint64(8)
                np.bitwise_or(eq, mv, out=xv)
                np.bitwise_and(eq, pv, out=mh)
                mh += pv
                mh ^= pv
                mh |= eq
                np.bitwise_or(mh, pv, out=ph)
                np.invert(ph, out=ph)
                ph |= mv
                mh &= pv
                ph <<= one
                mh <<= one
                np.bitwise_and(ph, xv, out=mv)
                xv |= ph
                np.invert(xv, out=xv)
                np.bitwise_or(mh, xv, out=pv)
            out[k : k + LANES] |= np.bitwise_count(pv << beyond) - np.bitwise_count(mv << beyond) <= limit
    return out


def near_lanes(data: np.ndarray, low: np.ndarray, high: np.ndarray, masks: np.ndarray, which: np.ndarray, size: np.ndarray, most: np.ndarray):
    """Numbers of the lanes whose least edits are at most ``most``, and these edits."""
    lanes = np.flatnonzero(may_be_near(data, low, high, masks, which, size, most))
    cost = least_edits(data, low[lanes], high[lanes], masks, which[lanes], size[lanes])
    near = cost <= most[lanes]
    return lanes[near], cost[near]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edits between ``item`` and any part of ``text``; that part's start and end.

    One row of the table for each byte of the item, as a whole: the running minimum takes in
    what insertions from the left add.
    """
    n = len(text)
    steps = np.arange(n + 1)
    cost, start = np.zeros(n + 1, np.int64), steps.copy()
    room = (n + 1).bit_length()
    below, back = (1 << room) - 1, n + 1 - steps
    for c in item:
        diagonal = cost[:-1] + (text != c)
        best, from_ = cost + 1, start.copy()
        better = diagonal < best[1:]
        np.copyto(from_[1:], start[:-1], where=better)
        np.minimum(best[1:], diagonal, out=best[1:])
        # from the left: the least of best[j] - j so far, plus j
        packed = best - steps
        packed <<= room
        packed |= back
        np.minimum.accumulate(packed, out=packed)
        packed &= below
        source = np.subtract(n + 1, packed, out=packed)
        cost = best.take(source)
        cost += steps
        cost -= source
        start = from_.take(source)
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


def _short(folded: np.ndarray, offsets: np.ndarray, v: Items, share: float):
    """(row, item, edits, start, end) of the best match of every short item in every row."""
    sizes = np.diff(offsets)
    lanes = -(-sizes // LANE)
    rows = np.repeat(np.arange(len(sizes)), lanes)
    low = offsets[rows] + (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE
    for p in v.short if len(low) else []:
        i, m = int(v.owner[p]), int(v.size[p])
        most = int(share * m)
        high = np.minimum(offsets[rows + 1], low + LANE + m + most)
        none = np.zeros(len(low), np.int64)
        near, cost = near_lanes(folded, low, high, _masks(v, np.array([p])), none, none + m, none + most)
        near = near[np.lexsort((low[near], cost, rows[near]))]
        for k in near[np.unique(rows[near], return_index=True)[1]].tolist():
            edits, s, e = align(v.items[i], folded[low[k] : high[k]])
            yield int(rows[k]), i, edits, int(low[k]) + s, int(low[k]) + e


def _matches(data: np.ndarray, offsets: np.ndarray, v: Items, share: float):
    """(row, item, edits, start, end) of the best match of every item in every row."""
    folded = fold(data)
    yield from _short(folded, offsets, v, share)
    starts, rows = windows(folded, offsets)
    if not len(starts) or not v.plans:
        return
    # zeros after every row, so that no window reads the next one
    gap = REACH
    n_rows = len(offsets) - 1
    spaced = np.zeros(len(folded) + n_rows * gap, np.uint8)
    spaced[np.arange(len(folded)) + np.repeat(np.arange(n_rows) * gap, np.diff(offsets))] = folded
    masks, found = _masks(v, np.arange(len(v.owner))), []
    for plan, (at, view) in zip(v.plans, candidates(spaced, starts + rows * gap, v), strict=True):
        row, item, piece = rows[at], plan.item[view], plan.piece[view]
        begin = starts[at] - plan.offset[view]  # where the item would begin without edits
        near = (row * len(v.owner) + piece) * (len(folded) // 8 + 64) + (begin + v.begin[piece]) // 8
        _, once = np.unique(near, return_index=True)
        row, item, piece, begin = row[once], item[once], piece[once], begin[once]
        most = ((share + ROOM) * v.size[piece]).astype(np.int64)
        low = np.maximum(begin + v.begin[piece] - most - 8, offsets[row])
        high = np.minimum(begin + v.begin[piece] + v.size[piece] + most + 8, offsets[row + 1])
        near, _ = near_lanes(folded, low, high, masks, piece, v.size[piece], most)
        found.append(np.stack([row[near], item[near], begin[near]], 1))
    seen: dict[tuple[int, int], list] = {}
    triples = np.unique(np.concatenate(found), axis=0)
    done: dict[tuple[int, int], int] = {}
    for r, i, b in triples.tolist():
        x = v.items[i]
        most = int(share * len(x))
        if (r, i) in done and b <= done[r, i]:
            continue  # the window of the last start holds this one's
        low = max(int(offsets[r]), b - 2 * most)
        high = min(int(offsets[r + 1]), b + len(x) + 4 * most)
        done[r, i] = b + 2 * most
        if high <= low:
            continue
        if b >= low and b + len(x) <= high and (folded[b : b + len(x)] == x).all():
            edits, s, e = 0, b - low, b - low + len(x)
        else:
            edits, s, e = align(x, folded[low:high])
        if edits <= most:
            best = seen.get((r, i))
            if best is None or (edits, low + s) < (best[0], best[1]):
                seen[r, i] = [edits, low + s, low + e]
    for (r, i), (edits, s, e) in seen.items():
        yield r, i, edits, s, e


def _blocks(benchmark: DataFrame):
    """Broadcast (ids, views) of the items, some BLOCK_BYTES of them at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("text")
    ).where(F.col("item_id").isNotNull() & F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        if own:
            ids = [r["item_id"] for r in own]
            yield spark.sparkContext.broadcast((ids, views([r["text"].encode() for r in own])))


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, edits, start and stop: items that occur in a document with at most
    ``share`` edits for each byte of the item, at the best place (code points, stop exclusive).

    Items without an id or without words are in no document, nor are any in null or empty
    texts. A null doc_id is kept; rows that repeat an id are searched each. Items are taken in
    blocks, each of which is broadcast.
    """
    schema = "doc_id bigint, item_id bigint, edits int, start bigint, stop bigint"
    rows, out = id_and_text(docs), None
    for shared in _blocks(benchmark):

        def run(batches, shared=shared):
            ids, v = shared.value
            for batch in batches:
                doc = batch.column(0).to_pylist()
                got = []
                for first, data, offsets in text_slices(batch.column(1)):
                    for r, i, edits, s, e in _matches(data, offsets, v, share):
                        head = bytes(data[offsets[r] : s]).decode("utf-8", "ignore")
                        body = bytes(data[s:e]).decode("utf-8", "ignore")
                        got.append((doc[first + r], ids[i], edits, len(head), len(head) + len(body)))
                cols = list(zip(*got)) if got else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                    names=["doc_id", "item_id", "edits", "start", "stop"],
                )

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` in which ``leaks`` finds no item, with all their columns. Texts are
    judged where they are read, so none is shuffled."""
    at = docs.columns.index("text")
    for shared in _blocks(benchmark):

        def run(batches, shared=shared):
            _, v = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                column = pc.fill_null(batch.column(at), "")
                for first, data, offsets in text_slices(column):
                    for r, *_ in _matches(data, offsets, v, share):
                        keep[first + r] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
