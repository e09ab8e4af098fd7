"""Fingerprints of texts by prefix polynomial hashes.

The hash of the bytes before a place, sum of byte times base to its position, kept for every place
modulo two primes, gives the hash of any span by one difference: spans of different texts are
equal if their hashes are, wherever they lie. Hashes of spans that start at two places agree up
to some length and differ beyond, so bisection finds the longest common extension.

A fingerprint is a small part of a text's prefix array: its length, the hash of all of it, hashes at
even steps from the start, and hashes at anchors, places chosen by the hash of the few bytes that
follow. A place that is an anchor in one text is one in every text that holds these bytes, and the
anchors of a coarser level are among those of a finer one, as are the steps, so long and short texts
still meet. The common beginning, spans between anchors and common extensions of anchors are
found without the texts.

The hash is of UTF-8 bytes; equal texts have equal fingerprints.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from vidmart.llm.bytewords import mix, text_slices
from vidmart.llm.tables import width

PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_000_003, 998_244_353)
WINDOW = 8  # bytes whose hash says whether a place is an anchor
ANCHORS = 32  # of a fingerprint, at most
STEPS = 16  # likewise
RUN = 12  # bytes that a common span has at least to count
BLOCK = 1 << 16  # bytes worked on together
CUT = 1 << 22  # bytes of the rows worked on together, if there is more than one
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the k-th base, and of its inverse, modulo the k-th prime."""
    if k not in _POWERS or len(_POWERS[k][0]) < n:
        p, size = PRIMES[k], 1 << max(n - 1, 1).bit_length()
        both = []
        for base in (BASES[k], pow(BASES[k], -1, p)):
            out = np.ones(1, np.uint64)
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), p)) % np.uint64(p)])
            both.append(out)
        _POWERS[k] = both[0], both[1]
    return _POWERS[k]


def inverses(k: int, at: np.ndarray) -> np.ndarray:
    """The k-th base to the power of less ``at``: what brings a span from there to the start."""
    far, near = np.divmod(at, BLOCK)
    steps, which = np.unique(far, return_inverse=True)
    lead = np.array([pow(BASES[k], -int(x) * BLOCK, PRIMES[k]) for x in steps], np.uint64)
    return powers(k, BLOCK)[1][near] * lead[which] % np.uint64(PRIMES[k])


class Prefix:
    """The prefix array of one text."""

    def __init__(self, data: np.ndarray):
        self.data, n = data, len(data)
        self.sums = []
        for k, p in enumerate(PRIMES):
            sums, carry = np.zeros(n + 1, np.uint64), 0
            power = powers(k, min(n, BLOCK) + 1)[0]
            for s in range(0, n, BLOCK):
                c = data[s : s + BLOCK].astype(np.uint64) + np.uint64(1)
                local = np.cumsum(c * power[: len(c)]) % np.uint64(p)
                sums[s + 1 : s + 1 + len(c)] = (local * np.uint64(pow(BASES[k], s, p)) + np.uint64(carry)) % np.uint64(p)
                carry = int(sums[s + len(c)])
            self.sums.append(sums)

    def span(self, start: int, stop: int) -> tuple[int, int]:
        """Hash of the bytes from ``start`` to ``stop``, the same wherever they lie."""
        return tuple(
            (int(s[stop]) - int(s[start])) * pow(BASES[k], -start, PRIMES[k]) % PRIMES[k] for k, s in enumerate(self.sums)
        )

    def extension(self, at: int, other: Prefix, there: int) -> int:
        """Bytes that both texts share from ``at`` and ``there`` on."""
        low, high = 0, min(len(self.data) - at, len(other.data) - there)
        while low < high:
            half = (low + high + 1) // 2
            if self.span(at, at + half) == other.span(there, there + half):
                low = half
            else:
                high = half - 1
        return low

    def extension_back(self, at: int, other: Prefix, there: int) -> int:
        """Bytes that both texts share before ``at`` and ``there``."""
        low, high = 0, min(at, there)
        while low < high:
            half = (low + high + 1) // 2
            if self.span(at - half, at) == other.span(there - half, there):
                low = half
            else:
                high = half - 1
        return low


def _blocks(data: np.ndarray, offsets: np.ndarray, least: np.ndarray) -> Iterator[tuple]:
    """For each block of bytes: its start, which of its bytes are anchors of at least their text's level in
    ``least``, their levels, and for each prime the prefix hash before each byte and after the last."""
    carry, n = [0] * len(PRIMES), len(data)
    for s in range(0, n, BLOCK):
        size = min(BLOCK, n - s)
        first, last = np.searchsorted(offsets, s, "right") - 1, np.searchsorted(offsets, s + size, "left")
        within = np.diff(np.clip(offsets[first : last + 1], s, s + size))  # bytes of each text in the block
        c = data[s : s + size + WINDOW].astype(np.uint64) + np.uint64(1)
        full = max(0, min(size, len(c) - WINDOW + 1))
        sums = []
        for k, p in enumerate(PRIMES):
            power, inverse = powers(k, BLOCK + WINDOW)
            local = np.zeros(len(c) + 1, np.uint64)
            np.cumsum(c * power[: len(c)], out=local[1:])  # below 2**60
            if k == 0:
                window = (local[WINDOW : WINDOW + full] - local[:full]) % np.uint64(p) * inverse[:full] % np.uint64(p)
                mixed = mix(window + np.uint64(1))
                level = np.bitwise_count((mixed & (~mixed + np.uint64(1))) - np.uint64(1)).astype(np.int64)
            at = local[: size + 1] % np.uint64(p) * np.uint64(pow(BASES[k], s, p)) + np.uint64(carry[k])
            sums.append(at % np.uint64(p))
            carry[k] = int(sums[k][size])
        high = np.flatnonzero(level >= np.repeat(least[first:last], within)[:full])
        row = np.searchsorted(offsets, high + s, "right") - 1
        inside = high + s + WINDOW <= offsets[row + 1]  # the bytes that follow are the text's own
        yield s, size, high[inside], level[high[inside]], sums


def _hex(values: np.ndarray) -> list[str]:
    text = values.astype(">u8").tobytes().hex()
    return [text[i : i + 16] for i in range(0, len(text), 16)]


def prints(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The fingerprint of every text that ``offsets`` bound in ``data``."""
    sizes = np.diff(offsets)
    # levels below this would have too many anchors in most texts
    least = np.maximum(0, np.frexp(np.maximum(sizes, 1) / ANCHORS)[1] - 3)
    step = np.maximum(0, np.frexp(sizes // STEPS)[1])  # a text has STEPS places 2**step apart, at most
    step += (sizes >> step) > STEPS
    evenly = sizes >> step
    first_step = np.concatenate([[0], np.cumsum(evenly)])
    nth = np.arange(first_step[-1]) - np.repeat(first_step[:-1], evenly) + 1
    wanted = np.concatenate([offsets, np.repeat(offsets[:-1], evenly) + (nth << np.repeat(step, evenly))])
    none = np.zeros(0, np.int64)
    found, at_wanted = [(none, none, *[none.astype(np.uint64)] * len(PRIMES))], [np.zeros(len(wanted), np.uint64) for _ in PRIMES]
    for s, size, at, level, sums in _blocks(data, offsets, least):
        found.append((at + s, level, *[x[at] for x in sums]))
        here = np.flatnonzero((wanted >= s) & (wanted <= s + size))
        for x, y in zip(at_wanted, sums, strict=True):
            x[here] = y[wanted[here] - s]
    place, level, *sums = (np.concatenate(x) for x in zip(*found, strict=True))
    rows = np.searchsorted(offsets, place, "right") - 1
    bounds = np.searchsorted(rows, np.arange(len(sizes) + 1))
    start = least.copy()
    for r in np.flatnonzero(np.diff(bounds) > ANCHORS).tolist():
        many = np.bincount(level[bounds[r] : bounds[r + 1]])[::-1].cumsum()[::-1]
        while start[r] < len(many) and many[start[r]] > ANCHORS:
            start[r] += 1
    keep = np.flatnonzero(level >= start[rows])
    place, level, rows = place[keep], level[keep], rows[keep]
    bounds = np.searchsorted(rows, np.arange(len(sizes) + 1))

    def hashed(values: list[np.ndarray], of: np.ndarray) -> list[str]:
        """Prefix hashes of places in the texts ``of``, as if each text stood alone."""
        own = []
        for k, (x, before, p) in enumerate(zip(values, at_wanted, PRIMES, strict=True)):
            begin = inverses(k, offsets[:-1])[of] if len(of) else np.zeros(0, np.uint64)
            own.append((x + np.uint64(p) - before[of]) % np.uint64(p) * begin % np.uint64(p))
        return _hex(own[0] << np.uint64(31) | own[1])

    whole = hashed([x[1 : len(offsets)] for x in at_wanted], np.arange(len(sizes)))
    steps = hashed([x[len(offsets) :] for x in at_wanted], np.repeat(np.arange(len(sizes)), evenly))
    anchors = [
        f"{p:x}.{v:x}.{h}"
        for p, v, h in zip((place - offsets[rows]).tolist(), level.tolist(), hashed([x[keep] for x in sums], rows), strict=True)
    ]
    out = []
    for r, n in enumerate(sizes.tolist()):
        head = f"{n:x}.{start[r]:x}.{whole[r]}.{step[r]:x}.{''.join(steps[first_step[r] : first_step[r + 1]])}"
        out.append(",".join([head, *anchors[bounds[r] : bounds[r + 1]]]))
    return out


class Marks:
    """What a fingerprint says: places and the hashes before them, from a level on."""

    def __init__(self, text: str):
        head, *rest = text.split(",")
        size, level, whole, step, evenly = head.split(".")
        self.size, self.level, self.whole, self.step = int(size, 16), int(level, 16), int(whole, 16), int(step, 16)
        self.evenly = [evenly[i : i + 16] for i in range(0, len(evenly), 16)]
        self.anchors = [(int(p, 16), int(v, 16), int(h, 16)) for p, v, h in (a.split(".") for a in rest)]

    def points(self, level: int) -> tuple[list[int], list[int]]:
        """Places and hashes of the start, the anchors from a level on, and the end."""
        kept = [(p, h) for p, v, h in self.anchors if v >= level and p]
        return [0, *[p for p, _ in kept], self.size], [0, *[h for _, h in kept], self.whole]


def _beginning(one: Marks, other: Marks) -> int:
    """Bytes that both texts begin with, as far as their steps tell."""
    step = max(one.step, other.step)
    x, y = (m.evenly[(1 << step - m.step) - 1 :: 1 << step - m.step] for m in (one, other))
    low, high = 0, min(len(x), len(y))
    while low < high:
        half = (low + high + 1) // 2
        if x[half - 1] == y[half - 1]:
            low = half
        else:
            high = half - 1
    return low << step


def _span(t: tuple, i: int, j: int) -> tuple[int, int, int]:
    """Length and hashes of the span between two points, the same wherever it lies."""
    places, h, g, u, v, _ = t
    return places[j] - places[i], (h[j] - h[i]) * u[i] % PRIMES[0], (g[j] - g[i]) * v[i] % PRIMES[1]


def _covered(one: tuple, other: tuple, begin: int, least: int) -> int:
    """Bytes of ``one`` in spans that ``other`` has as well, each extended as far as it goes. The texts
    share their first ``begin`` bytes. A text is its points: places, hashes by prime, inverses by
    prime, and what the spans from one to the next are known by."""
    starts: dict[tuple, list[int]] = {}
    for j, name in enumerate(other[-1]):
        starts.setdefault(name, []).append(j)
    places, names, end = one[0], one[-1], len(one[0]) - 1
    total, i = begin, bisect.bisect_right(places, begin) - 1
    while i < end:
        best = 0
        for j in starts.get(names[i], ()):
            low, high = 1, min(end - i, len(other[0]) - 1 - j)
            while low < high:  # the longest common extension, counted in points
                half = (low + high + 1) // 2
                if _span(one, i, i + half) == _span(other, j, j + half):
                    low = half
                else:
                    high = half - 1
            best = max(best, low)
        if best and places[i + best] - places[i] >= least:
            total += max(0, places[i + best] - max(begin, places[i]))
        i += max(best, 1)
    return total


def likenesses(pairs: list[tuple[str, str]]) -> list[float]:
    """For pairs of fingerprints the share of both texts, from 0 to 1, that lies in spans that the other has
    too, as far as the fingerprints tell."""
    out, marks, flat = [1.0] * len(pairs), {}, ([], [])
    todo = []
    for at, (a, b) in enumerate(pairs):
        if a == b:
            continue
        one, other = (marks[x] if x in marks else marks.setdefault(x, Marks(x)) for x in (a, b))
        if not one.size or not other.size:
            out[at] = 0.0
            continue
        level, bounds = max(one.level, other.level), []
        for m in (one, other):
            places, hashes = m.points(level)
            bounds.append((len(flat[0]), len(flat[0]) + len(places)))
            flat[0].extend(places)
            flat[1].extend(hashes)
        todo.append((at, one, other, bounds))
    if not todo:
        return out
    places, hashes = np.array(flat[0], np.int64), np.array(flat[1], np.uint64)
    columns, names = [flat[0]], [np.diff(places)]
    for part, p in zip((hashes >> np.uint64(31), hashes & np.uint64(0x7FFFFFFF)), PRIMES, strict=True):
        back = inverses(len(columns) - 1, places)
        names.append((part[1:] + np.uint64(p) - part[:-1]) % np.uint64(p) * back[:-1] % np.uint64(p))
        columns.append((part.tolist(), back.tolist()))
    keys = list(zip(*[x.tolist() for x in names], strict=True))
    (h, u), (g, v) = columns[1:]
    for at, one, other, bounds in todo:
        p, q = ((flat[0][i:j], h[i:j], g[i:j], u[i:j], v[i:j], keys[i : j - 1]) for i, j in bounds)
        least = min(RUN, max(1, min(one.size, other.size) // 3))
        begin = _beginning(one, other)
        begin = begin if begin >= least else 0
        both = _covered(p, q, begin, least) + _covered(q, p, begin, least)
        out[at] = min(1.0, both / (one.size + other.size))
    return out


def likeness_of(a: str, b: str) -> float:
    return likenesses([(a, b)])[0]


def likeness(a: str, b: str) -> Column:
    """``likeness_of`` two columns of fingerprints; null if one is null."""

    @F.arrow_udf("double")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        pairs = list(zip(x.to_pylist(), y.to_pylist(), strict=True))
        there = [i for i, (p, q) in enumerate(pairs) if p is not None and q is not None]
        out: list = [None] * len(pairs)
        for i in range(0, len(there), 1024):
            for at, value in zip(there[i : i + 1024], likenesses([pairs[k] for k in there[i : i + 1024]]), strict=True):
                out[at] = value
        return pa.array(out, pa.float64())

    return run(F.col(a), F.col(b))


def fingerprints(rows: DataFrame, columns: dict[str, str], keep: list[str]) -> DataFrame:
    """The columns ``keep``, and a fingerprint for each column of texts: ``columns`` maps texts to the names
    of their fingerprints. A null text is empty. Texts that a batch holds several times, in
    whichever column, are hashed once."""
    texts = [F.coalesce(F.col(c), F.lit("")).alias(f"t{i}") for i, c in enumerate(columns)]

    def cut(batch):
        """Runs of rows with about CUT bytes of text."""
        sizes = sum(pc.binary_length(batch.column(i)).to_numpy().astype(np.int64) for i in range(len(columns)))
        edges = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(sizes) // CUT)) + 1, [len(sizes)]])
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if high > low:
                yield batch.slice(low, high - low)

    def run(batches):
        for part in (p for batch in batches for p in cut(batch)):
            coded = pa.concat_arrays([part.column(i).cast(pa.large_string()) for i in range(len(columns))]).dictionary_encode()
            done = [x for _, data, offsets in text_slices(coded.dictionary) for x in prints(data, offsets)]
            out = pa.array(done, pa.string()).take(coded.indices)
            n = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [*part.columns[len(columns) :], *[out.slice(i * n, n) for i in range(len(columns))]],
                names=[*keep, *columns.values()],
            )

    schema = StructType([rows.schema[c] for c in keep])
    for name in columns.values():
        schema = schema.add(name, StringType())
    return rows.select(*texts, *keep).mapInArrow(run, schema)


def common_spans(pairs: DataFrame, a: str, b: str, least: int = 32) -> DataFrame:
    """``pairs`` with spans: array of (a_start, b_start, length), in code points, of spans of at least
    ``least`` bytes that both texts have, each as long as it goes. They start from anchors that agree,
    so a common span is found if it holds an anchor of both texts' common level.
    A null text has none. A column named spans is replaced."""
    others = [c for c in pairs.columns if c != "spans"]
    at = {c: i for i, c in enumerate(others)}

    def chars(data: np.ndarray, start: int, stop: int) -> tuple[int, int]:
        """First and last boundary of code points in a span of bytes."""
        lead = (data & 0xC0) != 0x80
        while start < stop and not lead[start]:
            start += 1
        while stop > start and stop < len(data) and not lead[stop]:
            stop -= 1
        return start, stop

    def found(x: str, y: str) -> list[dict]:
        one, other = (np.frombuffer(t.encode(), np.uint8) for t in (x, y))
        marks = [Marks(prints(d, np.array([0, len(d)]))[0]) for d in (one, other)]
        level = max(m.level for m in marks)
        p, q = Prefix(one), Prefix(other)
        starts: dict[tuple, list[int]] = {}
        for place, at, _ in marks[1].anchors:
            if at >= level:
                starts.setdefault(q.span(place, place + WINDOW), []).append(place)
        spans: set[tuple[int, int, int]] = set()
        for i in [0, *[place for place, at, _ in marks[0].anchors if at >= level]]:
            for j in [0] if i == 0 else starts.get(p.span(i, i + WINDOW), []):
                if any(s <= i < s + n and i - s == j - t for s, t, n in spans):
                    continue
                back = p.extension_back(i, q, j)
                n = back + p.extension(i, q, j)
                if n >= least:
                    spans.add((i - back, j - back, n))
        out = []
        for s, t, n in sorted(spans):
            lo, hi = chars(one, s, s + n)
            out.append(
                {
                    "a_start": len(bytes(one[:lo]).decode()), "b_start": len(bytes(other[: t + lo - s]).decode()),
                    "length": len(bytes(one[lo:hi]).decode()),
                }
            )
        return out

    kind = "array<struct<a_start: bigint, b_start: bigint, length: bigint>>"
    arrow = pa.list_(pa.struct([("a_start", pa.int64()), ("b_start", pa.int64()), ("length", pa.int64())]))

    def run(batches):
        for batch in batches:
            rows = zip(batch.column(at[a]).to_pylist(), batch.column(at[b]).to_pylist(), strict=True)
            spans = pa.array([found(x or "", y or "") if x and y else [] for x, y in rows], arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, spans], names=[*others, "spans"])

    from pyspark.sql.types import _parse_datatype_string

    schema = StructType([pairs.schema[c] for c in others]).add("spans", _parse_datatype_string(kind))
    return pairs.select(*others).mapInArrow(run, schema)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text: the text of the next row by descending doc_id, nulls last, ties by hash of the
    text; after the last row comes the first. A null text is empty.

    Quantiles of the ids part the rows into buckets, so no task sorts them all. Only where a bucket
    ends must the first row of the next bucket be known: these rows, one a bucket, are sent to both.
    Rows without an id are parted by hash. Rows that share an id are in one bucket.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("h", F.xxhash64("text")).withColumn(
        "o", -F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(-(1 << 63) - 1)).cast("decimal(20,0)"))
    )
    buckets = 4 * width(docs.sparkSession)
    at = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    bounds = rows.agg(F.approx_percentile("doc_id", at, F.lit(max(10_000, 10 * buckets)))).first()[0] or []
    bounds = sorted({-b for b in bounds})  # at most one a bucket
    steps = len(bounds).bit_length()
    known = F.array(*[F.lit(str(b)).cast("decimal(20,0)") for b in bounds])

    def halved(low, step):
        """Bounds below the row's place, by bisection."""
        further = low + step
        return F.when(F.col("o") > F.get(known, further - 1), further).otherwise(low)

    number = F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(steps))]), F.lit(0), halved) if steps else F.lit(0)
    nulls = (F.lit(len(bounds) + 1) + F.floor((F.col("h") / float(1 << 64) + 0.5) * buckets)).cast("int")
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), nulls).otherwise(number))
    heads = rows.groupBy("bucket").agg(F.min(F.struct("o", "h")).alias("x")).select("bucket", "x.*").collect()
    if not heads:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    heads = sorted(tuple(r) for r in heads)
    place = {b: (i, o, h) for i, (b, o, h) in enumerate(heads)}
    every = [place.get(b, (0, None, None)) for b in range(heads[-1][0] + 1)]
    before = F.get(F.array(*[F.lit(heads[i - 1][0]) for i, _, _ in every]), F.col("bucket"))  # the last before the first
    begin_o = F.get(F.array(*[F.lit(None if o is None else str(o)).cast("decimal(20,0)") for _, o, _ in every]), F.col("bucket"))
    begin_h = F.get(F.array(*[F.lit(h).cast("bigint") for _, _, h in every]), F.col("bucket"))
    own = F.struct(F.col("bucket"), F.lit(False).alias("end"))
    both = F.array(own, F.struct(before.alias("bucket"), F.lit(True).alias("end")))
    head = (F.col("o") == begin_o) & (F.col("h") == begin_h)
    spread = rows.withColumn("to", F.explode(F.when(head, both).otherwise(F.array(own))))
    spread = spread.select("doc_id", "text", "o", "h", "to.bucket", "to.end")
    inside = Window.partitionBy("bucket").orderBy("end", "o", "h", "text")
    return spread.withColumn("next_text", F.lead("text").over(inside)).where("not end").select("doc_id", "text", "next_text")
