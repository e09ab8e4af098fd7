"""Fill-in-middle: texts cut in three and put together for learning the middle part.

Bytes of UTF-8 fall into classes by what begins at them: a code point, a word, a line. A wavelet
matrix keeps the classes of many texts as three levels of bits; each level counts its ones word by
word, so how often a class occurs before any byte takes one look a level. The units before a byte
are the sum of such ranks over the classes that begin a unit, whichever unit is asked for, and
bisection on these sums finds the byte at which a given unit begins: for all texts of a slice
together, and for both cuts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from vidmart.llm.bytewords import spaces, text_slices

MARKS = ("<P>", "<S>", "<M>")
LEVELS = 3
CHAR, WORD, LINE = 4, 2, 1  # what begins at a byte
UNITS = {"chars": CHAR, "words": WORD, "lines": LINE}
RESULTS = ["n", "form", "prefix_chars", "middle_chars", "output"]


def classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The class of every byte. A word begins at a byte other than white space that starts a text or
    follows white space; a line at the start of a text and after each line feed."""
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    blank = spaces()[data]
    after_blank, after_feed = first.copy(), first.copy()
    after_blank[1:] |= blank[:-1]
    after_feed[1:] |= data[:-1] == 10
    char = (data & 0xC0) != 0x80
    return (char * CHAR + (~blank & after_blank) * WORD + after_feed * LINE).astype(np.uint8)


class WaveletMatrix:
    """Ranks of small numbers. Level by level, from the highest bit, numbers with a 0 go before those
    with a 1, in the order they had."""

    def __init__(self, codes: np.ndarray, levels: int = LEVELS):
        self.levels, self.words, self.ones, self.zeros = levels, [], [], []
        for level in range(levels - 1, -1, -1):
            bits = (codes >> level) & 1
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(len(codes) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=counts[1:])
            self.words.append(words)
            self.ones.append(counts)
            self.zeros.append(len(codes) - int(bits.sum()))
            codes = np.concatenate([codes[bits == 0], codes[bits == 1]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        low = self.words[level][at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.ones[level][at >> 6] + np.bitwise_count(low)

    def rank(self, code: int, at: np.ndarray) -> np.ndarray:
        """How often ``code`` is among the first ``at`` numbers."""
        low, high = np.zeros_like(at), at
        for level in range(self.levels):
            ones_low, ones_high = self._ones(level, low), self._ones(level, high)
            if code >> (self.levels - 1 - level) & 1:
                low, high = self.zeros[level] + ones_low, self.zeros[level] + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low

    def boundaries(self, unit: int, at: np.ndarray) -> np.ndarray:
        """How many units begin among the first ``at`` bytes: ranks of all classes that begin one."""
        return sum(self.rank(code, at) for code in range(1 << self.levels) if code & unit)

    def begin(self, unit: int, low: np.ndarray, high: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The byte from ``low`` to ``high`` at which the unit begins that ``number`` units go before, in all
        of the data; ``high`` if there is none. By bisection on the counts of boundaries."""
        low, high = low.copy(), high.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.boundaries(unit, np.minimum(middle + 1, high)) > number
            open_ = low < high
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low


def cuts(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, unit: int) -> dict[str, np.ndarray]:
    """For each text its units, the bytes of both cuts, and the code points before them. ``draws`` has two
    numbers for each text; they choose the cuts among all n + 1 places between units."""
    matrix = WaveletMatrix(classes(data, offsets))
    begin, end = offsets[:-1], offsets[1:]
    before = matrix.boundaries(unit, begin)
    n = matrix.boundaries(unit, end) - before
    places = np.sort(draws % (n + 1)[:, None], axis=1)
    at = []
    for place in places.T:
        found = matrix.begin(unit, begin, end, before + place)
        at.append(np.where(place == 0, begin, np.where(place == n, end, found)))
    chars = [matrix.boundaries(CHAR, x) for x in (begin, *at)]
    return {"n": n, "first": at[0], "second": at[1], "prefix": chars[1] - chars[0], "middle": chars[2] - chars[1]}


def _draw(seed: str, k: int):
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}")


def transform(
    docs: DataFrame, unit: str = "chars", plain: int = 10, suffix_first: int = 20, seed: str = "1"
) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars and output.

    Prefix and middle end after numbers of units drawn from the hash of seed and doc_id, the suffix is
    the rest. ``plain`` of 100 texts stay as they are, and so do empty ones and those that hold a
    mark; ``suffix_first`` of 100 others are ``<S>``suffix``<P>``prefix``<M>``middle (spm), the rest
    ``<P>``prefix``<S>``suffix``<M>``middle (psm). A unit is a code point, a word with the white space after
    it (leading white space goes with the first word), or a line with its line feed.

    A null text is empty; a null id counts as the empty string in the hash. Rows that repeat an
    id and a text get the same result. Other columns stay, except those named like a result.
    """
    others = [c for c in docs.columns if c not in ("text", *RESULTS)]
    draws = docs.select(F.coalesce("text", F.lit("")).alias("text"), *[_draw(seed, k) for k in range(4)], *others)
    kind = UNITS[unit]

    def run(batches):
        for batch in batches:
            h = np.stack([batch.column(1 + k).to_numpy(zero_copy_only=False) for k in range(4)], 1)
            for first, data, offsets in text_slices(batch.column(0)):
                rows = slice(first, first + len(offsets) - 1)
                c = cuts(data, offsets, h[rows, :2], kind)
                raw, forms, out = data.tobytes(), [], []
                ends = zip(offsets[:-1].tolist(), c["first"].tolist(), c["second"].tolist(), offsets[1:].tolist(), strict=True)
                for (a, i, j, b), (h3, h4) in zip(ends, h[rows, 2:].tolist(), strict=True):
                    text = raw[a:b]
                    if not text or h3 % 100 >= 100 - plain or any(m.encode() in text for m in MARKS):
                        forms.append("plain")
                        out.append(text)
                    elif h4 % 100 < suffix_first:
                        forms.append("spm")
                        out.append(b"<S>" + raw[j:b] + b"<P>" + raw[a:i] + b"<M>" + raw[i:j])
                    else:
                        forms.append("psm")
                        out.append(b"<P>" + raw[a:i] + b"<S>" + raw[j:b] + b"<M>" + raw[i:j])
                whole = np.array([f == "plain" for f in forms], bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(5 + k).slice(first, len(forms)) for k in range(len(others))],
                        pa.array(c["n"], pa.int64()), pa.array(forms, pa.string()),
                        pa.array(c["prefix"], pa.int64(), mask=whole), pa.array(c["middle"], pa.int64(), mask=whole),
                        pa.array(out, pa.binary()).cast(pa.string()),
                    ],
                    names=[*others, *RESULTS],
                )

    schema = StructType([docs.schema[c] for c in others])
    for name, t in zip(RESULTS, [LongType(), StringType(), LongType(), LongType(), StringType()], strict=True):
        schema = schema.add(name, t)
    return draws.mapInArrow(run, schema)


def restored():
    """The original text, from the columns form and output. Marks cannot occur in the parts of a text that
    was cut, so the first ones found are those that were put there."""
    text = F.col("output")

    def between(mark: str, after: str | None):
        start = F.locate(mark, text) + 3
        if after is None:
            return F.substr(text, start)
        return F.substr(text, start, F.locate(after, text) - start)

    psm = F.concat(between("<P>", "<S>"), between("<M>", None), between("<S>", "<M>"))
    spm = F.concat(between("<P>", "<M>"), between("<M>", None), between("<S>", "<P>"))
    return F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(text)


def digests(out: DataFrame) -> DataFrame:
    """The hashes of the outputs and of the texts rebuilt from them."""
    return out.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )
