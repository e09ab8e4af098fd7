"""Text columns: keys, video ids, comment scrubbing and hashtags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns the results depend on.
VIDEO_ID = r"/video/(\d+)"
SCRUB = r"[^\w\s.,!?]"
TAG_PUNCTUATION = ".,!?;:"

# (?U) makes \s mean Unicode white space; the four information separators are white space
# to a plain Python split() but not to Java, so they are named.
TAG = r"(?U)#(?<![^\s\x1c-\x1f]#)(?=[^\s\x1c-\x1f])#*+([^\s\x1c-\x1f]*+)"

# White space as a plain Python split() or strip() sees it.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    chr(c) for c in (*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


def strip(c: Column) -> Column:
    """Drop white space of any kind from both ends (``trim`` would only drop blanks)."""
    return F.btrim(c, F.lit(SPACES))


def normal_key(c: Column) -> Column:
    """Join-key form of a name: stripped and lower-cased."""
    return F.lower(strip(c))


def video_id(url: Column) -> Column:
    """Digits after ``/video/``; NULL where the address has none."""
    return F.nullif(F.regexp_extract(url, VIDEO_ID, 1), F.lit(""))


def scrub(c: Column, unicode: bool = False) -> Column:
    """Remove everything but word characters, white space and ``. , ! ?``.

    By default only ASCII letters count as word characters; ``unicode=True`` keeps letters
    of every script.
    """
    return F.regexp_replace(c, ("(?U)" if unicode else "") + SCRUB, "")


def hashtags(c: Column) -> Column:
    """Tags of a caption in order, repeats kept, as an array that is never NULL.

    A tag is a white-space separated word of two or more characters that starts with ``#``;
    all leading ``#`` go, then case, then punctuation at both ends. The pattern starts at a
    ``#``, looks back for white space or the start and ahead for one more character, so words
    that are no tags cost next to nothing.
    """
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(TAG), 1)
    return F.transform(found, lambda tag: F.btrim(F.lower(tag), F.lit(TAG_PUNCTUATION)))
