"""Secret scan through a trigram index.

Each rule is a regular expression. Trigrams that every match must contain are derived from it
as a Boolean query (an OR of ANDs). The documents' postings for the trigrams that occur in any
query are intersected, and only documents left over are scanned with that rule. A rule without
mandatory trigrams scans every document. All steps are DataFrame operations.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidmart.llm.tables import small_table

MOST_STRINGS = 64  # a longer list of alternatives is cut into its own trigrams
MOST_CLAUSES = 64  # a wider query is replaced by the weaker of its halves


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # in syntax that Python and Java share
    ignore_case: bool = False
    part: int = 0  # the group whose length counts
    least: int = 0  # characters that group must have

    @property
    def java(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("map_key", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("login_url", r"[a-z]+://[A-Za-z0-9._-]+:([^\x20\x09-\x0D/@]+)@", part=1, least=6),
)

Query = frozenset  # of clauses, each a frozenset of trigrams; the empty clause is always true
ALWAYS = Query([frozenset()])


def _least(clauses) -> Query:
    """Without clauses that another implies."""
    kept: list[frozenset] = []
    for c in sorted(set(clauses), key=len):
        if not any(k <= c for k in kept):
            kept.append(c)
    return Query(kept)


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MOST_CLAUSES:
        return max(a, b, key=lambda q: min(map(len, q), default=0))
    return _least(x | y for x in a for y in b)


def _spelled(strings: set[str]) -> Query:
    return _least(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _letters(items) -> set[str] | None:
    out = set()
    for op, value in items:
        if op is not sre.LITERAL:
            return None
        out.add(chr(value))
    return out if len(out) <= 8 else None


def _read(tokens) -> tuple[set[str] | None, Query]:
    """The only strings a sequence can match, if few, and its query."""
    strings: set[str] = {""}
    query, whole = ALWAYS, True
    for op, value in tokens:
        own, inner = None, ALWAYS
        if op is sre.LITERAL:
            own = {chr(value)}
        elif op is sre.IN:
            own = _letters(value)
        elif op is sre.SUBPATTERN:
            own, inner = _read(value[-1])
        elif op is sre.BRANCH:
            parts = [_read(x) for x in value[1]]
            if all(p[0] is not None for p in parts):
                own = set().union(*(p[0] for p in parts))
            inner = _least(c for p in parts for c in (_spelled(p[0]) if p[0] is not None else p[1]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, sub = value
            exact, sub_query = _read(sub)
            if exact is not None and (least, most) == (0, 1):
                own = exact | {""}
            elif exact is not None and least == most and least <= 4:
                own = {""}
                for _ in range(least):
                    own = {a + b for a in own for b in exact}
            elif least:
                inner = sub_query if exact is None else _spelled(exact)
        if own is not None and len(own) * len(strings) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in own}
            continue
        query = _both(_both(query, _spelled(strings)), _spelled(own) if own is not None else inner)
        strings, whole = {""}, False
    return (strings, _spelled(strings)) if whole else (None, _both(query, _spelled(strings)))


def trigram_query(rule: Rule) -> Query:
    """Trigrams, in lower case, that a match of the rule must contain: any clause, all of it."""
    return _both(ALWAYS, Query(frozenset(t.lower() for t in c) for c in _read(_parser.parse(rule.pattern))[1]))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index for ``trigrams``: (trigram, doc_id), one row for each that a text has."""
    low = F.lower("text")
    found = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams]))
    return docs.select(F.explode(found).alias("trigram"), "doc_id")


def candidates(index: DataFrame, rules: dict[str, Query]) -> DataFrame:
    """doc_id and kinds, the rules whose query the document's postings satisfy.

    The clauses, a set fixed by the rules, are broadcast; counts are summed before the shuffle.
    """
    spark = index.sparkSession
    clauses = [
        (kind, i, t, len(c)) for kind, q in rules.items() for i, c in enumerate(sorted(q, key=sorted)) for t in sorted(c)
    ]
    needed = small_table(spark, clauses, "kind string, clause int, trigram string, size int")
    return (
        index.distinct()
        .join(F.broadcast(needed), "trigram")
        .groupBy("doc_id", "kind", "clause")
        .agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
        .where("n = size")
        .groupBy("doc_id")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _spans(rule: Rule, number: int) -> Column:
    """Matches long enough, as (start, number, kind, end) in code points.

    Matches and the pieces between them, in turn, give each match its place.
    """
    text, java = F.col("text"), F.lit(rule.java)
    whole = F.expr(f"regexp_extract_all(text, {_quoted(rule.java)}, 0)")
    part = F.expr(f"regexp_extract_all(text, {_quoted(rule.java)}, {rule.part})")
    step = F.arrays_zip(
        F.transform(F.split(text, java, -1), F.length).alias("gap"),
        F.transform(whole, F.length).alias("size"),
        F.transform(part, F.length).alias("part"),
    )
    empty = F.array().cast("array<struct<start:int,number:int,kind:string,end:int>>")
    return F.aggregate(
        F.filter(step, lambda x: x["size"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["size"]).alias("at"),
            F.when(
                x["part"] >= rule.least,
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"), F.lit(number).alias("number"),
                            F.lit(rule.kind).alias("kind"),
                            (acc["at"] + x["gap"] + x["size"]).alias("end"),
                        )
                    ),
                ),
            ).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: acc["out"],
    )


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _long_enough(rule: Rule) -> Column:
    """A cheap test that a match with ``least`` characters may be there, for a class alone."""
    m = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return F.rlike("text", F.lit(f"{m[1]}{{{rule.least}}}")) if m else F.lit(True)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id and spans: array of (start, number, kind, end), by start and number of the rule.

    One row for each row, with an empty array where nothing is found; null texts are empty,
    null and repeated doc_ids are kept. Matches of a rule are leftmost and do not overlap;
    those whose group is too short are dropped. Upper and lower case are A-Z and a-z.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    queries = {r.kind: trigram_query(r) for r in rules}
    indexed = {k: q for k, q in queries.items() if frozenset() not in q}
    trigrams = sorted({t for q in indexed.values() for c in q for t in c})
    kinds = F.array().cast("array<string>")
    if trigrams:
        hits = candidates(postings(rows, trigrams), indexed).where("doc_id is not null")
        rows = rows.join(hits, "doc_id", "left")
        kinds = F.col("kinds")
    none = F.array().cast("array<struct<start:int,number:int,kind:string,end:int>>")
    found = []
    for i, r in enumerate(rules):
        go = _long_enough(r)
        if r.kind in indexed:  # a row without an id cannot be found in the index
            go = go & (F.coalesce(F.array_contains(kinds, r.kind), F.lit(False)) | F.col("doc_id").isNull())
        found.append(F.when(go, _spans(r, i)).otherwise(none))
    return rows.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def digests(scanned: DataFrame) -> DataFrame:
    """Counts and the two span lists of the base rules and of all rules."""
    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))),
            ",",
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["number"] < len(BASE))
    counts = [count(r.kind) for r in BASE]
    return scanned.select(
        "doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
