"""Each operator against a plain version on small tables, and on odd and empty input."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from vidmart.llm import (
    bpe, decontaminate, jaccard, kneserney, linededup, quality, queries, secretscan, sharding, topk, toxicity,
)

TOKENS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def held(doc_id, by, rest):
    return zlib.crc32(str(doc_id).encode()) % by == rest


# byte-level BPE


def test_bpe_equals_the_library(spark, odd, none):
    plain = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}
    )
    rng = random.Random(3)
    texts = ["", " a  b\n\n c", "ab" * 700, "naïve 日本語 🙂", "<|endoftext|>", "it's 12345 !!??"]
    texts += ["".join(chr(rng.randrange(32, 0x2FF)) for _ in range(300)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = bpe.decode(bpe.encode(docs, TOKENS, public_tokenizers.PATTERN), TOKENS)
    for r in out.collect():
        assert r["ids"] == plain.encode_ordinary(texts[r["doc_id"]])
        assert bytes(r["bytes"]).decode() == texts[r["doc_id"]]
    digest = {r["doc_id"]: r for r in bpe.digests(out).collect()}
    ids = " ".join(map(str, plain.encode_ordinary(texts[1])))
    assert digest[1]["ids_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert bpe.encode(odd, TOKENS, public_tokenizers.PATTERN).count() == odd.count()
    assert bpe.encode(none, TOKENS, public_tokenizers.PATTERN).count() == 0


# secrets


def test_secret_scan_equals_regular_expressions(spark, odd, none):
    texts = [
        'password = "abcdef123"; token: zz', "token=token:abcdef api_key='0123456789'", "AKIA" + "A1" * 9 + " AKIA12",
        "0123456789abcdef01234567 and deadbeef", "é🙂 Secret:  'hidden/value=='", "PASSWD:short nothing", None,
        "ghp_" + "a" * 40 + " xoxb-1234567890-ab", "K = Kelvin toKen=abcdefg",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secretscan.scan(docs).collect()}
    for i, text in enumerate(texts):
        want = []
        for number, rule in enumerate(secretscan.BASE + secretscan.MORE):
            flags = re.A | (re.I if rule.ignore_case else 0)
            for m in re.finditer(rule.pattern, text or "", flags):
                if len(m[rule.part]) >= rule.least:
                    want.append((m.start(), number, rule.kind, m.end()))
        assert got[i] == [(k, a, b) for a, _, k, b in sorted(want)], text
    assert sum(map(len, got.values())) >= 8
    assert secretscan.scan(odd).count() == odd.count()
    assert secretscan.scan(none).count() == 0


def test_trigram_queries():
    query = {r.kind: secretscan.trigram_query(r) for r in secretscan.BASE}
    assert query["hex"] == secretscan.ALWAYS
    assert query["access"] == frozenset([frozenset(["aki", "kia"])])
    assert len(query["assign"]) == 6
    assert frozenset(["tok", "oke", "ken"]) in query["assign"]


# shards


def test_shards(spark, none):
    rng = random.Random(1)
    texts = ["w" * rng.randrange(1, 400) for _ in range(500)] + ["same text"] * 250
    rows = [(i, t, rng.choice("ab"), rng.choice("xyz")) for i, t in enumerate(texts)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 6).collect()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in out:
        assert r["size"] == len(texts[r["doc_id"]]) + 8
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(out) == len(texts) and sorted(sizes) == list(range(6))
    assert max(sizes.values()) - min(sizes.values()) < 1000
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(none).count() == 0


def test_shards_of_odd_rows(odd):
    out = sharding.shard(odd).collect()
    assert len(out) == odd.count()
    assert sum(r["size"] for r in out) == sum(8 + len(r["text"] or "") for r in odd.collect())


# top-k


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 12)) * rng.uniform(0.1, 4, (400, 1))
    x[50:90] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (None, [1.0] * 12), (3, x[3].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk.top_k(table, F.col("vec_id") % 20 == 0, 10).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    q = np.floor(x * 1024).astype(np.int64)
    for i in range(0, 400, 20):
        s = q @ q[i]
        ids = np.append(np.arange(400), 3)  # id 3 has two rows, both of them candidates
        s = np.append(s, s[3])
        want = [(ids[j], s[j]) for j in np.lexsort((ids, -s)) if ids[j] != i][:10]
        assert got[i] == want
    assert sorted(got) == list(range(0, 400, 20))
    assert topk.top_k(table.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    few = topk.top_k(table.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 20 == 0).collect()
    assert len(few) == 2


def plain_top_k(rows, is_query, k):
    """By definition: each row with every other, ties to the smaller id."""
    out = []
    for a, (i, v) in enumerate(rows):
        if is_query(i):
            s = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(rows) if a != b)
            out += [(i, rank + 1, j, -minus) for rank, (minus, j) in enumerate(s[:k])]
    return sorted(out)


def test_top_k_in_many_bands_and_rounds(spark):
    """Bounds go from round to round; spread lengths let them rule out nearly all scores."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((3000, 8)) * np.exp(rng.standard_normal((3000, 1)) * 1.5)
    x[1000:1700] = x[1000]  # a crowd of one length is cut into parts
    ints = [(i, np.floor(v * 1024).astype(np.int64).tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    count = spark.sparkContext.accumulator(0)
    got = topk.top_k(table, F.col("vec_id") % 100 == 0, 10, block=64, worked_out=count).collect()
    assert sorted(map(tuple, got)) == plain_top_k(ints, lambda i: i % 100 == 0, 10)
    assert count.value < 0.1 * 30 * 3000
    assert topk._rounds({0: 1, 1: 1, 2: 6, 3: 100}) == [[0, 1], [2, 3]]


def test_top_k_of_odd_rows(spark):
    """Rows that repeat an id, vectors of other lengths and without components, clashing columns."""
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0]), (2, []), (2, [-1.0, 0.5, 4.0]), (100, [0.5, 0.5, 0.5, 0.5]), (100, [])]
    frame = spark.createDataFrame(
        [(i, v, 7, "x", 0.5) for i, v in rows], "vec_id long, embedding array<double>, row int, band string, norm double"
    )
    ints = [(i, [int(x * 1024) for x in v]) for i, v in rows]
    got = topk.top_k(frame, F.col("vec_id") % 100 == 0, 10).collect()
    assert sorted(map(tuple, got)) == plain_top_k(ints, lambda i: i % 100 == 0, 10)
    hollow = spark.createDataFrame([(0, []), (5, [])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(hollow, F.col("vec_id") == 0).collect()] == [(0, 1, 5, 0)]


# lines


def kept_lines(docs, least):
    """The definition, place by place."""
    lines = {d: t.split("\n") for d, t in docs}
    places = [(d, i) for d in sorted(lines) for i in range(len(lines[d])) if words(lines[d][i])]
    by_line, gone = defaultdict(list), defaultdict(set)
    for d, i in places:
        by_line[lines[d][i]].append((d, i))
    for d, i in places:
        best = 0
        for e, j in by_line[lines[d][i]]:
            if (e, j) >= (d, i):
                break
            n = 0
            while i + n < len(lines[d]) and j + n < len(lines[e]) and lines[d][i + n] == lines[e][j + n] and words(lines[d][i + n]):
                n += 1
            best = max(best, n)
        if best and sum(len(words(x)) for x in lines[d][i : i + best]) >= least:
            gone[d] |= set(range(i, i + best))
    return {d: "\n".join(x for i, x in enumerate(own) if i not in gone[d]) for d, own in lines.items()}


def test_line_dedup_equals_the_definition(spark):
    rng = random.Random(1)
    lines = ["a b c", "d e", "f", "g h i j", "k l m n o", "", "x"]
    docs = []
    for d in range(50):
        text = [rng.choice(lines) for _ in range(rng.randrange(0, 12))]
        if docs and rng.random() < 0.4:
            text += rng.choice(docs)[1].split("\n")
        docs.append((d, "\n".join(text)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.dedup(table, 6).collect()}
    assert got == kept_lines(docs, 6)


def test_line_dedup_of_odd_rows(odd, none):
    out = linededup.dedup(odd, 2)
    assert out.columns == [*odd.columns, "removed"]
    rows = out.collect()
    assert len(rows) == odd.count()
    assert [r["text"] for r in rows if r["doc_id"] == 2] == [None]
    assert {r["text"] for r in rows if r["doc_id"] == 1} == {"same line"}
    assert linededup.dedup(none).count() == 0


def kept_over_blank(docs, least):
    """The definition on lines with words only; blank lines inside a run go with it."""
    out = {}
    own = {d: [(i, x) for i, x in enumerate(t.split("\n")) if words(x)] for d, t in docs}
    places = [(d, i) for d in sorted(own) for i in range(len(own[d]))]
    for d, t in docs:
        gone, x = set(), own[d]
        for i in range(len(x)):
            best = 0
            for e, j in places:
                if (e, j) >= (d, i):
                    break
                n = 0
                while i + n < len(x) and j + n < len(own[e]) and x[i + n][1] == own[e][j + n][1]:
                    n += 1
                best = max(best, n)
            if best and sum(len(words(y)) for _, y in x[i : i + best]) >= least:
                gone |= set(range(x[i][0], x[i + best - 1][0] + 1))
        out[d] = "\n".join(y for i, y in enumerate(t.split("\n")) if i not in gone)
    return out


def test_line_dedup_over_blank_lines(spark):
    rng = random.Random(4)
    lines = ["a b c", "d e", "f", "g h i j", "k l m n o", "", " \t", "x"]
    docs = []
    for d in range(40):
        text = [rng.choice(lines) for _ in range(rng.randrange(0, 12))]
        if docs and rng.random() < 0.4:
            text += rng.choice(docs)[1].split("\n")
        docs.append((d, "\n".join(text)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.dedup(table, 6, over_blank=True).collect()}
    assert got == kept_over_blank(docs, 6)


def test_ranks_of_one_line_with_many_successors(spark):
    """The ranks by two lines do not depend on how the successors of a line are dealt to ranges."""
    rng = random.Random(12)
    places = []
    for text in range(150):  # line 0, then one of 40 lines, then line 0 again
        places += [(text, 0, 0, 0), (text, 0, 1, 1000 + rng.randrange(40) * 7), (text, 0, 2, 0)]
    frame = spark.createDataFrame(places, "did long, k long, pos int, r long")
    after = {(t, p): r for t, _, p, r in places}
    pairs = {(t, p): (r, after[t, p + 1]) for (t, p), r in after.items() if (t, p + 1) in after}
    order = sorted(pairs.values())
    want = {}
    for place, pair in pairs.items():
        if order.count(pair) > 1:
            mine = [q for q in order if q[0] == pair[0]]
            want[place] = pair[0] + mine.index(pair)
    for beyond in (0, 3, 6, 40):
        got = linededup.doubled(frame, 1, beyond).collect()
        assert {(r["did"], r["pos"]): r["r"] for r in got} == want


def test_op7_removes_a_passage_of_paragraphs(spark, tmp_path):
    rows = [[" ".join(f"p{k}w{i}" for i in range(30)), ""] for k in range(3)]
    passage = "\n".join(x for row in rows for x in row)  # 90 words, none of its lines has 50
    docs = [(d, f"first of {d}\n\n{passage}\nlast of {d}") for d in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["removed"], r["text"]) for r in queries.op7_line_dedup(spark, str(tmp_path)).collect()}
    assert got.pop(0) == (0, docs[0][1])
    assert got == {d: (5, f"first of {d}\n\n\nlast of {d}") for d in range(1, 20)}
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_chars", F.char_length("text"))
    texts = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, table, "").collect()}
    assert "p0w0" in texts[0] and not any("p0w0" in texts[d] for d in range(1, 20))


# Jaccard join


def linked(docs):
    sets = {}
    for d, t in docs:
        w = words(t)
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    least = {d: d for d in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                least[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_jaccard_join_equals_all_pairs(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(0, 30))) for _ in range(30)]
    docs = [(0, None), (1, ""), (2, " \n")]
    for i in range(3, 200):
        w = rng.choice(base).split(" ")
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = rng.choice("abcdefgxyz")
        docs.append((i, rng.choice([" ".join(w), "\n".join(w).upper(), "  ".join(w)])))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(table).collect()}
    assert got == linked(docs)


def test_jaccard_join_keeps_links_beside_near_misses(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    texts = []
    for i in range(120):  # copies, near copies and near misses that share their odd passages
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(90)] = f"x{rng.randrange(12)}"
        if i % 3 == 0:
            at, odd = rng.randrange(60), rng.randrange(3)
            words[at : at + 14] = [f"odd{odd}_{j}" for j in range(14 + rng.randrange(8))]
        texts.append(" ".join(words))
    docs = list(enumerate(texts))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(table).collect()}
    assert 10 < len({c for _, c in got.values()}) < 110
    assert got == linked(docs)


def test_jaccard_join_of_a_table_united_with_itself(spark):
    rng = random.Random(7)
    base = [" ".join(rng.choice("abcdefghij") for _ in range(30)) for _ in range(12)]
    docs = [(i, base[i % 12] + " z" * (i % 5)) for i in range(40)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3, "doc_id")
    one = spark.createDataFrame([(77, "seven words that only one row has")], "doc_id long, text string").coalesce(1)
    got = jaccard.join(table.union(table).union(one).union(one).union(one)).collect()
    want = linked([*docs, (77, "seven words that only one row has")])
    assert len(got) == 41
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_jaccard_join_of_odd_rows(odd, none):
    assert sorted(r["doc_id"] for r in jaccard.join(odd).collect()) == [1, 2, 3, 4, 5]
    assert jaccard.join(none).count() == 0
    assert jaccard.unique(odd).columns == odd.columns


def test_a_document_of_very_many_shingles(spark):
    """More of them in one bucket than 16 bits count."""
    long_ = " ".join(f"w{i}" for i in range(1_200_000))
    docs = [(1, long_), (2, long_ + " end"), (3, "a few words of their own")]
    got = {tuple(r) for r in jaccard.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {(1, 1_199_996, 1), (2, 1_199_997, 1), (3, 2, 3)}


def test_counts_travel_by_slice_and_bucket(spark):
    """What the buckets send back is one row a slice, however many documents it has."""
    docs = spark.createDataFrame([(i, f"the same words in every text {i % 7}") for i in range(4000)], "doc_id long, text string")
    rows = jaccard.described(docs.repartition(3))
    assert rows.count() == 4000 and rows.where("common < 3").count() == 0
    assert rows.agg(F.count_distinct("n", "d1", "d2")).first()[0] == 7


def test_unique_goes_by_the_text_of_each_row(spark):
    a, b, c = ("some words that make up text " + x * 9 for x in ("a ", "b ", "c "))
    rows = [(1, a), (2, a), (2, b), (3, b), (4, c), (4, ""), (5, None), (None, a), (4, c)]
    got = jaccard.unique(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(1, a), (2, b), (4, c), (4, ""), (5, None), (None, a), (4, c)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


# benchmark passages


def semi_global(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_align_equals_the_recurrence():
    rng = random.Random(2)
    for _ in range(200):
        a = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 12)))
        b = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 25)))
        edits, start, end = decontaminate.align(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8))
        assert edits == semi_global(a, b) and 0 <= start <= end <= len(b)


HAN = [chr(0x4E00 + 7 * i) for i in range(600)]
KINDS = {
    "prose": lambda rng, n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))[:n],
    "without spaces": lambda rng, n: "".join(rng.choice(HAN) for _ in range(n // 3)),
    "one long token": lambda rng, n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n)),
}


@pytest.mark.parametrize("kind", sorted(KINDS))
@pytest.mark.parametrize("size", [66, 124, 180, 380])
def test_recall_by_kind_of_text(kind, size):
    """Items copied into running text, with random edits: exact ones are all found."""
    rng = random.Random(size)
    make = KINDS[kind]
    items = [make(rng, size) for _ in range(40)]
    wanted = decontaminate.views([x.encode() for x in items])

    def edited(text, share):
        out = list(text)
        for _ in range(int(share * len(text))):
            at, how = rng.randrange(len(out)), rng.randrange(3)
            if how == 0:
                out[at] = rng.choice(text)
            elif how == 1:
                out.insert(at, rng.choice(text))
            else:
                del out[at]
        return "".join(out)

    for share in (0, 0.05, 0.1, 0.15, 0.2):
        texts = [(make(rng, 200) + edited(x, share) + make(rng, 200)).encode() for x in items]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        found = {(row, item) for row, item, *_ in decontaminate._matches(data, offsets, wanted, 0.2)}
        assert sum((k, k) in found for k in range(40)) >= (40 if share == 0 else 38)
        assert all(a == b for a, b in found)


def test_copies_whose_spaces_were_removed_are_found():
    rng = random.Random(4)
    items = [KINDS["prose"](rng, 120) for _ in range(30)]
    wanted = decontaminate.views([x.encode() for x in items])
    texts = [f"{KINDS['prose'](rng, 90)} {x.replace(' ', '')} {KINDS['prose'](rng, 90)}".encode() for x in items]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = {(row, item) for row, item, *_ in decontaminate._matches(np.frombuffer(b"".join(texts), np.uint8), offsets, wanted, 0.2)}
    near = {k for k, x in enumerate(items) if x.count(" ") <= 0.18 * len(x)}
    assert len(near) > 15 and sum((k, k) in found for k in near) >= 0.9 * len(near)


def test_benchmarks_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    rng = random.Random(8)
    items = [(i, KINDS["prose"](rng, 150)) for i in range(12)]
    docs = [(i, f"{KINDS['prose'](rng, 60)} {x}") for i, x in items] + [(99, KINDS["prose"](rng, 300))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.leaks(table, bench).collect()}
    assert got == {(i, i, 0) for i in range(12)}
    assert [r["doc_id"] for r in decontaminate.clean(table, bench).collect()] == [99]


def test_leaks_are_found_and_clean_texts_left(spark, odd, none):
    rng = random.Random(6)
    voc = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choices(voc, k=n))

    items = [(i, prose(40)) for i in range(20)] + [(20, None), (21, " "), (None, "no id at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1000 + i, prose(120)) for i in range(40)]
    for i in range(20):
        w = items[i][1].split(" ")
        w[7], w[30] = "zzz", "yyyy"
        docs += [(i, f"{prose(30)}\n{items[i][1].upper()} {prose(30)}"), (100 + i, f"{prose(9)} {' '.join(w)}")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(table, bench).collect()}
    assert got == {(i, i) for i in range(20)} | {(100 + i, i) for i in range(20)}
    assert sorted(r["doc_id"] for r in decontaminate.clean(table, bench).collect()) == list(range(1000, 1040))
    assert decontaminate.leaks(odd, bench).count() == 0
    assert decontaminate.clean(odd, bench).count() == odd.count()
    assert decontaminate.leaks(none, bench).count() == 0
    assert decontaminate.leaks(table, bench.where("false")).count() == 0


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at, c = rng.randrange(len(out)), rng.choice("abcdefghijklmnopqrstuvwxyz ")
        out[at : at + rng.choice([0, 1, 1])] = rng.choice([[c], [c], []])
    return "".join(out)


def test_leaks_reach_the_target_recall(spark):
    rng = random.Random(12)
    voc = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    sizes = {66: 40, 100: 40, 240: 30}
    items, docs = [], []
    for size, many in sizes.items():
        for _ in range(many):
            items.append((len(items), " ".join(rng.choices(voc, k=size))[:size]))
            for percent in (5, 10, 15, 20):
                copy = edited(rng, items[-1][1], size * percent // 100)
                docs.append((len(items) * 100 + percent, f"Some {rng.choice(voc)} before {copy} {rng.choice(voc)} after."))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.leaks(table, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    texts = dict(docs)
    for size in sizes:
        for percent in (5, 10, 15, 20):
            own = [(i, d) for i, t in items if len(t) == size for d in [(i + 1) * 100 + percent]]
            near = [
                (d, i) for i, d in own
                if semi_global(items[i][1].encode(), texts[d].lower().encode()) <= int(decontaminate.SHARE * size)
            ]
            assert near and sum(pair in got for pair in near) >= decontaminate.TARGET * len(near), (size, percent)


def test_short_items_are_found_wherever_they_are(spark):
    rng = random.Random(13)
    items = [(n, "".join(rng.choice("abcdefghijklmnop") for _ in range(n))) for n in range(10, 71, 3)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = []
    for n, x in items:
        docs += [(n, f"ZZ YY {x} XX WW"), (100 + n, f"{'QRS TUV ' * 60}{x}"), (200 + n, x), (300 + n, f"ZZ {edited(rng, x, n // 5)} WW")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for parts in (1, 3):
        got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(table.repartition(parts), bench).collect()}
        for n, _ in items:
            assert [got[d, n]["edits"] for d in (n, 100 + n, 200 + n)] == [0, 0, 0]
            assert (got[100 + n, n]["start"], got[100 + n, n]["stop"]) == (480, 480 + n)
            assert n > decontaminate.WORD or (300 + n, n) in got
    assert decontaminate.clean(table, bench).where("doc_id < 300").count() == 0


def test_walks_by_two_steps_equal_those_by_one():
    rng = np.random.default_rng(3)
    n, reach = 500, decontaminate.REACH
    data = np.concatenate([rng.integers(0, 256, n, np.uint8), np.zeros(reach, np.uint8)])
    data[100:200] = np.resize(np.frombuffer(b"ab", np.uint8), 100)  # many equal keys
    starts = np.arange(n)
    for walk, steps, places in [(w, p[2], p[3]) for p in decontaminate.PLANS for w in range(p[1])]:
        chosen = rng.choice(steps, places, replace=False)
        words = np.zeros(-(-reach // decontaminate.HELD), np.uint64)
        for s in chosen.tolist():
            words[s // decontaminate.HELD] |= np.uint64(255 << 8 * (s % decontaminate.HELD))
        keys = decontaminate._walk(decontaminate._pairs(data), starts, decontaminate._strides(11, walk), [words])[0]
        wanted = []
        for at in starts.tolist():
            written = []
            for s in range(steps):
                written.append(int(data[at]))
                at += int(decontaminate._bits(11)[walk, s, data[at]])
            wanted.append(tuple(written[s] for s in chosen))
        assert len(set(zip(wanted, keys.tolist()))) == len(set(wanted)) == len(set(keys.tolist()))


def test_glances_lose_no_near_piece_and_refute_most_others(monkeypatch):
    rng = random.Random(15)
    voc = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 5))) for _ in range(60)]
    items = [" ".join(rng.choices(voc, k=60))[:n] for n in range(66, 130, 2)]
    texts = [" ".join(rng.choices(voc, k=300)) for _ in range(200)]
    texts += [f"{texts[i]} {edited(rng, x, n)} {texts[-i]}" for i, x in enumerate(items) for n in range(0, len(x) // 4, 3)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    glances, exact, true_least = [], [], decontaminate.least_edits

    def all_of(data, low, high, masks, which, size, most):
        got = decontaminate.may_be_near(data, low, high, masks, which, size, most)
        near = true_least(data, low, high, masks, which, size) <= most
        assert not (near & ~got).any()
        glances.append(len(low))
        lanes = np.flatnonzero(got)
        exact.append(len(lanes))
        return np.flatnonzero(near), None

    def counted(data, low, *rest):
        exact.append(len(low))
        return true_least(data, low, *rest)

    wanted = decontaminate.views([x.encode() for x in items])
    with monkeypatch.context() as m:
        m.setattr(decontaminate, "near_lanes", all_of)
        whole = sorted(decontaminate._matches(data, offsets, wanted, 0.2))
    compared, seen = sum(glances), sum(exact)
    exact.clear()
    monkeypatch.setattr(decontaminate, "least_edits", counted)
    assert sorted(decontaminate._matches(data, offsets, wanted, 0.2)) == whole
    assert len(whole) > 100 and compared > 5000
    assert sum(exact) == seen < 0.3 * compared


# language model


def test_language_model(spark, odd, none):
    docs = [(i, t) for i, t in enumerate(["a b a", "b a c", "", None, "A b", "c c c d", "a b c", "zz a"] * 3)]
    out = {r["doc_id"]: r for r in kneserney.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    tokens = {i: [*words(t), "</s>"] for i, t in docs}
    counts = defaultdict(int)
    for i in tokens:
        if not held(i, 7, 2):
            for w in tokens[i]:
                counts[w] += 1
    n = sum(counts.values())
    for i, own in tokens.items():
        base = sum(np.log10((counts.get(w, 0) + 1) / (n + len(counts) + 1)) for w in own)
        r = out[i]
        assert (r["n_tokens"], r["train_tokens"], r["held_out"]) == (len(own), n, held(i, 7, 2))
        assert r["n_known"] == sum(w in counts for w in own)
        assert abs(r["base_score"] - base) < 1e-9 and r["score"] < 0
    assert kneserney.score(odd).count() == odd.count()
    assert kneserney.score(none).count() == 0


def plain_kneser_ney(training, texts):
    """log10 probabilities of texts, from dictionaries."""
    sequences = [["<s>", *words(t), "</s>"] for t in training]
    pairs, counts = defaultdict(int), defaultdict(int)
    for q in sequences:
        for v, w in zip(q, q[1:], strict=False):
            pairs[v, w] += 1
            counts[w] += 1
    near, after = defaultdict(int), defaultdict(list)
    for (v, w), c in pairs.items():
        near[w] += 1
        after[v].append(c)

    def discounts(values):
        n = [max(sum(x == k for x in values), 1) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [0, 1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        return [min(max(x, lo), hi) for x, lo, hi in zip(raw, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.95, 2.95], strict=True)]

    d, e = discounts(pairs.values()), discounts(near.values())
    total = sum(near.values())
    spare = sum(e[min(c, 3)] for c in near.values()) / total

    def lower(w):
        return max(near[w] - e[min(near[w], 3)], 0) / total + spare / (len(counts) + 1) if w in near else spare / (len(counts) + 1)

    out = []
    for t in texts:
        q, value = ["<s>", *words(t), "</s>"], 0.0
        for v, w in zip(q, q[1:], strict=False):
            p = lower(w)
            if v in after:
                c = pairs.get((v, w), 0)
                p = max(c - d[min(c, 3)], 0) / sum(after[v]) + sum(d[min(x, 3)] for x in after[v]) / sum(after[v]) * p
            value += np.log10(p)
        out.append(value)
    return out


def test_language_model_scores_equal_plain_ones(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("the a cat dog sat ran on under mat tree".split()) for _ in range(rng.randrange(25))) for _ in range(150)]
    texts += [f"word{i} only here {rng.random()}" for i in range(20)]
    docs = list(enumerate(texts))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = plain_kneser_ney([t for i, t in docs if not held(i, 7, 2)], texts)
    for r in kneserney.score(table).collect():
        assert abs(r["score"] - want[r["doc_id"]]) < 1e-9


def test_language_model_of_many_equal_upper_bits(tmp_path):
    """Pairs whose hashes agree in their upper half are all found."""
    n = 9
    for name, array in (
        ("pairs", np.full(n, 5, np.uint32)), ("rest", np.arange(n, dtype=np.uint8)),
        ("small", np.arange(1, n + 1, dtype=np.uint8)), ("big", np.zeros(0, np.int64)),
    ):
        array.tofile(tmp_path / f"{name}-0")
    np.zeros(0, np.uint64).tofile(tmp_path / "words-0")
    np.zeros(0, np.int64).tofile(tmp_path / "counts-0")
    facts = {"sizes": [0], "bits": 1, "pairs": [0], "blocks": [], "n_words": 0, "hot": np.zeros(0, np.int64)}
    model = kneserney.Model(str(tmp_path), facts)
    hashes = np.array([5 << 8 | k for k in range(n)], np.uint64) << np.uint64(24)
    kept = kneserney._pair_hash, kneserney.mix
    try:
        kneserney._pair_hash = lambda left, right: hashes[left]
        kneserney.mix = lambda x: x * np.uint64(0)
        got = model.pair_counts(np.arange(n), np.zeros(n, np.int64))
    finally:
        kneserney._pair_hash, kneserney.mix = kept
    assert got.tolist() == list(range(1, n + 1))


def test_language_model_files_must_be_seen(tmp_path):
    (tmp_path / "here").write_text("")
    kneserney._there(str(tmp_path), ["here"])
    with pytest.raises(FileNotFoundError, match="not shared"):
        kneserney._there(str(tmp_path), ["here", "elsewhere"])


# classifiers


def test_quality_on_held_out_rows(spark, odd, none):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(40))
        rows.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = quality.decided(quality.score(docs, known), 0.5).collect()
    assert all(r["held_out"] == held(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 for r in scored)
    assert all(r["predicted"] == labels[r["doc_id"]][1] for r in scored if r["held_out"])
    assert {r["doc_id"] for r in quality.accepted(docs, known).collect()} == {i for i, q, _ in labels if q}
    assert quality.score(odd, known).count() == odd.count()
    assert quality.score(none, known).count() == 0
    assert {r["score"] for r in quality.score(docs, known.where("false")).collect()} == {0.5}


def test_isotonic():
    assert quality.isotonic(np.ones(4), np.array([0.0, 1.0, 0.0, 2.0])).tolist() == [0.0, 0.5, 0.5, 2.0]


def test_toxicity_on_held_out_and_altered_words(spark, odd, none):
    rng = random.Random(9)
    voc = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeou") for _ in range(rng.randrange(1, 4))) for _ in range(200)]
    bad = ["wicked", "vixible"]
    rows, labels = [], []
    for i in range(500):
        w = rng.choices(voc, k=30)
        toxic = rng.random() < 0.3
        if toxic:
            w[rng.randrange(30)] = rng.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    rows += [(9000, f"{' '.join(voc[:9])} wic-ked"), (9001, f"{' '.join(voc[:9])} w i c k e d"), (9002, f"{voc[3]} wicqked")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = quality.decided(toxicity.score(docs, known), 0.7).collect()
    assert all(r["predicted"] == labels[r["doc_id"]][2] for r in scored if r["doc_id"] < 9000 and r["held_out"])
    assert all(r["predicted"] == 1 for r in scored if r["doc_id"] >= 9000)
    assert toxicity.score(odd, known).count() == odd.count()
    assert toxicity.score(none, known).count() == 0
    assert {r["score"] for r in toxicity.score(docs, known.where("false")).collect()} == {0.0}


def test_toxicity_ranks_by_few_labels(spark):
    rng = random.Random(10)
    voc = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeou") for _ in range(rng.randrange(2, 4))) for _ in range(60)]
    rows, toxic = [], set()
    for i in range(300):
        w = rng.choices(voc, k=30)
        if i % 9 == 0:
            toxic.add(i)
            w[rng.randrange(30)] = "vixible"
        rows.append((i, " ".join(w)))
    train = [i for i, _ in rows if not held(i, 3, 1)]
    few = [i for i in train if i in toxic][:3] + [i for i in train if i not in toxic][:23]
    known = spark.createDataFrame([(i, 1, int(i in toxic)) for i in few], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, known).collect() if r["doc_id"] not in few}
    pairs = [(scores[a], scores[b]) for a in scores if a in toxic for b in scores if b not in toxic]
    assert sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs) > 0.8
