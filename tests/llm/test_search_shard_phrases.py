"""Ranked search, sharding and phrase collocations: edge rows and brute-force versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from comptoir.llm import colloc, search, sharding

CLASH = ("score string", "rank int", "item int", "term string", "link string", "row int", "start string", "n int", "phrase int", "ids string")


def table(spark, rows, schema):
    d = spark.createDataFrame(rows, schema)
    for c in CLASH:
        name, kind = c.split()
        d = d.withColumn(name, F.lit(7).cast(kind))
    return d


# -- ranked search -----------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def tokens(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute_search(docs, items, top):
    held = [(i, Counter(tokens(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_all, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 25 + (75 * sum(c.values()) * n_all) // length
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in tokens(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i if i is not None else 0))
        for k, (s, none, i) in enumerate(sorted(scored)[:top]):
            out.append((item, k + 1, None if none else i, -s))
    return sorted(out, key=str)


def search_rows(spark, docs, items, top=10):
    index = search.Index.build(table(spark, docs, "doc_id long, text string"))
    got = search.search(index, table(spark, items, "item_id long, text string"), top).collect()
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got), key=str)


def test_search_matches_brute_force(spark):
    r = random.Random(5)
    vocabulary = ["the", "Of", "été", "a1", "x", "gamma", "日本", "zeta", "Zeta", "b-c", "q_r"] + [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 3, 20, 20, 200])))) for i in range(300)]
    docs += [(1000 + i, "gamma zeta the the the") for i in range(40)]  # copies tie, by id
    docs += [(7, "gamma"), (7, "gamma"), (None, "gamma zeta"), (8, None), (9, ""), (10, " .,;\n"), (11, "long w1 " * 40_000)]
    items = [(0, "gamma zeta"), (1, "the the of W1"), (2, None), (3, ""), (4, "unheard of words"), (4, "gamma, gamma; x"), (None, "日本 été"), (5, "unheard")]
    assert search_rows(spark, docs, items) == brute_search(docs, items, 10)
    assert search_rows(spark, docs, items, 3) == brute_search(docs, items, 3)


def test_search_in_groups_of_queries(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_TERMS", 3)
    docs = [(i, f"a b{i % 3} c{i}") for i in range(20)]
    items = [(i, f"b{i % 3} c{i} a") for i in range(6)]
    assert search_rows(spark, docs, items) == brute_search(docs, items, 10)


def test_search_empty_tables(spark):
    assert search_rows(spark, [], [(1, "a")]) == [] and search_rows(spark, [(1, "a")], []) == []
    assert search_rows(spark, [(1, None), (2, "...")], [(1, "a")]) == []


def test_bounds_are_never_below_scores():
    r = np.random.default_rng(3)
    docs = [Counter({f"t{w}".encode(): int(r.integers(1, 40)) for w in r.integers(0, 300, 30)}) for _ in range(90)]
    o = search._Open()
    for i, c in enumerate(docs):
        numbers = np.fromiter(c.values(), np.int32, len(c))
        o.add(i, c, numbers, int(np.frexp(numbers)[1].sum()))
    height, width, _, lengths, bits, *_ = search._close(o, {})
    words = [f"t{w}".encode() for w in range(0, 300, 5)]
    m = 25 + lengths
    asked = search._Asked(words, np.full(len(words), 1234.0), np.array([search.places(w) for w in words], np.uint64), [], np.zeros(0))
    bound = search._bounds(asked, height, width, len(docs), np.frombuffer(bits, np.uint8), m) * search.SLACK
    for d, c in enumerate(docs):
        for k, w in enumerate(words):
            if c[w]:
                assert bound[k, d] >= 1234 * ((10**9 * c[w]) // (1000 * c[w] + 8 * int(m[d])))
    missed = [(k, d) for d, c in enumerate(docs) for k, w in enumerate(words) if not c[w]]
    assert sum(bound[k, d] > 0 for k, d in missed) < 0.1 * len(missed)


# -- sharding ----------------------------------------------------------------


def check_shards(spark, rows, shards, **more):
    out = sharding.shard(table(spark, rows, "doc_id long, text string"), shards, **more).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards))
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    return out


def test_shards_are_even_and_keep_copies_together(spark):
    r = random.Random(2)
    rows = [(i, f"single {i}") for i in range(700)] + [(1000 + i, f"group {i % 90}") for i in range(400)]
    rows += [(3000 + i, "thirty") for i in range(30)] + [(5000, None), (5001, ""), (5002, None), (None, "x"), (None, "x"), (5, "single 5"), (5006, "long " * 50_000)]
    r.shuffle(rows)
    out = check_shards(spark, rows, 8)
    where = defaultdict(set)
    text = dict(rows)
    for x in out:
        if x.doc_id is not None and x.doc_id != 5:
            where[text[x.doc_id] or ""].add(x.shard)
    assert not [t for t, s in where.items() if len(s) > 1]


def test_shards_with_a_hot_group_and_nothing_else(spark):
    rows = [(i, "copy") for i in range(500)] + [(i, f"other {i // 2}") for i in range(500, 1000)]
    out = check_shards(spark, rows, 10)
    where = defaultdict(set)
    for x in out:
        if x.doc_id >= 500:
            where[x.doc_id // 2].add(x.shard)
    assert sum(len(s) == 1 for s in where.values()) >= 0.7 * len(where)  # by chance it would be a tenth
    assert len({x.shard for x in out if x.doc_id < 500}) < 10
    check_shards(spark, [(i, "copy") for i in range(103)], 10)


@pytest.mark.parametrize("n", [0, 1, 5, 24, 25])
def test_shards_of_few_rows(spark, n):
    check_shards(spark, [(i, f"t{i // 3}") for i in range(n)], 24)


def test_shards_by_another_link(spark):
    rows = [(i, f"text {i} of {i % 40}") for i in range(400)]
    out = check_shards(spark, rows, 4, link=F.regexp_extract("text", "of (.*)", 1))
    where = defaultdict(set)
    for x in out:
        where[x.doc_id % 40].add(x.shard)
    assert all(len(s) == 1 for s in where.values())


def test_ranks_are_gapless(spark):
    d = spark.range(2000).select("id", (F.col("id") % 3).alias("g"))
    got = sharding.ranked(d, ["g"], F.pmod(F.xxhash64("id"), F.lit(40)), ["id"]).collect()
    for g in range(3):
        assert sorted(r["rank"] for r in got if r.g == g) == list(range(sum(r.g == g for r in got)))


def test_quotas_never_overfill():
    r = random.Random(1)
    for _ in range(200):
        k = r.randint(2, 6)
        asked = {(i, j): r.randint(0, 50) for i in range(k) for j in range(k) if i != j}
        free = [r.randint(-5, 40) for _ in range(k)]
        q = sharding._quotas(asked, free)
        for j in range(k):
            inside = sum(n for (_, b), n in q.items() if b == j)
            outside = sum(n for (a, _), n in q.items() if a == j)
            swaps = sum(min(asked[i, j], asked[j, i]) for i in range(k) if i != j)
            assert inside - swaps <= max(0, free[j]) and outside >= swaps


# -- collocations ----------------------------------------------------------------


def brute_phrases(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 6):
                for i in range(len(ws) - k + 1):
                    f[lang][tuple(ws[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        often = {p: a for p, a in c.items() if a >= least}
        inside = defaultdict(int)
        for p, a in often.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(inside[p[i:i + size]], a)
        scored = []
        for p, a in often.items():
            if len(p) > 1 and inside[p] < a:
                score, k = min(((1000 * a * n[lang]) // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def phrase_rows(spark, rows, least, top=2000):
    got = colloc.collocations(table(spark, rows, "lang string, text string"), least, top).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r["n"], r.score) for r in got)


def test_collocations_match_brute_force(spark):
    r = random.Random(8)
    words = ["New", "york", "times", "of", "the", "état", "x y", "a\x00b", "new", "-"] + [f"w{i}" for i in range(12)]
    seps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!", "\r\n"]
    rows = [(r.choice(["en", "en", "fr", None]), "".join(r.choice(words) + r.choice(seps) for _ in range(r.randint(0, 60)))) for _ in range(150)]
    rows += [("en", "new york times square")] * 9 + [("en", None), ("de", ""), ("fr", " .. \n")] + [("xx", "the same words " * 3000)]
    assert phrase_rows(spark, rows, 5) == brute_phrases(rows, 5, 2000)
    assert phrase_rows(spark, rows, 3, 10) == brute_phrases(rows, 3, 10)
    assert phrase_rows(spark, [], 1) == [] and phrase_rows(spark, [("en", "one")], 2) == []


def test_pieces_and_chunks_cut_nothing(monkeypatch):
    monkeypatch.setattr(colloc, "CHUNK", 7)
    r = random.Random(4)
    texts = ["".join(r.choice(["a ", "b ", "cc\t", ". ", "\n", "D "]) for _ in range(r.randint(0, 40))) for _ in range(60)] + ["one two three " * 20]
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * len(texts)), pa.array([t.encode() for t in texts], pa.binary())], names=["lang", "data"])
    got, n = [], 0
    for b in colloc._chunks([batch]):
        c = b.to_pylist()[0]
        names = [b"\n", *c["words"]]
        got += [names[i] for i in np.frombuffer(c["stream"], np.int32)] + [b"\n"]
        n += c["n_words"]
        assert Counter(x for x in np.frombuffer(c["stream"], np.int32) if x) == Counter({i + 1: k for i, k in enumerate(c["counts"]) if k})

    def parts(words):
        out = [[]]
        for w in words:
            out.append([]) if w == b"\n" else out[-1].append(w)
        return [x for x in out if x]
    want = [w for t in texts for w in [*colloc.pieces(t.encode()), b"\n"]]
    assert parts(got) == parts(want) and n == sum(w != b"\n" for w in want)


@pytest.mark.parametrize(("n", "bits"), [(2, 1), (2, 7), (3, 21), (5, 13), (5, 25), (5, 30), (2, 40), (4, 33)])
def test_packed_phrases_come_back(n, bits):
    rng = np.random.default_rng(n * bits)
    ids = rng.integers(0, 1 << bits, (500, n))
    p = colloc.Packing(n, bits)
    packed = p.pack(ids)
    assert (p.unpack(packed) == ids).all()
    mixed = p.permute(packed)
    assert (p.restore(mixed) == packed).all() and (mixed <= p.mask).all()
    lanes, counts = colloc.tally(mixed, np.ones(len(mixed), np.int64))
    prefix = min(3, p.width)
    head = (lanes[:, 0] >> np.uint64(p.width - prefix)).astype(np.int64)
    assert int(counts.sum()) == 500 and len(lanes) == len({tuple(x) for x in ids.tolist()})
    for shard in np.unique(head):
        mine = head == shard
        big = counts[mine] * np.array([1, 127, 128, 1 << 40])[np.arange(mine.sum()) % 4]
        f = colloc.QuotientFilter.build(p, prefix, lanes[mine], big)
        back, numbers = f.read(int(shard))
        assert (back == lanes[mine]).all() and (numbers == big).all()


def test_filters_merge_like_counters():
    rng = np.random.default_rng(1)
    p = colloc.Packing(3, 6)
    total, filters = Counter(), []
    for _ in range(9):
        ids = rng.integers(0, 8, (rng.integers(1, 80), 3))
        total.update(map(tuple, ids.tolist()))
        lanes, counts = colloc.tally(p.permute(p.pack(ids)), np.ones(len(ids), np.int64))
        filters.append(colloc.QuotientFilter.build(p, 0, lanes, counts).read(0))
    lanes, counts = colloc.merge(filters)
    assert dict(zip(map(tuple, p.unpack(p.restore(lanes)).tolist()), counts.tolist(), strict=True)) == total
