"""Registered queries and the pipeline on the smallest tables, against SQL or plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from comptoir.llm import decontam, suite

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def texts(db):
    return dict(db.sql("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(suite.O))
def test_query_matches_sql(spark, db, name):
    df = suite.Q[name](spark, SF)
    want = db.sql(suite.O[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    rows = Counter(tuple(r[k] for k in cols) for r in df.collect())
    assert rows == Counter(tuple(r[want.columns.index(k)] for k in cols) for r in want.fetchall())


# -- plain versions ------------------------------------------------------------


def pieces(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = set()
    for i, text in texts.items():
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            out.add((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def check_packed(rows, texts):
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == pieces(texts) and len(rows) == len(pieces(texts))
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert [a for a, _ in b] == np.cumsum([0] + [n for _, n in b[:-1]]).tolist() and sum(n for _, n in b) <= 1024
    assert len(bins) <= 1.05 * sum(r.length for r in rows) / 1024 + 1


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def components(texts):
    fp = {i: fingerprint(t) for i, t in texts.items()}
    name = {i: i for i in fp}
    changed = True
    while changed:
        changed = False
        for a in fp:
            for b in fp:
                if name[a] < name[b] and (fp[a] ^ fp[b]).bit_count() <= 2:
                    name[b], changed = name[a], True
    return fp, name


def leaks(texts, items):
    """(document, item) -> least edits, within 15 % of the item, by comparing every item with every text."""
    out = {}
    split = {i: decontam.words(t) for i, t in texts.items()}
    for k, t in items.items():
        w = decontam.words(t)
        number = {x: n for n, x in enumerate(dict.fromkeys(w))}
        item = np.array([number[x] for x in w])
        for i, d in split.items():
            seq = np.array([number.get(x, -1) for x in d], np.int64)
            if len(seq) and np.isin(seq, item).sum() >= 0.5 * len(item):
                edits = decontam.fit_distance(item, seq)[0]
                if edits <= int(0.15 * len(item)):
                    out[i, k] = edits
    return out


def test_packing_query(spark, texts):
    check_packed(suite.op1_best_fit_packing(spark, SF).collect(), texts)


def test_simhash_query(spark, texts):
    fp, name = components(texts)
    got = suite.op9_simhash(spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fp[i]:016x}", name[i]) for i in fp}


def test_decontamination_query(spark, db, texts):
    want = leaks(texts, dict(db.sql("SELECT item_id, text FROM benchmark").fetchall()))
    got = {(r.doc_id, r.item_id): r.edits for r in suite.op3_decontamination(spark, SF).collect()}
    assert want and got.items() <= want.items() and len(got) >= 0.97 * len(want)
    assert {k for k, e in want.items() if e == 0} <= set(got)


def test_sharding_query(spark, texts):
    got = suite.op12_sharding(spark, SF).collect()
    assert {(r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in got} == {
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "rows", None) for i, t in texts.items()}
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    where = defaultdict(set)
    for r in got:
        where[texts[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    lang = suite.op7_language_id(spark, "/root/testdata/sf0.01").where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in lang) >= 0.97 * len(lang)
    good = suite.op6_quality_classifier(spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    assert sum(r.kept == bool(r.quality) for r in good) >= 0.97 * len(good)
    toxic = suite.op5_toxicity(spark, "/root/testdata/sf0.01").where("held_out").join(labels, "doc_id").collect()
    clean = [r for r in toxic if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    found = [r.score for r in toxic if r.toxic == 1]
    assert np.mean(found) > 3 * np.mean([r.score for r in clean])


def test_pipeline_stages_match_plain_versions(spark, db, texts):
    """Each stage on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for _, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, SF), "test-stage")
        out.append(docs.collect())
    assert all(d[0].asDict().keys() == spark.read.parquet(f"{SF}/documents.parquet").first().asDict().keys() for d in out[:4])
    kept = {i: texts[i] for i, k in db.sql(f"SELECT doc_id, kept FROM ({suite.O['op8_quality_rules']}) x").fetchall() if k}
    assert {r.doc_id: r.text for r in out[0]} == kept and len(kept) > 0.5 * len(texts)
    _, name = components(kept)
    single = {i: t for i, t in kept.items() if name[i] == i}
    assert {r.doc_id: r.text for r in out[1]} == single
    leaky = leaks(single, dict(db.sql("SELECT item_id, text FROM benchmark").fetchall()))
    clean = {r.doc_id: r.text for r in out[2]}
    assert clean.items() <= single.items() and set(single) - set(clean) <= {i for i, _ in leaky} and {i for (i, _), e in leaky.items() if e == 0}.isdisjoint(clean)
    private = {r.doc_id: r.text for r in out[3]}
    of = {r.doc_id: r for r in suite.op10_pii(spark, SF).collect()}
    assert private == {i: of[i].text for i in clean} and any(private[i] != clean[i] for i in clean)
    assert all((private[i] != clean[i]) == bool(of[i].pii) for i in clean)
    check_packed(out[4], private)


def test_stages_of_an_empty_table_and_odd_rows(spark):
    """Null, empty and repeated rows, null ids and an empty table pass through all stages."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    good = "the cat and the dog sat on the mat with a big red ball that was in the house by the old river bank near a mill"
    rows = [(1, good, "en", "s", 3), (1, good, "en", "s", 3), (2, None, None, None, None), (3, "", "en", "s", 0), (None, good + " and more of it to read", "en", "s", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, step in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(step(spark, docs, SF), "edge-stage")
        assert {r.doc_id for r in docs.collect()} == ({1, None} if data else set())
