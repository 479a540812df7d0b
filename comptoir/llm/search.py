"""Ranked lexical search over bit-sliced Bloom signatures.

Documents are kept in blocks of similar length. A block's signature is a bit
matrix with a column for each document: a term found in a document sets a few
rows of its column for each level of its number of occurrences (1, 2, 4, ...).
The rows of a term and level, combined by *and*, are a bitmap of the documents
that may hold the term so often. It overestimates and never misses one. With
the documents' lengths, the bitmaps of a query's terms, weighted, add up to an
upper bound of each document's score. Documents whose bound is below the best
scores found so far cannot be among the results; all others are rescored
exactly from the block's own list of terms and numbers of occurrences.

An index is made once and serves any queries: blocks, the number of documents
of each term, and totals, all written to the shared folder. A search first runs
over a small part of the blocks. The scores it finds bound the best ones from
below, so they only spare work in the search over all blocks. Queries are
answered in blocks of bounded size.

Null and empty texts hold no term; queries without a term found in a document
have no results. Null ids rank after others of equal score; rows that repeat an
id are documents of their own. Queries that repeat an id are answered each on
their own. Very long texts get wide signatures in blocks of their own. Empty
tables give empty results. Columns not named are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comptoir.llm._util import as_bytes, rows, stage

# In bytes: ASCII that is no letter or digit becomes a blank, A-Z lower case, all else stays.
_TERM = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c < 128 else c for c in range(256))
HASHES = 4  # rows set for a term and level
PER_ENTRY = 12  # rows of a signature for each term and level of its fullest document
BLOCK = 1024  # documents of a block at most
BLOCK_BITS = 1 << 23  # bits of a signature at most (wider ones hold fewer documents, one at least)
BLOCK_TERMS = 1 << 17  # terms listed in a block at most (or one document's)
OPEN_TERMS = 1 << 19  # terms listed in all blocks that a task has open
KNOWN = 1 << 16  # terms whose places a task remembers
LEVELS = 31  # occurrences in a text are below 2^31
SLACK = 1.0001  # bounds are sums of single-precision numbers
QUERY_TERMS = 1 << 13  # distinct terms of the queries answered together
FIRST = 32  # one block in so many is searched first


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TERM).split() if text else []


def places(term: bytes) -> tuple[int, int]:
    """Two 32-bit hashes; row i of level v is (a + (i + HASHES * v) * b) mod height."""
    h = xxhash.xxh64_intdigest(term, 7)
    return h & 0xFFFFFFFF, (h >> 32) | 1


def _rows_of(ab: np.ndarray, level: np.ndarray, height: int) -> np.ndarray:
    """(entries, HASHES) rows; the height is a power of two."""
    i = np.arange(HASHES, dtype=np.uint64)[None, :] + np.uint64(HASHES) * level[:, None].astype(np.uint64)
    return ((ab[:, :1] + i * ab[:, 1:]) & np.uint64(height - 1)).astype(np.int64)


# -- index ---------------------------------------------------------------------

_BLOCK = ("height int, width int, ids array<{id}>, lengths array<long>, bits binary, "
          "ends array<int>, terms array<int>, numbers array<int>, words array<binary>, df array<long>")


class _Numbers(dict):
    """Terms numbered as they come."""

    def __missing__(self, term: bytes) -> int:
        n = self[term] = len(self)
        return n


class _Open:
    """Documents of one length class, collected for a block: ids, and each one's
    terms (numbers in the block's vocabulary) with occurrences."""

    def __init__(self) -> None:
        self.vocabulary = _Numbers()
        self.ids: list = []
        self.terms: list[np.ndarray] = []
        self.numbers: list[np.ndarray] = []
        self.listed = self.widest = 0

    def add(self, i, c: Counter, numbers: np.ndarray, entries: int) -> None:
        self.ids.append(i)
        self.terms.append(np.fromiter(map(self.vocabulary.__getitem__, c), np.int32, len(c)))
        self.numbers.append(numbers)
        self.listed += len(c)
        self.widest = max(self.widest, entries)

    def height(self) -> int:
        return 1 << (self.widest * PER_ENTRY - 1).bit_length()

    def full(self) -> bool:
        return len(self.ids) >= BLOCK or self.listed >= BLOCK_TERMS or self.height() * (len(self.ids) + 8) > BLOCK_BITS


def _close(o: _Open, place: dict[bytes, tuple[int, int]]) -> tuple:
    height, width = o.height(), -(-len(o.ids) // 8)
    term, numbers = np.concatenate(o.terms), np.concatenate(o.numbers)
    sizes = np.fromiter(map(len, o.terms), np.int64, len(o.terms))
    doc = np.repeat(np.arange(len(o.ids)), sizes)
    ab = np.zeros((len(o.vocabulary), 2), np.uint64)
    for w, i in o.vocabulary.items():
        if w not in place:
            if len(place) >= KNOWN:
                place.clear()
            place[w] = places(w)
        ab[i] = place[w]
    matrix = np.zeros((height, len(o.ids)), np.uint8)
    level = 0
    alive = np.arange(len(term))
    while len(alive):
        r = _rows_of(ab[term[alive]], np.full(len(alive), level), height)
        matrix[r, doc[alive][:, None]] = 1
        level += 1
        alive = alive[numbers[alive] >= 1 << level]
    lengths = np.bincount(doc, weights=numbers, minlength=len(o.ids)).astype(np.int64)
    return (height, width, o.ids, lengths, np.packbits(matrix, axis=1, bitorder="little").tobytes(), np.cumsum(sizes), term, numbers, list(o.vocabulary),
            np.bincount(term, minlength=len(o.vocabulary)))


def _index(kinds: list[pa.DataType], names: list[str]):
    """(id, text in bytes) -> blocks."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Open] = {}
        place: dict[bytes, tuple[int, int]] = {}

        def give(o: _Open) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(_close(o, place), kinds, strict=True)], names=names)

        for b in rows(batches):
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                c = Counter(terms(t.as_py()))
                if not c:
                    continue  # no term: no score, and not counted
                numbers = np.fromiter(c.values(), np.int32, len(c))
                entries = int(np.frexp(numbers)[1].sum())  # a level for each binary digit
                o = held.setdefault(entries.bit_length(), _Open())
                o.add(i, c, numbers, entries)
                if o.full():
                    yield give(held.pop(entries.bit_length()))
                elif sum(x.listed for x in held.values()) > OPEN_TERMS:
                    yield give(held.pop(max(held, key=lambda k: held[k].listed)))
        for o in held.values():
            yield give(o)
    return run


@dataclass
class Index:
    """Blocks of documents (``blocks``), documents of each term (``df``: term, n),
    number of documents with a term (``docs``) and of all their terms (``length``)."""

    blocks: DataFrame
    df: DataFrame
    docs: int
    length: int

    @staticmethod
    def build(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Index:
        d = docs.select(F.col(f"`{id_col}`").alias("id"), as_bytes(f"`{text}`").alias("text"))
        schema = _BLOCK.format(id=d.schema["id"].dataType.simpleString())
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(d.sparkSession.createDataFrame([], schema).schema)
        blocks = stage(d.mapInArrow(_index(list(arrow.types), list(arrow.names)), schema), "blocks")
        total = blocks.agg(F.sum(F.size("ids")).cast("long"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
        df = blocks.select(F.explode(F.arrays_zip("words", "df")).alias("x")).groupBy(F.col("x.words").alias("term")).agg(F.sum("x.df").alias("n"))
        return Index(blocks, stage(df, "term-documents"), total[0] or 0, total[1] or 0)


# -- search ----------------------------------------------------------------------


@dataclass
class _Asked:
    """Queries answered together: ``words`` with weights, and each query's words and repeats."""

    words: list[bytes]
    weight: np.ndarray
    places: np.ndarray
    items: list[tuple[np.ndarray, np.ndarray]]
    least: np.ndarray  # a score that each query's results reach at least


def _share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _bounds(asked: _Asked, height: int, width: int, n_docs: int, bits: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(words, documents): upper bounds of each word's part of the score, from the
    slices, up to rounding to single precision (see SLACK)."""
    matrix = bits.reshape(height, width)
    level = np.zeros((len(asked.words), n_docs), np.uint8)  # binary digits of the occurrences, at most
    alive = np.arange(len(asked.words))
    may = None
    for at in range(LEVELS):
        here = np.bitwise_and.reduce(matrix[_rows_of(asked.places[alive], np.full(len(alive), at), height)], axis=1)
        may = here if may is None else may & here
        some = may.any(axis=1)
        alive, may = alive[some], may[some]
        if not len(alive):
            break
        level[alive] += np.unpackbits(may, axis=1, bitorder="little", count=n_docs)
    out = np.empty(level.shape, np.float32)
    for lo in range(0, len(out), 256):
        tf = (np.int64(1) << level[lo:lo + 256].astype(np.int64)) - 1
        out[lo:lo + 256] = _share(tf, m) * asked.weight[lo:lo + 256, None]
    return out


def _search(asked: _Asked, top: int, docs: int, length: int, kind: pa.DataType):
    """Blocks -> (item, id, score): for each query the best of the task's documents,
    and all that tie with the last of them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(asked.words, pa.binary())
        weight = asked.weight.astype(np.int64)
        best: list[list[tuple[int, bool, object]]] = [[] for _ in asked.items]  # (-score, no id, id), sorted
        floor = asked.least.copy()
        for b in rows(batches, 1):
            height, width = b.column(0)[0].as_py(), b.column(1)[0].as_py()
            ids, n = b.column(2)[0].values, b.column(3)[0].values.to_numpy(zero_copy_only=False)
            m = 25 + (75 * n * docs) // length
            bound = _bounds(asked, height, width, len(n), np.frombuffer(b.column(4)[0].as_buffer(), np.uint8), m)
            ends = b.column(5)[0].values.to_numpy(zero_copy_only=False)
            term, numbers = (b.column(i)[0].values.to_numpy(zero_copy_only=False) for i in (6, 7))
            number = pc.fill_null(pc.index_in(b.column(8)[0].values, value_set=wanted), -1).to_numpy(zero_copy_only=False)
            exact: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by document: the query words in it, sorted, and their parts
            for q, (which, times) in enumerate(asked.items):
                upper = SLACK * (times.astype(np.float32) @ bound[which]).astype(np.float64)
                may = np.flatnonzero((upper >= max(1, floor[q])))
                for d in may[np.argsort(-upper[may], kind="stable")].tolist():
                    if upper[d] < floor[q]:
                        break
                    if d not in exact:
                        lo = int(ends[d - 1]) if d else 0
                        at = number[term[lo:ends[d]]]
                        order = np.argsort(at)[np.count_nonzero(at < 0):]
                        at, tf = at[order], numbers[lo:ends[d]][order].astype(np.int64)
                        exact[d] = at, weight[at] * _share(tf, np.int64(m[d]))
                    at, part = exact[d]
                    if not len(at):
                        continue
                    k = np.minimum(np.searchsorted(at, which), len(at) - 1)
                    score = int((np.where(at[k] == which, part[k], 0) * times.astype(np.int64)).sum())
                    if score <= 0 or score < floor[q]:
                        continue
                    i = ids[d].as_py()
                    mine = best[q]
                    mine.append((-score, i is None, 0 if i is None else i))
                    mine.sort()
                    del mine[top:]
                    if len(mine) == top:
                        floor[q] = max(floor[q], -mine[-1][0])
        out = [(q, None if none else i, -s) for q, mine in enumerate(best) for s, none, i in mine]
        if out:
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], kind), pa.array(cols[2], pa.int64())], names=["item", "id", "score"])
    return run


def _ask(index: Index, group: list[list[bytes]]) -> _Asked:
    """Queries as words with weights; words in no document are left out."""
    spark = index.df.sparkSession
    wanted = sorted({t for x in group for t in x})
    if wanted:
        seen = spark.createDataFrame([(w,) for w in wanted], "term binary").join(index.df, "term").collect()  # at most the words asked for
    df = {bytes(r.term): r.n for r in seen} if wanted else {}
    words = [w for w in wanted if w in df]
    number = {w: i for i, w in enumerate(words)}
    weight = np.array([math.floor(1000 * math.log((2 * index.docs + 2) / (2 * df[w] + 1))) for w in words], np.float64)
    items = []
    for x in group:
        c = Counter(t for t in x if t in number)
        items.append((np.array([number[t] for t in c], np.int64), np.array(list(c.values()), np.float64)))
    return _Asked(words, weight, np.array([places(w) for w in words], np.uint64).reshape(-1, 2), items, np.zeros(len(group), np.int64))


def _groups(queries: DataFrame, id_col: str, text: str) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Queries in groups of at most QUERY_TERMS terms (or one query), one after another."""
    ids, lists, n = [], [], 0
    for r in queries.select(F.col(f"`{id_col}`").alias("id"), as_bytes(f"`{text}`").alias("text")).toLocalIterator():
        found = terms(bytes(r.text))
        if lists and n + len(found) > QUERY_TERMS:
            yield ids, lists
            ids, lists, n = [], [], 0
        ids.append(r.id)
        lists.append(found)
        n += len(found)
    if lists:
        yield ids, lists


def search(index: Index, queries: DataFrame, top: int = 10, query_id: str = "item_id", text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(query id, rank from 1, id, score): the ``top`` documents of each query with a
    score above 0, highest first, equal scores by ascending id."""
    spark = index.blocks.sparkSession
    kind = index.blocks.schema["ids"].dataType.elementType
    key = queries.schema[query_id].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    arrow = to_arrow_type(kind)
    shape = f"item int, id {kind.simpleString()}, score long"
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    read = index.blocks.select("height", "width", "ids", "lengths", "bits", "ends", "terms", "numbers", "words")
    out = None
    for ids, lists in _groups(queries, query_id, text):
        asked = _ask(index, lists)
        if not asked.words:
            continue

        def ranked(source: DataFrame, a: _Asked) -> DataFrame:
            found = source.mapInArrow(_search(a, top, index.docs, index.length, arrow), shape)
            return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)

        first = ranked(read.where(F.pmod(F.xxhash64("ids"), F.lit(FIRST)) == 0), asked)
        for r in first.where(F.col("rank") == top).select("item", "score").collect():  # a row a query
            asked.least[r.item] = r.score
        named = spark.createDataFrame(list(enumerate(ids)), f"item int, query {key.simpleString()}")
        part = ranked(read, asked).join(F.broadcast(named), "item")  # names of this group's queries
        part = stage(part.select(F.col("query").alias(query_id), "rank", F.col("id").alias(id_col), "score"), "ranked")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"{query_id} {key.simpleString()}, rank int, {id_col} {kind.simpleString()}, score long")
    return out
