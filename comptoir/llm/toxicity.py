"""Toxicity: distance-weighted votes of the nearest labelled examples.

A bounded sample of labelled documents (``MAX_EXAMPLES``, the least hashes of
the ids) is indexed. Terms are words and word beginnings of 4 to 6 bytes, all
that ``MIN_DOCS`` documents of the sample hold, whatever their label; document frequencies are counted
over all documents. A term weighs ``(1 + ln tf) * idf`` times its correlation with the label in the sample (its
size, of either sign): neutral terms stay in the vectors and weigh little. Vectors have length 1.

The index is inverted. Like examples lie in one block. Terms that many examples of a block hold
are a dense matrix there, with the greatest weight of each; lists of the others are added up for all examples. A
query visits blocks in the order of their upper bounds (what the lists gave, and the greatest
weights of the matrix) and leaves out those that cannot hold a neighbour, so the nearest
examples by cosine are exact. Their votes, weighted by cosine and shrunk
to the sample's share, are calibrated by isotonic regression on leave-one-out
votes of the sample; the neighbours are returned as evidence.

Null and empty texts, and texts without any indexed term, have no neighbours and
get the calibrated share of such examples. Without labels every score is 0. Equal texts get equal
scores; of examples of equal cosine the first in the index is nearer; very long texts are read whole; an
empty table gives no row; only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm._util import held_out, rows, stage

MAX_EXAMPLES = 10_000
MIN_DOCS = 2
PREFIXES = (4, 5, 6)
NEIGHBOURS = 15
BLOCK = 256
TOGETHER = 256  # queries that visit the blocks together
FIRST = 3  # blocks that each query visits first
COMMON = 8  # terms in one of so many examples of a block are kept in its matrix
ARRANGED = 512  # terms by which like examples are found
SINGLE = 1e-4  # more than a cosine is off in single precision
KNOWN = 1 << 18  # words whose terms a task remembers
THRESHOLD = 0.7

_SEPARATE = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SEPARATE).split()


def terms_of(word: bytes) -> list[bytes]:
    """The word, and its beginnings (marked by a hyphen)."""
    return [word, *(word[:n] + b"-" for n in PREFIXES if len(word) >= n)]


class Terms:
    """Term numbers of the vocabulary."""

    def __init__(self, terms: list[bytes]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.forget()

    def __getstate__(self) -> dict:
        return {"number": self.number}

    def __setstate__(self, state: dict) -> None:
        self.number = state["number"]
        self.forget()

    def forget(self) -> None:
        """``known``: places of words in ``held``, their term numbers (``none``: no more of them)."""
        self.none = len(self.number)
        self.known: dict[bytes, int] = {}
        self.held = np.zeros((0, 1 + len(PREFIXES)), np.int32)
        self.times = np.zeros(self.none + 1)

    def numbers(self, found: Iterable[bytes]) -> np.ndarray:
        """The term numbers of each word, a row each, filled up with ``none``."""
        at = list(map(self.known.get, found))
        if None in at:
            if len(self.known) + len(at) > KNOWN:
                self.known, self.held = {}, self.held[:0]
                at = [None] * len(at)
            get, none, known = self.number.get, self.none, self.known
            made = []
            for k, w in enumerate(found):
                if at[k] is None:
                    at[k] = known[w] = len(known)
                    made += [get(w, none)] + [get(w[:n] + b"-", none) if len(w) >= n else none for n in PREFIXES]
            made = np.array(made, np.int32).reshape(-1, self.held.shape[1])
            begin = len(known) - len(made)
            if len(self.known) > len(self.held):
                grown = np.zeros((max(len(self.known), 2 * len(self.held), 1024), self.held.shape[1]), np.int32)
                grown[:begin] = self.held[:begin]
                self.held = grown
            self.held[begin:begin + len(made)] = made
        return self.held[at]

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers of a text, ascending, and their occurrences."""
        n = Counter(words(text))
        if not n:
            return np.zeros(0, np.int64), np.zeros(0)
        ids = self.numbers(n).ravel()
        np.add.at(self.times, ids, np.repeat(np.fromiter(n.values(), np.float64, len(n)), self.held.shape[1]))
        ids.sort()
        new = np.ones(len(ids), bool)
        np.not_equal(ids[1:], ids[:-1], out=new[1:])
        term = ids[new]
        times = self.times[term]
        self.times[term] = 0
        last = len(term) - int(term[-1] == self.none)
        return term[:last].astype(np.int64), times[:last]

    def frequencies(self, texts: Iterable[str | None]) -> np.ndarray:
        """In how many of the texts each term is found."""
        n = np.zeros(self.none + 1, np.int64)
        for t in texts:
            if found := set(words(t)):
                n[self.numbers(found).ravel()] += 1  # once, however often it is among them
        return n[:-1]


def alike(vectors: np.ndarray, step: int) -> np.ndarray:
    """An order of the rows in which each ``step`` of them are alike: halves along the
    first principal axis, again and again."""
    def halve(rows: np.ndarray) -> list[np.ndarray]:
        steps = -(-len(rows) // step)
        if steps < 2:
            return [rows]
        x = vectors[rows]
        x = x - x.mean(axis=0)
        axis = np.random.default_rng(0).standard_normal(x.shape[1]).astype(x.dtype)
        for _ in range(8):
            axis = (x @ axis) @ x
            axis /= max(float(np.linalg.norm(axis)), 1e-30)
        rows = rows[np.argsort(x @ axis, kind="stable")]
        del x
        half = steps // 2 * step
        return halve(rows[:half]) + halve(rows[half:])

    return np.concatenate(halve(np.arange(len(vectors))))


class BlockMax:
    """Inverted index of unit vectors. Like vectors lie in one block. Terms that many vectors of a block hold are
    kept there in a dense matrix, with their greatest weights; the other entries lie in a list for each term. Blocks are
    multiplied in single precision; the cosines of all that may be neighbours by it are taken from the vectors themselves."""

    def __init__(self, vectors: Iterable[tuple[np.ndarray, np.ndarray]], n_terms: int):
        """``vectors``: (term numbers, weights) of each example."""
        size, terms, weights = [], [np.zeros(0, np.int32)], [np.zeros(0)]
        for some in batched(vectors, BLOCK):  # not all small arrays at once
            size += [len(t) for t, _ in some]
            terms.append(np.concatenate([t for t, _ in some]).astype(np.int32))
            weights.append(np.concatenate([w for _, w in some]))
        self.n, self.n_terms = len(size), n_terms
        self.blocks = max(1, -(-self.n // BLOCK))
        self.begin = np.cumsum([0, *size])
        self.term = np.concatenate(terms)
        del terms
        self.weight = np.concatenate(weights)
        del weights  # not beside what is made of them
        self._arrange()
        self.common = np.full(n_terms, -1, np.int32)
        self.dense = []  # (places in common, the block's matrix, greatest weights)
        parts = []
        for b in range(self.blocks):
            mine = self.order[b * BLOCK:(b + 1) * BLOCK]
            spans = list(map(slice, self.begin[mine].tolist(), self.begin[mine + 1].tolist()))
            term = np.concatenate([self.term[x] for x in spans]) if spans else self.term
            weight = np.concatenate([self.weight[x] for x in spans]) if spans else self.weight
            row = np.repeat(np.arange(len(mine)), [x.stop - x.start for x in spans])
            found = np.bincount(term, minlength=n_terms)
            many = np.flatnonzero((found * COMMON >= BLOCK) & (found > 1))
            place = np.full(n_terms, -1, np.int32)
            place[many] = np.arange(len(many))
            at = place[term]
            matrix = np.zeros((BLOCK, len(many)), np.float32)
            matrix[row[at >= 0], at[at >= 0]] = weight[at >= 0]
            self.dense.append((many, matrix, matrix.max(axis=0)))
            self.common[many] = 0
            parts.append((term[at < 0], (row[at < 0] + b * BLOCK).astype(np.min_scalar_type(self.blocks * BLOCK)), weight[at < 0].astype(np.float32)))
        of = np.flatnonzero(self.common >= 0)
        self.common[of] = np.arange(len(of))
        self.dense = [(self.common[many], matrix, best) for many, matrix, best in self.dense]
        term, example, rare = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        self.first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=n_terms))])
        order = np.argsort(term, kind="stable")
        del term
        self.example, self.rare = example[order], rare[order]

    def _arrange(self) -> None:
        """``order``: the examples as they lie in blocks, like ones (by the terms most of them hold) side by side."""
        found = np.bincount(self.term, minlength=self.n_terms)
        most = np.argsort(-found, kind="stable")[:ARRANGED]
        place = np.full(self.n_terms, -1, np.int32)
        place[most] = np.arange(len(most))
        at = place[self.term]
        held = np.zeros((self.n, len(most)), np.float32)
        held[np.repeat(np.arange(self.n, dtype=np.int32), np.diff(self.begin))[at >= 0], at[at >= 0]] = 1
        self.order = alike(held, BLOCK)
        self.place = np.empty(self.n, np.int64)
        self.place[self.order] = np.arange(self.n)

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, but: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """For each query the ``k`` examples of the greatest positive cosine (ties: the first), without its ``but``."""
        out: list[list[tuple[float, int]]] = []
        for at in range(0, len(queries), TOGETHER):
            out += self._nearest(queries[at:at + TOGETHER], k, but[at:at + TOGETHER] if but else [-1] * TOGETHER)
        return out

    def _rarer(self, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the lists of a query's terms give, for all places."""
        size = self.first[term + 1] - self.first[term]
        some = np.flatnonzero(size)
        size, first, weight = size[some], self.first[term[some]], weight[some].astype(np.float32)
        at = np.repeat(first - np.cumsum(size) + size, size)
        at += np.arange(len(at))
        given = self.rare.take(at)
        given *= np.repeat(weight, size)
        return np.bincount(self.example.take(at), weights=given, minlength=self.blocks * BLOCK)

    def _cosines(self, dense: np.ndarray, query: tuple[np.ndarray, np.ndarray], examples: np.ndarray) -> np.ndarray:
        """``dense`` holds zeros, before and after."""
        dense[query[0]] = query[1]
        out = [dense.take(self.term[x]) @ self.weight[x] for x in map(slice, self.begin[examples].tolist(), self.begin[examples + 1].tolist())]
        dense[query[0]] = 0
        return np.round(np.array(out), 12)

    def _nearest(self, queries: list, k: int, but: list[int]) -> list[list[tuple[float, int]]]:
        n = len(queries)
        if not self.n:
            return [[] for _ in queries]
        score = np.zeros((n, self.blocks, BLOCK), np.float32)
        common = np.zeros((int(self.common.max(initial=-1)) + 1, n), np.float32)
        for q, (term, weight) in enumerate(queries):
            row = self.common[term]
            common[row[row >= 0], q] = weight[row >= 0]
            score[q] = self._rarer(term, weight).reshape(self.blocks, BLOCK)
        bound = score.max(axis=2)
        for b, (of, _, best) in enumerate(self.dense):
            bound[:, b] += best @ common[of]

        def visit(chosen: np.ndarray) -> None:
            for b in np.flatnonzero(chosen.any(axis=0)).tolist():
                who = np.flatnonzero(chosen[:, b])
                of, matrix, _ = self.dense[b]
                given = common[of]
                score[who, b] += (matrix @ (given if len(who) == n else given[:, who])).T

        def kth(q: int, among: np.ndarray) -> float:
            """Least that a neighbour has, as far as these blocks tell."""
            s = score[q][among].ravel()
            more = k + (but[q] >= 0)  # one of them may be the one to leave out
            return float(np.partition(s, len(s) - more)[len(s) - more]) if len(s) >= more else 0.0

        least = np.zeros(n)
        seen = np.zeros(bound.shape, bool)
        np.put_along_axis(seen, np.argsort(-bound, axis=1, kind="stable")[:, :FIRST], True, axis=1)  # the most promising blocks
        visit(seen)
        for q in range(n):
            least[q] = kth(q, seen[q]) - SINGLE
        rest = ~seen & (bound > 0) & (bound >= least[:, None])  # all that may still hold a neighbour
        visit(rest)
        seen |= rest
        out = []
        dense = np.zeros(self.n_terms)
        for q in range(n):
            s = score[q].ravel()
            near = np.flatnonzero(s >= max(kth(q, seen[q]) - SINGLE, 1e-30))
            near = self.order[near[seen[q][near // BLOCK]]]
            near = near[near != but[q]]
            top = sorted((-x, i) for x, i in zip(self._cosines(dense, queries[q], near).tolist(), near.tolist(), strict=True) if x > 0)
            out.append([(-x, i) for x, i in top[:k]])
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of ``y`` on ``x`` (pool adjacent violators), as places and values."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum, count, least x, greatest x
    ux, first = np.unique(x[order], return_index=True)
    for v, part in zip(ux, np.split(y[order], first[1:]), strict=True):
        pools.append([float(part.sum()), len(part), v, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2], hi]
    at = np.array([e for p in pools for e in (p[2], p[3])])
    return at, np.array([v for s, n, _, _ in pools for v in [(s + 0.5 * (s / n)) / (n + 0.5)] * 2])


class Model:
    """Everything a task needs to score texts. Votes of examples are calibrated by ``calibrate``. Examples are
    kept as counts, the smallest form; the index is made of them where it is used."""

    def __init__(self, terms: list[bytes], weight: list[float], examples: Iterable[tuple[object, int, tuple[np.ndarray, np.ndarray]]]):
        self.terms = Terms(terms)
        self.weight = np.array(weight)
        ready, bare, labels = [], [], []
        for i, y, c in examples:
            t, w = self.vector(c)
            labels.append(y)
            if len(t):
                ready.append((int(t[w.argmax()]), str(i), i, y, c))
            else:
                bare.append(y)
        self.share = sum(labels) / len(labels) if labels else 0.0
        # Like examples side by side: the blocks' bounds are tighter.
        ready.sort(key=lambda r: r[:2])
        self.ids, self.toxic = [r[2] for r in ready], [r[3] for r in ready]
        self.sizes = [len(r[4][0]) for r in ready]
        self.held = [np.concatenate([r[4][k] for r in ready]) if ready else np.zeros(0, np.int32) for k in (0, 1)]
        self.bare = (sum(bare) + 0.5 * self.share) / (len(bare) + 0.5) if bare else self.share
        self.places, self.values = np.array([0.0]), np.array([self.share])

    @cached_property
    def number(self) -> dict:
        return {i: k for k, i in enumerate(self.ids)}

    @cached_property
    def index(self) -> BlockMax:
        cut = np.cumsum([0, *self.sizes]).tolist()
        return BlockMax((self.vector((self.held[0][a:b], self.held[1][a:b])) for a, b in zip(cut, cut[1:], strict=False)), len(self.weight))

    def __getstate__(self) -> dict:
        """Without what is made of the rest; counts as steps between term numbers, compressed: every executor keeps a copy."""
        term, n = self.held
        packed = [(x.dtype.str, x.nbytes, pa.compress(x.tobytes(), "zstd", asbytes=True)) for x in (np.diff(term, prepend=term.dtype.type(0)), n)]
        return {k: v for k, v in vars(self).items() if k not in ("index", "number")} | {"held": packed}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        steps, n = (np.frombuffer(pa.decompress(x, size, "zstd"), kind) for kind, size, x in state["held"])
        self.held = [np.cumsum(steps, dtype=steps.dtype), n]

    def calibrate(self, votes: list[tuple[float, int]]) -> None:
        """(leave-one-out vote, label) of the examples."""
        if votes:
            self.places, self.values = isotonic(np.array([v for v, _ in votes]), np.array([y for _, y in votes], float))

    def vector(self, counts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights, of length 1."""
        t, n = counts
        w = (1 + np.log(n.astype(np.float64))) * self.weight[t]
        norm = math.sqrt(float(w @ w))
        return (t[w > 0], w[w > 0] / norm) if norm else (t[:0], w[:0])

    def vote(self, near: list[tuple[float, int]]) -> float:
        return (sum(s * self.toxic[i] for s, i in near) + self.share) / (sum(s for s, _ in near) + 1)

    def without_themselves(self, examples: list, texts: list[str | None]) -> list[float | None]:
        """The votes of examples' neighbours, themselves left out; None for those that are not in the index."""
        at = [self.number.get(i, -1) for i in examples]
        near = self.index.nearest([self.vector(self.terms.counts(t)) for t in texts], NEIGHBOURS, at)
        return [self.vote(x) if i >= 0 else None for i, x in zip(at, near, strict=True)]

    def score(self, texts: list[str | None]) -> list[tuple[float, list[tuple[float, int]]]]:
        near = self.index.nearest([self.vector(self.terms.counts(t)) for t in texts], NEIGHBOURS)
        return [(float(np.interp(self.vote(x), self.places, self.values)) if x else self.bare, x) for x in near]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        max_examples: int = MAX_EXAMPLES) -> Model:
    """Learn from labelled rows outside the held-out third. Repeated labels of an id
    count once (the greatest); of repeated documents one row is used."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    known = stage(known.orderBy(F.xxhash64("id"), "id").limit(max_examples), "labelled")
    # At most max_examples ids: the broadcast has a bound.
    sample = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
    sample = stage(sample.groupBy("id").agg(F.max("y").alias("y"), F.max("text").alias("text")), "labelled-texts")

    def seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, pos = Counter(), Counter()
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = {x for w in set(words(t)) for x in terms_of(w)}
                n.update(found)
                if y:
                    pos.update(found)
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(n), pa.binary()), "n": pa.array(list(n.values()), pa.int64()), "pos": pa.array([pos[t] for t in n], pa.int64())})

    total, positive = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    stats = sample.select("y", "text").mapInArrow(seen, "term binary, n long, pos long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    n, k = F.col("n").cast("double"), F.col("pos").cast("double")
    off = k * (total - positive) - (n - k) * positive
    linked = F.abs(off) / F.sqrt(n * (total - n) * F.lit(float(positive * (total - positive))))
    # Terms of the sample, which is bounded. The driver takes columns, not rows.
    ask = stats.where((F.col("n") >= MIN_DOCS) & (F.col("n") < total)).select("term", linked.alias("linked")).orderBy("term")
    found = ask.toArrow() if 0 < positive < total else pa.table({"term": pa.array([], pa.binary()), "linked": pa.array([], pa.float64())})
    chosen, linked_to = found.column("term").to_pylist(), found.column("linked").to_pylist()
    made = docs.sparkSession.sparkContext.broadcast(Terms(chosen))

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = made.value.frequencies(t.as_py() for b in batches for t in b.column(0))
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"k": pa.array(k, pa.int32()), "n": pa.array(n[k], pa.int64())})

    df = np.zeros(len(chosen), np.int64)
    if chosen:
        counted = docs.select(text).mapInArrow(frequencies, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
        df[counted.column("k").to_numpy()] = counted.column("n").to_numpy()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = [made.value.counts(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([t.astype("<i4").tobytes() for t, _ in c], pa.binary()),
                                              pa.array([n.astype("<f4").tobytes() for _, n in c], pa.binary())], names=["id", "y", "t", "n"])

    kind = docs.schema[id_col].dataType.simpleString()
    examples = stage(sample.select("id", "y", "text").mapInArrow(count, f"id {kind}, y int, t binary, n binary"), "labelled-counts")
    made.destroy()
    n_docs = docs.count()
    weight = [(math.log((n_docs + 1) / (x + 1)) + 1) * r for x, r in zip(df.tolist(), linked_to, strict=True)]
    # at most max_examples, one task's at a time
    model = Model(chosen, weight, ((r.id, r.y, (np.frombuffer(r.t, "<i4"), np.frombuffer(r.n, "<f4"))) for r in examples.toLocalIterator()))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def votes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches):
            v = shared.value.without_themselves(b.column(0).to_pylist(), b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.float64()), b.column(1)], names=["v", "y"])

    made_votes = sample.repartition(sample.sparkSession.sparkContext.defaultParallelism).select("id", "y", "text").mapInArrow(votes, "v double, y int")
    model.calibrate(sorted((r.v, r.y) for r in made_votes.collect() if r.v is not None))  # at most max_examples
    shared.destroy()
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``score``, ``predicted`` and ``evidence``, the nearest three examples."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # unpacked, and its index made, once a Python worker

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        near_type = pa.list_(pa.struct([("example", pa.string()), ("similarity", pa.float64()), ("label", pa.int32())]))
        for b in rows(batches, 512):
            made = model.score(b.column(1).to_pylist())
            near = [[{"example": str(model.ids[i]), "similarity": s, "label": model.toxic[i]} for s, i in n[:3]] for _, n in made]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s for s, _ in made], pa.float64()), pa.array(near, near_type)],
                                             names=[id_col, "score", "evidence"])

    out = docs.select(id_col, F.col(text).alias("_text")).mapInArrow(
        run, f"`{id_col}` {kind}, score double, evidence array<struct<example:string,similarity:double,label:int>>")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
