"""Benchmark decontamination: approximate passages found by CGK embedding and LSH.

A text is a sequence of normalised words. Windows as long as an item slide over
every word of a document. The CGK random walk embeds a window of ``n`` words
in symbols (a word is repeated while the walk's coin for word and step says so;
the first ``2n`` of them are sampled), which turns edit distance into Hamming distance. Each repetition has
its own walk and samples a few positions; windows and items with the same
sampled bits (hashes of the symbols) are candidates, and an exact edit
distance over words decides. How many repetitions reach the target recall is
found for each length on made-up passages at the edit limit (``repeats_for``).
Insertions and deletions take the walks of long windows apart, so an item of more
than ``PART`` words is searched by parts of even length: at the edit limit of
the whole, at least one part is within its own limit. Exact passages are always found.

Windows that cannot match are not embedded: an alignment with at most ``k``
edits keeps at least ``n - 2 - 3k`` of the item's three-word runs, so a window
with fewer runs known from any item is out of reach (no loss). Items too short
for that count embed every window.

There is no shuffle: each document is searched where it is read. The items are
a stated query set; they are dealt to blocks of bounded size, and every block
is run against all documents. Null and empty texts match nothing, nor do null
or wordless items. Very long texts are searched whole, a stretch of windows at a time; only the
named columns are read, whatever others are called.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm._util import rows

BLOCK_BYTES = 8_000_000  # items sent to the tasks at a time
EDIT_RATE = 0.15  # edits per word of the item, rounded down
SAMPLED = 4
RECALL = 0.98  # of passages at the edit limit
PART = 45  # words that an item or a part of one has at most
TRIALS, MOST = 96, 160  # passages made up for each length; repetitions at most
RUN = 3
STRIDE = 4096  # windows embedded at a time

# ASCII punctuation and white space separate words; A-Z are lowered before.
_SEPARATE = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SEPARATE).split()


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sampled_keys(seqs: np.ndarray, repeats: range) -> np.ndarray:
    """LSH keys (m x repetitions) of the rows of ``seqs`` (m x n word numbers): the
    walks of all repetitions run side by side, as far as the last sampled position."""
    m, n = seqs.shape
    steps = 2 * n  # the walk has then read the window on average; later symbols are mostly padding
    walks = [np.random.default_rng([n, r]) for r in repeats]
    picked = np.stack([np.bincount(g.choice(steps, size=min(SAMPLED, steps), replace=False), minlength=steps) for g in walks], axis=1).astype(bool)
    salt = np.stack([g.integers(0, 2**63, size=steps, dtype=np.int64).view(np.uint64) for g in walks], axis=1)
    spread = np.concatenate([seqs, np.full((m, 1), -1, seqs.dtype)], axis=1).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    row = np.arange(m)[:, None]
    i, key = np.zeros((m, len(walks)), np.int64), np.zeros((m, len(walks)), np.uint64)
    for t in range(int(np.flatnonzero(picked.any(axis=1))[-1]) + 1):
        h = _mix(spread[row, i] + salt[t])
        if picked[t].any():  # sixteen bits of the symbol's hash
            key = np.where(picked[t], _mix(key ^ (h >> np.uint64(48))), key)
        i = np.minimum(i + (h & np.uint64(1)).astype(np.int64), n)
    return key


def fit_distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end): the least edit distance of ``item`` to any stretch of
    ``region``; of equal ones the first to end, then the longest."""
    n, m = len(item), len(region)
    d = np.zeros(m + 1, np.int64)
    start = np.arange(m + 1)
    ramp = np.arange(m + 1)
    for i in range(n):
        up = d + 1
        diag = np.concatenate([[i + 1], d[:-1] + (region != item[i])])
        best = np.minimum(up, diag)
        from_ = np.where(diag <= up, np.concatenate([[0], start[:-1]]), start)
        # left moves: the running minimum of best - ramp
        low = np.minimum.accumulate(best - ramp)
        src = np.maximum.accumulate(np.where(best - ramp == low, ramp, 0))
        d, start = low + ramp, from_[src]
    end = int(np.argmin(d))
    return int(d[end]), int(start[end]), end


@lru_cache(maxsize=1024)
def repeats_for(n: int, limit: int, recall: float = RECALL) -> int:
    """Repetitions after which the target share of made-up passages of ``n`` words with ``limit`` edits (a third each of
    insertions, deletions and a mixture with substitutions) has met the item's bits, in the windows around their start."""
    if limit == 0:
        return 1
    r = np.random.default_rng([n, limit])
    item = np.arange(1, n + 1)
    windows = []
    for trial in range(TRIALS):
        v = item.tolist()
        for _ in range(limit):
            act = trial % 3 if trial % 3 < 2 else int(r.integers(3))
            at = int(r.integers(len(v)))
            v[at:at + (act != 0)] = [] if act == 1 else [int(r.integers(n + 1, 1 << 40))]
        near = [-2 - x for x in r.integers(1, 1 << 40, 2 * (n + limit)).tolist()]
        whole = np.array(near[:limit] + v + near[limit:])
        windows.append(np.stack([whole[k:k + n] for k in range(2 * limit + 1)]))
    met = np.zeros(TRIALS, bool)
    for at in range(0, MOST, 8):
        group = range(at, at + 8)
        own = _sampled_keys(item[None, :], group)
        keys = _sampled_keys(np.concatenate(windows), group).reshape(TRIALS, 2 * limit + 1, 8)
        hit = (keys == own[0]).any(axis=1)
        for k in range(8):
            met |= hit[:, k]
            if met.mean() >= recall:
                return at + k + 1
    return MOST


class Index:
    """The items of one block, ready for search. Items are cut into parts (``seqs``) that are
    searched; ``items`` are verified."""

    def __init__(self, items: list[tuple[object, str]], edit_rate: float = EDIT_RATE, recall: float = RECALL,
                 repeats: dict[int, int] | None = None):
        split = [(i, w) for i, t in items if (w := words(t))]
        self.number: dict[bytes, int] = {}
        for _, w in split:
            for x in w:
                self.number.setdefault(x, len(self.number) + 1)
        self.ids = [i for i, _ in split]
        self.items = [np.array([self.number[x] for x in w], np.int64) for _, w in split]
        self.most = [int(edit_rate * len(s)) for s in self.items]
        cuts = [np.linspace(0, len(s), -(-len(s) // PART) + 1).astype(int).tolist() for s in self.items]
        self.part_of = [(k, lo) for k, c in enumerate(cuts) for lo in c[:-1]]
        self.seqs = [s[lo:hi] for s, c in zip(self.items, cuts, strict=True) for lo, hi in zip(c, c[1:], strict=False)]
        self.limit = [int(edit_rate * len(s)) for s in self.seqs]
        # The least number of an item's runs that any window in reach holds.
        self.least = np.array([max(0, len(s) - (RUN - 1) - RUN * k) for s, k in zip(self.seqs, self.limit, strict=True)], np.int64)
        self.base = len(self.number) + 1
        pairs = [(self._runs(s), np.full(max(0, len(s) - RUN + 1), k)) for k, s in enumerate(self.seqs)]
        code, item = (np.concatenate(x) if pairs else np.zeros(0, np.int64) for x in (list(zip(*pairs, strict=True)) or [(), ()]))
        both = np.unique(np.stack([code, item], axis=1), axis=0) if len(code) else np.zeros((0, 2), np.int64)
        self.codes, first = np.unique(both[:, 0], return_index=True)
        self.items_of, self.first = both[:, 1], np.append(first, len(both))
        # Repetitions in groups: later ones only where the earlier leave doubt.
        self.groups: dict[int, list[range]] = {}
        self.tables: dict[int, list[list[dict[int, list[int]]]]] = {}
        for n in {len(s) for s in self.seqs}:
            own = [k for k, s in enumerate(self.seqs) if len(s) == n]
            block = np.stack([self.seqs[k] for k in own])
            self.tables[n] = []
            r = (repeats or {}).get(n) or repeats_for(n, int(edit_rate * n), recall)
            at = sorted({0, 1, min(8, r), r})
            self.groups[n] = [range(a, b) for a, b in zip(at, at[1:], strict=False)]
            for g in self.groups[n]:
                tables: list[dict[int, list[int]]] = [{} for _ in g]
                for k, keys in zip(own, _sampled_keys(block, g).tolist(), strict=True):
                    for table, key in zip(tables, keys, strict=True):
                        table.setdefault(key, []).append(k)
                self.tables[n].append(tables)

    def _runs(self, s: np.ndarray) -> np.ndarray:
        return (s[:-2] * self.base + s[1:-1]) * self.base + s[2:] if len(s) >= RUN else s[:0]

    def _windows(self, seq: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item, window starts) still in reach; windows may hang over both ends by the edit limit."""
        at = np.flatnonzero((seq[:-2] > 0) & (seq[1:-1] > 0) & (seq[2:] > 0)) if len(seq) >= RUN else np.zeros(0, np.int64)
        code = (seq[at] * self.base + seq[at + 1]) * self.base + seq[at + 2] if len(at) else at
        place = np.searchsorted(self.codes, code)
        hit = self.codes[np.minimum(place, len(self.codes) - 1)] == code if len(self.codes) else np.zeros(len(at), bool)
        at, place = at[hit], place[hit]
        many = self.first[place + 1] - self.first[place] if len(at) else at
        where = np.repeat(at, many)
        which = self.items_of[np.repeat(self.first[place] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))] if len(at) else at
        count = np.bincount(which, minlength=len(self.seqs))
        for k in np.flatnonzero(count >= self.least).tolist():
            n, limit = len(self.seqs[k]), self.limit[k]
            starts = np.arange(-limit, len(seq) - n + limit + 1)
            if self.least[k] > 0:
                own = where[which == k]
                held = np.searchsorted(own, starts + n - RUN + 1) - np.searchsorted(own, starts)
                starts = starts[held >= self.least[k]]
            if len(starts):
                yield k, starts

    def search(self, texts: list[str | None]) -> list[tuple[int, object, int, int, int, int]]:
        """(text number, item id, edits, item words, start word, end word): the
        nearest stretch of each item that a text holds."""
        get = self.number.get
        seqs: dict[int, np.ndarray] = {}
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        tried: dict[tuple[int, int], list[tuple[int, int]]] = {}
        wanted: dict[int, dict[int, dict[int, np.ndarray]]] = {}  # window length -> text -> item -> starts
        for t, text in enumerate(texts):
            split = words(text)
            seq = np.fromiter(map(get, split, repeat(0)), np.int64, len(split))
            for k, starts in self._windows(seq):
                # Unknown words differ from each other and from every item's.
                seqs[t] = np.where(seq == 0, -2 - np.arange(len(seq)), seq)
                wanted.setdefault(len(self.seqs[k]), {}).setdefault(t, {})[k] = starts
        for n, of_text in wanted.items():
            for g, tables in enumerate(self.tables[n]):
                open_ = {t: [x for k, x in of.items() if best.get((t, self.part_of[k][0]), (1,))[0] > 0 and (g == 0 or self.limit[k] > 0)]
                         for t, of in of_text.items()}
                places = [(t, np.unique(np.concatenate(x))) for t, x in open_.items() if x]
                found: dict[tuple[int, int], set[int]] = {}
                for block, owner, starts in self._blocks(places, seqs, n):
                    keys = _sampled_keys(block, self.groups[n][g])
                    for r, table in enumerate(tables):
                        for w in np.flatnonzero(np.isin(keys[:, r], np.fromiter(table, np.uint64, len(table)))).tolist():
                            for k in table[int(keys[w, r])]:
                                found.setdefault((int(owner[w]), k), set()).add(int(starts[w]))
                for (t, k), at in found.items():
                    self._verify(t, k, at, seqs[t], best, tried)
        return [(t, self.ids[k], e, len(self.items[k]), a, b) for (t, k), (e, a, b) in sorted(best.items())]

    @staticmethod
    def _blocks(places: list[tuple[int, np.ndarray]], seqs: dict[int, np.ndarray], n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows of length ``n`` at the places, STRIDE at a time; words beyond an end are -1."""
        held, size = [], 0
        for t, starts in places:
            seq = seqs[t]
            for cut in range(0, len(starts), STRIDE):
                s = starts[cut:cut + STRIDE]
                at = s[:, None] + np.arange(n)[None, :]
                held.append((np.where((at >= 0) & (at < len(seq)), seq[np.clip(at, 0, len(seq) - 1)], -1), np.full(len(s), t), s))
                size += len(s)
                if size >= STRIDE:
                    yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                    held, size = [], 0
        if held:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))

    def _verify(self, t: int, part: int, at: set[int], seq: np.ndarray, best: dict, tried: dict) -> None:
        """The whole item of ``part`` around the places ``at`` where the part may begin."""
        k, offset = self.part_of[part]
        s, limit = self.items[k], self.most[k]
        # a place is off by the part's limit; the words before the part may have gained or lost as many as the item's
        off = 2 * limit if len(self.seqs[part]) == len(s) else 3 * limit
        done = tried.setdefault((t, k), [])
        for x in sorted(at):
            x -= offset
            lo, hi = max(0, x - off), min(len(seq), x + len(s) + off)
            if best.get((t, k), (1,))[0] == 0:
                return
            if any(a <= lo and hi <= b for a, b in done):
                continue
            hi = min(len(seq), x + 2 * len(s) + off)  # takes in the windows that follow
            done.append((lo, hi))
            edits, a, b = fit_distance(s, seq[lo:hi])
            if edits <= limit and edits < best.get((t, k), (limit + 1,))[0]:
                best[t, k] = (edits, lo + a, lo + b)


_ONCE = dict.fromkeys(range(PART + 1), 1)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
                  item_text: str = "text", edit_rate: float = EDIT_RATE, recall: float = RECALL) -> DataFrame:
    """One row per document and item it holds: the id columns, ``edits``,
    ``item_words``, ``start_word``, ``end_word`` (of the normalised words, end
    excluded) and ``similarity`` = 1 - edits / item_words. Rows of ``docs`` that
    repeat give rows that repeat; repeated items are searched once."""
    b = benchmark.select(F.col(item_col).alias("id"), F.col(item_text).alias("text")).where("text is not null").distinct()
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    id_t, item_t = (d.schema[c].dataType.simpleString() for d, c in ((docs, id_col), (benchmark, item_col)))
    schema = f"`{id_col}` {id_t}, `{item_col}` {item_t}, edits int, item_words int, start_word int, end_word int, similarity double"
    d = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    item_type = benchmark.schema[item_col].dataType

    def against(block: int) -> DataFrame:
        items = [(r.id, r.text) for r in b.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block).collect()]
        lengths = {len(x) for x in Index(items, edit_rate, repeats=_ONCE).seqs}
        repeats = {n: repeats_for(n, int(edit_rate * n), recall) for n in lengths}  # found once, here
        made: list[Index] = []

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not made:
                made.append(Index(items, edit_rate, recall, repeats))
            for batch in rows(batches, 4096):
                out = made[0].search(batch.column(1).to_pylist())
                if out:
                    at, item, edits, size_, a, e = (list(x) for x in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), _array(item, item_type), pa.array(edits, pa.int32()), pa.array(size_, pa.int32()),
                         pa.array(a, pa.int32()), pa.array(e, pa.int32()), pa.array(1 - np.array(edits) / np.array(size_))],
                        names=[id_col, item_col, "edits", "item_words", "start_word", "end_word", "similarity"])
        return d.mapInArrow(run, schema)

    return reduce(DataFrame.unionByName, [against(k) for k in range(n)])


def _array(values: list, spark_type) -> pa.Array:
    from pyspark.sql.pandas.types import to_arrow_type
    return pa.array(values, to_arrow_type(spark_type))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage. Rows without
    an id are judged by their own text."""
    named = contamination(docs, benchmark, id_col, text, **options).select(F.col(id_col).alias("_leak")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    kept = packed.where(F.col("_id").isNotNull()).join(named, F.col("_id") == F.col("_leak"), "left_anti").select("_row")
    bare = packed.where(F.col("_id").isNull()).withColumn("_key", F.xxhash64("_text"))
    leaks = contamination(bare.select(F.col("_key").alias(id_col), F.col("_text").alias(text)), benchmark, id_col, text, **options)
    bare = bare.join(leaks.select(F.col(id_col).alias("_leak")).distinct(), F.col("_key") == F.col("_leak"), "left_anti").select("_row")
    return kept.unionByName(bare).select("_row.*")
