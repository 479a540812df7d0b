"""Quality classifier: a weak-label model and a hashed linear scorer.

Eight heuristic labellers vote good, bad or nothing on a document. Their
accuracies are not known: expectation-maximisation estimates, for each class,
how often each labeller votes what, from the counts of the vote patterns of
all documents (3^8 patterns at most). The posterior of a pattern labels a
bounded sample of documents (``MAX_TRAIN``, least hashes of the ids), on which a
logistic scorer over hashed words, word shapes and coarse measures is trained.
Every document is then scored from its text alone.

Null and empty texts are scored as texts without a word. An empty table gives
no rows. Repeated rows get equal scores and count as often as they come in the vote patterns; a score of
the threshold itself is kept; very long texts are read whole; only the named columns are read, whatever others
are called.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm._util import as_bytes, rows, stage
from comptoir.llm.rules import STOP_WORDS

MAX_TRAIN = 6000
BITS = 15
EPOCHS = 6
GOOD, BAD, NONE = 1, 0, 2
_STOPS = frozenset(w.encode() for lang in STOP_WORDS for w in lang.split())
_SHAPE = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))


def measure(data: bytes) -> dict[str, float]:
    words = data.split()
    n = len(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    lower = data.lower().split()
    fours = set(zip(lower, lower[1:], lower[2:], lower[3:], strict=False)) if n > 3 else ()
    return {
        "n": n,
        "symbols": (len(data) - len(data.translate(None, b"#*$%&|<>"))) / max(1, n),
        "marks": (len(data) - len(data.translate(None, b"!?"))) / max(1, n),
        "upper": (len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / max(1, len(data)),
        "stops": sum(map(_STOPS.__contains__, lower)) / max(1, n),
        "dup_lines": 1 - len(set(lines)) / len(lines) if lines else 0.0,
        "fresh": len(fours) / (n - 3) if n > 3 else 1.0,
        "closed": sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":") for x in lines) / max(1, len(lines)),
        "length": sum(map(len, words)) / max(1, n),
    }


#: Labellers: (measure, is bad, is good); neither is no vote.
LABELLERS = (
    ("symbols", lambda x: x > 0.2, lambda x: x < 0.02),
    ("marks", lambda x: x > 0.5, lambda x: x < 0.1),
    ("upper", lambda x: x > 0.25, lambda x: x < 0.06),
    ("stops", lambda x: x < 0.03, lambda x: x > 0.12),
    ("dup_lines", lambda x: x > 0.3, lambda x: x == 0),
    ("fresh", lambda x: x < 0.6, lambda x: x > 0.9),
    ("n", lambda x: x < 20, lambda x: x >= 60),
    ("closed", lambda x: x < 0.2, lambda x: x > 0.6),
)


def votes(m: dict[str, float]) -> int:
    """The votes as one number in base 3."""
    v = 0
    for name, bad, good in LABELLERS:
        v = 3 * v + (BAD if bad(m[name]) else GOOD if good(m[name]) else NONE)
    return v


def _unpack(patterns: np.ndarray) -> np.ndarray:
    k = len(LABELLERS)
    return np.stack([patterns // 3 ** (k - 1 - j) % 3 for j in range(k)], axis=1)


class LabelModel:
    """Vote probabilities per labeller and class, and the share of good documents."""

    def __init__(self, counts: dict[int, int], steps: int = 200):
        patterns = np.array(sorted(counts), np.int64)
        n = np.array([counts[int(p)] for p in patterns], np.float64)
        v = _unpack(patterns)
        k = len(LABELLERS)
        good = ((v == GOOD).sum(axis=1) + 1) / ((v != NONE).sum(axis=1) + 2)  # majority
        for _ in range(steps):
            self.share = float((n @ good + 1) / (n.sum() + 2)) if len(n) else 0.5
            # probability of each vote given the class, smoothed
            self.table = np.ones((2, k, 3))
            for c, p in ((0, 1 - good), (1, good)):
                for j in range(k):
                    self.table[c, j] += np.bincount(v[:, j], weights=n * p, minlength=3) if len(n) else 0
            self.table /= self.table.sum(axis=2, keepdims=True)
            if not len(n):
                break
            new = self.posterior(patterns)
            if np.abs(new - good).max() < 1e-9:
                break
            good = new

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that documents with these votes are good."""
        v, j = _unpack(patterns), np.arange(len(LABELLERS))
        log = np.log(self.table[:, j, v]).sum(axis=2)
        odds = log[1] - log[0] + np.log(self.share) - np.log1p(-self.share)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    def accuracies(self) -> dict[str, float]:
        """How often each labeller that votes is right."""
        p = np.array([1 - self.share, self.share])
        right = p[0] * self.table[0, :, BAD] + p[1] * self.table[1, :, GOOD]
        cast = (p[:, None] * (1 - self.table[:, :, NONE])).sum(axis=0)
        return {name: float(r / c) for (name, _, _), r, c in zip(LABELLERS, right, cast, strict=True)}


def features(data: bytes, m: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed (place, value): words and shapes by log count, measures by rank."""
    # Distinct words and shapes are hashed once, with their counts.
    counts = [*((b"w:" + w, n) for w, n in Counter(data.lower().split()).items()),
              *((b"s:" + _squeeze(w), n) for w, n in Counter(data.translate(_SHAPE).split()).items())]
    at = np.fromiter((zlib.crc32(name) for name, _ in counts), np.int64, len(counts)) & ((1 << BITS) - 1)
    place, which = np.unique(at, return_inverse=True)
    value = np.log1p(np.bincount(which, weights=[n for _, n in counts], minlength=len(place)))
    value /= max(1e-9, np.sqrt((value ** 2).sum()))
    coarse = [f"{k}:{int(min(20, x * 20)) if k not in ('n', 'length') else int(np.log2(x + 1))}".encode() for k, x in m.items()]
    extra = np.array([zlib.crc32(c) & ((1 << BITS) - 1) for c in coarse], np.int64)
    return np.concatenate([place, extra]), np.concatenate([value, np.full(len(extra), 0.5)])


@lru_cache(maxsize=1 << 14)
def _squeeze(shape: bytes) -> bytes:
    return bytes(c for i, c in enumerate(shape) if i == 0 or shape[i - 1] != c) if len(shape) < 64 else b"long"


def train(rows_: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias) of a logistic scorer for soft targets: Adagrad in a fixed order."""
    w, g2 = np.zeros((1 << BITS) + 1), np.full((1 << BITS) + 1, 1e-3)
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows_)):
            at, x = rows_[i]
            at, x = np.append(at, 1 << BITS), np.append(x, 1.0)
            g = (1 / (1 + np.exp(-np.clip(w[at] @ x, -30, 30))) - target[i]) * x
            np.add.at(g2, at, g * g)
            np.add.at(w, at, -0.2 * g / np.sqrt(g2[at]))
    return w


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_train: int = MAX_TRAIN) -> tuple[LabelModel, np.ndarray]:
    d = docs.select(F.col(id_col).alias("id"), as_bytes(text).alias("data"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 1024):
            yield pa.RecordBatch.from_arrays([pa.array([votes(measure(t.as_py())) for t in b.column(0)], pa.int32())], names=["votes"])

    counts = {r.votes: r["count"] for r in d.select("data").mapInArrow(run, "votes int").groupBy("votes").count().collect()}
    labels = LabelModel(counts)
    # A bounded sample by hash: at most max_train ids, then their texts.
    chosen = stage(d.select("id").where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(max_train), "train-ids")
    sample = d.join(F.broadcast(chosen), "id").groupBy("id").agg(F.max("data").alias("data"))

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 256):
            out = [(v := measure(t), features(t, v), votes(v)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": b.column(0).cast(pa.string()), "at": pa.array([f[0].astype("<i4").tobytes() for _, f, _ in out], pa.binary()),
                                              "x": pa.array([f[1].astype("<f4").tobytes() for _, f, _ in out], pa.binary()), "votes": pa.array([k for _, _, k in out], pa.int32())})

    got = sorted(sample.select("id", "data").mapInArrow(extract, "id string, at binary, x binary, votes int").collect(), key=lambda r: r.id)
    target = labels.posterior(np.array([r.votes for r in got], np.int64)) if got else np.zeros(0)
    return labels, train([(np.frombuffer(r.at, "<i4").astype(np.int64), np.frombuffer(r.x, "<f4").astype(np.float64)) for r in got], target)


def score(docs: DataFrame, model: tuple[LabelModel, np.ndarray], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``score`` of the linear scorer, ``posterior`` of the label model and ``kept`` (score of 0.5 or more)."""
    labels, w = model
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 512):
            s, v = [], []
            for t in b.column(1).to_pylist():
                m = measure(t)
                at, x = features(t, m)
                s.append(1 / (1 + np.exp(-np.clip(w[at] @ x + w[-1], -30, 30))))
                v.append(votes(m))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array(labels.posterior(np.array(v, np.int64)), pa.float64())],
                                             names=[id_col, "score", "posterior"])

    d = docs.select(F.col(id_col), as_bytes(text).alias("_data"))
    return d.mapInArrow(run, f"`{id_col}` {kind}, score double, posterior double").withColumn("kept", F.col("score") >= 0.5)
