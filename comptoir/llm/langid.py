"""Language identification: a linear-chain conditional random field over words.

Words (runs of letters, lower-cased) are observed through their beginnings and
endings, letter n-grams and membership in per-language lexicons; labels of
neighbouring words are tied by learned transitions. Training sequences join
stretches of different languages, so that the field learns how often text
switches. Inference is forward-backward over the whole text: word marginals,
whose mean over the words is the score of a document's languages.

It is trained on a bounded sample: ``PER_LANGUAGE`` documents of each language
(least hashes of the ids) outside the held-out third, by Adagrad on the exact
likelihood. A task holds the words of one slice of texts at a time.

Texts that are null or without a letter are ``und`` with score 0; so is every text
when there is nothing to learn from. Equal rows get equal predictions, and are
drawn for training once; languages of equal marginals go by their order; null ids
are predicted but never learned from; only the id, text and, to learn, language
columns are read, whatever others are called. An empty table gives no row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comptoir.llm._util import held_out

PER_LANGUAGE = 200
LEXICON = 300
MIN_COUNT = 3
SEQUENCE = 48
STEPS = 40
SLICE_CHARS = 4_000_000
SEGMENT = 256  # words of a text that are gone through one after another
KNOWN = 1 << 17  # words whose emissions a task remembers
LANGUAGES = 256  # languages learned at most: those with most documents
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+").findall


def words(text: str | None) -> list[str]:
    return [w for w in _WORD(text.lower()) if w.isascii() or any(map(str.isalpha, w))] if text else []


def observed(word: str, lexicons: list[frozenset[str]]) -> list[str]:
    """The features of a word."""
    n = len(word)
    out = [f"<{word[:k]}" for k in range(1, min(n, 4) + 1)] + [f"{word[-k:]}>" for k in range(1, min(n, 4) + 1)]
    out += [word[i:i + 2] for i in range(n - 1)] + [word[i:i + 3] for i in range(n - 2)] + [f"={c}" for c in set(word) if c > "z"]
    return out + [f"#{k}" for k, x in enumerate(lexicons) if word in x] + (["#long"] if n > 12 else [])


def _expand(feature_lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, feature_lists), np.int64, len(feature_lists))
    return np.fromiter(chain.from_iterable(feature_lists), np.int64, int(size.sum())), size


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class Field:
    """Weights of the features and transitions for the learned languages."""

    def __init__(self, texts: list[tuple[str, str]]):
        """``texts``: (language, text) of the sample."""
        split = [(lang, w) for lang, t in texts if (w := words(t))]
        self.languages = sorted({lang for lang, _ in split})
        k = len(self.languages)
        number = {lang: i for i, lang in enumerate(self.languages)}
        count = [Counter() for _ in range(k)]
        for lang, w in split:
            count[number[lang]].update(w)
        self.lexicons = [frozenset(w for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON] if n > 1) for c in count]
        types = {w: i for i, w in enumerate(sorted({w for c in count for w in c}))}
        seen: Counter = Counter()
        lists = [observed(w, self.lexicons) for w in types]
        for f in lists:
            seen.update(f)
        self.number = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= MIN_COUNT))}
        get = self.number.get
        at, size = _expand([[x for f in own if (x := get(f)) is not None] for own in lists])
        self.weights, self.moves = np.zeros((len(self.number), k)), np.zeros((k, k))
        if k:
            self._train(split, number, types, at, size)

    def _train(self, split, number, types, at, size) -> None:
        rng, k = np.random.default_rng(11), len(self.languages)
        # Sequences of SEQUENCE words, each of one to three stretches of different documents.
        pools: list[list[list[str]]] = [[] for _ in range(k)]
        for lang, w in split:
            pools[number[lang]] += [w[i:i + SEQUENCE] for i in range(0, len(w), SEQUENCE)]
        flat = [(y, s) for y, p in enumerate(pools) for s in p]
        order = rng.permutation(len(flat))
        x, y = [], []
        for j, i in enumerate(order):
            row, label = [], []
            for lang, s in (flat[i], flat[order[j - 1]], flat[order[j - 2]])[:1 + j % 3]:
                part = s[:SEQUENCE // (1 + j % 3)] if j % 3 else s
                row += [types[w] for w in part]
                label += [lang] * len(part)
            x.append(row[:SEQUENCE])
            y.append(label[:SEQUENCE])
        n = np.array([len(r) for r in x])
        X, Y = np.zeros((len(x), SEQUENCE), np.int64), np.zeros((len(x), SEQUENCE), np.int64)
        for i, (a, b) in enumerate(zip(x, y, strict=True)):
            X[i, :len(a)], Y[i, :len(b)] = a, b
        mask = np.arange(SEQUENCE)[None, :] < n[:, None]
        n_types = len(size)
        owner = np.repeat(np.arange(n_types), size)
        truth = np.stack([np.bincount(X[mask & (Y == c)], minlength=n_types) for c in range(k)], axis=1)
        pair = mask[:, 1:]
        true_moves = np.zeros((k, k))
        np.add.at(true_moves, (Y[:, :-1][pair], Y[:, 1:][pair]), 1)
        g2w, g2m = np.full(self.weights.shape, 1e-2), np.full((k, k), 1e-2)
        total = mask.sum()
        for _ in range(STEPS):
            em = self._emissions(at, size)
            E, T = np.exp(em - em.max(axis=1, keepdims=True)), np.exp(self.moves)
            S = len(x)
            alpha = np.zeros((SEQUENCE, S, k))
            a = np.full((S, k), 1.0 / k)
            for t in range(SEQUENCE):
                a = (a @ T if t else a) * E[X[:, t]]
                a /= a.sum(axis=1, keepdims=True)
                alpha[t] = a
            expect, moves = np.zeros((n_types, k)), np.zeros((k, k))
            b = np.ones((S, k))
            for t in range(SEQUENCE - 1, -1, -1):
                live = mask[:, t]
                g = alpha[t] * b
                g /= g.sum(axis=1, keepdims=True)
                for c in range(k):
                    expect[:, c] += np.bincount(X[live, t], weights=g[live, c], minlength=n_types)
                if t:
                    eb = E[X[:, t]] * b
                    joint = alpha[t - 1][live][:, :, None] * T[None] * eb[live][:, None, :]
                    moves += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                    b = np.where(live[:, None], eb @ T.T, b)
                    b /= b.sum(axis=1, keepdims=True)
            diff = (truth - expect) / total
            gw = np.stack([np.bincount(at, weights=diff[owner, c], minlength=len(self.number)) for c in range(k)], axis=1) - 1e-7 * self.weights
            gm = (true_moves - moves) / total
            g2w += gw * gw * 1e4
            g2m += gm * gm * 1e4
            self.weights += 0.3 * gw * 100 / np.sqrt(g2w)
            self.moves += 0.3 * gm * 100 / np.sqrt(g2m)

    def _emissions(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Sums of the feature weights of each word type."""
        whole = np.concatenate([np.zeros((1, self.weights.shape[1])), np.cumsum(self.weights[at], axis=0)])
        end = np.cumsum(size)
        return whole[end] - whole[end - size]

    def _emission_of(self, found: list[str]) -> np.ndarray:
        """Emissions (before scaling) of distinct words."""
        get = self.number.get
        return self._emissions(*_expand([[x for f in observed(w, self.lexicons) if (x := get(f)) is not None] for w in found]))

    def label(self, texts: list[str | None], known: dict[str, np.ndarray] | None = None) -> np.ndarray:
        """Mean word marginals (texts x languages); zero without words. ``known`` remembers scaled emissions of words.

        Texts are cut into segments of SEGMENT words, and all segments are gone through side by side. The
        product of a segment's k x k steps carries the forward message over it, and likewise the backward one, so the
        marginals are those of the whole text."""
        k = len(self.languages)
        split = [words(t) for t in texts] if k else [[] for _ in texts]
        n = np.array([len(w) for w in split], np.int64)
        out = np.zeros((len(texts), k))
        if not len(n) or not n.max():
            return out
        known = {} if known is None else known
        ids = _Numbers()
        flat = np.fromiter(map(ids.__getitem__, chain.from_iterable(split)), np.int64, int(n.sum()))
        fresh = [w for w in ids if w not in known]
        if fresh:
            em = self._emission_of(fresh)
            if len(known) + len(fresh) > KNOWN:
                for w in [w for w in known if w not in ids]:
                    del known[w]
            known.update(zip(fresh, np.exp(em - em.max(axis=1, keepdims=True)), strict=True))
        E, T = np.array([known[w] for w in ids]), np.exp(self.moves - self.moves.max())

        per = -(-n // SEGMENT)  # segments of each text
        first = np.cumsum(per) - per
        owner = np.repeat(np.arange(len(n)), per)
        nth = np.arange(len(owner)) - first[owner]
        start = (np.cumsum(n) - n)[owner] + nth * SEGMENT
        size = np.minimum(SEGMENT, n[owner] - nth * SEGMENT)
        order = np.argsort(-size, kind="stable")  # segments longer than t come first
        live = np.searchsorted(-size[order], -np.arange(int(size.max())), side="left")

        # Products of the steps of segments that have a neighbour in their text.
        linked = order[(per[owner] > 1)[order]]
        product = np.zeros((len(owner), k, k))
        product[linked] = np.eye(k)
        for t in range(SEGMENT if len(linked) else 0):
            at = linked[:np.searchsorted(-size[linked], -t, side="left")]
            if not len(at):
                break
            p = product[at]
            p = np.where(((nth[at] > 0) | (t > 0))[:, None, None], p @ T, p) * E[flat[start[at] + t]][:, None, :]
            product[at] = p / p.sum(axis=(1, 2), keepdims=True)
        enter, leave = np.full((len(owner), k), 1.0 / k), np.ones((len(owner), k))
        for j in range(1, int(per.max())):
            text = np.flatnonzero(per > j)
            a = (enter[first[text] + j - 1][:, None, :] @ product[first[text] + j - 1])[:, 0]
            enter[first[text] + j] = a / a.sum(axis=1, keepdims=True)
            last = first[text] + per[text] - j  # from the end
            b = (product[last] @ leave[last][:, :, None])[:, :, 0]
            leave[last - 1] = b / b.sum(axis=1, keepdims=True)

        alpha = np.zeros((len(flat), k), np.float32)
        a, begins = enter[order], (nth == 0)[order]
        for t, m in enumerate(live.tolist()):
            place = start[order[:m]] + t
            a = a[:m]
            a = np.where((begins[:m] & (t == 0))[:, None], a, a @ T) * E[flat[place]]
            a /= a.sum(axis=1, keepdims=True)
            alpha[place] = a
        b, total = leave[order], np.zeros((len(order), k))
        for t in range(len(live) - 1, -1, -1):
            m = int(live[t])
            place = start[order[:m]] + t
            g = alpha[place] * b[:m]
            g /= g.sum(axis=1, keepdims=True)
            total[:m] += g
            nb = (E[flat[place]] * b[:m]) @ T.T
            b[:m] = nb / nb.sum(axis=1, keepdims=True)
        np.add.at(out, owner[order], total)
        return out / np.maximum(n, 1)[:, None]


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Field:
    """Learn from the rows with a language and a text outside the held-out third."""
    d = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    d = d.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"))
    most = d.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    d = d.join(F.broadcast(most.select("lang")), "lang")
    # The least hashes in two levels: no task sees more than 64 * per_language rows of a language, beside its own.
    some = d.distinct().withColumn("s", F.pmod("h", F.lit(64)))
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("lang", "s").orderBy("h", "id"))).where(F.col("r") <= per_language)
    top = some.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))).where(F.col("r") <= per_language)
    # At most per_language ids of at most LANGUAGES languages: the broadcast has a bound.
    chosen = docs.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")).join(F.broadcast(top.select("id", "lang")), ["id", "lang"])
    got = chosen.groupBy("id", "lang").agg(F.max("text").alias("text")).collect()
    return Field([(r.lang, r.text) for r in sorted(got, key=lambda r: (r.lang, str(r.id)))])


def predict(docs: DataFrame, field: Field, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` (the mean marginal of that language) and
    ``languages``, the shares of all languages of at least one in a hundred."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = field.languages
        known: dict[str, np.ndarray] = {}
        for b in batches:
            texts = b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars < SLICE_CHARS):
                    chars += len(texts[end] or "")
                    end += 1
                p = field.label(texts[at:end], known)
                best = p.argmax(axis=1) if len(names) else np.zeros(end - at, np.int64)
                top = p[np.arange(end - at), best] if len(names) else np.zeros(end - at)
                shares = [[(names[j], float(r[j])) for j in np.flatnonzero(r >= 0.01).tolist()] for r in p]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, end - at), pa.array([names[i] if s > 0 else UNKNOWN for i, s in zip(best.tolist(), top.tolist(), strict=True)], pa.string()),
                     pa.array(np.clip(top, 0, 1), pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                    names=[id_col, "lang_pred", "score", "languages"])
                at = end

    return docs.select(id_col, F.col(text).alias("_text")).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double, languages map<string,double>")
