"""SimHash near-duplicates: exact pairs within a few bits by tiled comparison.

Fingerprints are made in one pass without a shuffle. Equal ones are grouped
first, so copies cost one row. Distinct fingerprints are dealt to tiles by the
population counts of their four 16-bit quarters. Two fingerprints within ``r``
bits have quarter counts that differ by ``r`` in sum at most; so a tile meets
only the few tiles around it, and other tile pairs are skipped unread. Within
a tile pair, smaller blocks sorted by the counts of their eight bytes are
skipped by the same bound, and the rest compared exactly with numpy
exclusive-or and bit counts. A tile with many members is cut into blocks, and
all block pairs are compared in different tasks.

A block pair answers with a spanning forest of its links, never all pairs of a
group. The forests are joined to components by alternating star steps, each
written to the shared folder.

Null and empty texts have fingerprint zero; null ids take part in a component
but never name it (a component of null ids only has a null name). Repeated rows are rows of
one component; an empty table gives no row; very long texts are hashed whole; only the id and text columns
are read, whatever others are called, and ``keep_one`` returns the input's columns as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm._util import as_bytes, rows, stage

SEED = 42
QUARTERS, SIDE = 4, 17  # quarter counts are 0 to 16
CHUNK = 65_536  # shingles whose bits are summed at a time
BLOCK = 4096  # members of a tile compared in one task's step
FINE = 256  # fingerprints in a fine block


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words' shingles, repeats counted."""
    words = text.lower().split()  # bytes: splits at space and U+0009..U+000D, lowers A-Z only
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(whole, SEED)]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        h, seed = xxhash.xxh64_intdigest, SEED
        hashes = [h(whole[a:b], seed) for a, b in zip((end - size).tolist(), end[shingle - 1:].tolist(), strict=False)]
    n, ones = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = np.array(hashes[at:at + CHUNK], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp long) of every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 1024):
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["id", "fp"])

    d = docs.select(F.col(id_col).alias("id"), as_bytes(text).alias("data"))
    return d.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, fp long")


def _counts(fp: np.ndarray, parts: int) -> np.ndarray:
    """Population counts of the equal parts of unsigned fingerprints, low part first."""
    width = 64 // parts
    mask = np.uint64((1 << width) - 1)
    return np.stack([np.bitwise_count((fp >> np.uint64(i * width)) & mask) for i in range(parts)], axis=1).astype(np.int16)


def _offsets(radius: int) -> np.ndarray:
    """Steps to tiles of a smaller number within ``radius``, and the tile itself."""
    near = [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    return np.array([d for d in near if d <= (0,) * QUARTERS], np.int16)


def _deal(radius: int):
    """Each fingerprint to its own tile (home) and as a visitor to the smaller ones around it."""
    place = np.array([SIDE ** i for i in reversed(range(QUARTERS))], np.int64)
    steps = _offsets(radius)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 8192):
            fp = b.column(0).to_numpy(zero_copy_only=False)
            own = _counts(fp.view(np.uint64), QUARTERS)
            at = own[:, None, :] + steps[None, :, :]
            ok = ((at >= 0) & (at < SIDE)).all(axis=2)
            i, k = np.nonzero(ok)
            home = (steps[k] == 0).all(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array((at[i, k] @ place).astype(np.int32)), pa.array(fp[i]), pa.array(home)],
                                             names=["tile", "fp", "home"])
    return run


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of ``a`` and ``b`` pairwise; ``root`` maps to the least member, fully."""
    while True:
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            return
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def _forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, least member) of the links between two sets of fingerprints."""
    nodes, inverse = np.unique(np.concatenate([left, right]), return_inverse=True)
    root = np.arange(len(nodes))
    sides = []
    for part, at in ((left, inverse[:len(left)]), (right, inverse[len(left):])):
        u = part.view(np.uint64)
        c = _counts(u, 8)
        order = np.lexsort(c.T)
        u, c, at = u[order], c[order], at[order]
        cuts = range(0, len(u), FINE)
        sides.append([(u[i:i + FINE], at[i:i + FINE], c[i:i + FINE].min(axis=0), c[i:i + FINE].max(axis=0)) for i in cuts])
    if not sides[1]:
        return nodes[:0], nodes[:0]
    low = np.stack([x[2] for x in sides[1]])
    high = np.stack([x[3] for x in sides[1]])
    for u, at, lo, hi in sides[0]:
        gap = np.maximum(0, np.maximum(low - hi, lo - high)).sum(axis=1)
        for k in np.flatnonzero(gap <= radius):
            v, to = sides[1][k][:2]
            i, j = np.nonzero(np.bitwise_count(u[:, None] ^ v[None, :]) <= radius)
            if len(i):
                _merge(root, at[i], to[j])
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _compare(radius: int):
    """Streams of rows sorted by (tile, block): link forests of each block pair."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        key = None

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                fp, side = (np.concatenate(x) for x in zip(*held, strict=True))
                a, b = _forest(fp[side != 1], fp[side != 0], radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])
                held.clear()

        for batch in batches:
            tile, block, side, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            cut = np.flatnonzero((np.diff(tile) != 0) | (np.diff(block) != 0)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(tile)], strict=True):
                if lo < hi:
                    if key != (k := (tile[lo], block[lo])):
                        yield from close()
                        key = k
                    held.append((fp[lo:hi], side[lo:hi]))
        yield from close()
    return run


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Spanning forest edges (u, v), u > v, of the links within ``radius`` bits
    among distinct fingerprints (column ``fp``)."""
    dealt = distinct.select("fp").mapInArrow(_deal(radius), "tile int, fp long, home boolean")
    # At most 17^4 = 83,521 tiles: the table of the large ones has a bound and is broadcast.
    large = dealt.groupBy("tile").count().where(F.col("count") > BLOCK).select("tile", F.ceil(F.col("count") / BLOCK).cast("int").alias("n"))
    d = dealt.join(F.broadcast(large), "tile", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    other = F.sequence(F.lit(0), F.col("n") - 1)
    # side 0: left of the pair, 1: right, 2: both (its own block with itself)
    as_right = F.transform(other, lambda a: F.struct((a * F.col("n") + own).alias("block"), F.when(F.col("home") & (a == own), 2).otherwise(1).alias("side")))
    as_left = F.transform(F.filter(other, lambda b: F.col("home") & (b != own)), lambda b: F.struct((own * F.col("n") + b).alias("block"), F.lit(0).alias("side")))
    placed = d.select("tile", "fp", F.explode(F.concat(as_right, as_left)).alias("p")).select("tile", "p.block", F.col("p.side").cast("int").alias("side"), "fp")
    return placed.repartition("tile", "block").sortWithinPartitions("tile", "block").mapInArrow(_compare(radius), "u long, v long")


def connect(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (u, v): root is the least node of
    the component. Alternates large-star and small-star steps until nothing
    changes; steps and components stay distributed."""
    def both(e: DataFrame) -> DataFrame:
        return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        n = both(e) if large else e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = n.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        j = n.join(least, "u")
        if large:
            out = j.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return out.where(F.col("u") != F.col("v")).distinct()

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    e = stage(edges.where(F.col("u") != F.col("v")).distinct(), "links")
    seen = mark(e)
    while True:
        e = stage(star(star(e, True), False), "stars")
        now = mark(e)
        if now == seen:
            break
        seen = now
    nodes = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return nodes.unionByName(roots).groupBy("node").agg(F.min("root").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` (long) and ``component_id``, the
    smallest id reachable over links of at most ``radius`` differing bits."""
    fps = stage(fingerprints(docs, shingle, id_col, text), "fingerprints")
    distinct = stage(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    comp = connect(links(distinct, radius))
    rooted = distinct.join(comp, distinct["fp"] == comp["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(named, "root").select("fp", "component_id")
    return fps.join(of, "fp", "left").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id. Rows
    that repeat an id are one document, of which the least row stays. Rows
    without an id can't be told apart by it and stay."""
    near = near_duplicates(docs, shingle, radius, id_col, text)
    ids = near.groupBy(F.col(id_col).alias("_kept")).agg(
        F.count("*").alias("_rows"), F.max(F.col(id_col) == F.col("component_id")).alias("_stays"))
    ids = stage(ids.where("_stays").drop("_stays"), "kept-ids")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"))
    once = packed.join(ids.where("_rows = 1"), F.col("_id") == F.col("_kept")).select("_row")
    again = packed.join(ids.where("_rows > 1"), F.col("_id") == F.col("_kept")).groupBy("_id").agg(F.min("_row").alias("_row")).select("_row")
    nameless = packed.where(F.col("_id").isNull()).select("_row")
    return once.unionByName(again).unionByName(nameless).select("_row.*")
