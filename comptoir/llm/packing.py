"""Best-fit packing by minimum bin slack.

Documents become token pieces (only documents longer than a sequence are cut).
The packing needs nothing but the histogram of piece lengths, which has at most
``capacity`` entries however many pieces there are. Per bin, the longest piece
left is set, and a subset-sum dynamic programme over bit sets finds the fullest
combination of the lengths left that completes it. The combination is removed
as many times as the counts allow, so the plan stays short at any scale.

Each piece then finds its sequence and offset from its rank among the pieces of
its length. The task that makes the pieces numbers those of each length as it
goes; how many of a length the tasks before it made is one small vector for each
task, from prefix sums of their counts. Pieces are written in buckets by task and
read again as they lie, joined with their task's vector: neither ids nor
lengths are ever shuffled, and a length that most pieces share is nothing special.

Null texts are empty documents; null ids and repeated rows are packed as any
other; documents of one length are interchangeable, so ties need no order; an
empty table gives no row; a very long text is cut into many pieces in its task.
Only the id and text columns are read, whatever others are called.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comptoir.llm._util import rows, stage
from comptoir.session import new_subdir

LENGTHS_AT_ONCE = 1024  # tasks whose counts of a length are summed up in one window


# -- tokens ---------------------------------------------------------------

class Encoder:
    """Byte-level BPE with the ids of a ``tokenizers`` file, from the rank file of
    the same vocabulary (several times faster). The file's added tokens are matched
    in texts, as ``tokenizers`` does. A text on which the fast encoder fails (about
    a million white-space characters in a row) is encoded whole by ``tokenizers``."""

    def __init__(self, rank_file: str, pattern: str, tokenizer_file: str):
        import tiktoken
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(tokenizer_file, encoding="utf-8") as f:
            added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
        self.tokenizer_file, self.whole = tokenizer_file, None

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        try:
            ids = self.bpe.encode(text, allowed_special="all")
        except BaseException as e:
            # The regex engine's stack ran out: a ValueError, or a panic, which is no Exception.
            if not isinstance(e, ValueError) and type(e).__name__ != "PanicException":
                raise
            ids = self._tokenizer().encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _tokenizer(self):
        if self.whole is None:
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_file(self.tokenizer_file)
        return self.whole


def public_encoder() -> Encoder:
    import public_tokenizers
    return Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json"))


def token_pieces(docs: DataFrame, capacity: int, end_id: int = 2, id_col: str = "doc_id", text: str = "text",
                 encoder: Callable[[], object] = public_encoder) -> DataFrame:
    """One row per piece: the id column, ``piece``, ``start`` (the document's ids
    before it), ``length``, ``ids`` (binary, little-endian unsigned 32-bit), ``part``
    (the task that made it) and ``nth`` (its number among the part's pieces of that length).

    A document is its ids and ``end_id``; null texts are empty. A longer one is
    cut into pieces of ``capacity``, of which the first may be shorter."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder()
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for b in rows(batches, 512):
            at, piece, start, ids, nth = [], [], [], [], []
            for i, t in enumerate(b.column(1)):
                data = made.encode(t.as_py() or "") + end
                n = len(data) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    at.append(i)
                    piece.append(k)
                    start.append(lo)
                    ids.append(data[4 * lo:4 * hi])
                    nth.append(int(seen[hi - lo]))
                    seen[hi - lo] += 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([part] * len(ids), pa.int32()), pa.array(nth, pa.int64())],
                names=[id_col, "piece", "start", "length", "ids", "part", "nth"])

    return docs.select(F.col(id_col), F.col(text).alias("text") if text != id_col else F.col(text)).mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start long, length long, ids binary, part int, nth long")


# -- plan -----------------------------------------------------------------

def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of the lengths (each as often as it is there) with the
    greatest sum up to ``room``; among equals one of long lengths."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for size in sorted((s for s, c in counts.items() if c and s <= room), reverse=True):
        left, take = min(counts[size], room // size), 1
        while left:
            take = min(take, left)
            steps.append((size, take, reach))
            reach |= (reach << (size * take)) & mask
            left -= take
            take *= 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for size, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[size] = chosen.get(size, 0) + take
            total -= size * take
    return chosen


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how often each is used; covers every piece."""
    counts = {s: c for s, c in histogram.items() if c}
    out = []
    while counts:
        longest = max(counts)
        if longest > capacity:
            raise ValueError(f"a piece of {longest} does not fit {capacity}")
        counts[longest] -= 1
        combo = fullest(counts, capacity - longest)
        counts[longest] += 1
        combo[longest] = combo.get(longest, 0) + 1
        times = min(counts[s] // n for s, n in combo.items())
        out.append((combo, times))
        for s, n in combo.items():
            counts[s] -= n * times
            if not counts[s]:
                del counts[s]
    return out


def _in_buckets(pieces: DataFrame) -> DataFrame:
    """``pieces`` written in buckets by ``part`` (a task's rows are of one part, so nothing moves) and read again."""
    spark = pieces.sparkSession
    path = new_subdir(spark, "pieces")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    (pieces.write.format("parquet").option("path", path)
     .bucketBy(max(1, pieces.rdd.getNumPartitions()), "part").saveAsTable(name))
    return spark.table(name)


def _earlier(counts: DataFrame, length: str) -> DataFrame:
    """(part, before): for each part, how many pieces of each length the parts before it made. Sums go in
    two levels, so that no window holds a length's counts of all parts."""
    group = F.floor(F.col("part") / LENGTHS_AT_ONCE)
    c = counts.withColumn("_g", group)
    inner = Window.partitionBy(length, "_g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(length).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    coarse = c.groupBy(length, "_g").agg(F.sum("n").alias("m")).withColumn("_base", F.coalesce(F.sum("m").over(outer), F.lit(0))).drop("m")
    each = c.withColumn("_in", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(coarse, [length, "_g"])
    entry = F.struct(F.col(length).cast("int").alias("l"), (F.col("_base") + F.col("_in")).alias("b"))
    # at most one entry a length
    return each.groupBy("part").agg(F.map_from_entries(F.collect_list(entry)).alias("before"))


def pack(pieces: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (long), without ``part`` and ``nth``
    (see :func:`token_pieces`), which must number the pieces of each length in each part from 0."""
    written = _in_buckets(pieces)
    counts = stage(written.groupBy("part", length).agg(F.count("*").alias("n")), "piece-counts")
    hist = {int(r[0]): int(r[1]) for r in counts.groupBy(length).agg(F.sum("n")).collect()}  # at most `capacity` rows
    made = plan(hist, capacity)
    keys, uses, base, offset = [], [], [], []
    used, sequence = dict.fromkeys(hist, 0), 0
    for combo, times in made:
        at = 0
        for size in sorted(combo, reverse=True):
            keys.append((size << 44) + used[size])
            uses.append(combo[size])
            base.append(sequence)
            offset.append(at)
            used[size] += combo[size] * times
            at += size * combo[size]
        sequence += times
    order_ = np.argsort(np.array(keys, np.int64))
    lookup = [np.array(x, np.int64)[order_] for x in (keys, uses, base, offset)]

    # The build side of the hash join is a vector for each part of the bucket.
    ranked = written.join(_earlier(counts, length).hint("shuffle_hash"), "part")
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    # Generated, not projected: a projection would be merged into the one above, and the part's whole vector would wait
    # with each of the rows that Python works on (16 KB a row).
    rank = F.struct((F.element_at("before", F.col(length).cast("int")) + F.col("nth")).alias("_rank"))
    ranked = ranked.select(*kept, F.inline_outer(F.array(rank)))

    # Only length and rank go to Python; the rest of a row stays where it is.
    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key, use, first, off = lookup
        size, rank = size.to_numpy(np.int64), rank.to_numpy(np.int64)
        k = np.searchsorted(key, (size << 44) + rank, side="right") - 1
        nth = rank - (key[k] & ((1 << 44) - 1))
        return pd.DataFrame({"sequence_id": first[k] + nth // use[k], "offset": off[k] + nth % use[k] * size})

    return ranked.withColumn("_place", place(length, "_rank")).select(*kept, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text: str = "text",
                   keep_ids: bool = True, encoder: Callable[[], object] = public_encoder) -> DataFrame:
    """Pieces of all documents with ``ids_crc32``, ``sequence_id`` and ``offset``; with
    ``keep_ids`` also ``ids`` (binary). Null ids and repeated rows are packed as
    any other; an empty table gives no row."""
    pieces = token_pieces(docs, capacity, end_id, id_col, text, encoder).withColumn("ids_crc32", F.crc32("ids"))
    if not keep_ids:
        pieces = pieces.drop("ids")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: ``sequence_id`` and its ``ids`` in order of offset (at most ``capacity`` of them)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"]))).alias("_hex")) \
        .select("sequence_id", F.unhex("_hex").alias("ids"))
