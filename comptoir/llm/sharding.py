"""Sharding by balanced label propagation, with DataFrame operations only.

Documents that share a link (equal texts, unless another expression is given)
should meet in one shard, and every shard holds the same number of rows, one
more or less. Documents start dealt round robin. Those of one link that start
in one shard are a node with a weight, so a hot link is a node for each shard
and no more. A round joins every node with the votes of its neighbours, that
is the rows of its link in each shard, and asks for the shard with most votes,
one with room for the whole link first. Requests from shard i to shard j are
met up to a quota, largest gain first: as many rows as ask to go from j to i,
and a share of the free room of j. Each round is written to the shared folder.

After the rounds documents without a link fill up the shards. They cut no edge
wherever they go. Rows of links beyond a shard's capacity are moved too, so
counts come out exact. Ranks come from counts of small hash buckets and their
prefix sums: no window holds a whole shard.

A link of more rows than a shard holds is cut into as few parts as two to a
shard. Null texts link with empty ones. Null and repeated ids are rows like
others (rows are told apart by their place in the input); an empty table gives
an empty result; very long texts are only hashed and measured; other columns
are not read, whatever their names; ties between shards go by a hash of link
and shard, so that they spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comptoir.llm._util import as_bytes, stage

ROUNDS = 10
BUCKET = 500  # rows aimed at in a bucket that is ranked in one task
COARSE = 1024  # buckets whose counts are summed up in one task
GAINS, SLICES = 40, 16  # classes of gain (powers of two) and hash slices in which requests are met
LOCAL = (1 << 33) - 1  # part of a row's number that counts within its partition


def _pick(values: list, index: Column) -> Column:
    """The entry of a short list (one for each shard) at ``index``."""
    return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), index)


def ranked(df: DataFrame, by: list[str], bucket: Column, order: list[str], to: str = "rank") -> DataFrame:
    """``df`` with a gapless rank from 0 within ``by``. Buckets are ranked each
    on their own; prefix sums of their counts, in two levels, give where each begins."""
    d = df.withColumn("_b", bucket)
    counts = d.groupBy(*by, "_b").agg(F.count("*").alias("_n")).withColumn("_c", F.floor(F.col("_b") / COARSE))
    inner = Window.partitionBy(*by, "_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*by).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    coarse = counts.groupBy(*by, "_c").agg(F.sum("_n").alias("_m")).withColumn("_base", F.coalesce(F.sum("_m").over(outer), F.lit(0))).drop("_m")
    starts = (counts.withColumn("_in", F.coalesce(F.sum("_n").over(inner), F.lit(0))).join(coarse, [*by, "_c"])
              .select(*by, "_b", (F.col("_base") + F.col("_in")).alias("_from")))
    place = F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*order))
    return (d.withColumn("_place", place).join(starts, [*by, "_b"])
            .withColumn(to, F.col("_from") + F.col("_place") - 1).drop("_b", "_place", "_from"))


def nodes(rows: DataFrame, shards: int, capacity: int) -> DataFrame:
    """(link, part, start, weight, at) of links of two rows or more. ``rows`` has link and start."""
    start = rows.where(F.col("link").isNotNull()).groupBy("link", "start").agg(F.count("*").alias("weight"))
    total = F.sum("weight").over(Window.partitionBy("link"))
    parts = F.when(F.col("total") > capacity, F.least(F.lit(shards), F.ceil(2 * F.col("total") / capacity))).otherwise(1)
    return (start.repartition("link").withColumn("total", total).where("total > 1")
            .select("link", (F.col("start") % parts).cast("int").alias("part"), "start", "weight", F.col("start").alias("at")))


def _quotas(asked: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], int]:
    """Rows that may go from shard i to shard j: swaps, and a share of the free room."""
    swap = {(i, j): min(n, asked.get((j, i), 0)) for (i, j), n in asked.items()}
    rest = [0] * len(free)
    for (i, j), n in asked.items():
        rest[j] += n - swap[i, j]
    return {(i, j): swap[i, j] + (0 if rest[j] == 0 else min(n - swap[i, j], (n - swap[i, j]) * max(0, free[j]) // rest[j]))
            for (i, j), n in asked.items()}


def propagate(node: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """``node`` with ``at`` moved towards neighbours, at most ``rounds`` times."""
    of = ["link", "part"]
    node = stage(node, "nodes")
    for _ in range(rounds):
        load = {r.at: r.n for r in node.groupBy("at").agg(F.sum("weight").alias("n")).collect()}  # a row a shard
        free = [capacity - load.get(s, 0) for s in range(shards)]
        here = node.repartition(*of)
        votes = here.groupBy(*of, "at").agg(F.sum("weight").alias("votes"))
        total = here.groupBy(*of).agg(F.sum("weight").alias("total"))
        fits = F.col("total") - F.col("votes") <= _pick(free, F.col("at"))
        best = (votes.join(total, of).groupBy(*of)
                .agg(F.max(F.struct(fits.alias("fits"), "votes", F.xxhash64(*of, "at").alias("tie"), F.col("at").alias("to"))).alias("best")))
        joined = here.join(votes, [*of, "at"]).join(best, of)
        gain = F.col("best.votes") - F.col("votes") + 1
        wish = joined.select(
            *of, "start", "weight", "at", F.when(F.col("best.to") != F.col("at"), F.col("best.to")).alias("to"),
            F.least(F.lit(GAINS - 1), F.floor(F.log2(F.greatest(gain, F.lit(1))))).cast("int").alias("gain"),
            F.pmod(F.xxhash64(F.lit("slice"), *of), F.lit(SLICES)).cast("int").alias("slice"))
        wish = stage(wish, "wishes")
        # At most shards^2 * GAINS * SLICES sums, whatever the number of documents.
        sums = wish.where("to IS NOT NULL").groupBy("at", "to", "gain", "slice").agg(F.sum("weight").alias("n"))
        asked = {(r.at, r.to): r.n for r in sums.groupBy("at", "to").agg(F.sum("n").alias("n")).collect()}
        allowed = {p: n for p, n in _quotas(asked, free).items() if n > 0}
        if not allowed:
            return wish.select(*of, "start", "weight", "at")
        quota = _pick([allowed.get((i, j), 0) for i in range(shards) for j in range(shards)], F.col("at") * shards + F.col("to"))
        upto = F.sum("n").over(Window.partitionBy("at", "to").orderBy(F.desc("gain"), "slice"))
        met = sums.withColumn("upto", upto).where(F.col("upto") <= quota).select("at", "to", "gain", "slice", F.lit(True).alias("met"))
        moved = wish.join(F.broadcast(met), ["at", "to", "gain", "slice"], "left")
        node = stage(moved.select(*of, "start", "weight", F.when(F.col("met"), F.col("to")).otherwise(F.col("at")).alias("at")), "nodes")
    return node


def shard(docs: DataFrame, shards: int = 24, link: Column | None = None, id_col: str = "doc_id", text: str = "text",
          rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: its id, ``size`` (bytes of the text and 8),
    ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in each shard). Shards
    differ by one row at most. ``link`` (null: none) is what linked documents share;
    by default a digest of the text."""
    data = as_bytes(text)
    link = F.unhex(F.sha2(data, 256)) if link is None else link
    row = F.monotonically_increasing_id()
    all_rows = stage(
        docs.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(data) + F.lit(8)).cast("long").alias("size"),
                    F.crc32(data).alias("crc"), link.alias("link"), row.alias("row"))
        .withColumn("start", F.pmod(F.col("row").bitwiseAND(LOCAL) + 7 * F.shiftright("row", 33), F.lit(shards)).cast("int")), "rows")
    n = all_rows.count()
    capacity = max(1, n // shards)
    node = propagate(nodes(all_rows, shards, capacity), shards, capacity, rounds)

    # Nodes of more than a thousandth of all rows are fewer than a thousand: broadcast. The others join by key.
    hot = node.where(F.col("weight") * 1000 > n).select("link", "start", "at")
    cold = node.where(F.col("weight") * 1000 <= n).select("link", "start", "at")
    buckets = F.lit(n // BUCKET + 1)
    by_row, by_link = (F.pmod(F.xxhash64(c), buckets) for c in ("row", "link"))
    in_hot = all_rows.join(F.broadcast(hot), ["link", "start"]).withColumn("bucket", by_row)
    others = all_rows.join(F.broadcast(hot), ["link", "start"], "left_anti")
    named, nameless = others.where("link IS NOT NULL"), others.where("link IS NULL").withColumn("at", F.lit(None).cast("int"))
    placed = named.join(cold, ["link", "start"], "left").unionByName(nameless).withColumn("bucket", F.when(F.col("at").isNull(), by_row).otherwise(by_link))
    placed = stage(placed.unionByName(in_hot), "placed")

    load = {r.at: r.n for r in placed.where("at IS NOT NULL").groupBy("at").agg(F.count("*").alias("n")).collect()}  # a row a shard
    load = [load.get(s, 0) for s in range(shards)]
    fullest = sorted(range(shards), key=lambda s: (-load[s], s))[:n % shards]
    room = [n // shards + (s in fullest) for s in range(shards)]
    stay = [min(a, b) for a, b in zip(load, room, strict=True)]
    free_rows = n - sum(load)
    over, ends = [free_rows], [0]  # rank among the movers at which a shard's surplus begins; at which its holes begin
    for s in range(shards):
        over.append(over[-1] + load[s] - stay[s])
        ends.append(ends[-1] + room[s] - stay[s])

    linked = ranked(placed.where("at IS NOT NULL"), ["at"], F.col("bucket"), ["link", "row"])
    stays = F.col("rank") < _pick(stay, F.col("at"))
    keeping = linked.select("id", "size", "crc", F.when(stays, F.col("at")).alias("shard"), F.when(stays, F.col("rank")).alias("slot"),
                            F.when(~stays, F.col("rank") - _pick(stay, F.col("at")) + _pick(over, F.col("at"))).alias("mover"))
    loose = ranked(placed.where("at IS NULL"), [], F.col("bucket"), ["row"])
    filling = loose.select("id", "size", "crc", F.lit(None).cast("int").alias("shard"), F.lit(None).cast("long").alias("slot"), F.col("rank").alias("mover"))
    out = keeping.unionByName(filling)
    hole = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends[1:]]), lambda e: e <= F.col("mover"))).cast("int")
    out = out.withColumn("hole", F.when(F.col("mover").isNotNull(), hole))
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.coalesce("shard", "hole").alias("shard"),
                      F.coalesce("slot", F.col("mover") - _pick(ends, F.col("hole")) + _pick(stay, F.col("hole"))).alias("slot"))
