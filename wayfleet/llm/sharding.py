"""Sharding by balanced label propagation: linked documents meet in a shard while shards stay even in bytes."""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfleet.llm.common import cut, filled, gapless

#: Cells a group is dealt into per shard, steps of size per power of two, priority steps within a gain.
PIECES, STEPS, DRAWS = 10, 32, 16


def _lookup(values: dict[int, int], at: Column, default: int) -> Column:
    """A small table (one entry per shard) as an expression."""
    pairs = [part for k, v in values.items() for part in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), at), F.lit(default)) if pairs else F.lit(default)


def propagate(cells: DataFrame, shards: int, capacity: float, rounds: int) -> DataFrame:
    """Move cells of linked documents towards the shard that holds most of their neighbours.

    ``cells``: ``key, piece, n, bytes, shard``; cells of one key are neighbours. In each round a cell
    prefers the shard with most documents of its key among the shards with room, and may move if that shard
    is ahead of its own. Moves into a shard are taken by gain, then by hash, until its quota of bytes
    (its room, and what is about to leave it) is used up; the order is cut at a step of a histogram of
    ``shards`` x 512 rows, so that no list of movers is ever sorted in one place.
    """
    for _ in range(rounds):
        loads = {r["shard"]: r["b"] for r in cells.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
        room = {s: int(capacity - loads.get(s, 0)) for s in range(shards)}
        free = [s for s in range(shards) if room[s] > 0.01 * capacity] or [max(room, key=room.get)]
        votes = cut(cells.groupBy("key", "shard").agg(F.sum("n").alias("v")))
        tie = F.pmod(F.xxhash64("key", "shard"), F.lit(1 << 30))
        best = votes.where(F.col("shard").isin(free)).groupBy("key").agg(F.max(F.struct("v", tie.alias("tie"), "shard")).alias("best"))
        own = votes.withColumn("own", F.struct("v", tie.alias("tie"), "shard")).select("key", "shard", "own")
        wish = cells.join(own, ["key", "shard"]).join(best, "key", "left")
        gain = F.greatest(F.col("best.v") - F.col("own.v") + F.col("n"), F.lit(1))
        step = (31 - F.least(F.floor(F.log2(gain)), F.lit(31))) * DRAWS + F.pmod(F.xxhash64("key", "piece"), F.lit(DRAWS))
        wish = cut(wish.select("key", "piece", "n", "bytes", "shard", F.when(F.col("best") > F.col("own"), F.col("best.shard")).alias("to"), step.cast("int").alias("step")))
        movers = wish.where("to IS NOT NULL")
        leaving = {r["shard"]: r["b"] for r in movers.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
        if not leaving:
            return cells
        quota = _lookup({s: room[s] + leaving.get(s, 0) // 2 for s in range(shards)}, F.col("to"), 0)
        upto = Window.partitionBy("to").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
        flows = movers.groupBy("to", "step").agg(F.sum("bytes").alias("b")).withColumn("upto", F.sum("b").over(upto))
        cuts = {r["to"]: r["last"] for r in flows.where(F.col("upto") <= quota).groupBy("to").agg(F.max("step").alias("last")).collect()}
        if not cuts:
            return cells
        goes = F.col("to").isNotNull() & (F.col("step") <= _lookup(cuts, F.col("to"), -1))
        cells = cut(wish.withColumn("shard", F.when(goes, F.col("to")).otherwise(F.col("shard"))).drop("to", "step"))
    return cells


def settled(cells: DataFrame, shards: int, capacity: float) -> DataFrame:
    """The cells that stay where they are: those with a neighbour in their shard, up to its capacity."""
    votes = cells.groupBy("key", "shard").agg(F.sum("n").alias("v"))
    tied = cells.join(votes, ["key", "shard"]).where("v >= 2")
    step = (31 - F.least(F.floor(F.log2("v")), F.lit(31))) * DRAWS + F.pmod(F.xxhash64("piece", "key"), F.lit(DRAWS))
    tied = cut(tied.withColumn("step", step.cast("int")))
    upto = Window.partitionBy("shard").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    flows = tied.groupBy("shard", "step").agg(F.sum("bytes").alias("b")).withColumn("upto", F.sum("b").over(upto))
    cuts = {r["shard"]: r["last"] for r in flows.where(F.col("upto") <= F.lit(capacity)).groupBy("shard").agg(F.max("step").alias("last")).collect()}
    return tied.where(F.col("step") <= _lookup(cuts, F.col("shard"), -1)).select("key", "piece", "bytes", "shard")


def level(loads: list[float], bins: list[tuple[int, int, float]]) -> dict[int, list[int]]:
    """Deal bins of like sizes to shards, largest sizes first, so that loads come out even.

    ``bins``: number, rows, bytes. Returns for each bin the running count of rows up to each shard.
    """
    loads, ends = list(loads), {}
    for number, rows, size in sorted(bins, key=lambda b: -b[2] / b[1]):
        mean, counts = size / rows, [0] * len(loads)
        if rows > 4 * len(loads):
            low, high = min(loads), max(loads) + mean * rows
            for _ in range(80):
                mid = (low + high) / 2
                fits = sum(int(max(0.0, mid - x) / mean) for x in loads) <= rows
                low, high = (mid, high) if fits else (low, mid)
            counts = [int(max(0.0, low - x) / mean) for x in loads]
        heap = [(x + c * mean, s) for s, (x, c) in enumerate(zip(loads, counts, strict=True))]
        heapq.heapify(heap)
        for _ in range(rows - sum(counts)):
            x, s = heapq.heappop(heap)
            counts[s] += 1
            heapq.heappush(heap, (x + mean, s))
        loads = [x + c * mean for x, c in zip(loads, counts, strict=True)]
        total, ends[number] = 0, []
        for c in counts:
            total += c
            ends[number].append(total)
    return ends


def shard(docs: DataFrame, shards: int = 24, rounds: int = 6) -> DataFrame:
    """Put every document into one of ``shards`` shards of near equal bytes: ``doc_id, size, text_crc32, key, shard, slot``.

    ``size`` is the UTF-8 length of the text plus 8; null text has none and equals the empty text. Documents
    of equal text are linked. Groups start dealt over all shards by hash of ``doc_id`` (10 cells a shard, so a
    group of a third of all rows is many cells) and label propagation draws them together under
    capacity. Then documents without a neighbour in their shard even the shards out: they are binned by
    size (32 bins a power of two), the driver sees rows and bytes of each bin, and
    each bin is dealt by rank. ``slot`` numbers a shard's documents from 0 without gaps. Rows that
    repeat are documents of their own; null ids share one cell of their group. An empty table gives an empty result.
    """
    text = filled(F.col("text"))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("key"), F.pmod(F.xxhash64("doc_id"), F.lit(shards * PIECES)).cast("int").alias("piece"),
    )
    rows = cut(rows)
    capacity = (rows.agg(F.sum("size")).first()[0] or 0) / shards
    cells = rows.groupBy("key", "piece").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    groups = cells.groupBy("key").agg(F.sum("n").alias("all")).where("all >= 2").select("key")
    linked = cut(cells.join(groups, "key").withColumn("shard", (F.col("piece") % shards).cast("int")))
    stay = cut(settled(propagate(linked, shards, capacity, rounds), shards, capacity))
    loads = [0.0] * shards
    for r in stay.groupBy("shard").agg(F.sum("bytes").alias("b")).collect():
        loads[r["shard"]] = float(r["b"])
    placed = cut(rows.join(stay.drop("bytes"), ["key", "piece"], "left"))
    free = placed.where("shard IS NULL").drop("shard").withColumn("bin", F.floor(F.log2("size") * STEPS).cast("int"))
    free = cut(gapless(cut(free), "bin", ["doc_id", "text_crc32"], "rank"))
    bins = [(r["bin"], r["n"], float(r["b"])) for r in free.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).collect()]
    ends = json.dumps([{"bin": b, "ends": e} for b, e in level(loads, bins).items()])
    plan = docs.sparkSession.range(1).select(F.explode(F.from_json(F.lit(ends), "array<struct<bin:int,ends:array<bigint>>>")).alias("p")).select("p.bin", "p.ends")
    dealt = free.join(F.broadcast(plan), "bin")  # one row per bin: at most 32 for each power of two of sizes
    dealt = dealt.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("rank"))))
    columns = ["doc_id", "size", "text_crc32", "key", "shard"]
    whole = cut(placed.where("shard IS NOT NULL").select(columns).union(dealt.select(columns)))
    return gapless(whole, "shard", ["doc_id", "text_crc32"], "slot")
