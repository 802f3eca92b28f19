"""Near-duplicate documents: weighted signatures from hashed darts, banded joins and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfleet.llm.common import components, cut, filled, without

#: Words of a shingle, least weighted Jaccard similarity, bands and coordinates of a band.
WIDTH, SIMILARITY, BANDS, ROWS = 5, 0.8, 20, 5
#: Shingles and darts signed at once, and parts of the hash range in which overlaps are bounded.
THROWN, PARTS = 200_000, 64
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP, _WORD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, each one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def shingles(text: str, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed word windows of a whole text and how often each occurs. A text of fewer words has one
    window, all of them; a text without words has none."""
    words = text.encode("utf-8", "replace").split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    hashed = mixed(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    width = min(width, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = mixed(out * _WORD + hashed[i : i + len(out)] + _STEP)
    return np.unique(out, return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """DartMinHash of weighted sets, a row of ``size`` numbers each: two sets share each number with the
    probability of their weighted Jaccard similarity. Rows of empty sets are zeros.

    The weight axis of an item is cut into regions [2^v - 1, 2^(v+1) - 1). Darts hit a region in rank
    order as a Poisson stream of rate 2^v that depends on item and region only; each has a hashed weight
    and coordinate, and counts if its weight lies below the item's. The earliest dart of a coordinate is its
    number. Ranks are thrown up to a limit that gives a set about ``size ln size + 2 size`` darts; while a
    coordinate of a set is empty, its limit doubles and its streams go on.
    """
    out, rank = np.zeros(len(sets) * size, np.uint64), np.full(len(sets) * size, np.inf)
    total = np.array([float(w.sum()) for _, w in sets])
    limit = (size * np.log(size) + 2 * size) / np.maximum(total, 1)
    owner = np.repeat(np.arange(len(sets)), [len(i) for i, _ in sets])
    items = np.concatenate([i for i, _ in sets]) if sets else np.empty(0, np.uint64)
    weight = np.concatenate([w for _, w in sets]).astype(float) if sets else np.empty(0)
    key, low, high, own, doc = [], [], [], [], []
    v = 0
    while (inside := weight > 2**v - 1).any():
        with np.errstate(over="ignore"):
            key.append(mixed(items[inside] + _STEP * np.uint64(v + 1)))
        low.append(np.full(len(key[-1]), 2.0**v - 1))
        high.append(np.full(len(key[-1]), 2.0**v))
        own.append(weight[inside])
        doc.append(owner[inside])
        v += 1
    if not key:
        return out.reshape(len(sets), size)
    key, low, high, own, doc = (np.concatenate(x) for x in (key, low, high, own, doc))
    at, turn = np.zeros(len(key)), np.zeros(len(key), np.uint64)
    open_ = np.arange(len(key))
    while open_.size:
        live, slots, ranks, darts = open_, [], [], []
        while live.size:
            with np.errstate(over="ignore"):
                draw = mixed(key[live] + (turn[live] + np.uint64(1)) * _STEP)
            reached = at[live] - np.log(uniform(draw)) / high[live]
            hit = reached <= limit[doc[live]]
            live, reached, draw = live[hit], reached[hit], draw[hit]
            at[live] = reached
            turn[live] += np.uint64(1)
            with np.errstate(over="ignore"):
                dart = mixed(draw + _MIX1)
                kept = low[live] + uniform(mixed(dart + _MIX2)) * high[live] < own[live]
            slots.append(doc[live[kept]] * size + (dart[kept] % np.uint64(size)).astype(np.int64))
            ranks.append(reached[kept])
            darts.append(dart[kept])
        slot, when, dart = np.concatenate(slots), np.concatenate(ranks), np.concatenate(darts)
        order = np.lexsort((when, slot))
        slot, when, dart = slot[order], when[order], dart[order]
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        slot, when, dart = slot[first], when[first], dart[first]
        sooner = when < rank[slot]
        rank[slot[sooner]], out[slot[sooner]] = when[sooner], dart[sooner]
        missing = ~np.isfinite(rank).reshape(len(sets), size).all(axis=1)
        limit[missing] *= 2
        open_ = np.flatnonzero(missing[doc])
    return out.reshape(len(sets), size)


def band_keys(texts: list[str], bands: int = BANDS, rows: int = ROWS) -> list[list[int]]:
    """For each text one 64-bit key for each band of its signature; none for texts too short to have a full window.

    Texts are signed together until their shingles and darts reach ``THROWN``. A text of any length throws about
    the same number of darts, so for short texts the darts, not the shingles, are what takes memory.
    """
    out: list[list[int]] = [[] for _ in texts]
    darts = int(bands * rows * (np.log(bands * rows) + 2))
    start = 0
    while start < len(texts):
        sets, where, thrown = [], [], 0
        while start < len(texts) and thrown < THROWN:
            if len(texts[start].split(None, WIDTH)) >= WIDTH:
                sets.append(shingles(texts[start]))
                where.append(start)
                thrown += len(sets[-1][0]) + darts
            start += 1
        parts = signatures(sets, bands * rows).reshape(len(sets), bands, rows)
        key = np.tile(np.arange(bands, dtype=np.uint64), (len(sets), 1))
        with np.errstate(over="ignore"):
            for i in range(rows):
                key = mixed(key * _WORD + parts[:, :, i] + _STEP)
        for i, row in zip(where, key.view(np.int64).tolist(), strict=True):
            out[i] = row
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets of shingles; 0 if either is empty."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][left], b[1][right]).sum())
    either = int(a[1].sum()) + int(b[1].sum()) - both
    return both / either if either else 0.0


def sign(docs: DataFrame) -> DataFrame:
    """``doc_id, node, bands``: each document with the hash of its text and its band keys."""
    rows = docs.select("doc_id", F.xxhash64(filled(F.col("text"))).alias("node"), filled(F.col("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "node", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, node long, bands array<long>")


def verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose texts are as similar as asked.

    Texts are joined to pairs on either side; a node with many partners is one row that a split join repeats.
    """
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                keep = []
                for i, (x, y) in enumerate(zip(part.column("x"), part.column("y"), strict=True)):
                    if last[0] != a[i]:
                        last = (a[i], shingles(x.as_py()))
                    if similarity(last[1], shingles(y.as_py())) >= least:
                        keep.append(i)
                yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def shared_parts(texts: DataFrame) -> DataFrame:
    """For each text ``node, size, parts``: the weight of its shingles, and the weight of those that any other
    text here has too, in ``PARTS`` parts by hash."""

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text"), strict=True):
                found, weight = shingles(text.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), node)), pa.array(found.view(np.int64)), pa.array(weight.astype(np.int64))], ["node", "item", "w"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for text in batch.column("text"):
                found, weight = shingles(text.as_py())
                parts.append(np.bincount((found % np.uint64(PARTS)).astype(np.int64), weight, PARTS).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([int(p.sum()) for p in parts], pa.int64()), pa.array(parts, pa.list_(pa.int32()))], ["node", "size", "every"])

    rows = texts.mapInArrow(items, "node long, item long, w long")
    by_item = rows.groupBy("item").agg(F.min("node").alias("node"), F.max("node").alias("most"), F.sum("w").alias("w"))
    part = F.col("item").bitwiseAND(F.lit(PARTS - 1)).cast("int")
    alone = by_item.where("node = most").groupBy("node", part.alias("part")).agg(F.sum("w").alias("w"))
    alone = alone.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("part", "w"))).alias("alone"))
    whole = texts.mapInArrow(sums, "node long, size long, every array<int>").join(alone, "node", "left")
    left = F.transform("every", lambda c, i: (c - F.coalesce(F.element_at("alone", i), F.lit(0))).cast("int"))
    return whole.select("node", "size", F.when(F.col("alone").isNull(), F.col("every")).otherwise(left).alias("parts"))


def link(signed: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """Verified links between different texts, enough to join every class: ``(a, b)`` by node.

    Texts that share a band key are candidates. First every text of a bucket is compared with one leader,
    the text whose buckets are fullest, so a bucket of any size makes one pair per text. Buckets whose
    texts are in different classes after that are finished exactly: all their pairs across classes, but for
    those that cannot be similar. What two texts share lies within what each shares with any other text of
    these buckets, part by part of the hash range, so with sizes s and t the similarity is at most
    m / (s + t - m), where m sums the lesser weight of each of 64 parts. The variants of a text differ from
    each other by words of their own, and this bound tells them apart without pairing them.
    """
    nodes = signed.groupBy("node").agg(F.first("bands").alias("bands"), F.min("doc_id").alias("doc_id"))
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut(keyed.join(shared, "key"))
    wanted = members.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    found = docs.select(F.col("doc_id").alias("_id"), filled(F.col("text")).alias("text")).withColumn("_node", F.xxhash64("text"))
    texts = found.join(wanted, (F.col("_node") == F.col("node")) & F.col("_id").eqNullSafe(F.col("doc_id")))
    texts = cut(texts.groupBy("node").agg(F.first("text").alias("text")))

    fullest = members.groupBy("node").agg(F.sum("n").alias("full"))
    ranked = cut(members.join(fullest, "node"))
    leaders = ranked.groupBy("key").agg(F.max(F.struct("full", "node")).alias("m")).select("key", F.col("m.node").alias("a"))
    pairs = ranked.join(leaders, "key").where("node <> a")
    pairs = cut(pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct())
    links = cut(verify(pairs, texts, least))

    placed = members.join(components(links), "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    open_keys = placed.groupBy("key").agg((F.min("root") < F.max("root")).alias("more")).where("more").select("key")
    open_ = cut(placed.join(open_keys, "key"))
    bounds = shared_parts(texts.join(open_.select("node").distinct(), "node"))
    bounds = bounds.withColumn("shared", F.aggregate("parts", F.lit(0), lambda acc, c: acc + c))
    able = bounds.where(F.col("shared") >= F.lit(least - 1e-9) * F.col("size"))
    own_keys = open_.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    one = cut(open_.join(able.join(own_keys, "node"), "node"))
    names = ("key", "node", "root", "size", "shared", "parts", "keys")
    other = one.select([F.col(c).alias(f"{c}_b") for c in names])

    def enough(overlap: Column) -> Column:
        return overlap >= F.lit(least - 1e-9) * (F.col("size") + F.col("size_b") - overlap)

    common = F.aggregate(F.zip_with("parts", "parts_b", lambda x, y: F.least(x, y)), F.lit(0), lambda acc, c: acc + c)
    first = F.array_min(F.array_intersect("keys", "keys_b")) == F.col("key")  # a pair is made in one of its buckets
    near = (F.col("root") < F.col("root_b")) & enough(F.least("shared", "shared_b")) & first & enough(common)
    rest = one.join(other, (F.col("key") == F.col("key_b")) & near)
    rest = rest.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b"))
    rest = cut(rest.join(pairs, ["a", "b"], "left_anti"))
    return links.union(cut(verify(rest, texts, least)))


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: ``doc_id, node, class_id, class_size``.

    Documents are linked if their texts are equal, or if the multisets of their five-word windows have a
    weighted Jaccard similarity of ``least`` or more; classes are connected by links and named by their least
    ``doc_id``. Signatures of 100 numbers in 20 bands of 5 find a pair at 0.8 with probability 0.9996; every
    candidate is verified exactly. Copies are reduced to one text before any pair is made. Texts of under five words
    match equal texts only; null equals the empty text. Rows that repeat are in one class.
    """
    signed = cut(sign(docs))
    links = link(signed, docs, least)
    roots = components(links).withColumnRenamed("node", "_node")
    placed = signed.drop("bands").join(roots, F.col("node") == F.col("_node"), "left")
    placed = cut(placed.select("doc_id", "node", F.coalesce("root", "node").alias("_root")))
    named = placed.groupBy("_root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
                                        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("_first"))
    return placed.join(named, "_root").drop("_root")


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The document of least ``doc_id`` of each class, with the columns it had; of rows that repeat one stays."""
    first = classes(docs, least).select("_first").distinct().select(F.col("_first.doc_id").alias("_id"), F.col("_first.node").alias("_node"))
    docs = without(docs, ["_id", "_node", "_key", "_nth"])
    keyed = docs.withColumn("_key", F.xxhash64(filled(F.col("text"))))
    kept = keyed.join(first, (F.col("_key") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    nth = F.row_number().over(Window.partitionBy("_node", "_id").orderBy("_node"))
    return kept.withColumn("_nth", nth).where("_nth = 1").select([F.col(f"`{c}`") for c in docs.columns])
