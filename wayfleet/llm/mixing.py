"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import WORD, cut, filled, ranked, row_key, without

#: Documents of one leaf, and children of one inner node, of the reduction tree.
LEAF, FAN_IN = 4096, 64
#: Undecided documents that a node hands on for each power of two of sizes.
LADDER = 3


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """Words each source should give: ``target`` beside ``source`` and ``source_size``.

    Sources in order of code points, null last, weigh ``weights`` over and over. They share the words
    of all sources; a target stops at ``cap`` times its source and the excess goes to the others by
    weight until no target is above. Sources without words have target 0.
    """
    placed = ranked(sizes, [F.col("source").asc_nulls_last()], "_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    placed = cut(placed.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * F.lit(float(cap))))
    total, heavy = placed.agg(F.sum("source_size"), F.sum("_weight")).first()
    level, held = (total or 0) / (heavy or 1.0), -1
    while True:
        full = F.col("_weight") * F.lit(level) >= F.col("_cap")
        n, fixed, free = placed.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight")))
        ).first()
        if n == held or not free:
            break
        held, level = n, ((total or 0) - (fixed or 0.0)) / free
    target = F.least(F.col("_weight") * F.lit(level), F.col("_cap"))
    return placed.withColumn("target", target).drop("_place", "_weight", "_cap")


def pivot(size: np.ndarray, mass: np.ndarray, order: np.ndarray, rng: np.random.Generator) -> int:
    """Pair undecided documents in turn and move expected words between them until one has none or all.

    ``mass`` holds the expected words of each document and changes in place; its sum never does, nor
    the expectation of any entry. Returns the index left undecided, or -1.
    """
    held = -1
    for j in order:
        if not 0 < mass[j] < size[j]:
            continue
        if held < 0:
            held = j
            continue
        i, a, b = held, mass[held], mass[j]
        up, down = min(size[i] - a, b), min(a, size[j] - b)
        if rng.random() * (up + down) < down:
            mass[i], mass[j] = (size[i] if up == size[i] - a else a + up), (0.0 if up == b else b - up)
        else:
            mass[i], mass[j] = (0.0 if down == a else a - down), (size[j] if down == size[j] - b else b + down)
        open_ = [k for k in (i, j) if 0 < mass[k] < size[k]]
        held = open_[0] if open_ else -1
    return held


def settle(size: np.ndarray, mass: np.ndarray, ladder: np.ndarray) -> None:
    """Decide the last documents of a source, largest first, so that their words sum up to their mass."""
    left = float(mass[ladder].sum())
    for i in sorted(ladder, key=lambda k: (-size[k], k)):
        take = size[i] <= left + 0.5
        mass[i] = size[i] if take else 0.0
        left -= mass[i]
    smallest = [i for i in ladder if mass[i] == 0 and size[i] > 0]
    if smallest:
        i = min(smallest, key=lambda k: (size[k], k))
        if abs(left - size[i]) < abs(left):
            mass[i] = size[i]


def _node(last: bool, seed: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "row", "doc_id"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        rng = np.random.default_rng(zlib.crc32(repr((seed, *map(str, key))).encode()))
        size, mass = rows["size"].to_numpy(float), rows["mass"].to_numpy(float).copy()
        open_ = np.flatnonzero((mass > 0) & (mass < size))
        step = pd.Series(np.frexp(size[open_])[1])
        kept = (step.groupby(step).cumcount() < LADDER).to_numpy()
        ladder = open_[kept]
        held = pivot(size, mass, open_[~kept], rng)
        if held >= 0:
            ladder = np.append(ladder, held)
        if last:
            settle(size, mass, ladder)
        undecided = np.zeros(len(rows), bool)
        undecided[ladder] = not last
        return rows.assign(mass=mass, open=undecided)

    return run


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, seed: int = 7) -> DataFrame:
    """How often the mix takes each document: ``doc_id, size, source, source_size, target, copies, row``.

    Each source gets ``target / source_size`` expected copies of each of its documents. The whole
    part is certain; the fractions are rounded by weighted pivotal rounding: pairs of documents swap
    expected words until one of the two is in or out, so each leaf of the tree ends with one undecided
    document and a short ladder of undecided ones of every order of size. Nodes merge the rest of
    their children, 64 at a time, and the root of each source spends the last words down the ladder,
    so a source misses its target by about its smallest documents. A source with a third of all rows
    is dealt to many leaves by row hash.

    Null text has size 0; documents of size 0 take their whole part only and add no words. Null sources
    are one source. Rows that repeat are rounded one by one and dealt to as many leaves as they fill. Ties are broken by row hash and ``doc_id``,
    so reruns agree. An empty table gives an empty result.
    """
    text = filled(F.col("text"))
    rows = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        row_key(F.col("doc_id"), F.col("text"), F.col("source")).alias("row"),
    )
    # rows that repeat are one row with a count until they are dealt
    rows = cut(rows.groupBy("doc_id", "source", "size", "row").agg(F.count(F.lit(1)).alias("_times")))
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_times")).alias("source_size"), F.sum("_times").alias("_n"))
    targets = cut(source_targets(sizes, weights, cap))
    widest = targets.agg(F.max("_n")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    other = targets.withColumnRenamed("source", "_source")
    # at most a leaf of copies of a row stays together
    blocks = F.explode(F.expr(f"sequence(0L, (_times - 1) div {LEAF})"))
    inside = F.explode(F.expr(f"sequence(1L, least({LEAF}, _times - _block * {LEAF}))"))
    rows = rows.withColumn("_block", blocks).withColumn("_copy", inside).drop("_copy", "_times")
    dealt = F.when(F.col("_block") == 0, F.col("row")).otherwise(F.xxhash64("row", "_block"))
    level = (
        rows.join(other, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("whole", F.floor(ratio + 1e-12))
        .withColumn("mass", F.greatest(ratio - F.col("whole"), F.lit(0.0)) * F.col("size"))
        .withColumn("node", F.pmod(dealt, F.ceil(F.col("_n") / LEAF)).cast("long"))
        .withColumn("open", F.lit(True)).drop("_n", "_block")
    )
    schema, decided = level.schema, []
    depth = 1 + max(0, math.ceil(math.log(max(1, math.ceil(widest / LEAF)), FAN_IN) - 1e-9))
    for step in range(depth):
        done = cut(level.groupBy("source", "node").applyInPandas(_node(step == depth - 1, seed + step), schema))
        decided.append(done.where(~F.col("open")))
        level = done.where("open").withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
    result = decided[0]
    for more in decided[1:]:
        result = result.union(more)
    copies = F.col("whole") + F.when((F.col("mass") > 0) & (F.col("mass") >= F.col("size")), 1).otherwise(0)
    return result.select("doc_id", "size", "source", "source_size", "target", copies.cast("long").alias("copies"), "row")


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it, with the columns they had.

    Documents of which the mix takes none go. Of rows that repeat, the copies they got together are dealt evenly.
    """
    totals = mix(docs, **options).groupBy("row").agg(F.sum("copies").alias("_all"), F.count(F.lit(1)).alias("_rows"))
    docs = without(docs, ["_all", "_rows", "_row", "_copies", "_nth"])
    from pyspark.sql import Window

    keyed = docs.withColumn("_row", row_key(F.col("doc_id"), F.col("text"), F.col("source").cast("string")))
    joined = keyed.join(totals.withColumnRenamed("row", "_key"), F.col("_row") == F.col("_key"))
    nth = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    copies = F.floor(F.col("_all") / F.col("_rows")) + F.when(F.col("_nth") <= F.col("_all") % F.col("_rows"), 1).otherwise(0)
    return (
        joined.withColumn("_nth", nth).withColumn("_copies", copies.cast("int")).where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select([F.col(f"`{c}`") for c in docs.columns])
    )
