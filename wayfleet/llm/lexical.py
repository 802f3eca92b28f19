"""Ranked lexical search: item vocabulary tiles times document impact tiles, as dense products that stay exact."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from wayfleet.llm.common import cut

#: Terms of items that are searched for in one pass over the documents (a longer item has a pass of its own), items and
#: terms of a vocabulary tile, documents of an impact tile, candidates a task keeps before it drops the hopeless ones,
#: lists that one step of the merge puts together.
PASS, ITEMS, TERMS, DOCS, HELD, FAN_IN = 250_000, 256, 2_048, 1_024, 200_000, 64
#: Sums below this are exact in doubles.
EXACT = 2**53
#: Bytes that part terms become spaces, A-Z become a-z; all other bytes, those of letters beyond ASCII among them, stay.
_PARTED = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: letters and digits of ASCII and everything beyond it; A-Z lower-cased, nothing else."""
    return text.translate(_PARTED).split()


class Queries(NamedTuple):
    """Items of one pass, by number from 0: the terms of all of them, and item and term of every entry, by item."""

    number: dict[bytes, int]
    item: np.ndarray
    term: np.ndarray


def weights(counts: np.ndarray, documents: int) -> np.ndarray:
    """Whole weight of each term, from the number of documents that hold it."""
    logs = {df: math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in set(counts.tolist())}
    return np.array([logs[df] for df in counts.tolist()], np.int64)


def impacts(times: np.ndarray, lengths: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Whole impact of a term that occurs so many times in a document of that many terms."""
    if int(lengths.max(initial=0)) * documents * 50 < 2**63:
        measure = 50 + (50 * lengths * documents) // words
    else:
        measure = np.array([50 + 50 * n * documents // words for n in lengths.tolist()], np.int64)
    return (1_000_000_000 * times) // (1000 * times + 20 * measure)


def tiles(queries: Queries, weight: np.ndarray) -> list[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """Vocabulary tiles: first item and end of each group of items, with the terms that occur in them and their weights
    as a dense matrix of terms by items, in pieces of at most 2,048 terms."""
    made = []
    n = int(queries.item[-1]) + 1 if queries.item.size else 0
    for first in range(0, n, ITEMS):
        end = min(n, first + ITEMS)
        a, b = np.searchsorted(queries.item, [first, end])
        vocabulary, column = np.unique(queries.term[a:b], return_inverse=True)
        pieces = []
        for start in range(0, len(vocabulary), TERMS):
            own = vocabulary[start : start + TERMS]
            matrix = np.zeros((len(own), end - first))
            inside = (column >= start) & (column < start + TERMS)
            matrix[column[inside] - start, queries.item[a:b][inside] - first] = weight[queries.term[a:b][inside]]
            pieces.append((own, matrix))
        made.append((first, end, pieces))
    return made


def scores(piece: tuple[np.ndarray, np.ndarray], row: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, column: np.ndarray) -> np.ndarray:
    """Partial scores, documents by items, of one vocabulary tile; entries ``row, term, impact`` are those of an impact tile.

    ``column`` is scratch space, one place for each term, -1 throughout. Terms that no document of the tile holds are
    left out, and the others are multiplied in groups whose sums stay exact.
    """
    own, matrix = piece
    column[own] = np.arange(len(own))
    inside = np.flatnonzero(column[term] >= 0)
    used, at = np.unique(column[term[inside]], return_inverse=True)
    column[own] = -1
    total = np.zeros((docs, matrix.shape[1]), np.int64)
    if not used.size:
        return total
    most = int(matrix[used].max(initial=0)) * int(impact[inside].max(initial=0))
    step = max(1, (EXACT - 1) // max(1, most))
    for start in range(0, len(used), step):
        group = used[start : start + step]
        chosen = (at >= start) & (at < start + step)
        dense = np.zeros((docs, len(group)))
        dense[row[inside[chosen]], at[chosen] - start] = impact[inside[chosen]]
        total += (dense @ matrix[group]).astype(np.int64)
    return total


class Best:
    """The k best candidates of each item so far: highest score, then least id, no id last. Ties with the k-th stay."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.ones(items, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, first: int, found: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        """Scores of a tile, documents by items from ``first`` on."""
        limit = self.floor[first : first + found.shape[1]]
        if len(found) > self.k:
            # no more than the k best of the tile and their ties can matter
            at = len(found) - self.k
            limit = np.maximum(limit, np.partition(found, at, axis=0)[at])
        doc, item = np.nonzero(found >= limit)
        if doc.size:
            self.parts.append((item + first, found[doc, item], none[doc], ids[doc]))
            self.held += len(doc)
        if self.held > HELD:
            self.parts = [self.kept()]
            item, score, _, _ = self.parts[0]
            full = np.flatnonzero(np.bincount(item, minlength=len(self.floor)) == self.k)
            ends = np.searchsorted(item, full, "right") - 1
            self.floor[full] = score[ends]
            self.held = len(item)

    def kept(self) -> tuple[np.ndarray, ...]:
        """Item, score, whether there is no id, and id of the k best of each item, in order."""
        if not self.parts:
            none = np.empty(0, np.int64)
            return none, none, none.astype(bool), none
        item, score, none, ids = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((ids, none, -score, item))
        item, score, none, ids = item[order], score[order], none[order], ids[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        first = place < self.k
        return item[first], score[first], none[first], ids[first]


def _counted(queries) -> callable:
    """Arrow function: the number of terms of each text with any, and the items' terms among them with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = queries.value.number
        for batch in batches:
            ids, n, term, times, ends = [], [], [], [], [0]
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                found = terms(text or b"")
                if not found:
                    continue
                counted = Counter(found)
                known = counted.keys() & number.keys()
                ids.append(doc_id)
                n.append(len(found))
                term += [number[t] for t in known]
                times += [counted[t] for t in known]
                ends.append(len(term))
            ends = pa.array(ends, pa.int32())
            listed = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int64())) for v in (term, times)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), *listed], ["doc_id", "n", "term", "times"])

    return run


def _frequencies(size: int) -> callable:
    """Arrow function: documents that hold each term, and in the row of term -1 all documents and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, words = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            held += np.bincount(batch.column("term").flatten().to_numpy(), minlength=size)
            documents += batch.num_rows
            words += int(batch.column("n").to_numpy().sum())
        there = np.flatnonzero(held)
        columns = [np.r_[-1, there], np.r_[documents, held[there]], np.r_[words, np.zeros(len(there), np.int64)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["term", "documents", "words"])

    return run


def _searched(queries, weight, documents: int, words: int, items: int, k: int) -> callable:
    """Arrow function: the k best documents of a task for every item of the pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = tiles(queries.value, weight.value)
        column = np.full(len(weight.value), -1, np.int64)
        best = Best(items, k)
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS):
                part = batch.slice(start, DOCS)
                ids = part.column("doc_id")
                none = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                sizes = np.diff(part.column("term").offsets.to_numpy())
                row = np.repeat(np.arange(len(ids)), sizes)
                term, times = (part.column(c).flatten().to_numpy() for c in ("term", "times"))
                impact = impacts(times, part.column("n").to_numpy()[row], documents, words)
                for first, end, pieces in vocabulary:
                    found = np.zeros((len(ids), end - first), np.int64)
                    for piece in pieces:
                        found += scores(piece, row, term, impact, len(ids), column)
                    best.add(first, found, ids, none)
        item, score, none, ids = best.kept()
        made = [pa.array(item, pa.int64()), pa.array(ids, pa.int64(), mask=none), pa.array(score, pa.int64())]
        yield pa.RecordBatch.from_arrays(made, ["item", "doc_id", "score"])

    return run


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every item with their ``rank``, put together 64 lists at a time up a tree."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    parts = found.rdd.getNumPartitions()
    found = found.withColumn("_part", F.spark_partition_id())
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        found = found.withColumn("_part", F.expr(f"_part div {FAN_IN}").cast("int"))
        place = F.row_number().over(Window.partitionBy("item", "_part").orderBy(*order))
        found = found.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")
    place = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return found.drop("_part").withColumn("rank", place).where(F.col("rank") <= k)


def _passes(items: DataFrame) -> Iterator[tuple[list, Queries]]:
    """Ids and queries of one pass after another, each of at most 250,000 entries or a single item."""
    ids, number, item, term = [], {}, [], []
    for row in items.select("item_id", "text").toLocalIterator():
        own = dict.fromkeys(terms((row["text"] or "").encode("utf-8", "replace")))
        if item and len(item) + len(own) > PASS:
            yield ids, Queries(number, np.array(item, np.int64), np.array(term, np.int64))
            ids, number, item, term = [], {}, [], []
        if own:  # an item without terms has no documents
            item += [len(ids)] * len(own)
            term += [number.setdefault(t, len(number)) for t in own]
            ids.append(row["item_id"])
    if ids:
        yield ids, Queries(number, np.array(item, np.int64), np.array(term, np.int64))


def _one_pass(spark: SparkSession, docs: DataFrame, ids: list, queries: Queries, k: int) -> DataFrame:
    context = spark.sparkContext
    shared = context.broadcast(queries)
    counted = cut(docs.mapInArrow(_counted(shared), "doc_id long, n long, term array<long>, times array<long>"))
    held = counted.mapInArrow(_frequencies(len(queries.number)), "term long, documents long, words long")
    totals = held.groupBy("term").agg(F.sum("documents").alias("documents"), F.sum("words").alias("words")).collect()
    frequency = np.zeros(len(queries.number), np.int64)
    documents = words = 0
    for row in totals:  # one row for each term of the pass
        if row["term"] < 0:
            documents, words = row["documents"], row["words"]
        else:
            frequency[row["term"]] = row["documents"]
    weight = context.broadcast(weights(frequency, documents))
    run = _searched(shared, weight, documents, max(1, words), len(ids), k)
    best = _merged(counted.mapInArrow(run, "item long, doc_id long, score long"), k)
    names = spark.createDataFrame([Row(item=i, item_id=x) for i, x in enumerate(ids)], "item long, item_id long")
    return best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank_documents(items: DataFrame, docs: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` documents of highest lexical score for every item: ``item_id, rank, doc_id, score``.

    ``items`` holds ``item_id, text`` and ``docs`` holds ``doc_id, text`` (ids are whole numbers); other columns take no part.
    With N documents of at least one term, L terms in all of them, n terms in a document, df documents that hold a
    term and tf occurrences in one, the score is the sum over the item's different terms of floor(1000 * ln((2N + 2) / (2df + 1)))
    * (10^9 tf div (1000 tf + 20 m)), m = 50 + 50 n N div L. Scores above 0 are ranked from 1, equal ones by ``doc_id``, none last.

    Null and empty texts have no terms: such items get no rows, such documents do not count. An id that repeats, in either
    table, is answered or found once for each of its rows. Documents stay where they are read: each keeps the counts
    of the items' terms in a checkpoint, and tasks multiply tiles of 1,024 documents by tiles of 256 items and at most 2,048 terms.
    Only items travel: to the driver and from there to all tasks, in passes of at most 250,000 terms (or one item).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = None
    for ids, queries in _passes(items):
        own = _one_pass(spark, docs, ids, queries, k)
        found = own if found is None else found.union(own)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found
