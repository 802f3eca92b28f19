"""Exact top-k inner-product search by tiled matrix products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import cut

#: Rows of a candidate tile and of a query tile, lists merged by one node of the tree, rows dealt to one task.
SHARD, QUERIES, FAN_IN, TASK_ROWS = 4096, 512, 16, 65_536
#: Query tiles that meet a shard in one task.
BLOCK = 4
TILE = "tile long, n long, dim long, width int, ids binary, data binary"
LISTS = "query_tile long, part long, n long, query_ids binary, counts binary, ids binary, scores binary"


def usable(vector: Column) -> Column:
    """The vector is there and holds finite numbers only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~bad


def _pack(rows: int):
    """Rows to tiles: ids and a matrix in the narrowest integer type that holds it."""

    def one(ids: list, vectors: list, place: int) -> pd.DataFrame:
        dim = max((len(v) for v in vectors), default=0)
        matrix = np.zeros((len(ids), dim), np.float64)
        for i, v in enumerate(vectors):
            matrix[i, : len(v)] = v
        most = np.nextafter(2.0**63, 0)  # the largest double that is a long
        matrix = np.clip(matrix, -most, most).astype(np.int64)
        order = np.argsort(np.asarray(ids, np.int64), kind="stable")
        top = int(np.abs(matrix).max(initial=0))
        kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(k).max)
        data = np.ascontiguousarray(matrix[order].astype(kind))
        packed = np.asarray(ids, np.int64)[order].tobytes()
        return pd.DataFrame([(place, len(ids), dim, np.dtype(kind).itemsize, packed, data.tobytes())], columns=["tile", "n", "dim", "width", "ids", "data"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, made, ids, vectors = TaskContext.get().partitionId(), 0, [], []
        for frame in frames:
            for i, v in zip(frame["vec_id"].tolist(), frame["ints"].tolist(), strict=True):
                ids.append(i)
                vectors.append(v)
                if len(ids) == rows:
                    yield one(ids, vectors, part << 32 | made)
                    made, ids, vectors = made + 1, [], []
        if ids:
            yield one(ids, vectors, part << 32 | made)

    return run


def _matrix(data: bytes, n: int, dim: int, width: int) -> np.ndarray:
    return np.frombuffer(data, f"i{width}").reshape(n, dim)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows: as doubles where they are exact, else as whole numbers."""
    dim = max(left.shape[1], right.shape[1])
    left, right = (np.pad(m, ((0, 0), (0, dim - m.shape[1]))) for m in (left, right))
    bound = int(np.abs(left.astype(np.int64)).max(initial=0)) * int(np.abs(right.astype(np.int64)).max(initial=0)) * max(1, dim)
    if bound < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if bound < 2**63:
        return left.astype(np.int64) @ right.astype(np.int64).T
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best columns of each row, ties to the smaller id: counts, then ids and scores row by row.

    ``ids`` ascend, so the first of equal scores is the one to keep; ``own`` is the id each row leaves out.
    """
    counts, out_ids, out_scores = [], [], []
    every = np.arange(len(ids))
    for row, first, last in zip(scores, np.searchsorted(ids, own), np.searchsorted(ids, own, "right"), strict=True):
        # all rows of the own id leave first, however many there are
        at = np.concatenate([every[:first], every[last:]]) if last > first else every
        if len(at) > 2 * k + 8:
            others = row[at]
            floor = np.partition(others, len(at) - k)[len(at) - k]
            at = at[np.concatenate([np.flatnonzero(others > floor), np.flatnonzero(others == floor)[:k]])]
        at = at[np.lexsort((ids[at], -row[at]))][:k]
        counts.append(len(at))
        out_ids.append(ids[at])
        out_scores.append(row[at])
    return np.array(counts, np.int64), np.concatenate(out_ids), np.concatenate(out_scores)


def _search(k: int):
    def run(asked: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        found = []
        for q in asked.itertuples(index=False):
            queries, own = _matrix(q.data, q.n, q.dim, q.width), np.frombuffer(q.ids, np.int64)
            for r in shards.itertuples(index=False):
                counts, ids, scores = best(products(queries, _matrix(r.data, r.n, r.dim, r.width)), np.frombuffer(r.ids, np.int64), own, k)
                found.append((q.tile, r.part, q.n, q.ids, counts.tobytes(), ids.tobytes(), scores.tobytes()))
        return pd.DataFrame(found, columns=[c.split()[0] for c in LISTS.split(", ")])

    return run


def _merge(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "ids"], kind="stable")
        n = int(rows["n"].iloc[0])
        query = np.concatenate([np.repeat(np.arange(n), np.frombuffer(c, np.int64)) for c in rows["counts"]])
        ids = np.concatenate([np.frombuffer(b, np.int64) for b in rows["ids"]])
        scores = np.concatenate([np.frombuffer(b, np.int64) for b in rows["scores"]])
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        start = np.searchsorted(query, np.arange(n))
        kept = np.arange(len(query)) - start[query] < k
        counts = np.bincount(query[kept], minlength=n).astype(np.int64)
        first = rows.iloc[0]
        return pd.DataFrame([(first.query_tile, first.part, n, first.query_ids, counts.tobytes(), ids[kept].tobytes(), scores[kept].tobytes())], columns=rows.columns)

    return run


def _rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for r in frame.itertuples(index=False):
            counts = np.frombuffer(r.counts, np.int64)
            rank = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + 1
            yield pd.DataFrame({
                "query_id": np.repeat(np.frombuffer(r.query_ids, np.int64), counts), "rank": rank.astype(np.int32),
                "vec_id": np.frombuffer(r.ids, np.int64), "score": np.frombuffer(r.scores, np.int64),
            })


def top_k(queries: DataFrame, rows: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` rows of highest integer inner product for each query, without the query's own id.

    Both frames hold ``vec_id`` and ``ints`` (array of whole numbers as doubles). Result: ``query_id, rank,
    vec_id, score``, ties to the smaller ``vec_id``, fewer rows where there are fewer candidates.

    Rows become tiles of at most 4,096 (queries: 512), dealt evenly whatever their ids. Every query tile
    meets every shard: that is the stated query set against all rows, in blocks. A task multiplies two tiles
    at a time and keeps ``k`` per query; lists are merged 16 at a time up a tree. Vectors of unequal length
    are filled up with zeros, only components and scores beyond a long are held to its range, an id that repeats is
    answered (and found) once for each of its rows, and null ids take no part.
    """
    spark = rows.sparkSession

    def tiles(frame: DataFrame, size: int) -> DataFrame:
        frame = frame.where("vec_id IS NOT NULL")
        parts = max(spark.sparkContext.defaultParallelism, -(-frame.count() // TASK_ROWS))
        return cut(frame.repartition(parts).mapInPandas(_pack(size), TILE))

    asked, shards = tiles(queries, QUERIES), tiles(rows, SHARD)
    groups, blocks = shards.count(), max(1, -(-asked.count() // BLOCK))
    if not groups:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def dealt(frame: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("tile"), F.lit(parts)).cast("long")
        return frame.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))

    left = dealt(asked, "block", blocks, "part", groups).groupBy("part", "block")
    right = dealt(shards, "part", groups, "block", blocks).groupBy("part", "block")
    lists = left.cogroup(right).applyInPandas(_search(k), LISTS)
    width = groups
    while width > 1:
        width = -(-width // FAN_IN)
        lists = lists.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long"))
        lists = lists.groupBy("query_tile", "part").applyInPandas(_merge(k), LISTS)
    return lists.groupBy("query_tile").applyInPandas(_merge(k), LISTS).mapInPandas(_rows, "query_id long, rank int, vec_id long, score long")
