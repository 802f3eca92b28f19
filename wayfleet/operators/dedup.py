"""Deduplication of re-delivered records."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.schemas import WATERMARK

RECORD = ("id", "timestamp")
ARRIVED, COPY_OF = "_arrived", "_copy_of"


def _drop_copies_in_batch(keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = batch.select(keys).to_pandas().duplicated().to_numpy()
            yield batch.filter(pa.array(~copies)) if copies.any() else batch

    return run


def known_by(records: DataFrame, key: str = "id") -> Column:
    """What tells records apart: the key, or for a row without one its whole content."""
    content = F.to_json(F.struct(*(F.col(f"`{c}`") for c in records.columns)))
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.concat(F.lit("c"), content))


def dedup_stream(records: DataFrame, key: str = "id", delay: str = WATERMARK, combine: bool = False) -> DataFrame:
    """Drop records that are delivered again within ``delay`` of their first arrival; lose nothing else.

    A record is known by ``key``; a row without one is known by its whole content, so different rows
    are never taken for copies. What clears the state is the time at which a row reaches the query (the
    time of its batch, kept in the offset log), not its event time: late records land, and no
    record's clock can make others late. A copy that comes after ``delay`` is kept.

    The stateful operator shuffles by key without combining first. ``combine`` drops copies inside each
    Arrow batch before that, for streams where one record may hold a large share of a batch; it takes all
    rows through Python.
    """
    marked = records.withColumn(COPY_OF, known_by(records, key))
    if combine:
        marked = marked.mapInArrow(_drop_copies_in_batch([COPY_OF]), marked.schema)
    arrived = marked.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, delay)
    return arrived.dropDuplicatesWithinWatermark([COPY_OF]).drop(COPY_OF, ARRIVED)


def dedup_in_event_time(records: DataFrame, keys: tuple[str, ...], time_col: str, delay: str = WATERMARK) -> DataFrame:
    """One row per key on a stream whose watermark is its event time, ahead of joins that need one.

    ``records`` has no watermark yet and ``keys`` holds the event time. Rows behind the watermark
    are dropped, as the joins behind this would drop them.
    """
    return records.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def dedup_table(records: DataFrame, keys: tuple[str, ...] = RECORD) -> DataFrame:
    """Batch form: an aggregation, so Spark itself combines copies before the shuffle."""
    return records.dropDuplicates(list(keys))
