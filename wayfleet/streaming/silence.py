"""Devices that fall silent: a record when a device has been quiet for too long, and another when it is back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wayfleet.schemas import MAX_GAP_SECONDS, WATERMARK
from wayfleet.streaming.event_order import EVENT, TIME, InOrder, in_order, milliseconds, timed, waiting_fields

END = "_end"


class Silence(InOrder):
    """Stretches of regular ticks in order; remembers the end of the last one and whether its silence was told."""

    memory, fresh = "last bigint, told boolean", (None, False)

    def __init__(self, waiting, device: str, limit: int, forget: int | None):
        super().__init__(waiting, forget)
        names = waiting.fieldNames()
        self.end, self.limit = names.index(END), limit
        self.made = Row(device, "since", "until")

    def until(self, row: tuple) -> int | None:
        return row[self.end]

    def trim(self, rows: list[tuple], memory: tuple) -> list[tuple]:
        """Stretches that a regular gap parts are one."""
        out: list[list] = []
        for row in rows:
            if out and row[self.time] - out[-1][self.end] <= self.limit:
                out[-1][self.end] = max(out[-1][self.end], row[self.end])
            else:
                out.append(list(row))
        return [tuple(r) for r in out]

    def take(self, key: tuple, row: tuple, memory: tuple) -> tuple[tuple, list[Row]]:
        last, told = memory
        if last is None:
            return (row[self.end], False), []
        back = row[self.time] - last > self.limit
        if row[self.end] > last:
            last, told, before = row[self.end], False, last
        return (last, told), [self.made(key[0], before, row[self.time])] if back else []

    def wake(self, key: tuple, memory: tuple, watermark: int) -> tuple[tuple, list[Row], int | None]:
        last, told = memory
        if last is None or told:
            return memory, [], None
        over = last + self.limit
        if over < watermark * 1000:
            return (last, True), [self.made(key[0], last, None)], None
        return memory, [], max(over // 1000 + 1, watermark + 1)


def _stretches(device: str, limit: int):
    """Ticks of every Arrow batch as stretches: event time of the end, start, end and device."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(TIME)))
            if not batch.num_rows:
                continue
            devices = batch.column(device).dictionary_encode().indices.fill_null(-1)
            order = pc.sort_indices(pa.table({"d": devices, "t": batch.column(TIME)}), sort_keys=[("d", "ascending"), ("t", "ascending")]).to_numpy()
            of, at = devices.to_numpy()[order], batch.column(TIME).to_numpy()[order]
            first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (at[1:] - at[:-1] > limit)])
            last = np.r_[first[1:], len(at)] - 1
            kept = batch.take(pa.array(order[last]))
            columns = [kept.column(EVENT), pa.array(at[first]), pa.array(at[last]), kept.column(device)]
            yield pa.RecordBatch.from_arrays(columns, [EVENT, TIME, END, device])

    return run


def silences(
    ticks: DataFrame,
    device: str = "device_id",
    time: str = "timestamp",
    limit: str = f"{MAX_GAP_SECONDS} seconds",
    delay: str = WATERMARK,
    forget: str | None = None,
) -> DataFrame:
    """``device, since, until, gap_us`` of every gap of more than ``limit`` between ticks of a device on a stream.

    When the watermark has passed a device's last tick by ``limit``, a record without ``until`` comes out, although no
    row has arrived; when the device is back, one with it. A gap whose end is known by then gives the second
    only, so ``(device, since)`` names a gap and the record with ``until`` is the later one. Ticks without time take
    no part; order within ``delay`` does not matter, and what comes later is dropped by Spark. ``ticks`` has no watermark yet.

    Every Arrow batch is reduced to stretches of regular ticks before the shuffle, and what waits in state is too, so
    neither grows with the number of ticks of a device that does not fall silent. A device's state goes when it has been
    silent for ``forget`` of event time (None: never); its return then gives no record.
    """
    microseconds = 1000 * milliseconds(limit)
    rows = timed(ticks.select(device, time), time, delay)
    # the event time keeps its field, which holds the watermark
    fields = StructType([rows.schema[EVENT], rows.schema[TIME], StructField(END, LongType()), rows.schema[device]])
    stretches = rows.mapInArrow(_stretches(device, microseconds), fields)
    result = StructType([rows.schema[device], StructField("since", LongType()), StructField("until", LongType())])
    processor = Silence(waiting_fields(stretches), device, microseconds, None if forget is None else milliseconds(forget))
    found = in_order(stretches, device, processor, result)
    return found.select(device, F.timestamp_micros("since").alias("since"), F.timestamp_micros("until").alias("until"), (F.col("until") - F.col("since")).alias("gap_us"))
