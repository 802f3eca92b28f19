"""Trip truncation on a stream: devices stop being published while the trip is still running."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row

from wayfleet.schemas import ARRIVAL_TOLERANCE, DESTINATION, MAX_TICKS, WATERMARK
from wayfleet.streaming.event_order import TIME, InOrder, as_times, in_order, milliseconds, numbered, timed, waiting_fields


class TripEnd(InOrder):
    """Publishes the ticks of a device until the first one at the destination or ``max_ticks`` of them."""

    memory, fresh = "published int, ended boolean", (0, False)

    def __init__(self, waiting, order: Sequence[str], target, max_ticks: int, forget: int | None):
        super().__init__(waiting, forget)
        names = waiting.fieldNames()
        self.order = [names.index(c) for c in order]
        self.lat, self.lon = names.index("lat"), names.index("lon")
        self.target, self.max_ticks = target, max_ticks
        self.names = [n for n in names if n != TIME]
        self.places = [names.index(n) for n in self.names]

    def key(self, row: tuple) -> tuple:
        return tuple((row[i] is not None, 0 if row[i] is None else row[i]) for i in self.order)

    def arrived(self, row: tuple) -> bool:
        if row[self.lat] is None or row[self.lon] is None:
            return False
        return all(abs(x - y) <= ARRIVAL_TOLERANCE for x, y in zip((row[self.lat], row[self.lon]), self.target, strict=True))

    def trim(self, rows: list[tuple], memory: tuple) -> list[tuple]:
        """What is behind an arrival, or behind as many ticks as may still be published, never will be: rows that are
        yet to come only push it further back."""
        published, ended = memory
        if ended:
            return []
        rows = rows[: self.max_ticks - published]
        end = next((i + 1 for i, row in enumerate(rows) if self.arrived(row)), len(rows))
        return rows[:end]

    def take(self, key: tuple, row: tuple, memory: tuple) -> tuple[tuple, list[Row]]:
        published, ended = memory
        if ended or self.arrived(row):
            return (published, True), []
        made = Row(*self.names, "rn")(*(row[i] for i in self.places), published + 1)
        return (published + 1, published + 1 >= self.max_ticks), [made]


def _leading(device: str, order: Sequence[str], n: int):
    """The first ``n`` rows of each device in every Arrow batch; no other can be among the first ``n`` of the device."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows <= n:
                yield batch
                continue
            devices = batch.column(device).dictionary_encode().indices.fill_null(-1)
            keys = pa.table({"d": devices, **{f"k{i}": batch.column(c) for i, c in enumerate(order)}})
            by = [("d", "ascending"), *((f"k{i}", "ascending") for i in range(len(order)))]
            sorted_ = pc.sort_indices(keys, sort_keys=by, null_placement="at_start").to_numpy()
            of = devices.to_numpy()[sorted_]
            place = np.arange(len(of)) - np.searchsorted(of, of)
            yield batch if place.max() < n else batch.take(pa.array(np.sort(sorted_[place < n])))

    return run


def truncate_stream(
    ticks: DataFrame,
    device: str = "device_id",
    order: tuple[str, ...] = ("timestamp", "id"),
    target=DESTINATION,
    max_ticks: int = MAX_TICKS,
    delay: str = WATERMARK,
    forget: str | None = None,
) -> DataFrame:
    """Streaming form of ``truncate_trips``: the same rows, in event-time order, wherever batches begin and end.

    A tick is published when the watermark (``delay`` behind the latest event time) has passed it, so a tick or an
    arrival that comes late by less counts in its place; Spark drops what comes later. Ticks without time
    are numbered when they come. ``ticks`` has no watermark yet.

    At most ``max_ticks`` rows of a device wait, and none behind an arrival; once a trip has ended only a counter and a
    flag are left. They go when the device has been silent for ``forget`` of event time (None: never); should
    it come back after that, it starts anew. The map side passes on at most ``max_ticks`` rows per device and Arrow
    batch, so a device that sends a large share of the stream does not fill its task.
    """
    rows = timed(ticks, order[0], delay)
    leading = rows.mapInArrow(_leading(device, order, max_ticks), rows.schema)
    fields = waiting_fields(rows)
    processor = TripEnd(fields, order, target, max_ticks, None if forget is None else milliseconds(forget))
    result = numbered(type(fields)([f for f in fields if f.name != TIME]), "rn")
    return as_times(in_order(leading, device, processor, result), ticks.schema)
