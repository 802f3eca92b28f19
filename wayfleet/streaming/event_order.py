"""Rows of a stream in event-time order per device, whatever order they arrive in: buffer, timers and end of state."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

#: Event time of a row for the watermark, and the same in microseconds for the order.
EVENT, TIME = "_event", "_time"


def milliseconds(interval: str) -> int:
    """Length of an interval such as ``2 minutes`` or ``1 day 30 seconds``."""
    units = {"day": 86_400_000, "hour": 3_600_000, "minute": 60_000, "second": 1000, "millisecond": 1}
    words = interval.split()
    pairs = list(zip(words[::2], words[1::2], strict=True))
    if not pairs or any(unit.rstrip("s") not in units for _, unit in pairs):
        raise ValueError(f"not an interval: {interval!r}")
    return sum(int(n) * units[unit.rstrip("s")] for n, unit in pairs)


def as_times(rows: DataFrame, like: StructType) -> DataFrame:
    """Microseconds back to timestamps where ``like`` has them; other columns stay."""
    kinds = {f.name: f.dataType for f in like}
    return rows.select([F.timestamp_micros(F.col(f"`{c}`")).alias(c) if isinstance(kinds.get(c), TimestampType) else F.col(f"`{c}`") for c in rows.columns])


def timed(rows: DataFrame, time: str, delay: str) -> DataFrame:
    """The rows with their event time, its watermark, and all timestamps as microseconds, which pass through Python
    unchanged whatever the year."""
    marked = rows.withColumn(EVENT, F.col(time)).withWatermark(EVENT, delay)

    def whole(field: StructField) -> Column:
        column = F.col(f"`{field.name}`")
        return F.unix_micros(column).alias(field.name) if isinstance(field.dataType, TimestampType) else column

    return marked.select(EVENT, F.unix_micros(time).alias(TIME), *map(whole, rows.schema))


class InOrder(StatefulProcessor):
    """Hands the rows of a device to ``take`` in event-time order as soon as none can come before them.

    A row waits until the watermark has passed its time; Spark drops what arrives behind the watermark, so the order is
    final. One timer per device releases what is due; with nothing waiting it is set to when the device is to be
    forgotten (``forget`` milliseconds of event time after its last row), and then its state is deleted.
    Subclasses define ``memory`` (DDL of what they remember), ``fresh`` (its first value) and ``take``.
    """

    memory = ""
    fresh: tuple = ()

    def __init__(self, waiting: StructType, forget: int | None):
        self.fields = waiting
        self.time = waiting.fieldNames().index(TIME)
        self.forget = forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.told = handle.getValueState("told", f"timer bigint, newest bigint, {self.memory}")
        self.waiting = handle.getListState("waiting", self.fields)

    # What subclasses say ----------------------------------------------------------------------------------

    def key(self, row: tuple) -> Any:
        """Order of rows that wait."""
        return (row[self.time] is not None, row[self.time] or 0)

    def trim(self, rows: list[tuple], memory: tuple) -> list[tuple]:
        """The waiting rows, in order, that can still matter."""
        return rows

    def take(self, key: tuple, row: tuple, memory: tuple) -> tuple[tuple, list[Row]]:
        """What is remembered after this row, and what it brings out."""
        raise NotImplementedError

    def until(self, row: tuple) -> int | None:
        """Time up to which a row tells of its device."""
        return row[self.time]

    def wake(self, key: tuple, memory: tuple, watermark: int) -> tuple[tuple, list[Row], int | None]:
        """All that is due was taken: what is remembered, what else comes out, and when (ms) to ask again at the latest."""
        return memory, [], None

    # Spark's side -----------------------------------------------------------------------------------------

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        timer, newest, *rest = self.told.get() if self.told.exists() else (None, None, *self.fresh)
        names = self.fields.fieldNames()
        before = self.waiting.get() if self.waiting.exists() else ()
        held, latest = self._bounded(before, (tuple(r[n] for n in names) for r in rows), tuple(rest))
        if latest is not None:
            newest = latest if newest is None else max(newest, latest)
        if held:
            self.waiting.put(held)
        elif self.waiting.exists():
            self.waiting.clear()
        due = self._due(held[0], timerValues) if held else timer
        if due is None:
            due = self._later(newest, timerValues)
        if timer is not None and due is not None and due < timer:
            self.handle.deleteTimer(timer)
            timer = None
        if timer is None and due is not None:
            self.handle.registerTimer(due)
            timer = due
        self.told.update((timer, newest, *rest))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        _, newest, *rest = self.told.get()
        memory, out = tuple(rest), []
        held = sorted((tuple(r) for r in self.waiting.get()), key=self.key) if self.waiting.exists() else []
        at = 0
        while at < len(held) and (held[at][self.time] is None or held[at][self.time] < watermark * 1000):
            memory, made = self.take(key, held[at], memory)
            out += made
            at += 1
        held = self.trim(held[at:], memory)
        memory, made, ask = self.wake(key, memory, watermark)
        out += made
        if held:
            self.waiting.put(held)
            due = self._due(held[0], timerValues)
            ask = due if ask is None else min(ask, due)
        else:
            self.waiting.clear()
            gone = self._gone(newest)
            if ask is None and gone is not None and gone < watermark:
                self.told.clear()
                return iter(out)
        timer = self._later(newest, timerValues) if ask is None else ask
        if timer is not None:
            self.handle.registerTimer(timer)
        self.told.update((timer, newest, *memory))
        return iter(out)

    def _bounded(self, held: Iterable[tuple], rows: Iterable[tuple], memory: tuple) -> tuple[list[tuple], int | None]:
        """All waiting rows in order, and the latest time among the new ones; trimmed while they come in."""
        waiting, latest, fresh = [tuple(r) for r in held], None, 0
        for row in rows:
            if (until := self.until(row)) is not None:
                latest = until if latest is None else max(latest, until)
            waiting.append(row)
            fresh += 1
            if fresh >= 1000:
                waiting, fresh = self.trim(sorted(waiting, key=self.key), memory), 0
        return self.trim(sorted(waiting, key=self.key), memory), latest

    def _due(self, row: tuple, timers) -> int:
        """When the watermark has passed the row; rows without time are due at once."""
        now = timers.getCurrentWatermarkInMs() + 1
        return now if row[self.time] is None else max(now, row[self.time] // 1000 + 1)

    def _gone(self, newest: int | None) -> int | None:
        return None if self.forget is None or newest is None else newest // 1000 + 1 + self.forget

    def _later(self, newest: int | None, timers) -> int | None:
        gone = self._gone(newest)
        return None if gone is None else max(gone, timers.getCurrentWatermarkInMs() + 1)


def in_order(rows: DataFrame, device: str, processor: InOrder, result: StructType) -> DataFrame:
    """Run the processor over timed rows (see ``timed``)."""
    return rows.groupBy(device).transformWithState(processor, result, "append", "eventTime")


def waiting_fields(rows: DataFrame) -> StructType:
    """What of the timed rows waits in state: all but the event time, of which the microseconds are kept."""
    return StructType([f for f in rows.schema if f.name != EVENT])


def numbered(schema: StructType, name: str) -> StructType:
    """The schema with one more whole number."""
    return StructType([*schema.fields, StructField(name, LongType())])
