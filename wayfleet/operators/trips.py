"""Trip rules: arrival, truncation, legs and gaps. Inputs carry ``lat`` and ``lon`` (see ``codec``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfleet.functions.geo import expected_step, heading, step_within, within
from wayfleet.operators.neighbours import with_previous
from wayfleet.schemas import (
    ARRIVAL_TOLERANCE,
    DESTINATION,
    MAX_GAP_SECONDS,
    MAX_TICKS,
    MIN_GAP_SECONDS,
)

ORDER = ("timestamp", "id")


def arrivals(ticks: DataFrame, target=DESTINATION, tolerance: float = ARRIVAL_TOLERANCE) -> DataFrame:
    """Ticks inside the destination box. A plain predicate: batch and streaming."""
    return ticks.filter(within(F.col("lat"), F.col("lon"), target, tolerance))


def truncate_trips(
    ticks: DataFrame,
    device: str = "device_id",
    order: tuple[str, ...] = ORDER,
    target=DESTINATION,
    max_ticks: int = MAX_TICKS,
) -> DataFrame:
    """Each device's ticks before its first arrival, ``max_ticks`` at most, numbered in ``rn``. Batch only.

    No row past ``max_ticks`` is ever published, whatever it says, so the first ``max_ticks`` rows of
    a device decide everything. Spark turns that limit into a group limit ahead of the shuffle: a
    task passes on at most ``max_ticks`` rows of a device, however many it has.
    """
    trip = Window.partitionBy(device).orderBy(*order)
    arrived = F.coalesce(within(F.col("lat"), F.col("lon"), target), F.lit(False))
    return (
        _first_rows(ticks, device, order, max_ticks)
        .withColumn("rn", F.col("rn").cast("bigint"))
        .withColumn("_arrived", F.max(arrived).over(trip.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .filter(~F.col("_arrived"))
        .drop("_arrived")
    )


def _first_rows(df: DataFrame, device: str, order: tuple[str, ...], n: int) -> DataFrame:
    """The first ``n`` rows per device, numbered in ``rn``."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(device).orderBy(*order))).filter(F.col("rn") <= n)


def legs(
    ticks: DataFrame, device: str = "device_id", order: tuple[str, ...] = ORDER, target=DESTINATION
) -> DataFrame:
    """Movement since the device's previous tick, heading per axis and the step-size check."""
    moved = with_previous(ticks, ["lat", "lon"], device, order)
    moved = moved.withColumns(
        {"dlat": F.col("lat") - F.col("prev.lat"), "dlon": F.col("lon") - F.col("prev.lon")}
    )
    return moved.withColumns(
        {
            "lat_dir": heading(F.col("lat"), target[0]),
            "lon_dir": heading(F.col("lon"), target[1]),
            "step_ok": step_within(F.col("dlat"), expected_step(0, target=target))
            & step_within(F.col("dlon"), expected_step(1, target=target)),
        }
    ).drop("prev")


def gaps(
    ticks: DataFrame, device: str = "device_id", order: tuple[str, ...] = ORDER
) -> DataFrame:
    """Microseconds since the device's previous tick and whether the gap is a regular one."""
    time = order[0]
    timed = with_previous(ticks, [time], device, order)
    gap = F.unix_micros(time) - F.unix_micros(f"prev.{time}")
    return (
        timed.withColumn("gap_us", gap)
        .withColumn("in_range", F.col("gap_us").between(MIN_GAP_SECONDS * 1_000_000, MAX_GAP_SECONDS * 1_000_000))
        .drop("prev")
    )
