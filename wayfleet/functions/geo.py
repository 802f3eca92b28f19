"""Location, geofence and heading expressions. All stay inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfleet.schemas import (
    ARRIVAL_TOLERANCE,
    DESTINATION,
    ORIGIN,
    STEP_JITTER,
    STEPS_PER_TRIP,
)


def parse_point(location: Column) -> Column:
    """JSON text ``[lat,lon]`` to an array of doubles; NULL when it is not such a text."""
    return F.from_json(location, "array<double>")


def within(lat: Column, lon: Column, target=DESTINATION, tolerance: float = ARRIVAL_TOLERANCE) -> Column:
    """True when both axes are at most ``tolerance`` degrees from the target, borders included."""
    return (F.abs(lat - F.lit(target[0])) <= tolerance) & (F.abs(lon - F.lit(target[1])) <= tolerance)


def heading(position: Column, target: float) -> Column:
    """+1 while below the target on one axis, otherwise (equality included) -1."""
    return F.when(position < F.lit(target), F.lit(1)).otherwise(F.lit(-1))


def expected_step(axis: int, origin=ORIGIN, target=DESTINATION, steps: int = STEPS_PER_TRIP) -> float:
    """Regular movement per tick on one axis (0 = latitude, 1 = longitude)."""
    return abs(abs(origin[axis]) - abs(target[axis])) / steps


def step_within(delta: Column, step: float, jitter: float = STEP_JITTER) -> Column:
    """True when the movement's size is the regular step give or take the jitter."""
    return F.abs(F.abs(delta) - F.lit(step)) <= jitter
