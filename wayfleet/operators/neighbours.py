"""The preceding row of the same device, for devices of any size. Batch only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

PIECE = "_piece"
#: Length of a piece of a device's time.
PIECE_TIME = "hour"


def with_previous(
    df: DataFrame,
    carry: list[str],
    device: str = "device_id",
    order: tuple[str, ...] = ("timestamp", "id"),
    piece: str = PIECE_TIME,
) -> DataFrame:
    """Add struct ``prev``: the ``carry`` columns of the device's preceding row, NULL on its first.

    ``order`` starts with the event time; ties on all of it are ordered arbitrarily.

    A window over a whole device would put a device that sends a large share of all rows into one task. So every
    device is cut into pieces of time, a window runs per (device, piece), and only the border rows of the pieces, two
    each at most, meet in a window over the device. There is one path for all devices, and nothing runs until
    the result is read. ``piece`` is a unit of ``date_trunc``; the rows of one piece of one device are sorted in one task.

    Both branches read the same exchange, so the rows are shuffled once.
    """
    inside = Window.partitionBy(device, PIECE).orderBy(*order)
    borders = Window.partitionBy(device).orderBy(*order)
    cut = df.withColumn(PIECE, F.date_trunc(piece, F.col(order[0])))
    rows = cut.withColumns({"prev": _lag(carry, inside), "_last": F.lead(F.lit(True)).over(inside).isNull()})
    first = F.col("prev").isNull()
    heads = (
        rows.filter(first | F.col("_last"))
        .withColumns({"_first": first, "prev": _lag(carry, borders)})
        .filter("_first")
        .drop("_first")
    )
    return rows.filter(~first).unionByName(heads).drop(PIECE, "_last")


def _lag(carry: list[str], over: WindowSpec) -> Column:
    """Struct of the lagged columns, NULL where there is no row before.

    Lagging a struct would send a second copy of its columns through the shuffle.
    """
    there_is_one = F.lag(F.lit(True)).over(over)
    return F.when(there_is_one, F.struct(*(F.lag(c).over(over).alias(c) for c in carry)))
