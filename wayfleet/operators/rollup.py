"""Windowed roll-up of speed per device (an addition for users; the landing job does not run it)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.schemas import WATERMARK


def speed_rollup(records: DataFrame, width: str = "1 hour", delay: str = WATERMARK) -> DataFrame:
    """Tumbling-window record count and speed sum per device.

    The sum is kept in whole hundredths so that it does not depend on the order of addition;
    the mean is ``sum_cents / (100 * n_speed)``. Partial aggregation before the shuffle leaves one
    row per task, window and device. On a stream only windows the watermark has passed come out.
    """
    cents = F.round(F.col("speed") * 100).cast("bigint")
    return (
        records.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", width).alias("w"), "device_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("speed").alias("n_speed"),
            F.sum(cents).alias("sum_cents"),
        )
        .select(F.col("w.start").alias("window_start"), "device_id", "n", "n_speed", "sum_cents")
    )
