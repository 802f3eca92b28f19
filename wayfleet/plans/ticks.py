"""The driver's ``events`` table read as vehicle ticks: one row, one tick, five sibling records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.operators.codec import fan_out
from wayfleet.schemas import (
    CAMERA,
    INCIDENT_STATUSES,
    INCIDENT_TEXT,
    INCIDENT_TYPES,
    MAKE,
    MODEL,
    SNAPSHOT,
    WEATHER_CONDITIONS,
)
from wayfleet.sources.replay import table_stream


def as_ticks(events: DataFrame) -> DataFrame:
    along = F.least(F.col("value") / 100, F.lit(1.0))
    return events.select(
        "event_id",
        F.concat(F.lit("V-"), F.col("user_id").cast("string")).alias("device_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.lit(40.758896) + F.lit(1.580704) * along).alias("lat"),
        (F.lit(-73.98513) + F.lit(2.91533) * along).alias("lon"),
        "value",
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(spark.read.parquet(f"{sf_dir}/events.parquet"))


def ticks_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    return as_ticks(table_stream(spark, path, spark.read.parquet(path).schema))


def _item(values: list[str], position: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (position % len(values)) + 1)


def payloads() -> dict[str, list[Column]]:
    """Columns of each sibling record in terms of a tick; the record id comes first."""
    value, k = F.col("value"), F.col("k")

    def lead(prefix: str) -> list[Column]:
        return [
            F.concat(F.lit(prefix), F.col("event_id").cast("string")).alias("id"),
            F.col("device_id"),
            F.col("timestamp"),
            F.array("lat", "lon").alias("location"),
        ]

    return {
        "vehicle": [
            *lead("v-"),
            value.alias("speed"),
            F.lit(MAKE).alias("make"),
            F.lit(MODEL).alias("model"),
            (F.lit(2014) + k % 12).alias("year"),
        ],
        "gps": [*lead("g-"), (value + 1).alias("speed")],
        "traffic": [*lead("t-"), F.lit(CAMERA).alias("camera_id"), F.lit(SNAPSHOT).alias("snapshot")],
        "weather": [
            *lead("w-"),
            k.cast("double").alias("temperature"),
            _item(WEATHER_CONDITIONS, k).alias("weather_condition"),
            k.alias("precipitation"),
            (F.lit(100) - k).alias("humidity"),
            (k % 31).cast("double").alias("wind_speed"),
            value.alias("air_quality"),
        ],
        "emergency": [
            *lead("e-"),
            F.concat(F.lit("i-"), F.col("event_id").cast("string")).alias("incident_id"),
            _item(INCIDENT_TYPES, k).alias("incident_type"),
            _item(INCIDENT_STATUSES, k).alias("status"),
            F.lit(INCIDENT_TEXT).alias("description"),
        ],
    }


def records(tick_rows: DataFrame) -> dict[str, DataFrame]:
    return fan_out(tick_rows, payloads())
