"""Wire format: JSON records in a keyed log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wayfleet.functions.geo import parse_point

# to_json writes milliseconds unless told otherwise.
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
WRITE_OPTIONS = {"timestampFormat": MICROS, "timestampNTZFormat": MICROS}

CORRUPT = "_corrupt_record"


def decode(log: DataFrame, schema: StructType) -> DataFrame:
    """Records of a log with a ``value`` column (binary or text), one column per schema field.

    A value that is no JSON object of the schema gives a row of NULLs, as do NULL and empty
    values; a single field that does not fit is NULL. No row is dropped.
    """
    record = F.from_json(F.col("value").cast("string"), schema)
    return log.select(record.alias("record")).select("record.*")


def decode_flagged(log: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """``decode`` plus ``is_bad`` and the untouched ``raw`` text of every row of which no field could be read.

    JSON of another layout is not bad, but gives a row of NULLs, so its text is kept as well.

    One parse serves good and bad rows. Land the result with the flag as a folder level and select
    either side from the table: a filter put directly on the decoded columns would move below the
    decode and parse every value a second time.
    """
    text = F.col("value").cast("string")
    flagged = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = log.select(
        *keep,
        text.alias("raw"),
        F.from_json(text, flagged, {"columnNameOfCorruptRecord": CORRUPT}).alias("record"),
    )
    bad = F.col("raw").isNull() | (F.trim("raw") == "") | F.col(f"record.{CORRUPT}").isNotNull()
    unread = F.coalesce(*(F.col(f"record.{name}").cast("string") for name in schema.fieldNames())).isNull()
    return parsed.select(
        *keep,
        *(F.col(f"record.{name}").alias(name) for name in schema.fieldNames()),
        F.when(bad | unread, F.col("raw")).alias("raw"),
        bad.alias("is_bad"),
    )


def record_value(columns: list[Column] | list[str]) -> Column:
    """The columns as one UTF-8 JSON object."""
    return F.to_json(F.struct(*columns), WRITE_OPTIONS).cast("binary")


def encode(records: DataFrame, key: str = "id") -> DataFrame:
    """Rows as a log of binary ``key`` and JSON ``value``."""
    return records.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        record_value(records.columns).alias("value"),
    )


def parse_location(records: DataFrame) -> DataFrame:
    """Replace the ``location`` text by ``lat`` and ``lon``; unparseable text gives NULLs."""
    columns = [c for c in records.columns if c != "location"]
    point = records.select(*columns, parse_point(F.col("location")).alias("point"))
    return point.select(*columns, F.get("point", F.lit(0)).alias("lat"), F.get("point", F.lit(1)).alias("lon"))


def fan_out(ticks: DataFrame, payloads: Mapping[str, list[Column]]) -> dict[str, DataFrame]:
    """One frame per record kind; a tick's siblings share device, timestamp and location."""
    return {kind: ticks.select(*columns) for kind, columns in payloads.items()}


def topic_log(ticks: DataFrame, payloads: Mapping[str, list[Column]], topics: Mapping[str, str]) -> DataFrame:
    """All siblings as one ``topic, key, value`` log, from a single pass over the ticks.

    The first payload column is the record id and becomes the key.
    """
    entries = [
        F.struct(
            F.lit(topics[kind]).alias("topic"),
            columns[0].cast("string").cast("binary").alias("key"),
            record_value(columns).alias("value"),
        )
        for kind, columns in payloads.items()
    ]
    return ticks.select(F.inline(F.array(*entries)))
