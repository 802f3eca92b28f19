"""Files replayed as streams: a stand-in for Kafka in tests and for backfills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def text_log(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """One JSON record per line, in the ``value`` column."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def table_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet folder or file as a stream; without a rate limit what is there now is one batch.

    The file source takes no single file, but it takes a pattern that matches this one name and no other.
    """
    path = path.rstrip("/")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
