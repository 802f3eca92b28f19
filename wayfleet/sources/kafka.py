"""Kafka topics as streams, tables and sinks. Needs the ``spark-sql-kafka-0-10`` package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wayfleet.config import JobConfig


def source_options(config: JobConfig, kind: str) -> dict[str, str]:
    """Options of one topic's streaming read; offsets apply to a first start, then the checkpoint rules."""
    options = {
        "kafka.bootstrap.servers": config.brokers,
        "subscribe": config.topics[kind],
        "startingOffsets": config.starting_offsets,
    }
    if config.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    if config.min_partitions is not None:
        # More tasks than topic partitions: a topic whose few partitions hold most data is split.
        options["minPartitions"] = str(config.min_partitions)
    return {**options, **config.kafka_options}


def table_options(config: JobConfig, kind: str) -> dict[str, str]:
    """Options of one topic's read as a table: all it holds now."""
    options = source_options(config, kind)
    options.pop("maxOffsetsPerTrigger", None)
    return {**options, "endingOffsets": "latest"}


def sink_options(config: JobConfig) -> dict[str, str]:
    """Options of a write: brokers and what concerns the client."""
    client = {k: v for k, v in config.kafka_options.items() if k.startswith("kafka.")}
    return {"kafka.bootstrap.servers": config.brokers, **client}


def topic_stream(spark: SparkSession, config: JobConfig, kind: str) -> DataFrame:
    """Endless log of one topic with Kafka's own columns; ``codec.decode`` uses ``value`` only."""
    return spark.readStream.format("kafka").options(**source_options(config, kind)).load()


def topic_table(spark: SparkSession, config: JobConfig, kind: str) -> DataFrame:
    """What a topic holds now, for reconciliation and backfills."""
    return spark.read.format("kafka").options(**table_options(config, kind)).load()


def publish_table(log: DataFrame, config: JobConfig) -> None:
    """Write a ``topic, key, value`` log; each row goes to the topic it names."""
    log.write.format("kafka").options(**sink_options(config)).save()


def publish_stream(log: DataFrame, config: JobConfig, checkpoint: str) -> StreamingQuery:
    """Streaming form of ``publish_table``. Delivery is at least once: see ``dedup_stream``."""
    return (
        log.writeStream.format("kafka")
        .options(**sink_options(config))
        .option("checkpointLocation", checkpoint)
        .start()
    )
