"""Append-only Parquet landing of decoded streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfleet.config import JobConfig
from wayfleet.operators.codec import decode, decode_flagged
from wayfleet.operators.dedup import dedup_stream
from wayfleet.schemas import KINDS, schema
from wayfleet.sources.kafka import topic_stream
from wayfleet.streaming.accounting import Accounting, observe_landed, observe_read
from wayfleet.streaming.supervise import supervise


def land(
    records: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    interval: str | None = None,
    available_now: bool = False,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a Parquet folder; a restart on the same checkpoint adds no row twice."""
    writer = (
        records.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def landing_frame(log: DataFrame, kind: str, config: JobConfig) -> tuple[DataFrame, tuple[str, ...]]:
    """What one topic's query writes, and the folder columns it is laid out by.

    Without ``dedup`` nothing here keeps state, so the watermark drops no late row; it is there for
    stateful operators that are put behind this frame. With it, the watermark is on the time of arrival,
    and no row is late.
    """
    if config.quarantine:
        flagged = decode_flagged(log, schema(kind))
        # Folder names come back as text whatever they were, so text is what is written.
        foreign = F.col("raw").isNotNull()
        verdict = F.when(F.col("is_bad"), F.lit("bad")).when(foreign, F.lit("foreign")).otherwise(F.lit("good"))
        records, folders = flagged.withColumn("verdict", verdict).drop("is_bad"), ("verdict",)
    else:
        records, folders = decode(log, schema(kind)), ()
    if config.account:
        records = observe_read(records, kind)
    if config.dedup:
        records = dedup_stream(records, delay=config.dedup_delay)
    else:
        records = records.withWatermark("timestamp", config.watermark)
    if config.partition_by_date:
        records, folders = records.withColumn("event_date", F.to_date("timestamp")), (*folders, "event_date")
    if config.account:
        records = observe_landed(records, kind)
    return records.alias(kind), folders


def start_landing(
    spark: SparkSession,
    config: JobConfig,
    logs: Mapping[str, DataFrame] | None = None,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Start one independent landing query per record kind, from Kafka unless ``logs`` are given.

    When one cannot start, those before it are stopped and its error is raised.
    """
    started = []
    try:
        for kind in KINDS:
            log = logs[kind] if logs else topic_stream(spark, config, kind)
            records, folders = landing_frame(log, kind, config)
            started.append(
                land(
                    records,
                    config.output(kind),
                    config.checkpoint(kind),
                    interval=config.trigger_interval,
                    available_now=available_now,
                    partition_by=folders,
                )
            )
    except BaseException:
        for query in started:
            query.stop()
        raise
    return started


def land_supervised(
    spark: SparkSession,
    config: JobConfig,
    logs: Mapping[str, DataFrame] | None = None,
    available_now: bool = False,
) -> None:
    """Run the landing job until it ends or a query of it fails, with the figures of every batch if ``config.account``."""
    if not config.account:
        supervise(spark, start_landing(spark, config, logs, available_now))
        return
    listener = Accounting(spark, config)
    spark.streams.addListener(listener)
    try:
        queries = start_landing(spark, config, logs, available_now)
        try:
            supervise(spark, queries)
        finally:
            listener.settle(queries)
    finally:
        spark.streams.removeListener(listener)
