"""Figures of the running landing job: what every batch of every topic read, landed and could not use."""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wayfleet.config import JobConfig
from wayfleet.schemas import KINDS, schema
from wayfleet.sources.files import names, write_text

READ, LANDED = "read", "landed"
FIGURES = "topic string, batch bigint, read bigint, landed bigint, undecodable bigint, without_time bigint"


def observe_read(records: DataFrame, kind: str) -> DataFrame:
    """Count decoded rows of a topic, rows of which no field could be read, and other rows without event time."""
    empty = F.coalesce(*(F.col(name).cast("string") for name in schema(kind).fieldNames())).isNull()
    return records.observe(
        f"{READ} {kind}",
        F.count(F.lit(1)).alias("read"),
        F.count_if(empty).alias("undecodable"),
        F.count_if(~empty & F.col("timestamp").isNull()).alias("without_time"),
    )


def observe_landed(records: DataFrame, kind: str) -> DataFrame:
    """Count the rows that reach the sink."""
    return records.observe(f"{LANDED} {kind}", F.count(F.lit(1)).alias("landed"))


class Accounting(StreamingQueryListener):
    """Keeps the observed figures of each batch in a small file of its own, named by topic and batch.

    Spark repeats a batch that was not committed under the same number. If the sink had not taken it, its file is
    written anew; if it had, the repeat lands nothing and the first figures stand. So nothing counts twice. Make
    and add the listener before the queries start, and ``settle`` after they end.
    """

    def __init__(self, spark: SparkSession, config: JobConfig):
        self._spark, self._config = spark, config
        self._taken = {topic: last_batch(spark, config.output(kind)) for kind, topic in config.topics.items()}
        self._ended, self._change = set(), threading.Condition()
        self.errors: list[Exception] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        figures: dict[str, dict] = {}
        for name, row in progress.observedMetrics.items():
            step, _, kind = name.partition(" ")
            if step in (READ, LANDED) and kind in KINDS:
                figures.setdefault(kind, {}).update(row.asDict())
        for kind, counted in figures.items():
            topic = self._config.topics[kind]
            if progress.batchId <= self._taken[topic]:
                continue
            try:
                write_text(self._spark, f"{accounts_dir(self._config)}/{topic}/{progress.batchId:012d}.json", json.dumps({"topic": topic, "batch": progress.batchId, **counted}))
            except Exception as error:  # a listener must not raise; settle does
                self.errors.append(error)

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def settle(self, queries: Sequence[StreamingQuery], seconds: float = 60) -> None:
        """Wait until the figures of queries that have ended are written; raise what went wrong."""
        runs = {str(q.runId) for q in queries}
        with self._change:
            if not self._change.wait_for(lambda: runs <= self._ended, seconds):
                raise TimeoutError("no word of the end of some queries")
        if self.errors:
            raise self.errors[0]


def last_batch(spark: SparkSession, output: str) -> int:
    """Number of the last batch in the sink's own log, -1 if there is none."""
    return max((int(n.removesuffix(".compact")) for n in names(spark, f"{output}/_spark_metadata")), default=-1)


def accounts_dir(config: JobConfig) -> str:
    return f"{config.root.rstrip('/')}/accounts"


def batch_accounts(spark: SparkSession, config: JobConfig) -> DataFrame:
    """``topic, batch`` and the figures of every batch so far."""
    return spark.read.schema(FIGURES).option("recursiveFileLookup", "true").json(accounts_dir(config))


def accounts(spark: SparkSession, config: JobConfig) -> DataFrame:
    """``topic, read, landed, undecodable, without_time`` of all batches so far."""
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("read", "landed", "undecodable", "without_time")]
    return batch_accounts(spark, config).groupBy("topic").agg(*totals)


def unaccounted(spark: SparkSession, config: JobConfig) -> DataFrame:
    """``topic, batch`` of batches that were committed but have no figures: the driver was lost between the two."""
    commits = None
    for kind in KINDS:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(f"{config.checkpoint(kind)}/commits")
        named = listed.select(F.lit(config.topics[kind]).alias("topic"), F.regexp_extract("path", "([0-9]+)$", 1).cast("long").alias("batch"))
        commits = named if commits is None else commits.unionByName(named)
    return commits.join(batch_accounts(spark, config), ["topic", "batch"], "left_anti")
