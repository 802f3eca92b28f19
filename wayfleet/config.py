"""Job settings, overridable from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from wayfleet.schemas import DEFAULT_TOPICS, WATERMARK


@dataclass(frozen=True)
class JobConfig:
    """Where records come from and where they land.

    ``root`` is a folder every executor reaches (object store or shared file system);
    tables go to ``<root>/output/<topic>`` and progress to ``<root>/checkpoints/<topic>``.
    """

    root: str
    brokers: str = "localhost:9092"
    topics: Mapping[str, str] = field(default_factory=lambda: dict(DEFAULT_TOPICS))
    watermark: str = WATERMARK
    starting_offsets: str = "earliest"
    # Rate and parallelism limits of the Kafka source; None leaves Spark's default.
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    # Further options of the Kafka source and sink, such as ``kafka.security.protocol`` or ``failOnDataLoss``.
    kafka_options: Mapping[str, str] = field(default_factory=dict)
    # None starts the next batch as soon as the last one is done, which at a low input
    # rate lands many small files; a processing-time interval bounds the file count.
    trigger_interval: str | None = None
    # Extra sink layout: adds an event_date column and folder level for partition pruning.
    partition_by_date: bool = False
    # Opt-in extras; without them every row lands as it was decoded.
    quarantine: bool = False
    dedup: bool = False
    # Count what every batch reads, lands and cannot use (streaming.accounting).
    account: bool = False
    # How long after its first arrival a record is known; the state holds the keys of this time.
    dedup_delay: str = "1 hour"

    @classmethod
    def from_env(cls, root: str, env: Mapping[str, str] | None = None, **overrides) -> JobConfig:
        """Read the broker list and the topic names from environment variables."""
        env = os.environ if env is None else env
        topics = {kind: env.get(f"{kind.upper()}_TOPIC", name) for kind, name in DEFAULT_TOPICS.items()}
        brokers = env.get("KAFKA_BOOTSTRAP_SERVER", cls.brokers)
        return cls(**{"root": root, "brokers": brokers, "topics": topics, **overrides})

    def output(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/output/{self.topics[kind]}"

    def checkpoint(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{self.topics[kind]}"
