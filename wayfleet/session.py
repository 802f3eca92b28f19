"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that can be changed on a running session.
RUNTIME = {
    # Wire timestamps carry no zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The INT96 default keeps no min/max statistics, so time filters could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Join and dedup state outgrows the heap on a long stream; RocksDB keeps it on disk. Changelog
# checkpoints upload only what a batch changed, and format 3 keeps a join's four maps in one store.
STATE = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

# Object-store access: keys come from the default provider chain (instance role, environment,
# profile), never from source.
OBJECT_STORE = {
    "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
}


def build_session(app: str = "wayfleet", packages: tuple[str, ...] = (), **extra: str) -> SparkSession:
    """Session for the landing job. Master, memory and executor counts are left to spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    for key, value in {**RUNTIME, **STATE, **OBJECT_STORE, **extra}.items():
        builder = builder.config(key, value)
    if packages:
        builder = builder.config("spark.jars.packages", ",".join(packages))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that a session handed to us does not set itself."""
    settings = dict(RUNTIME)
    if spark.conf.get(PROVIDER, STATE[PROVIDER]) == STATE[PROVIDER]:
        settings.update(STATE)
    for key, value in settings.items():
        if key == "spark.sql.session.timeZone" or spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, changed: Mapping[str, str]) -> Iterator[None]:
    """Change session settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        return tempfile.mkdtemp(prefix="wayfleet-")
    return f"{base.rstrip('/')}/wayfleet/{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without replacing a folder the cluster has set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
