"""Fewer, larger files for landed tables, while the landing job and readers go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StringType, StructType

from wayfleet.config import JobConfig
from wayfleet.schemas import schema
from wayfleet.sources import files
from wayfleet.sources.versions import Versions

#: Lines of the sink's log.
ENTRY = "path string, size bigint, action string"
#: Bytes of input that become one file.
FILE_BYTES = 128 << 20


def landed_schema(config: JobConfig, kind: str) -> tuple[StructType, list[str]]:
    """Columns of a landed table, folder columns last, and the names of those."""
    fields = StructType(schema(kind).fields)
    folders = []
    if config.quarantine:
        fields, folders = fields.add("raw", StringType()).add("verdict", StringType()), ["verdict"]
    if config.partition_by_date:
        fields, folders = fields.add("event_date", DateType()), [*folders, "event_date"]
    return fields, folders


def committed_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size`` of every file in a file sink's own log: what finished batches wrote, and nothing else."""
    log = f"{folder}/_spark_metadata"
    names = [n for n in files.names(spark, log) if n.removesuffix(".compact").isdigit()]
    if not names:
        return spark.createDataFrame([], "path string, size bigint")
    # a compact file repeats what was logged before it, so the last one and what follows it are enough
    last = max((i for i, n in enumerate(sorted(names, key=_batch)) if n.endswith(".compact")), default=0)
    paths = [f"{log}/{n}" for n in sorted(names, key=_batch)[last:]]
    # Spark's file sources refuse this folder, so its lines are read as plain text; the first one of a file is a version
    lines = spark.sparkContext.textFile(",".join(paths)).filter(lambda line: line.startswith("{"))
    entries = spark.read.schema(ENTRY).json(lines)
    gone = entries.where("action = 'delete'").select("path")
    return entries.where("action = 'add'").join(gone, "path", "left_anti").select("path", "size").distinct()


def _batch(name: str) -> tuple[int, bool]:
    return int(name.removesuffix(".compact")), name.endswith(".compact")


def _root(config: JobConfig, kind: str) -> str:
    return f"{config.root.rstrip('/')}/compacted/{config.topics[kind]}"


def _tail(spark: SparkSession, config: JobConfig, kind: str, parts: list[int]) -> DataFrame:
    """Committed files that no part holds."""
    committed = committed_files(spark, config.output(kind))
    if not parts:
        return committed
    held = spark.read.schema("path string").parquet(*[f"{_root(config, kind)}/files/part={n}" for n in parts])
    return committed.join(held, "path", "left_anti")


def _read(spark: SparkSession, config: JobConfig, kind: str, base: str, paths: list[str]) -> DataFrame:
    fields, _ = landed_schema(config, kind)
    if not paths:
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).option("basePath", base).parquet(*paths).select(fields.names)


def compact(spark: SparkSession, config: JobConfig, kind: str, file_bytes: int = FILE_BYTES) -> int:
    """Rewrite the files that the landing query has committed since the last time; returns how many there were.

    The files to rewrite come from the sink's log, so the running query is not touched and files of an unfinished batch
    are left alone. The rewrite is a new part beside the old ones, with the list of files that it holds; then one small
    file switches ``read_compacted`` to it. A run that fails before that leaves nothing that readers see, and the next
    one writes the same part again. The list of files since the last run passes through the driver, the rows do not.
    """
    versions = Versions(spark, _root(config, kind))
    found = versions.latest()
    parts = list(found[1]["parts"]) if found else []
    new = [(r["path"], r["size"]) for r in _tail(spark, config, kind, parts).collect()]
    if not new:
        return 0
    part = len(parts)
    rows = _read(spark, config, kind, config.output(kind), [p for p, _ in new])
    _, folders = landed_schema(config, kind)
    target = f"{_root(config, kind)}/rows/part={part}"
    whole = rows.coalesce(max(1, -(-sum(s for _, s in new) // file_bytes))) if not folders else rows.hint("rebalance", *folders)
    whole.write.mode("overwrite").partitionBy(*folders).parquet(target)
    held = spark.createDataFrame([(p,) for p, _ in new], "path string").coalesce(1)
    held.write.mode("overwrite").parquet(f"{_root(config, kind)}/files/part={part}")
    versions.publish(part, {"parts": [*parts, part]})
    return len(new)


def read_compacted(spark: SparkSession, config: JobConfig, kind: str) -> DataFrame:
    """A landed table from its compacted parts and the files that were committed since; the same rows as ``read_landed``."""
    found = Versions(spark, _root(config, kind)).latest()
    parts = list(found[1]["parts"]) if found else []
    tail = [r["path"] for r in _tail(spark, config, kind, parts).select("path").collect()]
    rows = _read(spark, config, kind, config.output(kind), tail)
    for n in parts:
        base = f"{_root(config, kind)}/rows/part={n}"
        rows = rows.unionByName(_read(spark, config, kind, base, [base]))
    return rows
