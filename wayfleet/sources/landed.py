"""Landed tables: direct reads, catalog registration and a join-ready layout."""

from __future__ import annotations

import re
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wayfleet.config import JobConfig
from wayfleet.operators.correlate import TICK, one_per_record
from wayfleet.schemas import EXTRA, KINDS, LEAD, schema
from wayfleet.sources import files
from wayfleet.sources.versions import Versions


#: Part of the names of tables in the join-ready layout.
BY_TICK = "_by_tick"


def read_landed(spark: SparkSession, config: JobConfig, kind: str) -> DataFrame:
    """One landed table with its known schema (no footer is read to infer it).

    Spark's reader follows the sink's commit log, so files of uncommitted batches stay invisible.
    """
    landed = schema(kind).add("raw", "string") if config.quarantine else schema(kind)
    return spark.read.schema(landed).parquet(config.output(kind))


def landed_folders(spark: SparkSession, output_root: str) -> dict[str, str]:
    """Name and path of every table folder below the output root; bookkeeping folders are left out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(output_root)
    listing = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(path)
    folders = {s.getPath().getName(): s.getPath().toString() for s in listing if s.isDirectory()}
    return {name: where for name, where in sorted(folders.items()) if name[0] not in "_."}


def _literal(text: str) -> str:
    """A SQL string literal, whatever the text holds."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create_database(spark: SparkSession, database: str, config: JobConfig) -> None:
    """Its folder goes below the shared root, not into a warehouse folder of the driver's machine."""
    where = f"{config.root.rstrip('/')}/catalog/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION {_literal(where)}")


class Finding(NamedTuple):
    """What a crawl did about a table, or could not do."""

    table: str
    action: str
    detail: str


def crawl(spark: SparkSession, database: str, config: JobConfig) -> list[Finding]:
    """Bring the database in line with the landed folders: one external table per folder.

    A table that is there stays, and readers with it: only what differs is changed. Found are ``created`` tables, ``added``
    columns, new ``partitions``, a ``conflict`` (a column of another type than the table's; the table is left as it is)
    and tables whose folder is ``gone`` (also left). Tables of known topics in the plain layout have their fixed schema,
    others that of their files' footers, columns of all files together.
    """
    _create_database(spark, database, config)
    there = {t.name for t in spark.catalog.listTables(database)}
    folders = landed_folders(spark, f"{config.root.rstrip('/')}/output")
    found = [Finding(name, "gone", "") for name in sorted(there - folders.keys()) if BY_TICK not in name]
    for name, where in folders.items():
        table, fields = f"`{database}`.`{name}`", _folder_schema(spark, config, name, where)
        if name in there and _location(spark, table) != where:  # the database was made for another root
            spark.sql(f"DROP TABLE {table}")
            there.discard(name)
        if name not in there:
            columns = "" if fields is None else f"({_columns(fields)})"
            spark.sql(f"CREATE TABLE {table} {columns} USING parquet LOCATION {_literal(where)}")
            found.append(Finding(name, "created", ""))
        elif fields is None:
            read = _merged_schema(spark, where)
            if isinstance(read, str):
                found.append(Finding(name, "conflict", read))
            else:
                found += _alter(spark, table, name, read)
        found += _partitions(spark, database, name)
    return found


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"] if rows else ""


def _folder_schema(spark: SparkSession, config: JobConfig, name: str, where: str) -> StructType | None:
    """The fixed schema of a known topic in the plain layout."""
    kinds = {config.topics[kind]: kind for kind in KINDS}
    plain = not (config.partition_by_date or config.quarantine)
    return schema(kinds[name]) if plain and name in kinds else None


def _merged_schema(spark: SparkSession, where: str) -> StructType | str:
    """Columns of all files of a folder, or what is wrong with them."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(where).schema
    except (PySparkException, Py4JError) as error:  # merging runs as a job, whose error comes as it is
        said = re.findall(r"\[[A-Z_]*MERGE[A-Z_.]*\][^\n]*", str(error))
        if not said:
            raise
        return said[-1]  # the cause


def _columns(fields: StructType | list) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _alter(spark: SparkSession, table: str, name: str, read: StructType) -> list[Finding]:
    """Add the columns that only the files have; tell of those whose types differ."""
    known = {f.name.lower(): f.dataType for f in spark.table(table).schema}
    differ = [f for f in read if f.name.lower() in known and known[f.name.lower()] != f.dataType]
    found = [Finding(name, "conflict", f"{f.name}: table {known[f.name.lower()].simpleString()}, files {f.dataType.simpleString()}") for f in differ]
    new = [f for f in read if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(new)})")
        found.append(Finding(name, "added", _columns(new)))
    return found


def _partitions(spark: SparkSession, database: str, name: str) -> list[Finding]:
    """Add the partitions that are only in the folder."""
    if not any(column.isPartition for column in spark.catalog.listColumns(f"`{database}`.`{name}`")):
        return []
    table = f"`{database}`.`{name}`"
    before = spark.sql(f"SHOW PARTITIONS {table}").count()
    spark.sql(f"MSCK REPAIR TABLE {table} ADD PARTITIONS")
    new = spark.sql(f"SHOW PARTITIONS {table}").count() - before
    return [Finding(name, "partitions", str(new))] if new else []


def register(spark: SparkSession, database: str, config: JobConfig) -> list[str]:
    """Create the database and one external table per landed folder, or bring them up to date; returns the table names."""
    crawl(spark, database, config)
    return list(landed_folders(spark, f"{config.root.rstrip('/')}/output"))


def cluster_by_tick(spark: SparkSession, database: str, config: JobConfig, buckets: int, keep: int = 2) -> list[str]:
    """Rewrite the landed tables bucketed by tick, below ``<root>/by_tick``; returns the names to read them by.

    Correlating the rewritten tables needs no shuffle, however often it is done. One file per bucket
    also replaces the many small files of a low-rate stream. Only what can correlate is rewritten:
    rows without device or time stay in the landed tables, and copies of a record count once.

    Every run writes new tables aside and then switches the names, which are views, over to them. Readers
    are never without a table, and those at work keep theirs: the last ``keep`` versions stay.
    """
    _create_database(spark, database, config)
    names = []
    for kind in KINDS:
        topic = config.topics[kind]
        root, name = f"{config.root.rstrip('/')}/by_tick/{topic}", f"`{database}`.`{topic}{BY_TICK}`"
        versions = Versions(spark, root)
        last = versions.latest()
        number = last[0] + 1 if last else 0
        table = f"`{database}`.`{topic}{BY_TICK}_{number}`"
        # the shuffle that brings the records of a tick together also forms the buckets
        placed = read_landed(spark, config, kind).dropna(subset=list(TICK)).repartition(buckets, *TICK)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        (
            one_per_record(placed, "id")
            .write.bucketBy(buckets, *TICK)
            .sortBy(*TICK)
            .mode("overwrite")
            .option("path", f"{root}/v={number}")
            .saveAsTable(table)
        )
        versions.publish(number, {"number": number, "table": table})
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")
        for gone in versions.expire(keep):
            spark.sql(f"DROP TABLE IF EXISTS {gone['table']}")
            files.remove(spark, f"{root}/v={gone['number']}")
        names.append(name)
    return names
