"""The speed roll-up as a stored table that is current after every batch, open windows included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfleet.operators.rollup import speed_rollup
from wayfleet.schemas import WATERMARK
from wayfleet.sources import files
from wayfleet.sources.versions import Versions

KEY = ["window_start", "device_id"]
COLUMNS = "window_start timestamp, device_id string, n bigint, n_speed bigint, sum_cents bigint"
#: Versions that stay readable after newer ones, for readers that are still at work.
KEEP = 10


def store_rollup(
    records: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 hour",
    delay: str = WATERMARK,
    keep: int = KEEP,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep ``speed_rollup`` of a stream in a table (``read_rollup``), one partition a day of windows.

    Every batch brings the windows it changed. The days these belong to are written anew, old windows and changed
    ones, into a folder numbered by the batch, and then one small file switches readers to it. A batch that is
    repeated starts from the version before it and writes the same folder again, so nothing counts twice and readers
    never see half a batch. Folders that only versions older than the last ``keep`` use are deleted.
    """
    rolled = speed_rollup(records, width, delay)

    def upsert(changed: DataFrame, batch: int) -> None:
        _upsert(changed.sparkSession, changed, batch, path, keep)

    writer = rolled.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(upsert)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def _upsert(spark: SparkSession, changed: DataFrame, batch: int, path: str, keep: int) -> None:
    versions = Versions(spark, path)
    before = versions.latest(below=batch)
    days = dict(before[1]["days"]) if before else {}
    changed = changed.withColumn("day", F.to_date("window_start").cast("string")).persist()
    try:
        touched = [r["day"] for r in changed.select("day").distinct().collect()]  # a row for each day of the batch
        if not touched:
            return
        old = _read(spark, path, {d: days[d] for d in touched if d in days})
        # of a window that is in both, what the later batch says counts; one shuffle by window, no join
        both = old.withColumn("_new", F.lit(0)).unionByName(changed.select(old.columns).withColumn("_new", F.lit(1)))
        rest = F.struct("_new", *[c for c in changed.columns if c not in (*KEY, "day")])
        merged = both.groupBy("day", *KEY).agg(F.max(rest).alias("r")).select("day", *KEY, "r.*").drop("_new")
        merged.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={batch}")
    finally:
        changed.unpersist()
    versions.publish(batch, {"days": {**days, **dict.fromkeys(touched, batch)}})
    _clean(spark, versions, path, keep)


def _clean(spark: SparkSession, versions: Versions, path: str, keep: int) -> None:
    gone = versions.expire(keep)
    if not gone:
        return
    used = {(d, b) for n in versions.numbers() for d, b in versions.get(n)["days"].items()}
    for day, batch in {(d, b) for content in gone for d, b in content["days"].items()} - used:
        files.remove(spark, f"{path}/batch={batch}/day={day}")


def _read(spark: SparkSession, path: str, days: dict[str, int]) -> DataFrame:
    empty = spark.createDataFrame([], f"{COLUMNS}, day string")
    if not days:
        return empty
    folders = [f"{path}/batch={b}/day={d}" for d, b in days.items()]
    read = spark.read.schema(f"{COLUMNS}, batch bigint, day string").option("basePath", path).parquet(*folders)
    return read.select(empty.columns)


def read_rollup(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The stored roll-up as of the last batch, or of an earlier one that is still kept."""
    versions = Versions(spark, path)
    found = versions.latest() if version is None else (version, versions.get(version))
    return _read(spark, path, dict(found[1]["days"]) if found else {}).drop("day")
