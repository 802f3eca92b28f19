"""One callable per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfleet.config import JobConfig
from wayfleet.operators import codec, quality, trips
from wayfleet.operators.clock import hold
from wayfleet.operators.correlate import correlate
from wayfleet.operators.dedup import dedup_stream
from wayfleet.operators.drift import field_report
from wayfleet.operators.rollup import speed_rollup
from wayfleet.plans.ticks import payloads, records, ticks, ticks_stream
from wayfleet.schemas import DEFAULT_TOPICS, DOMAINS, KINDS, schema
from wayfleet.session import settings, shared_dir, tune
from wayfleet.sources.compaction import compact, read_compacted
from wayfleet.sources.landed import cluster_by_tick, read_landed, register
from wayfleet.sources.replay import table_stream
from wayfleet.streaming.accounting import accounts
from wayfleet.streaming.land import land, land_supervised, landing_frame, start_landing
from wayfleet.streaming.live_trips import truncate_stream
from wayfleet.streaming.silence import silences
from wayfleet.streaming.stored_rollup import read_rollup, store_rollup
from wayfleet.streaming.supervise import supervise

ORDER = ("timestamp", "event_id")
TRIP_COLUMNS = ["event_id", "device_id", "timestamp", "lat", "lon"]


def _ntz(df: DataFrame, column: str = "timestamp", name: str | None = None) -> DataFrame:
    out = df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return out.withColumnRenamed(column, name) if name else out


def _run(spark: SparkSession, stream: DataFrame, folder: str, windows: bool = False) -> DataFrame:
    """Land all of a stream below a folder and return the landed table."""
    return _run_each(spark, {folder: stream}, windows)


def _run_each(spark: SparkSession, streams: Mapping[str, DataFrame], windows: bool = False) -> DataFrame:
    """Land all of several streams, each by a query of its own below its folder, and return the landed rows of all.

    A task reports the metrics of every operator of its stage to the driver, so a union of n streams in one query
    would send n times the bytes. Only windows need the extra batch without data that Spark appends to bring out what the last
    watermark closed; joins and dedup have emitted everything by then.
    """
    at_start = {
        "spark.sql.streaming.noDataMicroBatches.enabled": str(windows).lower(),
    }
    queries = []
    try:
        with settings(spark, at_start):
            for folder, stream in streams.items():
                queries.append(land(stream, f"{folder}/out", f"{folder}/checkpoint", available_now=True))
    except BaseException:
        for query in queries:
            query.stop()
        raise
    supervise(spark, queries)
    return reduce(DataFrame.unionByName, [spark.read.schema(stream.schema).parquet(f"{folder}/out") for folder, stream in streams.items()])


def _landed_job(spark: SparkSession, sf_dir: str) -> JobConfig:
    """Run the whole landing job over the five encoded topics of the events table."""
    config = JobConfig(root=shared_dir(spark))
    logs = {kind: codec.encode(df) for kind, df in records(ticks_stream(spark, sf_dir)).items()}
    supervise(spark, start_landing(spark, config, logs, available_now=True))
    return config


def decode_kind(kind: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    log = codec.encode(records(ticks(spark, sf_dir))[kind])
    return _ntz(codec.parse_location(codec.decode(log, schema(kind))))


def decode_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle records, JSON of another layout and plain prose in one topic."""
    good = codec.encode(records(ticks(spark, sf_dir))["vehicle"])
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    foreign = events.select(
        F.concat(F.lit("p-"), F.col("event_id").cast("string")).cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
    )
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prose = documents.select(
        F.concat(F.lit("d-"), F.col("doc_id").cast("string")).cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
    )
    log = good.unionByName(foreign).unionByName(prose)
    flagged = codec.decode_flagged(log, schema("vehicle"), keep=("key",))
    return flagged.select(F.col("key").cast("string").alias("record_key"), "is_bad", "device_id", "raw")


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of what the quarantine kept of two topics: JSON of other layouts, and prose."""
    events, documents = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("events", "documents"))
    described = F.to_json(F.struct("doc_id", "lang", F.struct("source", "n_chars").alias("origin")))
    strange = {
        "vehicle": events.select(F.col("props").alias("value")),
        "weather": documents.select(F.explode(F.array(described, "text")).alias("value")),
    }
    kept = []
    for kind, values in strange.items():
        good = codec.encode(records(ticks(spark, sf_dir))[kind]).select(F.col("value").cast("string"))
        flagged = codec.decode_flagged(good.unionByName(values), schema(kind))
        kept.append(flagged.where("raw IS NOT NULL").select(F.lit(DEFAULT_TOPICS[kind]).alias("topic"), F.col("raw").alias("value")))
    return field_report(kept[0].unionByName(kept[1]), {DEFAULT_TOPICS[kind]: schema(kind) for kind in strange})


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vehicle record delivered three times, each delivery in batches of its own."""
    log, folder = codec.encode(records(ticks(spark, sf_dir))["vehicle"]), shared_dir(spark)
    for _ in range(3):
        log.write.mode("append").parquet(f"{folder}/log")
    files = len(spark.read.parquet(f"{folder}/log").inputFiles())
    stream = table_stream(spark, f"{folder}/log", log.schema, files_per_batch=max(1, files // 3))
    seen = codec.decode(stream, schema("vehicle")).select("id", "device_id", "timestamp")
    return _run(spark, dedup_stream(seen, delay="1 day"), folder).select("id", "device_id")


def _gps_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = codec.encode(records(ticks_stream(spark, sf_dir))["gps"])
    return landing_frame(log, "gps", JobConfig(root=""))[0]


def watermark_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(codec.parse_location(_run(spark, _gps_stream(spark, sf_dir), shared_dir(spark))))


def land_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs twice on one checkpoint; the second run finds nothing new."""
    folder = shared_dir(spark)
    _run(spark, _gps_stream(spark, sf_dir), folder)
    return _ntz(codec.parse_location(_run(spark, _gps_stream(spark, sf_dir), folder)))


def correlate_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(correlate(records(ticks(spark, sf_dir))))


def correlate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = correlate(records(ticks_stream(spark, sf_dir)))
    # RocksDB looks a key up ahead of every write only to count the rows of the state
    with settings(spark, {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}):
        return _ntz(_run(spark, joined, shared_dir(spark)))


def correlate_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of landed tables after they were rewritten in the join-ready layout."""
    config = _landed_job(spark, sf_dir)
    names = cluster_by_tick(spark, "wayfleet_clustered", config, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    tables = {kind: spark.table(name) for kind, name in zip(KINDS, names, strict=True)}
    return _ntz(correlate(tables, unique=True))


def landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _landed_job(spark, sf_dir)
    landed = {kind: read_landed(spark, config, kind) for kind in KINDS}
    return quality.topic_counts(quality.tag_topics(landed, config.topics))


def landing_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of the landing job over topics with records of another layout, prose and records without time, in two
    runs on one checkpoint: the second finds new files only. A run takes at most four batches, however many files there are."""
    config = JobConfig(root=shared_dir(spark), account=True)
    tick_rows, events = ticks(spark, sf_dir), spark.read.parquet(f"{sf_dir}/events.parquet")
    timeless = tick_rows.withColumn("timestamp", F.when(F.col("k") % 10 != 0, F.col("timestamp")))
    values = {kind: codec.encode(df) for kind, df in records(timeless).items()}
    values["vehicle"] = values["vehicle"].select("value").unionByName(events.select(F.col("props").cast("binary").alias("value")))
    prose = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("text").cast("binary").alias("value"))
    values["weather"] = values["weather"].select("value").unionByName(prose)
    logs = {kind: df.select("value") for kind, df in values.items()}
    for run in range(2):
        streams = {}
        for kind, log in logs.items():
            log.write.mode("append").parquet(f"{config.root}/log/{kind}")
            files = len(spark.read.schema(log.schema).parquet(f"{config.root}/log/{kind}").inputFiles())
            streams[kind] = table_stream(spark, f"{config.root}/log/{kind}", log.schema, files_per_batch=max(1, -(-files // (4 * (run + 1)))))
        land_supervised(spark, config, streams, available_now=True)
    return accounts(spark, config)


def encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return codec.decode(codec.encode(events, key="event_id"), events.schema)


def fan_out_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.topic_counts(quality.tag_topics(records(ticks(spark, sf_dir)), DEFAULT_TOPICS))


def publish_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a producer would write to the five topics, read back by its common fields."""
    log = codec.topic_log(ticks(spark, sf_dir), payloads(), DEFAULT_TOPICS)
    common = StructType(schema("gps").fields[:4])
    seen = log.select(
        "topic",
        F.col("key").cast("string").alias("record_key"),
        F.from_json(F.col("value").cast("string"), common).alias("record"),
    )
    return _ntz(codec.parse_location(seen.select("topic", "record_key", "record.*")))


def parse_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = ticks(spark, sf_dir).select("event_id", F.to_json(F.array("lat", "lon")).alias("location"))
    return codec.parse_location(texts)


def geofence_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = trips.arrivals(ticks(spark, sf_dir)).select("event_id", "device_id", "timestamp")
    return _ntz(found, name="event_ts")


def trip_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ticks(spark, sf_dir).select(*TRIP_COLUMNS)
    return trips.truncate_trips(rows, order=ORDER).select("event_id", "device_id", "rn")


def _deliveries(spark: SparkSession, rows: DataFrame, folder: str, n: int = 4) -> tuple[DataFrame, str]:
    """The rows as a stream of ``n`` + 1 deliveries by time, of which every third row comes one delivery late, and the
    delay that covers this. A last record, of device ``clock``, moves the watermark past all others.
    """
    first, last = rows.agg(F.unix_seconds(F.min("timestamp")), F.unix_seconds(F.max("timestamp"))).first()
    first, last = first or 0, last or 0
    width = (last - first) // n + 1
    due = F.least((F.unix_seconds("timestamp") - first) / width + F.when(F.col("event_id") % 3 == 0, 1).otherwise(0), F.lit(n))
    for k in range(n + 1):
        rows.where(due.cast("int") == k).write.mode("append").parquet(f"{folder}/in")
    delay = 2 * width + 1
    clock = {"device_id": F.lit("clock"), "timestamp": F.timestamp_seconds(F.lit(last + delay + 3600))}
    closing = spark.range(1).select([clock.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema])
    closing.write.mode("append").parquet(f"{folder}/in")
    files = len(spark.read.schema(rows.schema).parquet(f"{folder}/in").inputFiles())
    return table_stream(spark, f"{folder}/in", rows.schema, files_per_batch=max(1, files // (n + 2))), f"{delay} seconds"


def trip_truncate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip truncation of a stream of several batches with late rows."""
    folder = shared_dir(spark)
    rows, delay = _deliveries(spark, ticks(spark, sf_dir).select(*TRIP_COLUMNS), folder)
    kept = truncate_stream(rows, order=ORDER, delay=delay).select("event_id", "device_id", "rn")
    return _run(spark, kept, folder, windows=True).where("device_id <> 'clock'")


def silent_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps of more than a minute on a stream of several batches with late rows, those still open among them."""
    folder = shared_dir(spark)
    rows, delay = _deliveries(spark, ticks(spark, sf_dir).select(*TRIP_COLUMNS), folder)
    told = _run(spark, silences(rows, delay=delay), folder, windows=True).where("device_id <> 'clock'")
    # a gap that was told while open is told again when it ends
    gap = told.groupBy("device_id", "since").agg(F.max("until").alias("until"), F.max("gap_us").alias("gap_us"))
    return _ntz(_ntz(gap, "since"), "until")


def trip_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ticks(spark, sf_dir).select(*TRIP_COLUMNS)
    return trips.legs(rows, order=ORDER).select("event_id", "dlat", "dlon", "lat_dir", "lon_dir", "step_ok")


def gap_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ticks(spark, sf_dir).select("event_id", "device_id", "timestamp")
    return trips.gaps(rows, order=ORDER).select("event_id", "device_id", "gap_us", "in_range")


def quality_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(records(ticks(spark, sf_dir)), DEFAULT_TOPICS)


def violations_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule violations per hour on streams of several batches with late rows."""
    folder = shared_dir(spark)
    rows, delay = _deliveries(spark, ticks(spark, sf_dir), folder)
    streams = records(rows)
    counted = {f"{folder}/{kind}": quality.violations_by_window(streams[kind], DEFAULT_TOPICS[kind], DOMAINS[kind], delay=delay) for kind in KINDS}
    found = _run_each(spark, counted, windows=True)
    return _ntz(found, "window_start")


def reconcile_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was produced against a landed log in which records are lost, doubled or of another producer."""
    produced = quality.tag_topics(records(ticks(spark, sf_dir)), DEFAULT_TOPICS)
    config = JobConfig(root=shared_dir(spark))
    lost, doubled, foreign = (F.col("event_id") % n == 0 for n in (11, 7, 13))

    def sent(kind: str) -> DataFrame:
        rows = ticks_stream(spark, sf_dir)
        own, none = F.array(F.lit("")), F.array().cast("array<string>")
        kept = F.when(lost, none).when(doubled, F.array(F.lit(""), F.lit(""))).otherwise(own)
        marks = F.concat(kept, F.when(foreign, F.array(F.lit("x-"))).otherwise(none))
        marked = rows.withColumn("mark", F.explode(marks))
        columns = payloads()[kind]
        return marked.select(F.concat("mark", columns[0]).alias("id"), *columns[1:])

    logs = {kind: codec.encode(sent(kind)) for kind in KINDS}
    supervise(spark, start_landing(spark, config, logs, available_now=True))
    landed = {kind: quality.drop_empty(read_landed(spark, config, kind)) for kind in KINDS}
    return quality.reconcile(produced, quality.tag_topics(landed, config.topics))


def rollup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    gps = records(ticks_stream(spark, sf_dir))["gps"]
    rolled = _run(spark, speed_rollup(gps), shared_dir(spark), windows=True)
    return _ntz(rolled, "window_start").select("window_start", "device_id", "n", "sum_cents")


def rollup_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly roll-up of a stream whose first batch holds a record of the year 2999, and that record's own table."""
    folder = shared_dir(spark)
    rows = ticks(spark, sf_dir).select(*TRIP_COLUMNS, F.col("value").alias("speed"))
    wrong = rows.withColumn("timestamp", F.to_timestamp(F.lit("2999-01-01 00:00:00"))).orderBy("event_id").limit(1)
    wrong.write.mode("append").parquet(f"{folder}/in")
    stream, delay = _deliveries(spark, rows, folder)
    held, ahead = hold(stream)
    rolled = _run(spark, speed_rollup(held, delay=delay), f"{folder}/held", windows=True)
    side = _run(spark, ahead, f"{folder}/ahead")
    cents = F.round(F.col("speed") * 100).cast("bigint").alias("sum_cents")
    told = rolled.select(F.lit(False).alias("ahead"), "window_start", "device_id", "n", "sum_cents").unionByName(
        side.select(F.lit(True).alias("ahead"), F.col("timestamp").alias("window_start"), "device_id", F.lit(1).cast("bigint").alias("n"), cents)
    )
    return _ntz(told, "window_start")


def rollup_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored roll-up after a stream of several batches with late rows: all windows, open ones too."""
    folder = shared_dir(spark)
    rows, delay = _deliveries(spark, ticks(spark, sf_dir).select(*TRIP_COLUMNS, F.col("value").alias("speed")), folder)
    supervise(spark, [store_rollup(rows, f"{folder}/table", f"{folder}/checkpoint", delay=delay, available_now=True)])
    stored = read_rollup(spark, f"{folder}/table").where("device_id <> 'clock'")
    return _ntz(stored, "window_start").select("window_start", "device_id", "n", "sum_cents")


def land_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed gps records, compacted between two runs of the landing query and read with what came after."""
    config = JobConfig(root=shared_dir(spark))
    log = codec.encode(records(ticks(spark, sf_dir))["gps"])
    for part in range(2):
        log.where(F.pmod(F.xxhash64("key"), F.lit(2)) == part).write.mode("append").parquet(f"{config.root}/log")
        stream = table_stream(spark, f"{config.root}/log", log.schema)
        frame, _ = landing_frame(stream, "gps", config)
        supervise(spark, [land(frame, config.output("gps"), config.checkpoint("gps"), available_now=True)])
        if part == 0:
            compact(spark, config, "gps")
    return _ntz(codec.parse_location(read_compacted(spark, config, "gps")))


def catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _landed_job(spark, sf_dir)
    register(spark, "wayfleet_landed", config)
    return spark.sql(
        "SELECT incident_type, status, count(*) AS n "
        "FROM wayfleet_landed.emergency_data GROUP BY incident_type, status"
    )


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = {
        **{f"decode_{kind}": partial(decode_kind, kind) for kind in KINDS},
        "decode_quarantine": decode_quarantine,
        "schema_drift": schema_drift,
        "dedup_stream": dedup,
        "watermark_passthrough": watermark_passthrough,
        "land_parquet": land_parquet,
        "correlate_five": correlate_five,
        "correlate_stream": correlate_stream,
        "correlate_clustered": correlate_clustered,
        "landing_counts": landing_counts,
        "landing_accounts": landing_accounts,
        "encode_roundtrip": encode_roundtrip,
        "fan_out_counts": fan_out_counts,
        "publish_log": publish_log,
        "parse_location": parse_location,
        "geofence_arrivals": geofence_arrivals,
        "trip_truncate": trip_truncate,
        "trip_truncate_stream": trip_truncate_stream,
        "silent_devices": silent_devices,
        "trip_legs": trip_legs,
        "gap_audit": gap_audit,
        "quality_violations": quality_violations,
        "violations_stream": violations_stream,
        "reconcile_topics": reconcile_topics,
        "rollup_stream": rollup_stream,
        "rollup_guarded": rollup_guarded,
        "rollup_store": rollup_store,
        "land_compacted": land_compacted,
        "catalog_sql": catalog_sql,
    }

    def tuned(query):
        return lambda spark, sf_dir: query(tune(spark), sf_dir)

    return {name: tuned(query) for name, query in plain.items()}
