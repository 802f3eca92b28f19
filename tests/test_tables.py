import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from wayfleet.config import JobConfig
from wayfleet.operators import quality
from wayfleet.operators.codec import encode
from wayfleet.operators.correlate import correlate
from wayfleet.plans import queries
from wayfleet.plans.ticks import records, ticks, ticks_stream
from wayfleet.schemas import DEFAULT_TOPICS, KINDS, schema
from wayfleet.session import settings, shared_dir
from wayfleet.sources import kafka
from wayfleet.sources.landed import cluster_by_tick, crawl, landed_folders, read_landed, register
from wayfleet.streaming.job import main, parse
from wayfleet.streaming.land import start_landing
from wayfleet.streaming.supervise import supervise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    config = JobConfig(root=str(tmp_path_factory.mktemp("landed")))
    logs = {k: encode(df) for k, df in records(ticks_stream(spark, SF)).items()}
    supervise(spark, start_landing(spark, config, logs, available_now=True))
    return config


def test_register_makes_one_table_per_folder(spark, landed):
    names = register(spark, "reg", landed)
    assert names == sorted(DEFAULT_TOPICS.values())
    assert "_spark_metadata" not in landed_folders(spark, f"{landed.root}/output/gps_data")
    for kind in KINDS:
        table = spark.table(f"reg.{DEFAULT_TOPICS[kind]}")
        assert table.schema == schema(kind) and table.count() == 1000


def test_register_is_repeatable_and_infers_unknown_folders(spark, landed, tmp_path):
    config = JobConfig(root=str(tmp_path))
    spark.range(3).write.parquet(f"{tmp_path}/output/other")
    (tmp_path / "output" / "_spark_metadata").mkdir()
    assert register(spark, "reg2", config) == register(spark, "reg2", config) == ["other"]
    assert spark.sql("SELECT sum(id) AS s FROM reg2.other").first()["s"] == 3


def test_uncommitted_files_stay_invisible(spark, landed):
    stray = f"{landed.output('gps')}/part-stray.parquet"
    read_landed(spark, landed, "gps").limit(5).toPandas().to_parquet(stray)
    assert read_landed(spark, landed, "gps").count() == 1000


def test_time_filters_reach_the_landed_scan(spark, landed):
    plan = (
        read_landed(spark, landed, "weather")
        .filter("timestamp >= timestamp'2024-01-15'")
        .select("temperature")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "GreaterThanOrEqual(timestamp,2024-01-15" in plan
    assert "ReadSchema: struct<timestamp:timestamp,temperature:double>" in plan


def test_landed_timestamps_carry_statistics(spark, landed):
    import glob

    import pyarrow.parquet as pq

    files = [f for f in glob.glob(f"{landed.output('weather')}/*.snappy.parquet") if pq.read_metadata(f).num_rows]
    meta = pq.read_metadata(files[0])
    at = meta.schema.names.index("timestamp")
    assert meta.row_group(0).column(at).statistics.has_min_max


def test_clustered_tables_correlate_without_a_shuffle(spark, same, landed):
    names = cluster_by_tick(spark, "reg3", landed, buckets=4)
    tables = {kind: spark.table(name) for kind, name in zip(KINDS, names, strict=True)}
    files = [f for f in os.listdir(f"{landed.root}/by_tick/gps_data/v=0") if f.endswith(".parquet")]
    assert len(files) == 4 and tables["gps"].count() == 1000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for unique in (False, True):
            joined = correlate(tables, unique=unique)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan
        assert "Aggregate" not in plan
        want = correlate(records(ticks(spark, SF)))
        assert joined.count() == 1000
        assert same(want, joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_clustering_again_switches_readers_at_once(spark, tmp_path):
    config = JobConfig(root=str(tmp_path))
    for kind in KINDS:
        spark.createDataFrame([], schema(kind)).write.parquet(config.output(kind))
    row = ("a", "d", dt.datetime(2024, 1, 1), None, 1.0)
    readers = []
    for n in range(4):
        spark.createDataFrame([(f"{n}", *row[1:]), (f"{n}", *row[1:]), ("x", None, None, None, None)], schema("gps")).write.mode("append").parquet(config.output("gps"))
        names = cluster_by_tick(spark, "reg5", config, buckets=2)
        readers.append(spark.table(names[KINDS.index("gps")]))
    # every reader sees its own version as long as it is kept; names stay the same
    assert [r.count() for r in readers[2:]] == [3, 4]
    assert sorted(os.listdir(f"{config.root}/by_tick/gps_data")) == ["v=2", "v=3", "versions"]
    assert {t.name for t in spark.catalog.listTables("reg5") if "gps" in t.name} == {"gps_data_by_tick", "gps_data_by_tick_2", "gps_data_by_tick_3"}


def test_violations_on_known_rows(spark):
    when = dt.datetime(2024, 1, 1)
    gps = [("a", "d", when, "[1,2]", s) for s in (14.9, 15.0, 65.0, 65.1, None)]
    trouble = [("a", "d", when, "[1,2]", "i", t, s, "x") for t, s in
               (("None", "Active"), ("Flood", "Resolved"), (None, "Open"), ("Fire", None))]
    rows = {"gps": spark.createDataFrame(gps, schema("gps")), "emergency": spark.createDataFrame(trouble, schema("emergency"))}
    got = {(r["topic"], r["rule"]): r["violations"] for r in quality.violations(rows, DEFAULT_TOPICS).collect()}
    assert got == {("gps_data", "speed"): 2, ("emergency_data", "incident_type"): 1, ("emergency_data", "status"): 1}


def test_reconcile_shows_topics_of_either_side(spark):
    produced = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "3"), ("b", "1")], "topic string, record string")
    there = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "2"), ("c", "1")], "topic string, record string")
    got = {r["topic"]: tuple(r)[1:] for r in quality.reconcile(produced, there).collect()}
    assert got == {"a": (3, 3, 1, 0, 1), "b": (1, 0, 1, 0, 0), "c": (0, 1, 0, 1, 0)}


def test_a_second_crawl_changes_only_what_is_new(spark, tmp_path):
    config = JobConfig(root=str(tmp_path), partition_by_date=True)
    gps, other = config.output("gps"), f"{config.root}/output/other"
    rows = spark.createDataFrame([("a", "d", None, None, 1.0)], schema("gps")).withColumn("event_date", F.lit("2024-01-01").cast("date"))
    rows.write.partitionBy("event_date").parquet(gps)
    spark.range(3).write.parquet(other)
    assert [f[:2] for f in crawl(spark, "crawled", config)] == [("gps_data", "created"), ("gps_data", "partitions"), ("other", "created")]
    assert crawl(spark, "crawled", config) == []
    reader = spark.table("crawled.other")
    # a new partition, a new column with rows that do not have it, and a folder that goes
    rows.withColumn("event_date", F.lit("2024-01-02").cast("date")).write.mode("append").partitionBy("event_date").parquet(gps)
    spark.range(3, 5).withColumn("Näme", F.lit("x")).write.mode("append").parquet(other)
    found = crawl(spark, "crawled", config)
    assert found == [("gps_data", "partitions", "1"), ("other", "added", "`Näme` string")]
    assert spark.table("crawled.gps_data").count() == 2 and reader.count() == 3
    assert spark.table("crawled.other").where("`Näme` IS NULL").count() == 3 and spark.table("crawled.other").count() == 5
    assert crawl(spark, "crawled", config) == []


def test_a_crawl_reports_types_that_differ(spark, tmp_path):
    config = JobConfig(root=str(tmp_path))
    for name, first, then in (("same", "bigint", "string"), ("grown", "string", "string")):
        folder = f"{config.root}/output/{name}"
        spark.range(2).select(F.col("id").cast(first).alias("c")).write.parquet(folder)
        crawl(spark, "conflicting", config)
        spark.range(2).select(F.col("id").cast(then).alias("c")).write.mode("append").parquet(folder)
    found = crawl(spark, "conflicting", config)
    assert [(f.table, f.action) for f in found] == [("same", "conflict")] and "MERGE" in found[0].detail
    assert spark.table("conflicting.grown").count() == 4
    shutil.rmtree(f"{config.root}/output/grown")
    assert ("grown", "gone", "") in crawl(spark, "conflicting", config)


def test_a_quote_in_the_root_does_not_break_registration(spark, tmp_path):
    config = JobConfig(root=str(tmp_path / "driver's"))
    rows = spark.createDataFrame([("a", "d", None, None, 1.0)], schema("gps"))
    rows.write.parquet(config.output("gps"))
    register(spark, "wayfleet_quoted", config)
    assert spark.table("wayfleet_quoted.gps_data").count() == 1


def test_replay_reads_one_name_only(spark, tmp_path):
    from wayfleet.sources.replay import table_stream

    spark.range(3).write.parquet(str(tmp_path / "gps_data"))
    spark.range(5).write.parquet(str(tmp_path / "gps_data_old"))
    stream = table_stream(spark, str(tmp_path / "gps_data"), spark.range(1).schema)
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3


def test_empty_rows_are_not_counted_as_landed(spark):
    df = spark.createDataFrame([(None,) * 5, ("a", None, None, None, None)], schema("gps"))
    assert quality.drop_empty(df).count() == 1


def test_settings_from_the_environment():
    env = {"KAFKA_BOOTSTRAP_SERVER": "b:1", "VEHICLE_TOPIC": "cars"}
    config = JobConfig.from_env("s3a://bucket/base/", env)
    assert config.brokers == "b:1" and config.topics["vehicle"] == "cars" and config.topics["gps"] == "gps_data"
    assert config.output("vehicle") == "s3a://bucket/base/output/cars"
    assert config.checkpoint("gps") == "s3a://bucket/base/checkpoints/gps_data"


def test_command_line():
    config, once = parse(["--root", "/r", "--brokers", "k:9", "--trigger-interval", "1 minute", "--dedup"])
    assert not once
    assert (config.root, config.brokers, config.trigger_interval) == ("/r", "k:9", "1 minute")
    assert config.dedup and not config.quarantine and config.max_offsets_per_trigger is None


def test_main_lands_the_topics(spark, tmp_path, monkeypatch):
    encoded = {k: encode(df) for k, df in records(ticks_stream(spark, SF)).items()}
    monkeypatch.setattr("wayfleet.streaming.land.topic_stream", lambda _, config, kind: encoded[kind])
    for _ in range(2):
        main(["--root", str(tmp_path), "--available-now"])
    config = JobConfig(root=str(tmp_path))
    assert [read_landed(spark, config, kind).count() for kind in KINDS] == [1000] * 5


def test_partitioned_layouts_register(spark, tmp_path):
    config = JobConfig(root=str(tmp_path), partition_by_date=True, quarantine=True)
    logs = {k: encode(df) for k, df in records(ticks_stream(spark, SF)).items()}
    supervise(spark, start_landing(spark, config, logs, available_now=True))
    assert len(register(spark, "reg4", config)) == 5
    days = spark.sql("SELECT event_date, count(*) AS n FROM reg4.gps_data WHERE verdict = 'good' GROUP BY event_date")
    assert sum(r["n"] for r in days.collect()) == 1000 and days.count() > 1


def test_kafka_options():
    options = kafka.source_options(JobConfig(root="/r", brokers="k:9"), "traffic")
    assert options == {"kafka.bootstrap.servers": "k:9", "subscribe": "traffic_data", "startingOffsets": "earliest"}
    limited = JobConfig(root="/r", max_offsets_per_trigger=10, min_partitions=64)
    assert kafka.source_options(limited, "gps")["maxOffsetsPerTrigger"] == "10"
    assert kafka.source_options(limited, "gps")["minPartitions"] == "64"


def test_further_kafka_options_reach_source_and_sink():
    further = {"failOnDataLoss": "false", "kafka.security.protocol": "SSL"}
    config = JobConfig(root="/r", brokers="k:9", max_offsets_per_trigger=10, kafka_options=further)
    assert further.items() <= kafka.source_options(config, "gps").items()
    table = kafka.table_options(config, "gps")
    assert table["endingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in table and further.items() <= table.items()
    assert kafka.sink_options(config) == {"kafka.bootstrap.servers": "k:9", "kafka.security.protocol": "SSL"}
    given, _ = parse(["--root", "/r", "--kafka-option", "failOnDataLoss=false", "--kafka-option", "kafka.x=a=b", "--account"])
    assert given.kafka_options == {"failOnDataLoss": "false", "kafka.x": "a=b"} and given.account
    with pytest.raises(SystemExit):
        parse(["--root", "/r", "--kafka-option", "nothing"])


def test_rows_without_id_are_reconciled_by_content(spark):
    rows = [(None, "d", None, None, 1.0), (None, "d", None, None, 2.0), ("a", "d", None, None, 1.0)]
    produced = {"gps": spark.createDataFrame(rows, schema("gps"))}
    landed_ = {"gps": spark.createDataFrame([(None, "d", None, None, 3.0), rows[0], rows[0], rows[2]], schema("gps"))}
    got = quality.reconcile(*(quality.tag_topics(side, DEFAULT_TOPICS) for side in (produced, landed_))).collect()
    assert [tuple(r) for r in got] == [("gps_data", 3, 4, 1, 1, 1)]


def test_scratch_goes_below_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark), shared_dir(spark)
    assert first.startswith(base) and first != second


@pytest.fixture
def small_events(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1, i % 7, i % 50), i % 9, "click", float(i % 80), f'{{"k": {i % 100}}}') for i in range(240)]
    made = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    made.repartition(12).write.parquet(f"{tmp_path}/events.parquet")
    documents = spark.createDataFrame([(i, f"prose {i}") for i in range(5)], "doc_id long, text string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_accounts_take_few_batches_of_many_files(spark, small_events, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "shared_dir", lambda _: f"{tmp_path}/job")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "4194304"}):
        got = {r["topic"]: tuple(r)[1:] for r in queries.landing_accounts(spark, small_events).collect()}
    assert got["gps_data"] == (480, 480, 0, 48) and got["vehicle_data"][:3] == (960, 960, 480) and got["weather_data"][:3] == (490, 490, 10)
    assert len(list((tmp_path / "job/log/gps").glob("*.parquet"))) == 24
    assert len(list((tmp_path / "job/accounts/gps_data").glob("*.json"))) <= 8


def test_violations_stream_keeps_kinds_apart(spark, small_events, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "shared_dir", lambda _: f"{tmp_path}/job")
    started, land = [], queries.land
    monkeypatch.setattr(queries, "land", lambda *a, **k: started.append(a) or land(*a, **k))
    found = queries.violations_stream(spark, small_events)
    totals = {(r["topic"], r["rule"]): r["bad"] for r in found.groupBy("topic", "rule").agg(F.sum("violations").alias("bad")).collect()}
    batch = {(r["topic"], r["rule"]): r["violations"] for r in queries.quality_violations(spark, small_events).collect()}
    assert totals == batch and len(started) == 5
