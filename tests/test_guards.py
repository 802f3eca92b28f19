"""Schema drift, clocks that run ahead, rules by window."""

import json
from collections import Counter

from pyspark.sql import functions as F

from wayfleet.operators import codec
from wayfleet.operators.clock import hold
from wayfleet.operators.drift import field_report
from wayfleet.operators.quality import violations_by_window
from wayfleet.operators.rollup import speed_rollup
from wayfleet.schemas import DOMAINS, schema
from wayfleet.sources.replay import text_log
from wayfleet.streaming.land import land
from wayfleet.streaming.supervise import supervise


def gps(id_, time, speed=20.0):
    return json.dumps({"id": id_, "device_id": "d", "timestamp": time, "location": [1.0, 2.0], "speed": speed})


def landed(spark, frame, tmp_path, name):
    query = land(frame, str(tmp_path / name), str(tmp_path / f"{name}-cp"), available_now=True)
    supervise(spark, [query])
    return spark.read.schema(frame.schema).parquet(str(tmp_path / name))


def report(frame):
    return Counter(tuple(r) for r in frame.select("topic", "field", "type", "n", "verdict").collect())


def test_field_report(spark):
    values = [
        ("a", '{"id": 1, "x": {"y": [1, 2.5]}, "z": null}'), ("a", '{"id": "one", "z": true, "id2": 3}'), ("a", "{}"), ("a", "[1]"), ("a", "17"),
        ("a", "prose"), ("a", ""), ("a", None), ("b", '{"é \\"q\\"": 1.5}'), (None, '{"k": 1}'),
    ]
    frame = spark.createDataFrame(values, "topic string, value string")
    got = report(field_report(frame, {"a": schema("gps"), "c": schema("traffic")}))
    missing = Counter({("c", f, None, 0, "missing"): 1 for f in schema("traffic").fieldNames()})
    missing.update({("a", f, None, 0, "missing"): 1 for f in schema("gps").fieldNames() if f != "id"})
    assert got == missing + Counter([
        ("a", "id", "VARIANT", 2, "known"), ("a", "x", "OBJECT<y: ARRAY<DECIMAL(21,1)>>", 1, "new"), ("a", "z", "BOOLEAN", 2, "new"),
        ("a", "id2", "BIGINT", 1, "new"), ("a", None, None, 5, "not an object"), ("b", 'é "q"', "DECIMAL(2,1)", 1, "new"), (None, "k", "BIGINT", 1, "new"),
    ])


def test_field_report_of_nothing(spark):
    none = spark.createDataFrame([], "topic string, value binary")
    assert field_report(none, {}).count() == 0
    assert {r["verdict"] for r in field_report(none, {"gps_data": schema("gps")}).collect()} == {"missing"}


def test_one_wrong_clock_loses_no_other_record(spark, batches, tmp_path):
    files = (
        [gps("a", "2024-01-01T10:00:00"), gps("wrong", "2999-01-01T00:00:00"), gps("none", None)],
        [gps("b", "2024-01-01T10:30:00")],
        [gps("c", "2024-01-01T11:30:00"), gps("d", "2024-01-01T12:30:00")],
    )
    folder = batches(*files)
    records = codec.decode(text_log(spark, folder), schema("gps"))
    held, ahead = hold(records)
    rolled = landed(spark, speed_rollup(held), tmp_path, "held")
    assert sorted(r["n"] for r in rolled.collect()) == [1, 2]
    assert [r["id"] for r in landed(spark, ahead, tmp_path, "ahead").collect()] == ["wrong"]
    # without the guard what comes two batches later is lost
    assert sum(r["n"] for r in landed(spark, speed_rollup(records), tmp_path, "open").collect()) == 2
    # a table is parted alike, and nothing is lost
    table = codec.decode(spark.read.text(folder), schema("gps"))
    assert [sorted(map(str, (r["id"] for r in part.collect()))) for part in hold(table)] == [["a", "b", "c", "d", "none"], ["wrong"]]


def test_rules_by_window_on_streams(spark, batches, tmp_path):
    files = (
        [gps("a", "2024-01-01T10:00:00", 70.0), gps("b", "2024-01-01T10:59:59.999999", 20.0), gps("e", "2024-01-01T10:01:00", None)],
        [gps("late", "2024-01-01T10:58:30", 1.0), gps("c", "2024-01-01T11:30:00", 3.0), gps("t", None, 3.0)],
        [gps("too late", "2024-01-01T10:00:00", 1.0), gps("clock", "2024-01-01T12:30:00")],
        [gps("too late", "2024-01-01T10:00:00", 1.0)],
    )
    records = codec.decode(text_log(spark, batches(*files)), schema("gps"))
    found = landed(spark, violations_by_window(records, "gps_data", DOMAINS["gps"]), tmp_path, "v")
    got = sorted((r["topic"], r["window_start"].hour, r["rule"], r["n"], r["violations"]) for r in found.collect())
    # late by one batch is still in time, as Spark moves the watermark between batches
    assert [g for g in got if g[1] == 11] == [("gps_data", 11, "speed", 1, 1)]
    assert got[0][:3] == ("gps_data", 10, "speed") and got[0][3] in (3, 4) and len(got) == 2
    table = codec.decode(spark.read.text(str(tmp_path / "in")), schema("gps"))
    whole = violations_by_window(table.where(F.col("id") != "too late"), "gps_data", DOMAINS["gps"])
    assert sorted(r["n"] for r in whole.collect()) == [1, 1, 3]
