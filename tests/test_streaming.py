import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wayfleet.config import JobConfig
from wayfleet.operators import codec
from wayfleet.operators.correlate import CARRIED, correlate
from wayfleet.operators.dedup import dedup_stream, dedup_table
from wayfleet.operators.rollup import speed_rollup
from wayfleet.operators.trips import gaps, truncate_trips
from wayfleet.plans import queries
from wayfleet.schemas import DESTINATION, KINDS, schema
from wayfleet.sources.landed import read_landed
from wayfleet.sources.replay import text_log
from wayfleet.streaming.live_trips import truncate_stream
from wayfleet.streaming.land import land, landing_frame, start_landing
from wayfleet.streaming.silence import silences
from wayfleet.streaming.supervise import supervise


def gps(id_, clock, device="d", speed=20.0):
    return json.dumps(
        {"id": id_, "device_id": device, "timestamp": f"2024-01-01T{clock}", "location": [1.0, 2.0], "speed": speed}
    )


THREE = (
    [gps("a", "10:00:00"), gps("b", "10:30:00"), '{"id":"a", oops'],
    [gps("late", "09:00:00"), gps("c", "10:31:00")],
    [gps("late2", "08:00:00"), gps("a", "10:00:00")],
)


def run(spark, frame, tmp_path, name="t", **options):
    query = land(frame, str(tmp_path / name), str(tmp_path / f"{name}-cp"), available_now=True, **options)
    supervise(spark, [query])
    return spark.read.schema(frame.schema).parquet(str(tmp_path / name))


def ids(df):
    return sorted((r["id"] for r in df.collect()), key=lambda v: (v is not None, v))


def test_pass_through_keeps_late_and_undecodable_rows_and_restarts_cleanly(spark, batches, tmp_path):
    log = text_log(spark, batches(*THREE))
    frame, _ = landing_frame(log, "gps", JobConfig(root="x"))
    assert ids(run(spark, frame, tmp_path)) == [None, "a", "a", "b", "c", "late", "late2"]
    assert run(spark, frame, tmp_path).count() == 7


def test_restart_picks_up_only_new_files(spark, batches, tmp_path):
    folder = batches([gps("a", "10:00:00")])
    frame, _ = landing_frame(text_log(spark, folder), "gps", JobConfig(root="x"))
    run(spark, frame, tmp_path)
    (tmp_path / "in" / "next.txt").write_text(gps("b", "10:01:00") + "\n")
    assert ids(run(spark, frame, tmp_path)) == ["a", "b"]


def test_dedup_drops_copies_of_earlier_batches_and_keeps_late_rows(spark, batches, tmp_path):
    records = codec.decode(text_log(spark, batches(*THREE)), schema("gps"))
    assert ids(run(spark, dedup_stream(records), tmp_path)) == [None, "a", "b", "c", "late", "late2"]


@pytest.mark.parametrize("first", ["2024-01-02T10:00:00", "2999-01-01T00:00:00"])
def test_dedup_loses_nothing_to_a_clock_that_runs_ahead(spark, batches, tmp_path, first):
    ahead = gps("ahead", "10:00:00").replace("2024-01-01T10:00:00", first)
    files = [[ahead], *([gps(f"r{i:02d}", f"10:{i:02d}:00")] for i in range(8)), [gps(f"r{i:02d}", f"10:{i:02d}:00") for i in range(41)]]
    config = JobConfig(root="x", dedup=True)
    frame, _ = landing_frame(text_log(spark, batches(*files)), "gps", config)
    assert ids(run(spark, frame, tmp_path)) == ["ahead", *(f"r{i:02d}" for i in range(41))]


@pytest.mark.parametrize("quarantine", [False, True])
def test_dedup_keeps_different_records_without_id(spark, batches, tmp_path, quarantine):
    lines = [gps(None, "10:00:00", device=f"d{i}") for i in range(5)]
    frame, _ = landing_frame(text_log(spark, batches(lines, lines)), "gps", JobConfig(root="x", dedup=True, quarantine=quarantine))
    assert sorted(r["device_id"] for r in run(spark, frame, tmp_path).collect()) == [f"d{i}" for i in range(5)]


@pytest.mark.parametrize("combine", [False, True])
def test_dedup_with_a_dominant_key(spark, same, batches, tmp_path, combine):
    lines = [gps("hot", "10:00:00")] * 500 + [gps(f"r{i}", "10:00:01") for i in range(20)] + ["oops"] * 200
    records = codec.decode(text_log(spark, batches(lines, lines, lines)), schema("gps"))
    out = run(spark, dedup_stream(records, combine=combine), tmp_path)
    decoded = out.dropna("all")
    assert ids(decoded) == ["hot", *sorted(f"r{i}" for i in range(20))]
    assert out.count() - decoded.count() == 1
    batch = codec.decode(spark.read.text(str(tmp_path / "in")), schema("gps")).dropna("all")
    assert same(dedup_table(batch), decoded)


def test_dedup_state_is_cleared(spark, batches, tmp_path):
    """Neither old keys nor those of undecodable rows stay behind once the delay has passed."""
    files = [[gps(f"b{i}", f"1{i}:00:00"), f"oops {i}"] for i in range(6)]
    records = codec.decode_flagged(text_log(spark, batches(*files)), schema("gps"))
    query = land(
        dedup_stream(records, delay="0 seconds"), str(tmp_path / "o"), str(tmp_path / "c"), available_now=True
    )
    supervise(spark, [query])
    assert spark.read.parquet(str(tmp_path / "o")).count() == 12
    last = json.loads(query.recentProgress[-1].json)["stateOperators"][0]
    assert last["numRowsTotal"] <= 3


def test_rollup_emits_closed_windows_only(spark, batches, tmp_path):
    records = codec.decode(text_log(spark, batches(*THREE)), schema("gps"))
    got = run(spark, speed_rollup(records, width="5 minutes"), tmp_path).collect()
    start = dt.datetime(2024, 1, 1)
    assert sorted((r["window_start"], r["n"], r["sum_cents"]) for r in got) == [
        (start + dt.timedelta(hours=9), 1, 2000),
        (start + dt.timedelta(hours=10), 1, 2000),
    ]


def trip(id_, second, device="d", at=(41.0, -73.0)):
    clock = f"10:{second // 60:02d}:{second % 60:02d}"
    record = json.loads(gps(id_, clock, device))
    return json.dumps({**record, "location": list(at)})


CLOCK = "11:59:59"


def live(spark, batches, tmp_path, *files, name="t", **options):
    """Live truncation of the batches and a last one, of another device, that moves the clock on."""
    log = text_log(spark, batches(*files, [gps("clock", CLOCK, "clock")], name=f"{name}-in"))
    ticks = codec.parse_location(codec.decode(log, schema("gps")))
    return run(spark, truncate_stream(ticks, **options), tmp_path, name).where("device_id IS DISTINCT FROM 'clock'")


def test_live_truncation_across_batches(spark, batches, tmp_path):
    files = (
        [trip("a2", 80), trip("a1", 40), *(trip(f"h{i:03d}", i, "hot") for i in range(150))],
        [trip("a4", 160, at=DESTINATION), trip("a3", 120), trip("a5", 200), trip("n", 101, "new", at=DESTINATION)],
        [trip("a6", 240), *(trip(f"h{i:03d}", i, "hot") for i in range(150, 260)), trip("n2", 142, "new")],
    )
    numbers = {r["id"]: r["rn"] for r in live(spark, batches, tmp_path, *files).collect()}
    hot = {f"h{i:03d}": i + 1 for i in range(200)}
    assert numbers == {"a1": 1, "a2": 2, "a3": 3, **hot}


def test_live_truncation_orders_late_ticks_and_arrivals(spark, batches, tmp_path):
    files = (
        [trip("b", 40), trip("d", 100), trip("x", 40, "e"), trip("z", 110, "e")],
        [trip("a", 0), trip("c", 60)],  # earlier ticks in a later batch
        [trip("y", 70, "e", at=DESTINATION)],  # the arrival comes after the tick behind it
    )
    numbers = {r["id"]: r["rn"] for r in live(spark, batches, tmp_path, *files).collect()}
    assert numbers == {"a": 1, "b": 2, "c": 3, "d": 4, "x": 1}


def test_live_truncation_equals_the_table_form(spark, same, batches, tmp_path):
    rng = random.Random(7)
    rows = [(i * 7 % 3000, trip(f"x{i:04d}", i * 7 % 3000, f"d{i % 5 % 4}", DESTINATION if i % 401 == 400 else (41.0, -73.0)))
            for i in range(1500)]
    rows.append((5, trip("nowhere", 5, "d1", (None, None))))
    rows.append((9, trip("none", 9, None)))
    rows.sort(key=lambda r: r[0] + rng.uniform(0, 110))  # later than its turn by less than the delay
    lines = [line for _, line in rows]
    files = [lines[i : i + 251] for i in range(0, len(lines), 251)]
    assert len(files) == 6
    got = live(spark, batches, tmp_path, *files)
    table = codec.parse_location(codec.decode(spark.read.text(str(tmp_path / "t-in")), schema("gps")))
    assert same(truncate_trips(table.where("device_id IS DISTINCT FROM 'clock'")), got)


def test_live_truncation_passes_values_unchanged(spark, batches, tmp_path):
    layout = "id string, device_id string, timestamp timestamp, lat double, lon double, n bigint, seen timestamp"
    file = [json.dumps({"id": f"r{i}", "device_id": "d", "timestamp": t, "lat": 1.0, "lon": 2.0, "n": n, "seen": "9999-12-31T23:59:59.999999"})
            for i, (t, n) in enumerate([("2024-01-01T00:00:00.000001", 2**53 + 1), ("9998-12-31T00:00:00", None)])]
    clock = json.dumps({"id": "c", "device_id": "clock", "timestamp": "9999-12-31T23:59:59"})
    log = text_log(spark, batches(file, [clock]))
    rows = log.select(F.from_json("value", layout).alias("r")).select("r.*")
    got = run(spark, truncate_stream(rows), tmp_path).where("device_id = 'd'").orderBy("id")
    assert got.dtypes == [*rows.dtypes, ("rn", "bigint")]
    shown = [tuple(r) for r in got.select("id", F.col("timestamp").cast("string"), "n", F.col("seen").cast("string"), "rn").collect()]
    last = "9999-12-31 23:59:59.999999"
    assert shown == [("r0", "2024-01-01 00:00:00.000001", 2**53 + 1, last, 1), ("r1", "9998-12-31 00:00:00", None, last, 2)]


def test_state_of_ended_and_silent_devices_goes(spark, batches, tmp_path):
    files = (
        [trip(f"t{i}", i, f"d{i}") for i in range(20)],
        [trip(f"u{i}", 300 + i, f"d{i}", DESTINATION if i % 2 else (41.0, -73.0)) for i in range(20)],
        [gps("c1", "11:00:00", "clock")],
        [gps("c2", "11:10:00", "clock")],
    )
    log = text_log(spark, batches(*files))
    ticks = codec.parse_location(codec.decode(log, schema("gps")))
    query = land(truncate_stream(ticks, forget="20 minutes"), str(tmp_path / "o"), str(tmp_path / "c"), available_now=True)
    supervise(spark, [query])
    assert spark.read.parquet(str(tmp_path / "o")).where("device_id <> 'clock'").count() == 30
    told = spark.read.format("statestore").option("stateVarName", "told").load(str(tmp_path / "c"))
    assert [r["key"]["device_id"] for r in told.collect()] == ["clock"]


def test_silence_is_told_without_a_row_and_again_at_its_end(spark, batches, tmp_path):
    files = (
        [trip("a", 0), trip("b", 50), trip("x", 0, "e"), trip("n", 0, None)],
        [trip("c", 90), trip("clock", 300, "clock")],  # d is quiet from 90 on, e from 0
        [trip("late", 200), trip("e2", 400, "e"), trip("clock", 460, "clock")],  # late by less than the delay
        [trip("clock", 900, "clock")],
    )
    log = text_log(spark, batches(*files))
    ticks = codec.parse_location(codec.decode(log, schema("gps")))
    found = run(spark, silences(ticks), tmp_path).where("device_id IS DISTINCT FROM 'clock'")
    start = dt.datetime(2024, 1, 1, 10)
    got = Counter((r["device_id"], (r["since"] - start).seconds, r["until"] and (r["until"] - start).seconds, r["gap_us"]) for r in found.collect())
    assert got == Counter([
        ("e", 0, None, None), (None, 0, None, None), ("d", 90, None, None), ("d", 90, 200, 110_000_000), ("e", 0, 400, 400_000_000),
        ("d", 200, None, None), ("e", 400, None, None),
    ])


def test_silence_equals_gaps_of_the_table(spark, batches, tmp_path):
    rng = random.Random(3)
    rows = [(s, trip(f"x{i}", s, f"d{i % 3}")) for i, s in enumerate(rng.choices(range(3400), k=300))]
    rows.sort(key=lambda r: r[0] + rng.uniform(0, 110))
    lines = [line for _, line in rows]
    files = [lines[i : i + 50] for i in range(0, len(lines), 50)]
    log = text_log(spark, batches(*files, [gps("clock", CLOCK, "clock")]))
    found = run(spark, silences(codec.parse_location(codec.decode(log, schema("gps")))), tmp_path).where("device_id <> 'clock'")
    table = codec.parse_location(codec.decode(spark.read.text(str(tmp_path / "in")), schema("gps"))).where("device_id <> 'clock'")
    want = gaps(table).where("gap_us > 60000000").select("device_id", F.timestamp_micros(F.unix_micros("timestamp") - F.col("gap_us")).alias("since"), F.col("timestamp").alias("until"), "gap_us")
    closed, open_ = found.where("until IS NOT NULL"), found.where("until IS NULL").select("device_id", "since")
    assert Counter(closed.collect()) == Counter(want.collect())
    last = table.groupBy("device_id").agg(F.max("timestamp").alias("since"))
    assert Counter(open_.join(closed, ["device_id", "since"], "left_anti").collect()) == Counter(last.collect())


def sibling_logs(spark, batches):
    """Five topics, three files each, five ticks per file."""
    logs = {}
    for kind in KINDS:
        files = []
        for b in range(3):
            lines = []
            for i in range(5):
                record = json.loads(gps(f"{kind[0]}-{b}-{i}", f"10:{b * 10:02d}:{i * 10:02d}", device=f"d{i % 2}"))
                lines.append(json.dumps(record))
            files.append(lines)
        logs[kind] = text_log(spark, batches(*files, name=kind))
    return logs


def test_five_way_stream_join(spark, batches, tmp_path):
    streams = {k: codec.decode(log, schema(k)) for k, log in sibling_logs(spark, batches).items()}
    out = run(spark, correlate(streams), tmp_path).collect()
    assert len(out) == 15
    assert all(r["vehicle_id"][1:] == r["gps_id"][1:] == r["emergency_id"][1:] for r in out)


def test_stream_and_table_correlation_agree(spark, same, batches, tmp_path):
    logs = sibling_logs(spark, batches)
    streams = {k: codec.decode(log, schema(k)) for k, log in logs.items()}
    tables = {k: codec.decode(spark.read.text(str(tmp_path / k)), schema(k)) for k in KINDS}
    live, still = run(spark, correlate(streams), tmp_path), correlate(tables)
    assert same(live, still)


def test_copies_of_a_record_do_not_multiply(spark, same, batches, tmp_path):
    logs = sibling_logs(spark, batches)
    once = {k: codec.decode(spark.read.text(str(tmp_path / k)), schema(k)) for k in KINDS}
    twice = {k: df.unionByName(df) for k, df in once.items()}
    assert same(correlate(once), correlate(twice))
    streams = {k: codec.decode(log.unionByName(log), schema(k)) for k, log in logs.items()}
    live = run(spark, correlate(streams), tmp_path)
    assert same(correlate(once), live)


def test_every_distinct_record_of_a_tick_correlates(spark, same, batches, tmp_path):
    """Two incidents at one tick give two rows; so do siblings that come in different batches."""
    logs = sibling_logs(spark, batches)
    second = gps("e-second", "10:00:00", device="d0")
    (tmp_path / "emergency" / "003.txt").write_text(second + "\n" + second + "\n")
    tables = {k: codec.decode(spark.read.text(str(tmp_path / k)), schema(k)) for k in KINDS}
    still = correlate(tables)
    assert sorted(r["emergency_id"] for r in still.where("vehicle_id = 'v-0-0'").collect()) == ["e-0-0", "e-second"]
    assert still.count() == 16
    once = {k: text_log(spark, str(tmp_path / k), files_per_batch=9) for k in KINDS}
    live = run(spark, correlate({k: codec.decode(log, schema(k)) for k, log in once.items()}), tmp_path)
    assert same(still, live)


def test_records_without_id_are_no_copies(spark):
    rows = {k: codec.decode(spark.createDataFrame([(gps(k, "10:00:00"),)], "value string"), schema(k)) for k in KINDS}
    lines = [(gps(None, "10:00:00", speed=s),) for s in (20.0, 30.0, 30.0)]
    rows["gps"] = codec.decode(spark.createDataFrame(lines, "value string"), schema("gps"))
    assert sorted(r["gps_speed"] for r in correlate(rows).collect()) == [20.0, 30.0]


def test_record_ids_do_not_join(spark, batches, tmp_path):
    sibling_logs(spark, batches)
    left, right = (codec.decode(spark.read.text(str(tmp_path / k)), schema(k)) for k in ("vehicle", "gps"))
    assert left.join(right, ["id", "timestamp"]).count() == 0
    assert left.join(right, ["device_id", "timestamp"]).count() == 15


def test_undecodable_rows_do_not_correlate(spark):
    rows = {k: codec.decode(spark.createDataFrame([("oops",)] * 3, "value string"), schema(k)) for k in KINDS}
    joined = correlate(rows)
    assert joined.count() == 0
    assert joined.columns == ["device_id", "timestamp", *(n for c in CARRIED.values() for n in c.values())]


def test_one_failing_query_stops_the_others(spark, batches, tmp_path):
    good = text_log(spark, batches(*THREE, name="good"))
    bad = text_log(spark, batches(["x"], name="bad")).select(F.raise_error(F.lit("boom")).cast("string").alias("v"))
    running = [
        land(good, str(tmp_path / "g"), str(tmp_path / "g-cp")),
        land(bad, str(tmp_path / "b"), str(tmp_path / "b-cp")),
    ]
    with pytest.raises(StreamingQueryException, match="boom"):
        supervise(spark, running)
    assert not any(q.isActive for q in running)


def test_a_strangers_failure_does_not_stop_our_queries(spark, batches, tmp_path):
    bad = text_log(spark, batches(["x"], name="bad")).select(F.raise_error(F.lit("boom")).cast("string").alias("v"))
    stranger = land(bad, str(tmp_path / "b"), str(tmp_path / "b-cp"))
    with pytest.raises(StreamingQueryException):
        stranger.awaitTermination()
    good = text_log(spark, batches(*THREE, name="good"))
    assert run(spark, good, tmp_path).count() == 7


def test_landing_job_layouts(spark, batches, tmp_path):
    logs = sibling_logs(spark, batches)
    (tmp_path / "gps" / "junk.txt").write_text("oops\n" + gps("g-0-0", "10:00:00", device="d0") + "\n")
    plain = JobConfig(root=str(tmp_path / "plain"))
    supervise(spark, start_landing(spark, plain, logs, available_now=True))
    assert {k: read_landed(spark, plain, k).count() for k in KINDS} == {**dict.fromkeys(KINDS, 15), "gps": 17}

    full = JobConfig(root=str(tmp_path / "full"), partition_by_date=True, quarantine=True, dedup=True)
    supervise(spark, start_landing(spark, full, logs, available_now=True))
    landed = read_landed(spark, full, "gps")
    assert {"event_date", "verdict", "raw"} <= set(landed.columns)
    assert [r["raw"] for r in landed.filter("verdict = 'bad'").collect()] == ["oops"]
    assert landed.filter("verdict = 'good'").count() == 15
    plan = landed.filter("verdict = 'good' AND event_date = date'2024-01-01'")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull" in plan.toString()


class Ended:
    """A query that is gone; ``fails_later`` fails only after it was first asked whether it is active."""

    def __init__(self, fails_later=False):
        self.asked, self.fails_later, self.stopped = 0, fails_later, False

    @property
    def isActive(self):
        self.asked += 1
        return self.fails_later and self.asked == 1

    def exception(self):
        return StreamingQueryException("boom") if self.fails_later and self.asked > 1 else None

    def stop(self):
        self.stopped = True


def test_a_failure_between_two_looks_is_not_swallowed():
    class Streams:
        awaitAnyTermination = resetTerminated = staticmethod(lambda: None)

    class Session:
        streams = Streams

    with pytest.raises(StreamingQueryException):
        supervise(Session, [Ended(), Ended(fails_later=True)])


def test_queries_started_before_one_that_cannot_start_are_stopped(spark, batches, tmp_path):
    from wayfleet.schemas import KINDS
    from wayfleet.streaming.land import start_landing

    folder = batches(*THREE)
    logs = {kind: text_log(spark, folder) for kind in KINDS}
    logs[KINDS[3] if isinstance(KINDS, (list, tuple)) else list(KINDS)[3]] = spark.range(1).select(F.lit("x").alias("value"))
    before = {q.id for q in spark.streams.active}
    with pytest.raises(Exception):
        start_landing(spark, JobConfig(root=str(tmp_path / "r")), logs)
    assert {q.id for q in spark.streams.active} <= before


def test_correlation_does_not_count_the_rows_of_its_state(spark, tmp_path, monkeypatch):
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    rows = [(i, i, dt.datetime(2024, 1, 1, 10, 0, i), "click", 5.0, '{"k": 7}') for i in range(3)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    asked, landed = [], queries.land
    monkeypatch.setattr(queries, "land", lambda *a, **b: asked.append(spark.conf.get(key, None)) or landed(*a, **b))
    assert queries.correlate_stream(spark, str(tmp_path)).count() == 3
    assert asked == ["false"] and spark.conf.get(key, None) is None
