import datetime as dt
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfleet.operators import codec
from wayfleet.schemas import DEFAULT_TOPICS, KINDS, schema

PROBE = StructType()
for name, kind in zip(
    ("id", "device_id", "timestamp", "location", "temperature", "precipitation"),
    ("string", "string", "timestamp", "string", "double", "integer"),
    strict=True,
):
    PROBE.add(name, kind)
EMPTY = dict.fromkeys(PROBE.fieldNames())


def log(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value string")


def decode_one(spark, value):
    rows = codec.decode(log(spark, value), PROBE).collect()
    assert len(rows) == 1
    return rows[0].asDict()


MATRIX = {
    "full": (
        '{"id":"a","device_id":"d","timestamp":"2024-03-01T10:00:00.123456",'
        '"location":[40.758896, -73.98513],"temperature":55.5,"precipitation":3}',
        {
            "id": "a",
            "device_id": "d",
            "timestamp": dt.datetime(2024, 3, 1, 10, 0, 0, 123456),
            "location": "[40.758896,-73.98513]",
            "temperature": 55.5,
            "precipitation": 3,
        },
    ),
    "no fraction": ('{"timestamp":"2024-03-01T10:00:00"}', {"timestamp": dt.datetime(2024, 3, 1, 10)}),
    "offset": ('{"timestamp":"2024-03-01T10:00:00+02:00"}', {"timestamp": dt.datetime(2024, 3, 1, 8)}),
    "malformed": ('{"id":"a", oops', {}),
    "truncated": ('{"id":"a","device_id":"d"', {}),
    "tombstone": (None, {}),
    "empty": ("", {}),
    "json null": ("null", {}),
    "array": ('[{"id":"a"},{"id":"b"}]', {}),
    "int 3.5": ('{"id":"a","precipitation":3.5}', {"id": "a"}),
    "int 3.0": ('{"id":"a","precipitation":3.0}', {"id": "a"}),
    "int text": ('{"id":"a","precipitation":"3"}', {"id": "a"}),
    "int overflow": ('{"id":"a","precipitation":99999999999}', {"id": "a"}),
    "double text": ('{"id":"a","temperature":"55.5"}', {"id": "a"}),
    "bad time": ('{"id":"a","timestamp":"not a time","precipitation":1}', {"id": "a", "precipitation": 1}),
    "extra key": ('{"id":"a","zzz":1,"precipitation":1}', {"id": "a", "precipitation": 1}),
    "duplicate key": ('{"id":"a","id":"b","precipitation":1}', {"id": "b", "precipitation": 1}),
    "key case": ('{"ID":"a","precipitation":1}', {"precipitation": 1}),
    "number as text": ('{"id":17,"precipitation":1}', {"id": "17", "precipitation": 1}),
}


@pytest.mark.parametrize("case", MATRIX)
def test_decode_matrix(spark, case):
    value, expected = MATRIX[case]
    assert decode_one(spark, value) == {**EMPTY, **expected}


def test_decode_nan(spark):
    row = decode_one(spark, '{"id":"a","temperature":NaN}')
    assert row["id"] == "a" and math.isnan(row["temperature"])


def test_decode_takes_binary_values(spark):
    df = log(spark, '{"id":"a"}').select(F.col("value").cast("binary").alias("value"), F.lit(1).alias("offset"))
    out = codec.decode(df, PROBE)
    assert out.columns == PROBE.fieldNames() and out.first()["id"] == "a"


BAD = {"malformed", "truncated", "tombstone", "empty", "json null", "array"} | {
    "int 3.5", "int 3.0", "int text", "int overflow", "double text", "bad time",
}


def test_flagged_decode_keeps_the_text_of_bad_rows(spark):
    names = list(MATRIX)
    df = log(spark, *(MATRIX[name][0] for name in names))
    rows = codec.decode_flagged(df, PROBE, keep=("n",)).collect()
    assert {names[r["n"]] for r in rows if r["is_bad"]} == BAD
    for r in rows:
        unread = not any(v is not None for v in (r[f] for f in PROBE.fieldNames()))
        assert r["raw"] == (MATRIX[names[r["n"]]][0] if r["is_bad"] or unread else None)


def test_flagged_decode_keeps_the_text_of_another_layout(spark):
    row = codec.decode_flagged(log(spark, '{"ID":"a"}'), PROBE).first()
    assert row["raw"] == '{"ID":"a"}' and not row["is_bad"]


def test_flagged_decode_agrees_with_decode(spark, same):
    df = log(spark, *(value for value, _ in MATRIX.values()))
    plain = codec.decode(df, PROBE)
    flagged = codec.decode_flagged(df, PROBE).select(*PROBE.fieldNames())
    assert same(plain, flagged)


def test_schemas_are_nullable_and_lead_with_the_common_fields():
    for kind in KINDS:
        fields = schema(kind).fields
        assert [f.name for f in fields[:4]] == ["id", "device_id", "timestamp", "location"]
        assert all(f.nullable for f in fields)


def test_encoded_wire_form(spark):
    row = spark.createDataFrame(
        [("v-0", "V-8", dt.datetime(2024, 1, 1, 0, 0, 7, 179575), [40.5, -73.25])],
        "id string, device_id string, timestamp timestamp, location array<double>",
    )
    out = codec.encode(row).first()
    assert bytes(out["key"]) == b"v-0"
    assert json.loads(bytes(out["value"])) == {
        "id": "v-0", "device_id": "V-8", "timestamp": "2024-01-01T00:00:07.179575", "location": [40.5, -73.25],
    }


TEXT = st.none() | st.text(st.characters(exclude_categories=("Cs",)), max_size=20)
REAL = st.none() | st.floats(allow_nan=False, allow_infinity=False)
TIME = st.none() | st.datetimes(dt.datetime(1970, 1, 2), dt.datetime(2200, 1, 1))
INT = st.none() | st.integers(-(2**31), 2**31 - 1)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(TEXT, TEXT, TIME, TEXT, REAL, TEXT, TEXT, INT), min_size=1, max_size=30))
def test_decode_inverts_encode(spark, same, rows):
    df = spark.createDataFrame(rows, schema("vehicle"))
    back = codec.decode(codec.encode(df), schema("vehicle"))
    assert same(df, back)


def test_location_text(spark):
    texts = ["[40.758896,-73.98513]", "[1]", "[]", "oops", "", None, "[1,2,3]", '["a",2]']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, location string")
    got = {r["id"]: (r["lat"], r["lon"]) for r in codec.parse_location(df).collect()}
    assert got[0] == (40.758896, -73.98513) and got[1] == (1.0, None) and got[6] == (1.0, 2.0)
    assert all(got[i] == (None, None) for i in (2, 3, 4, 5))


def test_topic_log_is_one_pass_and_equals_the_fan_out(spark, same):
    from wayfleet.plans.ticks import as_ticks, payloads

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ticks = as_ticks(events)
    log_all = codec.topic_log(ticks, payloads(), DEFAULT_TOPICS)
    for kind, df in codec.fan_out(ticks, payloads()).items():
        part = log_all.filter(F.col("topic") == DEFAULT_TOPICS[kind]).select("key", "value")
        alone = codec.encode(df)
        assert same(part, alone)
    assert log_all._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
