"""The same questions as DuckDB SQL over the driver's tables."""

from __future__ import annotations

from wayfleet.schemas import (
    CAMERA,
    DEFAULT_TOPICS,
    DOMAINS,
    INCIDENT_STATUSES,
    INCIDENT_TEXT,
    INCIDENT_TYPES,
    KINDS,
    MAKE,
    MODEL,
    SNAPSHOT,
    WEATHER_CONDITIONS,
)

TICKS = """ticks AS (
  SELECT event_id, 'V-' || CAST(user_id AS VARCHAR) AS device_id, ts AS event_ts,
         40.758896E0 + 1.580704E0 * least(value / 100E0, 1E0) AS lat,
         -73.98513E0 + 2.91533E0 * least(value / 100E0, 1E0) AS lon,
         value, CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k
  FROM events)"""

ARRIVED = "(abs(lat - 42.3396E0) <= 0.02E0 AND abs(lon - (-71.0698E0)) <= 0.02E0)"
BY_DEVICE = "(PARTITION BY device_id ORDER BY event_ts, event_id)"


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _pick(values: list[str]) -> str:
    return f"([{_quoted(values)}])[k % {len(values)} + 1]"


EXTRA = {
    "vehicle": f"value AS speed, '{MAKE}' AS make, '{MODEL}' AS model, CAST(2014 + k % 12 AS INTEGER) AS year",
    "gps": "value + 1 AS speed",
    "traffic": f"'{CAMERA}' AS camera_id, '{SNAPSHOT}' AS snapshot",
    "weather": (
        f"CAST(k AS DOUBLE) AS temperature, {_pick(WEATHER_CONDITIONS)} AS weather_condition, "
        "k AS precipitation, CAST(100 - k AS INTEGER) AS humidity, "
        "CAST(k % 31 AS DOUBLE) AS wind_speed, value AS air_quality"
    ),
    "emergency": (
        f"'i-' || CAST(event_id AS VARCHAR) AS incident_id, {_pick(INCIDENT_TYPES)} AS incident_type, "
        f"{_pick(INCIDENT_STATUSES)} AS status, '{INCIDENT_TEXT}' AS description"
    ),
}


def _record(kind: str) -> str:
    return (
        f"SELECT '{kind[0]}-' || CAST(event_id AS VARCHAR) AS id, device_id, "
        f'event_ts AS "timestamp", lat, lon, {EXTRA[kind]} FROM ticks'
    )


RECORDS = ",\n".join(f"{kind} AS ({_record(kind)})" for kind in KINDS)
WITH_TICKS = f"WITH {TICKS}\n"
WITH_RECORDS = f"WITH {TICKS},\n{RECORDS}\n"

CORRELATE = WITH_RECORDS + """
SELECT device_id, "timestamp", v.id AS vehicle_id, g.id AS gps_id, t.id AS traffic_id,
       w.id AS weather_id, e.id AS emergency_id, v.speed AS vehicle_speed, g.speed AS gps_speed,
       w.temperature, e.incident_type
FROM vehicle v JOIN gps g USING (device_id, "timestamp") JOIN traffic t USING (device_id, "timestamp")
     JOIN weather w USING (device_id, "timestamp") JOIN emergency e USING (device_id, "timestamp")"""


TRUNCATE = WITH_TICKS + f"""
SELECT event_id, device_id, rn FROM (
  SELECT event_id, device_id, row_number() OVER {BY_DEVICE} AS rn,
         max(CASE WHEN {ARRIVED} THEN 1 ELSE 0 END) OVER {BY_DEVICE} AS arrived
  FROM ticks) WHERE rn <= 200 AND arrived = 0"""


def _union(select: str) -> str:
    return " UNION ALL ".join(select.format(kind=kind, topic=DEFAULT_TOPICS[kind]) for kind in KINDS)


def _violations() -> str:
    parts = []
    for kind, rules in DOMAINS.items():
        for rule, domain in rules.items():
            test = f"BETWEEN {domain[0]} AND {domain[1]}" if isinstance(domain, tuple) else f"IN ({_quoted(domain)})"
            parts.append(
                f"SELECT '{DEFAULT_TOPICS[kind]}' AS topic, '{rule}' AS rule, "
                f"count(*) FILTER (WHERE NOT ({rule} {test})) AS violations FROM {kind}"
            )
    return WITH_RECORDS + "\nUNION ALL ".join(parts)


def _hourly_violations() -> str:
    parts = []
    for kind, rules in DOMAINS.items():
        for rule, domain in rules.items():
            test = f"BETWEEN {domain[0]} AND {domain[1]}" if isinstance(domain, tuple) else f"IN ({_quoted(domain)})"
            parts.append(
                f"SELECT '{DEFAULT_TOPICS[kind]}' AS topic, time_bucket(INTERVAL 1 HOUR, \"timestamp\") AS window_start, "
                f"'{rule}' AS rule, count({rule}) AS n, count(*) FILTER (WHERE NOT ({rule} {test})) AS violations FROM {kind} GROUP BY ALL"
            )
    return WITH_RECORDS + "\nUNION ALL ".join(parts)


HOURLY = """
SELECT time_bucket(INTERVAL 1 HOUR, event_ts) AS window_start, device_id, count(*) AS n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS sum_cents
FROM ticks GROUP BY ALL"""


def _drift() -> str:
    """Fields of the strange values, counted where they are made, and the schemas' own, which none of these has."""
    def missing(kind: str, names: str) -> str:
        return f"SELECT '{DEFAULT_TOPICS[kind]}', unnest([{names}]), NULL, 0::BIGINT, 'missing'"

    lead = "'id', 'device_id', 'timestamp', 'location'"
    return f"""
SELECT 'vehicle_data' AS topic, 'k' AS field, 'BIGINT' AS type, count(*) AS n, 'new' AS verdict FROM events
UNION ALL SELECT 'weather_data', 'doc_id', 'BIGINT', count(*), 'new' FROM documents
UNION ALL SELECT 'weather_data', 'lang', 'STRING', count(lang), 'new' FROM documents
UNION ALL SELECT 'weather_data', 'origin', 'OBJECT<n_chars: BIGINT, source: STRING>', count(*), 'new' FROM documents
UNION ALL SELECT 'weather_data', NULL, NULL, count(*), 'not an object' FROM documents
UNION ALL {missing('vehicle', lead + ", 'speed', 'make', 'model', 'year'")}
UNION ALL {missing('weather', lead + ", 'temperature', 'weather_condition', 'precipitation', 'humidity', 'wind_speed', 'air_quality'")}"""


def oracle() -> dict[str, str]:
    counts = WITH_RECORDS + _union("SELECT '{topic}' AS topic, count(*) AS n FROM {kind}")
    return {
        **{f"decode_{kind}": WITH_TICKS + _record(kind) for kind in KINDS},
        "decode_quarantine": WITH_TICKS + """
SELECT 'v-' || CAST(event_id AS VARCHAR) AS record_key, false AS is_bad, device_id, CAST(NULL AS VARCHAR) AS raw
FROM ticks
UNION ALL SELECT 'p-' || CAST(event_id AS VARCHAR), false, NULL, props FROM events
UNION ALL SELECT 'd-' || CAST(doc_id AS VARCHAR), true, NULL, text FROM documents""",
        "dedup_stream": WITH_TICKS + "SELECT 'v-' || CAST(event_id AS VARCHAR) AS id, device_id FROM ticks",
        "watermark_passthrough": WITH_TICKS + _record("gps"),
        "land_parquet": WITH_TICKS + _record("gps"),
        "correlate_five": CORRELATE,
        "correlate_stream": CORRELATE,
        "correlate_clustered": CORRELATE,
        "landing_counts": counts,
        "fan_out_counts": counts,
        "landing_accounts": WITH_RECORDS.rstrip() + """,
log AS (""" + _union("SELECT '{kind}' AS kind, '{topic}' AS topic FROM {kind}") + """),
foreign_rows AS (SELECT 'vehicle_data' AS topic, count(*) AS n FROM events UNION ALL SELECT 'weather_data', count(*) FROM documents),
undated AS (SELECT count(*) AS n FROM ticks WHERE k % 10 = 0)
SELECT topic, 2 * (count(*) + coalesce(any_value(f.n), 0)) AS read, 2 * (count(*) + coalesce(any_value(f.n), 0)) AS landed,
       2 * coalesce(any_value(f.n), 0) AS undecodable, 2 * any_value(u.n) AS without_time
FROM log LEFT JOIN foreign_rows f USING (topic), undated u GROUP BY topic""",
        "publish_log": WITH_RECORDS
        + _union(
            "SELECT '{topic}' AS topic, id AS record_key, id, device_id, \"timestamp\", lat, lon FROM {kind}"
        ),
        "encode_roundtrip": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "parse_location": WITH_TICKS + "SELECT event_id, lat, lon FROM ticks",
        "geofence_arrivals": WITH_TICKS + f"SELECT event_id, device_id, event_ts FROM ticks WHERE {ARRIVED}",
        "trip_truncate": TRUNCATE,
        "trip_truncate_stream": TRUNCATE,
        "silent_devices": WITH_TICKS + f"""
SELECT device_id, event_ts AS since, until, epoch_us(until) - epoch_us(event_ts) AS gap_us
FROM (SELECT device_id, event_ts, lead(event_ts) OVER {BY_DEVICE} AS until FROM ticks)
WHERE until IS NULL OR epoch_us(until) - epoch_us(event_ts) > 60000000""",
        "trip_legs": WITH_TICKS + f"""
SELECT event_id, dlat, dlon,
       CASE WHEN lat < 42.3396E0 THEN 1 ELSE -1 END AS lat_dir,
       CASE WHEN lon < -71.0698E0 THEN 1 ELSE -1 END AS lon_dir,
       abs(abs(dlat) - abs(abs(40.758896E0) - abs(42.3396E0)) / 100E0) <= 0.0005E0
         AND abs(abs(dlon) - abs(abs(-73.985130E0) - abs(-71.0698E0)) / 100E0) <= 0.0005E0 AS step_ok
FROM (SELECT event_id, lat, lon, lat - lag(lat) OVER {BY_DEVICE} AS dlat,
             lon - lag(lon) OVER {BY_DEVICE} AS dlon FROM ticks)""",
        "gap_audit": WITH_TICKS + f"""
SELECT event_id, device_id, gap_us, gap_us BETWEEN 30000000 AND 60000000 AS in_range
FROM (SELECT event_id, device_id,
             epoch_us(event_ts) - epoch_us(lag(event_ts) OVER {BY_DEVICE}) AS gap_us FROM ticks)""",
        "quality_violations": _violations(),
        "reconcile_topics": WITH_TICKS + _union(
            "SELECT '{topic}' AS topic, count(*) AS produced, "
            "count(*) - count(*) FILTER (WHERE event_id % 11 = 0) + count(*) FILTER (WHERE event_id % 7 = 0 AND event_id % 11 <> 0) "
            "+ count(*) FILTER (WHERE event_id % 13 = 0) AS landed, "
            "count(*) FILTER (WHERE event_id % 11 = 0) AS missing, count(*) FILTER (WHERE event_id % 13 = 0) AS extra, "
            "count(*) FILTER (WHERE event_id % 7 = 0 AND event_id % 11 <> 0) AS duplicated FROM ticks"),
        "rollup_stream": WITH_RECORDS + """
SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") AS window_start, device_id, count(*) AS n,
       CAST(sum(CAST(round(speed * 100) AS BIGINT)) AS BIGINT) AS sum_cents
FROM gps
WHERE time_bucket(INTERVAL 1 HOUR, "timestamp") + INTERVAL 1 HOUR
      <= (SELECT max("timestamp") - INTERVAL 2 MINUTE FROM gps)
GROUP BY ALL""",
        "rollup_store": WITH_TICKS + HOURLY,
        "rollup_guarded": WITH_TICKS + f"""
SELECT false AS ahead, * FROM ({HOURLY}) UNION ALL
(SELECT true, TIMESTAMP '2999-01-01 00:00:00', device_id, 1, CAST(round(value * 100) AS BIGINT) FROM ticks ORDER BY event_id LIMIT 1)""",
        "violations_stream": _hourly_violations(),
        "schema_drift": _drift(),
        "land_compacted": WITH_TICKS + _record("gps"),
        "catalog_sql": WITH_RECORDS
        + "SELECT incident_type, status, count(*) AS n FROM emergency GROUP BY incident_type, status",
    }
