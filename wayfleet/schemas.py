"""The five record kinds, their wire schemas and the value domains of their fields."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Record layout and value domains of the telemetry wire format.
LEAD = "id string, device_id string, timestamp timestamp, location string"

EXTRA = {
    "vehicle": "speed double, make string, model string, year integer",
    "gps": "speed double",
    "traffic": "camera_id string, snapshot string",
    "weather": (
        "temperature double, weather_condition string, precipitation integer, "
        "humidity integer, wind_speed double, air_quality double"
    ),
    "emergency": "incident_id string, incident_type string, status string, description string",
}

DEFAULT_TOPICS = {
    "vehicle": "vehicle_data",
    "gps": "gps_data",
    "traffic": "traffic_data",
    "weather": "weather_data",
    "emergency": "emergency_data",
}

WEATHER_CONDITIONS = [
    "Sunny", "Mostly Sunny", "Cloudy", "Partly Cloudy", "Showers", "Rain",
    "Heavy Rain", "Thunderstorm", "Light Snow", "Snow", "Heavy Snow", "Hail",
]
INCIDENT_TYPES = ["Accident", "Fire", "Medical", "Police", "None"]
INCIDENT_STATUSES = ["Active", "Resolved"]

MAKE = "Porsche"
MODEL = "911"
CAMERA = "Camera-1"
SNAPSHOT = "Base64EncodedString"
INCIDENT_TEXT = "Description of the incident"

ORIGIN = (40.758896, -73.985130)
DESTINATION = (42.3396, -71.0698)
ARRIVAL_TOLERANCE = 0.02
STEPS_PER_TRIP = 100
STEP_JITTER = 0.0005
MAX_TICKS = 200
MIN_GAP_SECONDS = 30
MAX_GAP_SECONDS = 60

WATERMARK = "2 minutes"

# rule -> (low, high) or list of allowed values, per record kind
DOMAINS: dict[str, dict[str, tuple | list]] = {
    "vehicle": {"speed": (15, 65), "year": (2014, 2024)},
    "gps": {"speed": (15, 65)},
    "traffic": {"camera_id": [CAMERA]},
    "weather": {
        "temperature": (0, 100),
        "weather_condition": WEATHER_CONDITIONS,
        "precipitation": (0, 100),
        "humidity": (0, 100),
        "wind_speed": (0, 30),
        "air_quality": (0, 500),
    },
    "emergency": {"incident_type": INCIDENT_TYPES, "status": INCIDENT_STATUSES},
}

KINDS = tuple(EXTRA)


def schema(kind: str) -> StructType:
    """Wire schema of one record kind; every field is nullable."""
    fields = StructType()
    for column in f"{LEAD}, {EXTRA[kind]}".split(", "):
        fields.add(*column.split())
    return fields
