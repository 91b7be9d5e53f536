"""Schemas of the raw file, the cleaned tables, the telemetry and the live tables."""

from pyspark.sql import types as T

# Headers of the raw results file, in file order. Every field is read as text.
RAW_HEADERS = [
    "Year of event",
    "Event dates",
    "Event name",
    "Event distance/length",
    "Event number of finishers",
    "Athlete performance",
    "Athlete club",
    "Athlete country",
    "Athlete year of birth",
    "Athlete gender",
    "Athlete age category",
    "Athlete average speed",
    "Athlete ID",
]
RAW_FILE = T.StructType([T.StructField(h, T.StringType()) for h in RAW_HEADERS])


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """Schema from ``name type, ...``; unlike Spark's own, it needs no running session."""
    fields = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


TIME_LIMITED = _struct(
    "year_of_event int, event_dates string, event_name string, event_number_of_finishers int, "
    "athlete_club string, athlete_country string, athlete_year_of_birth int, athlete_gender string, "
    "athlete_id bigint, athlete_age int, time_limit_h int, distance_crossed_km double, "
    "athlete_average_speed_kmph double, id bigint, age_group string"
)

DISTANCE_LIMITED = _struct(
    "year_of_event int, event_dates string, event_name string, event_number_of_finishers int, "
    "time_spent string, athlete_club string, athlete_country string, athlete_year_of_birth double, "
    "athlete_gender string, athlete_id bigint, athlete_age int, distance_km double, time_spent_s int, "
    "athlete_average_speed_kmph double, id bigint, distance_group_km string, age_group string"
)

# Both cleaned tables in one, as one pass over the raw file stores them.
RESULTS = T.StructType(
    [f for f in DISTANCE_LIMITED.fields]
    + [f for f in TIME_LIMITED.fields if f.name not in DISTANCE_LIMITED.names]
    + [T.StructField("kind", T.StringType())]
)

# Telemetry fields in message order; the runner travels as the message key.
TELEMETRY_FIELDS = ["time", "latitude", "longitude", "altitude", "distance", "heart_rate", "speed"]
TELEMETRY = _struct(
    "runner_id bigint, time timestamp, latitude double, longitude double, "
    "altitude float, distance float, heart_rate int, speed float"
)

TOPIC = _struct("topic string, key string, value string")

LIVE_TABLES = {
    "avg_speed": _struct("runner_id bigint, time timestamp, avg_speed double"),
    "pace": _struct("runner_id bigint, time timestamp, pace double"),
    "comparison": _struct("runner_id bigint, time timestamp, comparison string"),
    "altitude_gain": _struct("runner_id bigint, time timestamp, value double"),
    "finish_estimation": _struct("runner_id bigint, time timestamp, estimated_min double"),
    "elev_gain_total": _struct("runner_id bigint, time timestamp, value double"),
}
