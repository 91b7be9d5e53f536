"""Telemetry messages and the measures taken from them; the same for batch and stream."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.schemas import TELEMETRY, TELEMETRY_FIELDS

# Text form of a time, and minutes per km for one metre per second.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
PACE_FACTOR = 16.666666667


def encode(time: Column, value: Column, unit: str = "") -> Column:
    """Message ``time,value[unit]``; null if either part is."""
    parts = [F.date_format(time, TIME_FORMAT), F.lit(","), value.cast("string")]
    return F.concat(*parts, F.lit(unit)) if unit else F.concat(*parts)


def to_topic(df: DataFrame, topic: str, value: Column, unit: str = "") -> DataFrame:
    """Rows of a topic: the runner as key, ``time,value`` as message."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.col("runner_id").cast("string").alias("key"),
        encode(F.col("time"), value, unit).alias("value"),
    )


def to_messages(df: DataFrame) -> DataFrame:
    """Telemetry rows as comma messages. Empty fields stay empty, so positions never shift."""
    fields = [F.date_format("time", TIME_FORMAT)] + [
        F.col(name).cast("string") for name in TELEMETRY_FIELDS[1:]
    ]
    return df.select(
        F.col("runner_id").cast("string").alias("key"),
        F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields]).alias("value"),
    )


def from_messages(df: DataFrame) -> DataFrame:
    """Typed telemetry from key and message, by position; what cannot be read is null."""
    parts = F.split(F.col("value").cast("string"), ",")
    columns = []
    for field in TELEMETRY.fields[1:]:
        text = F.get(parts, F.lit(TELEMETRY_FIELDS.index(field.name)))
        typed = F.try_to_timestamp(text) if field.name == "time" else text.try_cast(field.dataType)
        columns.append(typed.alias(field.name))
    return df.select(F.col("key").cast("string").try_cast("bigint").alias("runner_id"), *columns)


def from_topic(df: DataFrame, name: str, dtype: str = "float") -> DataFrame:
    """Typed ``runner_id, time, <name>`` from the messages of a derived topic."""
    parts = F.split(F.col("value").cast("string"), ",")
    return df.select(
        F.col("key").cast("string").try_cast("bigint").alias("runner_id"),
        F.try_to_timestamp(F.get(parts, F.lit(0))).alias("time"),
        F.get(parts, F.lit(1)).try_cast(dtype).alias(name),
    )


def whole_second(time: Column) -> Column:
    """Derived topics carry time to the second."""
    return F.date_trunc("second", time)


def pace(speed: Column) -> Column:
    """Minutes per km from m/s, to four decimals; null when standing still."""
    return F.round(F.try_divide(F.lit(PACE_FACTOR), speed), 4)


def climb(current: Column, previous: Column) -> Column:
    """Metres gained, to four decimals; zero downhill or if an altitude is missing."""
    return F.round(F.when(current > previous, current - previous).otherwise(F.lit(0).cast("float")), 4)


def speed_status(speed: Column, average: Column) -> Column:
    """``faster`` above the average, else ``slower``; compared as the 32-bit values of the topics."""
    return F.when(speed > average.cast("float"), "faster").otherwise("slower")


def minutes_left(distance: Column, average_kmph: Column, length_km: int) -> Column:
    """Minutes to the finish at the average speed, to four decimals; null if the average is zero."""
    remaining = F.lit(length_km * 1000).cast("float") - distance
    return F.round(F.try_divide(remaining, average_kmph * (1000 / 60)), 4)
