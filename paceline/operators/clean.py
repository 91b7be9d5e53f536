"""Raw results to the two typed tables. Every step is narrow: there is no shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.functions.bands import AGE_BANDS, DISTANCE_BANDS, band
from paceline.functions.parsing import (
    clock_seconds,
    kilometres,
    limit_hours,
    speed_always_metres,
    speed_mixed_units,
    whole_number,
)

def length() -> Column:
    """The text that says how long an event is."""
    return F.col("`event_distance/length`")


def normalise_names(df: DataFrame) -> DataFrame:
    """Column names in lower case, with underscores for spaces."""
    return df.toDF(*[name.replace(" ", "_").lower() for name in df.columns])


def is_time_limited(text: Column) -> Column:
    """True for events measured in days or hours; null, and so in neither table, without a length."""
    return text.contains("d") | text.contains("h")


def with_age(raw: DataFrame) -> DataFrame:
    """Identity columns typed, the age added and the age category dropped."""
    year = whole_number(F.col("year_of_event"))
    birth = whole_number(F.col("athlete_year_of_birth"))
    return raw.withColumns(
        {
            "year_of_event": year,
            "event_number_of_finishers": whole_number(F.col("event_number_of_finishers")),
            "athlete_id": F.col("athlete_id").try_cast("bigint"),
            "athlete_year_of_birth": F.col("athlete_year_of_birth").try_cast("double"),
            "athlete_age": F.try_subtract(year, birth),
        }
    ).drop("athlete_age_category")


def time_limited(raw: DataFrame) -> DataFrame:
    """Results of events with a time limit: the distance is the performance."""
    typed = (
        with_age(raw.filter(is_time_limited(length())))
        .withColumnsRenamed(
            {"event_distance/length": "time_limit", "athlete_performance": "distance_crossed"}
        )
        .withColumns(
            {
                "time_limit_h": limit_hours(F.col("time_limit")),
                "distance_crossed_km": kilometres(F.col("distance_crossed")),
                "athlete_year_of_birth": F.col("athlete_year_of_birth").try_cast("int"),
                "athlete_average_speed_kmph": speed_always_metres(F.col("athlete_average_speed")),
            }
        )
        .drop("time_limit", "distance_crossed", "athlete_average_speed")
    )
    return typed.withColumn("age_group", band(F.col("athlete_age"), AGE_BANDS))


def distance_limited(raw: DataFrame) -> DataFrame:
    """Results of events over a fixed distance: the time is the performance."""
    typed = (
        with_age(raw.filter(~is_time_limited(length())))
        .withColumnsRenamed(
            {"event_distance/length": "distance", "athlete_performance": "time_spent"}
        )
        .withColumns(
            {
                "distance_km": kilometres(F.col("distance")),
                "time_spent_s": clock_seconds(F.col("time_spent")),
                "athlete_average_speed_kmph": speed_mixed_units(F.col("athlete_average_speed")),
            }
        )
        .drop("distance", "athlete_average_speed")
    )
    return typed.withColumns(
        {
            "distance_group_km": band(F.col("distance_km"), DISTANCE_BANDS),
            "age_group": band(F.col("athlete_age"), AGE_BANDS),
        }
    )


def both_limits(raw: DataFrame) -> DataFrame:
    """Results of both kinds in one pass, with the columns of both tables and ``kind``, ``time`` or ``distance``;
    the columns of the other kind are null. Rows without a length are in neither table and left out."""
    timed = is_time_limited(F.col("_length"))
    done = F.col("_performance")
    speed_text = F.col("_speed")
    typed = with_age(
        raw.withColumnsRenamed({
            "event_distance/length": "_length", "athlete_performance": "_performance", "athlete_average_speed": "_speed",
        }).filter(timed.isNotNull())
    ).withColumns(
        {
            "kind": F.when(timed, "time").otherwise("distance"),
            "time_limit_h": F.when(timed, limit_hours(F.col("_length"))),
            "distance_crossed_km": F.when(timed, kilometres(done)),
            "distance_km": F.when(~timed, kilometres(F.col("_length"))),
            "time_spent": F.when(~timed, done),
            "time_spent_s": F.when(~timed, clock_seconds(done)),
            "athlete_average_speed_kmph": F.when(timed, speed_always_metres(speed_text)).otherwise(speed_mixed_units(speed_text)),
            "age_group": band(F.col("athlete_age"), AGE_BANDS),
        }
    )
    return typed.withColumn(
        "distance_group_km", F.when(F.col("kind") == "distance", band(F.col("distance_km"), DISTANCE_BANDS))
    ).drop("_length", "_performance", "_speed")


# Bits of monotonically_increasing_id() that number the rows of a partition; the others are the partition's.
_PART_BITS = 33


def with_row_id(df: DataFrame) -> DataFrame:
    """Add ``id``, unique over the table but not the same in the next run."""
    return df.withColumn("id", F.monotonically_increasing_id())


def with_dense_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Add ids 0 to n - 1, in ranges of which rows are spread evenly.

    Partitions count their rows first; a row's id is its number within its partition after the rows of the
    partitions before. So there is one number per partition on the driver and no window over the rows. ``df`` must
    fall into the same partitions when it is read again, as files do; store what comes from a shuffle.
    """
    marked = df.withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", _PART_BITS)
    counts = sorted((r["part"], r["count"]) for r in marked.groupBy(part.alias("part")).count().collect())
    starts, total = [], 0
    for number, count in counts:
        starts.append((number, total))
        total += count
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    own = F.col("_at").bitwiseAND((1 << _PART_BITS) - 1)
    placed = marked.join(F.broadcast(offsets), part == F.col("_part"))
    return placed.withColumn(name, F.col("_start") + own).drop("_at", "_part", "_start")


def with_content_id(df: DataFrame) -> DataFrame:
    """Add ``content_id``, the same in every run; rows that are copies share it.

    128 bits, because 64 bits collide at some billions of rows. Fields are joined with a separator
    and nulls marked, so different rows cannot give the same text.
    """
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in df.columns]
    return df.withColumn("content_id", F.md5(F.concat_ws("\x1f", *fields)))


def conform(df: DataFrame, schema) -> DataFrame:
    """Columns in the order and with the types of a stored table."""
    return df.select([F.col(f.name).cast(f.dataType) for f in schema.fields])
