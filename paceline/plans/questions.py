"""The ten questions over the cleaned tables.

``distance`` is the distance-limited table, ``time`` the time-limited one.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.functions.bands import (
    AGE_BANDS,
    DISTANCE_BANDS,
    band_start,
    beyond_first_band,
    has_band,
    in_known_band,
)
from paceline.functions.parsing import decade_start
from paceline.operators.aggregates import exact_by
from paceline.operators.ranking import top_dense_rank

BAND = "distance_group_km"
MEAN_SPEED = "avg_athlete_speed_kmph"
TOP = 10
MIN_FINISHERS = 10


def speed() -> Column:
    return F.col("athlete_average_speed_kmph")


def long_enough() -> Column:
    """Has a distance band other than the first."""
    return beyond_first_band(F.col("distance_km"), DISTANCE_BANDS)


def moved() -> Column:
    """Has a speed, and not zero."""
    return speed() != 0


def known_age() -> Column:
    return in_known_band(F.col("athlete_age"), AGE_BANDS)


def by_band(label: str = BAND) -> Column:
    """Bands in order of length, ``'None'`` last."""
    return band_start(F.col(label)).asc_nulls_last()


def fastest_events(distance: DataFrame) -> DataFrame:
    """Events with the highest mean speed, top ten per band, of those with over ten finishers."""
    keys = ["year_of_event", "event_name", BAND, "distance_km"]
    means = exact_by(distance.filter(long_enough() & moved()), keys, speed(), MEAN_SPEED, F.count("*").alias("athlete_num"))
    events = means.filter(F.col("athlete_num") > MIN_FINISHERS)
    top = top_dense_rank(events, BAND, MEAN_SPEED, "rank", TOP)
    return top.orderBy(by_band(), "rank")


def athletes_per_band(distance: DataFrame) -> DataFrame:
    """How many results each band has."""
    counts = distance.filter(long_enough()).groupBy(BAND).agg(F.count("*").alias("num_athletes"))
    return counts.orderBy(F.desc("num_athletes"))


def speed_by_band_and_age(distance: DataFrame) -> DataFrame:
    """Count and mean speed per band and age group, of results with a positive speed."""
    known = distance.filter(long_enough() & known_age() & (speed() > 0))
    means = exact_by(known, [BAND, "age_group"], speed(), MEAN_SPEED, F.count("*").alias("athlete_num"))
    return means.orderBy(by_band(), by_band("age_group"))


def most_attended_events(distance: DataFrame) -> DataFrame:
    """Events with most results, top ten per band, the first band included."""
    events = (
        distance.filter(has_band(F.col("distance_km")))
        .groupBy("year_of_event", "event_name", BAND)
        .agg(F.count("*").alias("athlete_num"))
    )
    top = top_dense_rank(events, BAND, "athlete_num", "rank", TOP)
    return top.orderBy(by_band(), "rank")


def fastest_countries(distance: DataFrame) -> DataFrame:
    """Countries with the highest mean speed, top ten per band."""
    countries = exact_by(distance.filter(long_enough() & moved()), [BAND, "athlete_country"], speed(), MEAN_SPEED)
    top = top_dense_rank(countries, BAND, MEAN_SPEED, "rank", TOP)
    return top.orderBy(by_band(), "rank")


def _athletes_of_both(time: DataFrame, distance: DataFrame, label: str) -> DataFrame:
    """Distinct athletes per label over both tables, counted; a null athlete does not count."""
    either = time.select(label, "athlete_id").union(distance.select(label, "athlete_id"))
    return (
        either.distinct()
        .groupBy(label)
        .agg(F.count("athlete_id").alias("num_of_athletes"))
    )


def athletes_per_country(time: DataFrame, distance: DataFrame) -> DataFrame:
    """Athletes per country; one who ran for two countries counts in both."""
    counts = _athletes_of_both(time, distance, "athlete_country")
    return counts.withColumnRenamed("athlete_country", "country").orderBy(F.desc("num_of_athletes"))


def athletes_per_age_group(time: DataFrame, distance: DataFrame) -> DataFrame:
    """Athletes per known age group; one who raced in two age groups counts in both."""
    return _athletes_of_both(time.filter(known_age()), distance.filter(known_age()), "age_group")


def distance_per_decade(time: DataFrame) -> DataFrame:
    """Kilometres covered in time-limited events, per decade."""
    decade = decade_start(F.col("year_of_event")).alias("decade_start")
    return exact_by(time, [decade], F.col("distance_crossed_km"), "total_distance", mean=False)


def speed_by_gender(distance: DataFrame) -> DataFrame:
    """Mean speed of women and men per band."""
    either = distance.filter(long_enough() & moved() & F.col("athlete_gender").isin("F", "M"))
    means = exact_by(either, [BAND, "athlete_gender"], speed(), MEAN_SPEED)
    return means.orderBy(by_band(), "athlete_gender")
