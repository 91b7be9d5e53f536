"""Edge rows of every derived column."""

import datetime

import pytest
from pyspark.sql import functions as F

from paceline.functions import bands, parsing, telemetry
from paceline.operators.clean import is_time_limited


def each(spark, values, kind, make):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in frame.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "make, cases",
    [
        (is_time_limited, {"50km": False, "6d": True, "24h": True, "24H": False, None: None}),
        (parsing.limit_hours, {"6d": 144, "24h": 24, "1d12h": 25, "dh": None, "99999999999h": None}),
        (
            parsing.kilometres,
            {"50km": 50.0, "26.2mi": 42.1648, "100": 0.0, None: 0.0, "1,5km": None, "4x5km": None, "km": None},
        ),
        (
            parsing.clock_seconds,
            {
                "4:51:39 h": 17499, "1d 05:23:11 h": 105791, "n/a": None, "2d": None, None: None,
                "d 1:00:00": None, "99999999999:00:00": None, "1000000:00:00 h": None, "": None,
            },
        ),
        (parsing.speed_always_metres, {"10500": 10.5, "10.5": 0.0105, "x": None}),
        (
            parsing.speed_mixed_units,
            {"10500": 10.5, "10.5": 10.5, "50": 50.0, "50.1": 0.0501, "x": None, None: None},
        ),
        (parsing.whole_number, {"1978.0": 1978, "1978": 1978, "": None, None: None, "1e10": None}),
    ],
    ids=lambda p: getattr(p, "__name__", ""),
)
def test_text(spark, make, cases):
    assert each(spark, cases, "string", make) == pytest.approx(list(cases.values()))


def test_bands(spark):
    ages = {None: None, 0: None, -3: None, 16: "None", 17: "17-30", 29: "17-30", 30: "30-45",
            44: "30-45", 45: "45-120", 119: "45-120", 120: "None"}
    assert each(spark, ages, "int", lambda c: bands.band(c, bands.AGE_BANDS)) == list(ages.values())
    lengths = {None: None, 0.0: None, 39.9: "0-40", 40.0: "40-65", 65.0: "65-90", 90.0: "90-120",
               120.0: "120-200", 200.0: "200-1000", 1000.0: "1000-6000", 6000.0: "None"}
    labels = each(spark, lengths, "double", lambda c: bands.band(c, bands.DISTANCE_BANDS))
    assert labels == list(lengths.values())


def test_predicates_on_numbers_select_what_the_labels_say(spark):
    lengths = [None, -1.0, 0.0, 0.5, 39.9999, 40.0, 64.9, 5999.9, 6000.0, 1e9]
    frame = spark.createDataFrame([(x,) for x in lengths], "x double")
    label = bands.band(F.col("x"), bands.DISTANCE_BANDS)
    pairs = [
        (bands.beyond_first_band(F.col("x"), bands.DISTANCE_BANDS), label.isNotNull() & (label != "0-40")),
        (bands.has_band(F.col("x")), label.isNotNull()),
    ]
    ages = spark.createDataFrame([(x,) for x in [None, -1, 0, 16, 17, 119, 120]], "x int")
    age = bands.band(F.col("x"), bands.AGE_BANDS)
    for numbers, labels in pairs:
        assert frame.filter(numbers).collect() == frame.filter(labels).collect()
    known = bands.in_known_band(F.col("x"), bands.AGE_BANDS)
    assert ages.filter(known).collect() == ages.filter(age.isNotNull() & (age != "None")).collect()


def test_bands_must_join():
    with pytest.raises(ValueError):
        bands.band(F.lit(1), [(0, 1), (2, 3)])


def test_band_start(spark):
    labels = {"0-40": 0, "1000-6000": 1000, "None": None, None: None}
    assert each(spark, labels, "string", bands.band_start) == list(labels.values())


def test_decades(spark):
    day = datetime.date
    years = {1991: day(1990, 1, 1), 2000: day(1990, 1, 1), 2001: day(2000, 1, 1), None: None, 0: None}
    assert each(spark, years, "int", parsing.decade_start) == list(years.values())


def test_measures(spark):
    assert each(spark, [2.5, 0.0, None], "float", telemetry.pace) == [6.6667, None, None]
    steps = spark.createDataFrame([(10.0, 12.5), (12.5, 10.0), (None, 1.0)], "p float, c float")
    gains = steps.select(telemetry.climb(F.col("c"), F.col("p")).alias("g")).collect()
    assert [r.g for r in gains] == [2.5, 0.0, 0.0]
    pairs = spark.createDataFrame([(3.0, 2.0), (2.0, 2.0), (None, 2.0), (2.7, 2.7)], "s float, a double")
    status = pairs.select(telemetry.speed_status(F.col("s"), F.col("a")).alias("c")).collect()
    # 2.7 as a 32-bit value lies above the 64-bit 2.7; on the topics both are 32-bit.
    assert [r.c for r in status] == ["faster", "slower", "slower", "slower"]
    left = spark.createDataFrame([(5000.0, 12.0), (5000.0, 0.0), (5000.0, None)], "d float, v double")
    minutes = left.select(telemetry.minutes_left(F.col("d"), F.col("v"), 21).alias("m")).collect()
    assert [r.m for r in minutes] == [80.0, None, None]


def test_messages_keep_positions(spark):
    rows = spark.createDataFrame(
        [(7, datetime.datetime(2024, 1, 1), None, 15.0, 1.5, 2.5, None, 3.25)],
        "runner_id bigint, time timestamp, latitude double, longitude double, altitude float, "
        "distance float, heart_rate int, speed float",
    )
    message = telemetry.to_messages(rows)
    assert message.first().value == "2024-01-01 00:00:00,,15.0,1.5,2.5,,3.25"
    assert telemetry.from_messages(message).collect() == rows.collect()
    broken = spark.createDataFrame([("x", "not a time,a,b")], "key string, value string")
    assert set(telemetry.from_messages(broken).first()) == {None}
