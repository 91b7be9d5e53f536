"""Measures over telemetry, for batch and streaming frames alike.

A watermark means nothing to a batch frame, so the same plan serves both. Only the previous-second
join has a batch form of its own: it can count copies of a row first, which a stream cannot.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.functions.telemetry import climb, minutes_left, pace, speed_status, whole_second
from paceline.operators.aggregates import exact_by
from paceline.operators.ranking import repeat_rows
from paceline.operators.running import running_total

# Window length, and how late a row may be for either window.
WINDOW = "5 seconds"
SPEED_DELAY = "1 second"
CLIMB_SECONDS = 5
CLIMB_DELAY = f"{CLIMB_SECONDS} seconds"


def second() -> Column:
    return F.expr("interval 1 second")


def speeds(telemetry: DataFrame) -> DataFrame:
    """Speed in m/s at each second, to four decimals."""
    return telemetry.select(
        "runner_id", whole_second(F.col("time")).alias("time"), F.round("speed", 4).alias("speed")
    )


def paces(speed: DataFrame) -> DataFrame:
    """Minutes per km at each second."""
    return speed.select("runner_id", "time", pace(F.col("speed")).alias("pace"))


def average_speeds(speed: DataFrame, delay: str = SPEED_DELAY) -> DataFrame:
    """Mean speed per runner and five-second window, to four decimals."""
    keys = ["runner_id", F.window("time", WINDOW)]
    means = exact_by(speed.withWatermark("time", delay), keys, F.col("speed"), "avg_speed")
    return means.withColumn("avg_speed", F.round("avg_speed", 4))


def window_rows(speed: DataFrame, delay: str = SPEED_DELAY) -> DataFrame:
    """How many rows each runner and window has, under the same watermark as the means."""
    windows = speed.withWatermark("time", delay).groupBy("runner_id", F.window("time", WINDOW))
    return windows.agg(F.count("*").alias("rows"))


def topic_time() -> Column:
    """Time of a window on its topic: its last second, as the end is not part of it."""
    return F.col("window.end") - second()


def table_time() -> Column:
    """Time of a window in its table: its end."""
    return F.col("window.end")


def comparisons(speed: DataFrame, delay: str = SPEED_DELAY) -> DataFrame:
    """Speed at the last second of each window against the mean of that window.

    A window keeps the speeds of its last second beside its mean, so the input is read once and there
    is no join.
    """
    timed = speed.withWatermark("time", delay).select(
        "runner_id", "time", "speed", F.window("time", WINDOW).alias("window")
    )
    is_last = F.col("time") == topic_time()
    last = F.collect_list(F.when(is_last, F.struct("speed"))).alias("last")
    windows = exact_by(timed, ["runner_id", "window"], F.col("speed"), "avg_speed", last)
    each = windows.select(
        "runner_id", topic_time().alias("time"), F.round("avg_speed", 4).alias("avg_speed"), F.explode("last.speed").alias("speed"))
    status = speed_status(F.col("speed"), F.col("avg_speed"))
    return each.select("runner_id", "time", status.alias("comparison"))


def altitudes(telemetry: DataFrame) -> DataFrame:
    return telemetry.select(
        "runner_id",
        whole_second(F.col("time")).alias("time"),
        F.round("altitude", 4).alias("altitude"),
    )


def _in_two_roles(altitude: DataFrame) -> DataFrame:
    """Each row twice: as it is at its second, and as what was before at the next one."""
    roles = F.array(
        F.struct(F.col("time"), F.lit(True).alias("is_now")),
        F.struct((F.col("time") + second()).alias("time"), F.lit(False).alias("is_now")),
    )
    return altitude.withColumn("_role", F.explode(roles)).select(
        *[c for c in altitude.columns if c != "time"], "_role.*"
    )


def _both_roles(*fields: str) -> list[Column]:
    """Aggregates: the rows of a second, and those of the second before."""
    row = F.struct(*fields)
    return [
        F.collect_list(F.when(F.col("is_now"), row)).alias("_now"),
        F.collect_list(F.when(~F.col("is_now"), row)).alias("_before"),
    ]


def _climb_pairs(telemetry: DataFrame) -> DataFrame:
    """Rows one second apart, paired per runner, with the number of copies of each pair. One scan: copies
    are counted first, then a second meets the one before it in one aggregation."""
    keys = ["runner_id", "time"]
    counted = altitudes(telemetry).groupBy(*keys, "altitude").agg(F.count("*").alias("n"))
    met = _in_two_roles(counted.filter(F.col("time").isNotNull() & F.col("runner_id").isNotNull()))
    pairs = met.groupBy(*keys).agg(*_both_roles("altitude", "n")).withColumn("_c", F.explode("_now"))
    return pairs.withColumn("_p", F.explode("_before")).select(
        *keys,
        climb(F.col("_c.altitude"), F.col("_p.altitude")).alias("altitude_gain"),
        (F.col("_c.n") * F.col("_p.n")).alias("_copies"),
    )


def altitude_gains(telemetry: DataFrame) -> DataFrame:
    """Metres climbed since the second before; no row if that second is missing. For batch frames."""
    return repeat_rows(_climb_pairs(telemetry), "_copies")


def altitude_gains_live(telemetry: DataFrame, delay: str = CLIMB_DELAY) -> DataFrame:
    """Metres climbed since the second before, by a join of the stream with itself.

    Both inputs carry a watermark on the joined time, so a second leaves the state once it is past.
    """
    now = altitudes(telemetry).withWatermark("time", delay)
    before = (
        altitudes(telemetry)
        .select(
            "runner_id", (F.col("time") + second()).alias("time"), F.col("altitude").alias("_previous")
        )
        .withWatermark("time", delay)
    )
    return now.join(before, ["runner_id", "time"]).select(
        "runner_id", "time", climb(F.col("altitude"), F.col("_previous")).alias("altitude_gain")
    )


def _elevation(gains: DataFrame, gain: Column) -> DataFrame:
    sums = exact_by(gains, ["runner_id", F.window("time", WINDOW)], gain, "value", mean=False)
    return sums.withColumn("value", F.round("value", 4))


def elevation_windows(telemetry: DataFrame) -> DataFrame:
    """Metres climbed per runner and five-second window. For batch frames."""
    return _elevation(_climb_pairs(telemetry), F.col("altitude_gain") * F.col("_copies"))


def elevation_windows_live(telemetry: DataFrame, delay: int = CLIMB_SECONDS) -> DataFrame:
    """Metres climbed per runner and five-second window.

    A window waits for the watermark anyway, so a second can wait for it too: each row goes into the
    aggregate of its own second and of the next, and the windows add up what these give. The stream is
    read once and nothing is joined. The later role is a second ahead, so the delay is one longer.
    """
    met = _in_two_roles(altitudes(telemetry)).withWatermark("time", f"{delay + 1} seconds")
    seconds = met.groupBy("runner_id", "time").agg(*_both_roles("altitude"))
    zero = F.lit(0.0)
    gained = F.aggregate(
        F.array_sort("_now"), zero,
        lambda total, c: F.aggregate(
            F.array_sort("_before"), total,
            lambda sum_, p: sum_ + climb(c["altitude"], p["altitude"]).cast("double"),
        ),
    )
    both = seconds.filter((F.size("_now") > 0) & (F.size("_before") > 0) & F.col("runner_id").isNotNull())
    return _elevation(both.select("runner_id", "time", gained.alias("altitude_gain")), F.col("altitude_gain"))


def elevation_of_gains(gains: DataFrame, delay: str = CLIMB_DELAY) -> DataFrame:
    """The same from gains that were found before, as on their topic."""
    return _elevation(gains.withWatermark("time", delay), F.col("altitude_gain"))


def as_table(windows: DataFrame, value: str) -> DataFrame:
    """Rows of a live table from windows: runner, end of window, value."""
    return windows.select("runner_id", table_time().alias("time"), value)


def total_climb(altitude_gain: DataFrame) -> DataFrame:
    """Metres climbed so far, at each row of the ``altitude_gain`` table."""
    totals = running_total(altitude_gain, "runner_id", "time", "value", "total")
    return totals.select("runner_id", "time", F.col("total").alias("value"))


# How long a repeated row of a live table may come after the first one.
REPEAT_DELAY = "1 hour"


def once(table: DataFrame, delay: str = REPEAT_DELAY) -> DataFrame:
    """Rows of a live table as a stream, each runner and time once.

    A batch of the stream before that is run again replaces its files by files of other names, which a stream
    reading the table takes as new. Keys stay in the state for ``delay`` of event time; what comes later still
    is behind the watermark, so it is left out as well.
    """
    return table.withWatermark("time", delay).dropDuplicatesWithinWatermark(["runner_id", "time"])


def climb_totals(altitude_gain: DataFrame) -> DataFrame:
    """Metres climbed so far per runner, and when; one row each. Also for streams."""
    sums = exact_by(altitude_gain, ["runner_id"], F.col("value"), "total", F.max("time").alias("time"), mean=False)
    return sums.select("runner_id", "time", F.round("total", 4).alias("value"))


def latest(table: DataFrame) -> DataFrame:
    """The latest row of a live table; none if it is empty. Runners at the same time: lowest id."""
    return table.orderBy(F.desc("time"), "runner_id").limit(1)


def latest_per_runner(table: DataFrame, value: str = "value") -> DataFrame:
    """The latest value of every runner."""
    return table.groupBy("runner_id").agg(
        F.max("time").alias("time"), F.max_by(value, "time").alias(value)
    )


def finish_estimates(
    telemetry: DataFrame, history: DataFrame, length_km: int, salts: int = 1
) -> DataFrame:
    """Minutes to the finish at each row, null for runners without history.

    ``history`` is one row per runner; Spark broadcasts it if it is below its own size threshold.
    Beyond that a batch join splits a busy runner by itself. A stream cannot, so it should ask for
    salts: every runner's history is then there that many times, and its rows spread over them.
    """
    left, right, keys = telemetry, history, ["runner_id"]
    if salts > 1:
        left = left.withColumn("_salt", F.pmod(F.hash("time"), F.lit(salts)))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys = ["runner_id", "_salt"]
    distance = F.round("distance", 4)
    return left.join(right, keys, "left").select(
        "runner_id",
        "time",
        minutes_left(distance, F.col("average_speed"), length_km).alias("estimated_min"),
    )
