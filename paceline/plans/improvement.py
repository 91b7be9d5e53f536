"""Athletes who improved most between their first and their last race in a band.

The obvious plan joins the table to itself twice and pairs every result of an athlete's first day
with every result of the last one. Here only pairs that can reach the top ranks are formed:

1. One aggregation finds, per athlete and band, the first and last day, the lowest speed on the
   first and the highest on the last. With no speed below zero that pair is the athlete's best.
2. The tenth best distinct value of a band, over these, is a floor for its top ten. Athletes whose
   best is below it are out; the others are few, and their days are read again.
3. The same is done with the single speeds of those days, and only then are speeds paired. Speeds
   below zero, which no runner has but nothing in the data rules out, are bounded here: the
   improvement ``(last - first) / first * 100`` is linear in ``last`` and in ``1 / first``, so its
   greatest value is at an extreme of each.

Both floors are values of real pairs, so at least ten distinct values reach them and nothing below
can be in the top ten: the result is exact. Copies of a result are counted, not paired, and are
written out after the ranking.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.operators.joins import join_same
from paceline.operators.ranking import (
    floor_of_leaders,
    repeat_rows,
    top_dense_rank,
)
from paceline.plans.questions import BAND, TOP, by_band, long_enough, speed
from paceline.session import shared_path
from paceline.sources.files import read_table, write_table

WHO = ["athlete_id", BAND]


def improvement(first: Column, last: Column) -> Column:
    """Change from ``first`` to ``last`` in percent of ``first``."""
    return (last - first) / first * 100


def _not_below(value: str, floor: str) -> Column:
    """At or above the floor, or one of them unknown. The slack covers rounding; ranks are exact later."""
    size = F.abs(F.col(floor))
    low = F.when(size < float("inf"), F.col(floor) - (size + 100) * 1e-9).otherwise(F.col(floor))
    return F.coalesce(F.col(value) >= low, F.lit(True))


def _reaching_floor(df: DataFrame, value: str, k: int) -> DataFrame:
    """Rows that can still be in the top ``k`` of their band. There is one floor per band label."""
    floor = floor_of_leaders(df.filter(F.col(value).isNotNull()), BAND, value, k, "_floor")
    floors = join_same(df, floor, [BAND], "left")
    return floors.filter(_not_below(value, "_floor")).drop("_floor")


def _careers(runs: DataFrame) -> DataFrame:
    """First and last day per athlete and band, and the best improvement between them.

    The best is null, which means unknown, for a career with a speed below zero or not finite. A
    result without a speed still sets the day; it sorts behind all others of its day.
    """
    day, usable = F.col("event_dates"), F.nullif(speed(), F.lit(0.0))
    ends = runs.groupBy(*WHO).agg(
        F.min(F.struct(day, usable.isNull().alias("none"), usable.alias("s"))).alias("f"),
        F.max(F.struct(day, usable.isNotNull().alias("some"), usable.alias("s"))).alias("l"),
        F.min(usable).alias("slowest"),
        F.max(usable).alias("fastest"),
    )
    both_days = ~F.col("f.none") & F.col("l.some")
    best = F.when((F.col("slowest") > 0) & (F.col("fastest") < float("inf")), improvement(F.col("f.s"), F.col("l.s")))
    return ends.filter(both_days).select(
        *WHO,
        F.col("f.event_dates").alias("_first"),
        F.col("l.event_dates").alias("_last"),
        best.alias("_best"),
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    write_table(df, path)
    return read_table(df.sparkSession, path, df.schema)


def _speeds_of_ends(runs: DataFrame, careers: DataFrame) -> DataFrame:
    """Distinct speeds of the first and last day of the given careers, with the number of copies."""
    ends = careers.select(
        *WHO,
        F.explode(
            F.array(
                F.struct(F.col("_first").alias("event_dates"), F.lit(True).alias("is_first")),
                F.struct(F.col("_last").alias("event_dates"), F.lit(False).alias("is_first")),
            )
        ).alias("_end"),
    ).select(*WHO, "_end.*")
    return (
        join_same(runs.filter(speed() != 0), ends, [*WHO, "event_dates"])
        .groupBy(*WHO, "is_first", speed().alias("speed"))
        .agg(F.count("*").alias("copies"))
    )


def _with_best(speeds: DataFrame) -> DataFrame:
    """Each speed with the best improvement it can be part of, which is that of a real pair."""
    first, last = F.when(F.col("is_first"), F.col("speed")), F.when(~F.col("is_first"), F.col("speed"))
    extremes = speeds.groupBy(*WHO).agg(
        F.min_by(first, 1 / first).alias("_f1"),
        F.max_by(first, 1 / first).alias("_f2"),
        F.min(last).alias("_l1"),
        F.max(last).alias("_l2"),
    )
    its = F.col("speed")
    as_first = F.greatest(improvement(its, F.col("_l1")), improvement(its, F.col("_l2")))
    as_last = F.greatest(improvement(F.col("_f1"), its), improvement(F.col("_f2"), its))
    return (
        join_same(speeds, extremes, WHO)
        .withColumn("_best", F.when(F.col("is_first"), as_first).otherwise(as_last))
        .drop("_f1", "_f2", "_l1", "_l2")
    )


def most_improved(distance: DataFrame, k: int = TOP) -> DataFrame:
    """Top ten improvements per band. Days compare as text, as they are stored.

    The results are read twice, with one job each time. What each reading leaves is stored: Spark
    then knows the size of the careers, and broadcasts them if they are below its threshold, so the
    second reading needs no shuffle of the results; and no later step reaches back to the results.
    """
    runs = distance.filter(
        long_enough() & F.col("athlete_id").isNotNull() & F.col("event_dates").isNotNull()
    ).select(*WHO, "event_dates", "athlete_average_speed_kmph")
    careers = _stored(_reaching_floor(_careers(runs), "_best", k), "careers")
    speeds = _stored(_speeds_of_ends(runs, careers), "career_speeds")
    speeds = _reaching_floor(_with_best(speeds), "_best", k)
    firsts = speeds.filter("is_first").select(
        *WHO, F.col("speed").alias("avg_speed_first_marathon"), F.col("copies").alias("_n1")
    )
    lasts = speeds.filter("not is_first").select(
        *WHO, F.col("speed").alias("avg_speed_last_marathon"), F.col("copies").alias("_n2")
    )
    pairs = join_same(firsts, lasts, WHO).withColumn(
        "improvement_percentage",
        improvement(F.col("avg_speed_first_marathon"), F.col("avg_speed_last_marathon")),
    )
    top = top_dense_rank(pairs, BAND, "improvement_percentage", "rank_by_improvement", k)
    return repeat_rows(repeat_rows(top, "_n1"), "_n2").orderBy(by_band(), "rank_by_improvement")
