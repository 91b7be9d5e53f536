"""What a runner's race history says about the pace to expect."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.operators.aggregates import recency_weighted_mean


def weighted_history(distance: DataFrame, length_km: float, now: int) -> DataFrame:
    """Mean speed per runner over races of exactly this length up to the year ``now``, recent years
    weighing more; to four decimals."""
    races = distance.filter(F.col("distance_km") == length_km).withColumnRenamed(
        "athlete_id", "runner_id"
    )
    means = recency_weighted_mean(
        races, ["runner_id"], "year_of_event", "athlete_average_speed_kmph", now, "average_speed"
    )
    # Means of a few races often end in exactly half a unit of the fourth decimal. As a decimal such
    # a mean is exact and rounds up; as a double it would go by its last bit.
    mean = F.col("average_speed")
    rounded = F.round(mean.try_cast("decimal(28,9)"), 4).cast("double")
    return means.withColumn("average_speed", F.coalesce(rounded, F.round(mean, 4)))
