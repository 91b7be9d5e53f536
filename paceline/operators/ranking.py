"""Top ranks per group, with ties, when one group may hold most of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paceline.operators.joins import join_same

def leading_values(df: DataFrame, group: str, value: str, rank: str, k: int) -> DataFrame:
    """The ``k`` largest distinct values of each group, with their rank.

    Duplicates are removed before the window, so each map task sends at most ``k`` rows per group
    (``WindowGroupLimit``): neither a hot group nor a mass of ties reaches a single task.
    """
    order = W.partitionBy(group).orderBy(F.col(value).desc_nulls_first())
    return (
        df.select(group, value)
        .distinct()
        .withColumn(rank, F.dense_rank().over(order))
        .filter(F.col(rank) <= k)
    )


def top_dense_rank(df: DataFrame, group: str, value: str, rank: str, k: int) -> DataFrame:
    """Rows of ``df`` whose dense rank by falling ``value`` within ``group`` is at most ``k``.

    There are ``k`` leading values per group to join back; adaptive execution broadcasts them if
    they turn out small. ``value`` is computed once for the leaders and once for the rows, so it
    must come out the same each time (see ``exact_avg``).
    """
    leaders = leading_values(df, group, value, rank, k)
    return join_same(df, leaders, [group, value])


def floor_of_leaders(df: DataFrame, group: str, value: str, k: int, out: str) -> DataFrame:
    """The ``k``-th largest distinct value of each group; no row for a group with fewer."""
    return (
        leading_values(df, group, value, "_rank", k)
        .filter(F.col("_rank") == k)
        .select(group, F.col(value).alias(out))
    )


def repeat_rows(df: DataFrame, times: str, block: int = 100_000) -> DataFrame:
    """Each row ``times`` times, and the column dropped.

    Made in blocks, never as one long array; blocks are dealt out, so the copies of one row are
    written by as many tasks as they have blocks.
    """
    return (
        df.withColumn("_block", F.explode(F.expr(f"sequence(0L, ({times} - 1) div {block}L)")))
        .repartition(*df.columns, "_block")
        .withColumn(
            "_copy",
            F.explode(F.expr(f"sequence(1L, least({block}L, {times} - _block * {block}L))")),
        )
        .drop("_block", "_copy", times)
    )
