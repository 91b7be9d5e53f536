"""Equality joins that add no null filters."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, nulls being equal; the key columns of the left are kept.

    Besides matching nulls this keeps plans small. For a plain equality Spark infers ``key IS NOT
    NULL`` and pushes it to the scan; if the key is a label derived from text, the filter is a copy
    of all that derives it. A null-safe equality is hashed just the same but infers nothing.
    """
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})

    def same(key: str) -> Column:
        return F.col(key).eqNullSafe(F.col(f"_right_{key}"))

    joined = left.join(renamed, reduce(Column.__and__, map(same, keys)), how)
    return joined.drop(*[f"_right_{key}" for key in keys])
