"""Half-open bands ``[low, high)`` over a number, labelled ``low-high``.

A band label depends on nothing but its number, so predicates here look at the number: a filter on
the label would be pushed down with the whole CASE in it and read the raw text once per bound.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The band bounds and the label of a number outside all bands.
AGE_BANDS = [(17, 30), (30, 45), (45, 120)]
DISTANCE_BANDS = [(0, 40), (40, 65), (65, 90), (90, 120), (120, 200), (200, 1000), (1000, 6000)]
NO_BAND = "None"


def band(number: Column, bounds: list[tuple[int, int]]) -> Column:
    """Label of the band; null for null or non-positive numbers, ``'None'`` outside all bands.

    The bands must ascend without gaps, so one comparison each is enough.
    """
    if any(low != high for (_, high), (low, _) in zip(bounds, bounds[1:])):
        raise ValueError(f"bands must join: {bounds}")
    below = F.when(number.isNull() | (number <= 0), F.lit(None)).when(number < bounds[0][0], NO_BAND)
    labelled = reduce(lambda chain, b: chain.when(number < b[1], f"{b[0]}-{b[1]}"), bounds, below)
    return labelled.otherwise(NO_BAND)


def has_band(number: Column) -> Column:
    """True where the label is not null."""
    return number > 0


def beyond_first_band(number: Column, bounds: list[tuple[int, int]]) -> Column:
    """True where the label is neither null nor that of the first band, which must start at 0."""
    return number >= bounds[0][1]


def in_known_band(number: Column, bounds: list[tuple[int, int]]) -> Column:
    """True where the label is neither null nor ``'None'``; the bounds must join without gaps."""
    return (number > 0) & (number >= bounds[0][0]) & (number < bounds[-1][1])


def band_start(label: Column) -> Column:
    """Sort key of a label: its lower bound, null for ``'None'``."""
    return F.split_part(label, F.lit("-"), F.lit(1)).try_cast("int")
