"""Typed values from the free text of the raw results.

Text that cannot be read gives null, never an error. Expressions name their text as seldom as they
can: in a pushed-down filter each mention is a copy of whatever makes up the text, and generated
methods above 8 kB of bytecode are not compiled to machine code.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns and the factor that decide which text is read, and how.
NUMBER = r"([0-9]+(.[0-9]+)?)"
INTEGER = r"([0-9]+)"
DAYS = r"([0-9]+)d"
CLOCK = r"[0-9]+:[0-9]{2}:[0-9]{2}"
KM_PER_MILE = 1.609344


def whole_number(text: Column) -> Column:
    """Integer from text that may carry a fraction, such as ``1978.0``."""
    return text.try_cast("double").try_cast("int")


def kilometres(text: Column) -> Column:
    """Distance in km, to four decimals: from km or miles, zero for any other unit or none."""
    unit = F.when(text.contains("km"), 1.0).when(text.contains("mi"), KM_PER_MILE)
    number = F.regexp_extract(text, NUMBER, 1).try_cast("float").cast("double")
    return F.when(unit.isNull(), 0.0).otherwise(F.round(number * unit, 4))


def limit_hours(text: Column) -> Column:
    """Time limit in hours: the first integer, as days if ``d`` occurs plus as hours if ``h`` does."""
    number = F.regexp_extract(text, INTEGER, 1).try_cast("int").cast("bigint")
    days = F.when(text.contains("d"), number * 24).otherwise(0)
    hours = F.when(text.contains("h"), number).otherwise(0)
    return (days + hours).try_cast("int")


def clock_seconds(text: Column) -> Column:
    """Seconds from ``[Nd ]H:MM:SS``; null if there is no clock part.

    Starts with the seconds: without a clock there is no third part, and the rest is not evaluated.
    A cast of the empty first part would raise and catch an exception in every such row.
    """
    clock = F.split(F.regexp_extract(text, CLOCK, 0), ":")
    hours, minutes, seconds = (
        F.get(clock, F.lit(part)).try_cast("int").cast("bigint") for part in (0, 1, 2)
    )
    days = F.when(text.contains("d"), F.regexp_extract(text, DAYS, 1).try_cast("int")).otherwise(0)
    return (seconds + minutes * 60 + hours * 3600 + days.cast("bigint") * 86400).try_cast("int")


def speed_always_metres(text: Column) -> Column:
    """Speed of a time-limited result: always taken as m/h and divided by 1000."""
    return text.try_cast("float").cast("double") / 1000.0


def speed_mixed_units(text: Column) -> Column:
    """Speed of a distance-limited result: divided by 1000 only above 50, where km/h is implausible."""
    speed = text.try_cast("double")
    return speed / F.when(speed > 50, 1000.0).otherwise(1.0)


def decade_start(year: Column) -> Column:
    """First of January of the decade that ends with the next round year: 2000 gives 1990-01-01."""
    decade = (F.floor((year - 1) / 10) * 10).cast("int")
    return F.when(year.between(1, 9999), F.make_date(decade, F.lit(1), F.lit(1)))
