"""Aggregates whose result does not depend on the order in which rows arrive.

A sum of doubles changes in its last bits with the order of the shuffle blocks. Ranks then split or
merge ties from run to run, and a stage that is computed again after a lost executor may disagree
with its first result. Sums of decimals are exact, so they always agree.

Whole sums per group (``exact_by``) go one step at a time: a value that is ``n / 10^9`` for a whole ``n`` below
10^15, as dividing back shows, is added as two halves of ``n``, in ``bigint`` sums that cost no more than a sum of
doubles; other values add the digits of their decimal text, twenty bits at a time. Both make the same sum as
the decimals below. Each step is a projection of its own, so what several sums share is computed once.

Where an aggregate is needed as an expression, decimals are summed: a double is taken as the shortest decimal text that reads back as it, cut into a part of 18
fraction digits and the next 18 digits below. That holds all digits of any value from 1e-15 up; a
value out of range (smaller, larger, NaN, infinite) is added by itself, as the double it is, to the exact
sum of the others.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRACTION = 18
# Digits of a part: before the point ten, or four where it is multiplied by a year.
WIDE, NARROW = 28, 22
LEAST = 1e-15


def exact_parts(number: Column, digits: int = WIDE) -> tuple[Column, Column, Column]:
    """High and low decimal part of a double, null if it is out of range, and the double if it is."""
    number = number.cast("double")
    size = F.abs(number)
    fits = (size < 10.0 ** (digits - FRACTION) - 1) & ((size >= LEAST) | (size == 0))
    kind = f"decimal({digits},{FRACTION})"
    high = F.when(fits, number).try_cast(kind)
    below = (number - high.cast("double")) * 10.0**FRACTION
    return high, F.when(fits, below).try_cast(kind), F.when(~fits, number)


def put_together(high: Column, low: Column, rest: Column) -> Column:
    """The double of a sum from the sums of its parts; null if there was nothing to add."""
    exact = high.cast("double") + F.coalesce(low.cast("double"), F.lit(0.0)) / 10.0**FRACTION
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)


def exact_sum(number: Column, add: Callable[[Column], Column] = lambda c: c) -> Column:
    """Sum as a double; ``add`` may put the sums over a window."""
    high, low, rest = exact_parts(number)
    return put_together(add(F.try_sum(high)), add(F.try_sum(low)), add(F.sum(rest)))


def exact_avg(number: Column) -> Column:
    """Mean as a double."""
    return F.try_divide(exact_sum(number), F.count(number))


HALF = 25  # bits of the lower half of a short value: room for 2^38 rows of a group, then a sum fails and never wraps
THIRD = 20  # bits of a third of 18 digits


def _halves(number: str, width: int, parts: int) -> list[str]:
    """A whole number in parts of some bits, the leading one first; only that one may be negative."""
    lower = [f"shiftright({number}, {width * i}) & {(1 << width) - 1}L" for i in reversed(range(parts - 1))]
    return [f"shiftright({number}, {width * (parts - 1)})", *lower]


def _of_halves(sums: list[str], width: int) -> str:
    """The number again, as a decimal, from sums of its parts; null parts add nothing."""
    shifted = [f"cast(coalesce({c}, 0) as decimal(20,0)) * {1 << width * i}BD" for i, c in enumerate(reversed(sums))]
    return f"({' + '.join(shifted)})"


SUMS = [f"_s{i}" for i in range(10)]


def with_parts(df: DataFrame, value: Column) -> DataFrame:
    """``df`` with what each row adds to the sums ``SUMS``, and its value as ``_v``."""
    unit = f"{10**FRACTION}BD"
    fits = f"abs(_v) < {10.0 ** (WIDE - FRACTION) - 1}D and (abs(_v) >= {LEAST}D or _v = 0)"
    steps = [
        {"_n": "rint(_v * 1e9D)"},
        {"_short": "abs(_n) < 1e15D and _n / 1e9D = _v"},
        {"_w": "case when _short then cast(_n as bigint) end",
         "_high": f"case when not _short and {fits} then try_cast(_v as decimal({WIDE},{FRACTION})) end"},
        {"_upper": f"cast((_high - floor(_high)) * {unit} as bigint)",
         "_lower": f"cast(try_cast((_v - cast(_high as double)) * 1e{FRACTION}D as decimal({WIDE},{FRACTION})) * {unit} as bigint)"},
        dict(zip(SUMS, [
            *_halves("_w", HALF, 2), "cast(floor(_high) as bigint)", *_halves("_upper", THIRD, 3), *_halves("_lower", THIRD, 3),
            "case when not _short and _high is null then _v end"])),
    ]
    out = df.withColumn("_v", value.cast("double"))
    for step in steps:
        out = out.selectExpr("*", *[f"{text} as {name}" for name, text in step.items()])
    return out.drop(*[name for step in steps[:-1] for name in step])


def from_sums(df: DataFrame, out: str, count: str | None = None) -> DataFrame:
    """``df`` with the double of a sum, or of a mean over ``count``, in place of the sums of the parts."""
    quick = f"_s2 is null and _s9 is null and _s0 between {-(1 << 27)} and {1 << 27}"
    units = (
        f"cast(coalesce(_s2, 0) as decimal(20,0)) * {10**FRACTION}BD + {_of_halves(SUMS[3:6], THIRD)}"
        f" + {_of_halves(SUMS[:2], HALF)} * {10**9}BD"
    )
    # Whole numbers of the last digit's unit, read as text: no rounding before the one to a double.
    read = lambda number, digits: f"cast(concat(cast({number} as string), 'E-{digits}') as double)"
    steps = [
        {"_long": f"case when {quick} then null else {units} end", "_below": f"case when {quick} then null else {_of_halves(SUMS[6:9], THIRD)} end"},
        {"_exact": f"case when _s0 is not null or _s2 is not null then {read('_long', FRACTION)} + {read('_below', 2 * FRACTION)} end"},
        {"_sum": f"case when {quick} then cast(shiftleft(_s0, {HALF}) + _s1 as double) / 1e9D when _s9 is null then _exact "
                 "else coalesce(_exact, 0D) + _s9 end"},
    ]
    for step in steps:
        df = df.selectExpr("*", *[f"{text} as {name}" for name, text in step.items()])
    result = F.expr(f"try_divide(_sum, {count})" if count else "_sum")
    return df.withColumn(out, result).drop("_long", "_below", "_exact", "_sum", *SUMS, *([count] if count else []))


def exact_by(df: DataFrame, keys: list[str | Column], value: Column, out: str, *more: Column, mean: bool = True) -> DataFrame:
    """Per group the mean (or the sum) of a double as ``out``, after the keys and ``more`` aggregates."""
    sums = [F.expr(f"sum({s})").alias(s) for s in SUMS]
    grouped = with_parts(df, value).groupBy(*keys).agg(*more, *sums, F.expr("count(_v)").alias("_count"))
    return from_sums(grouped, out, "_count") if mean else from_sums(grouped.drop("_count"), out)


def recency_weighted_mean(
    df: DataFrame, keys: list[str], year: str, value: str, now: int, out: str
) -> DataFrame:
    """Mean per key in which a year ``y`` weighs ``1 - (now - y) / (now - first + 1)``.

    ``first`` is the key's earliest year, so a weight is ``(y - first + 1) / (now - first + 1)``. The
    divisor is the same for all rows of a key and cancels; what is left is linear in ``y``, so one
    aggregation with map-side partial sums is enough: no window and no second pass, however many
    rows one key has. For years up to ``now``; ``now`` itself no longer matters then.
    A missing value adds nothing above the line but keeps its weight below, a missing year neither.
    """
    high, low, rest = exact_parts(F.col(value), NARROW)
    years = F.col(year).cast("decimal(5,0)")
    sums = df.filter(F.col(year) <= now).groupBy(*keys).agg(
        (F.min(year) - 1).alias("_before"),
        F.try_sum(high).alias("_high"),
        F.try_sum(high * years).alias("_high_by_year"),
        F.try_sum(low).alias("_low"),
        F.try_sum(low * years).alias("_low_by_year"),
        F.sum(rest).alias("_rest"),
        F.sum(rest * F.col(year)).alias("_rest_by_year"),
        F.count("*").alias("_rows"),
        F.sum(F.col(year).cast("bigint")).alias("_years"),
    )

    def weighted(part: str) -> Column:
        before = F.col("_before").cast("decimal(5,0)")
        # One digit less than the most there are, so that the difference keeps its fraction.
        return F.col(f"_{part}_by_year").try_cast("decimal(36,18)") - (before * F.col(f"_{part}")).try_cast("decimal(36,18)")

    rest_weighted = F.col("_rest_by_year") - F.col("_before") * F.col("_rest")
    top = put_together(weighted("high"), weighted("low"), rest_weighted)
    bottom = F.col("_years") - F.col("_before") * F.col("_rows")
    return sums.select(*keys, F.try_divide(top, bottom).alias(out))
