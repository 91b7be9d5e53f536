"""Running total per key in two levels, so that one busy key spreads over many tasks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.operators.aggregates import SUMS, from_sums, with_parts
from paceline.operators.joins import join_same


def running_total(
    df: DataFrame, key: str, time: str, value: str, out: str, span_seconds: int = 86400
) -> DataFrame:
    """``df`` with the sum of ``value`` up to and including each row, per key in order of time.

    For rows that are unique in (key, time). The time line is cut into spans: totals run within each
    (key, span), and what came before a span is a running total of span sums, of which a key has
    only as many as there are spans (days) in the data. Adding is exact (see ``aggregates``).
    """
    spans = df.withColumn("_span", F.floor(F.unix_timestamp(time) / span_seconds))
    parts = with_parts(spans, F.col(value)).drop("_v")
    before = f"over (partition by `{key}` order by _span rows between unbounded preceding and 1 preceding)"
    offsets = (
        parts.groupBy(key, "_span")
        .agg(*[F.sum(s).alias(s) for s in SUMS])
        .selectExpr(f"`{key}`", "_span", *[f"sum({s}) {before} as _before{s}" for s in SUMS])
    )
    within = f"over (partition by `{key}`, _span order by `{time}` rows between unbounded preceding and current row)"
    running = parts.selectExpr(*[f"`{c}`" for c in spans.columns], *[f"sum({s}) {within} as _within{s}" for s in SUMS])
    both = join_same(running, offsets, [key, "_span"]).selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[f"coalesce(_within{s} + _before{s}, _within{s}, _before{s}) as {s}" for s in SUMS],
    )
    return from_sums(both, out).withColumn(out, F.coalesce(out, F.lit(0.0)))
