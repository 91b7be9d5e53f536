"""Helpers shared by the operators: stored intermediates, in-plan tables, and positions along a line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.session import shared_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: lineage ends there, and a lost executor
    costs no more than its running tasks."""
    path = shared_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: Column | str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fixed_rows(spark: SparkSession, names: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """A small table of constants, held in the plan itself."""
    kinds = [next((type(row[i]) for row in rows if row[i] is not None), str) for i in range(len(names))]
    sql = {str: "string", int: "bigint", float: "double", bool: "boolean"}
    schema = "array<struct<" + ",".join(f"`{n}`:{sql[k]}" for n, k in zip(names, kinds)) + ">>"
    values = F.array(*[F.struct(*[F.lit(v).cast(sql[k]).alias(n) for n, k, v in zip(names, kinds, row)]) for row in rows])
    if not rows:
        values = F.array()
    return spark.range(1).select(F.explode(values.cast(schema)).alias("r")).select("r.*")


def on_a_line(df: DataFrame, key: str, order: Sequence[Column], length: Column, start: str) -> DataFrame:
    """Lay the rows of each key end to end: adds where a row starts, the sum of lengths before it.

    The rows of a key are cut into about sqrt(n) runs by the leading bits of a hash, runs are placed by
    their sums and rows within their run, so no task sorts more than some sqrt(n) rows of one key,
    however large that key is. The order is that of the hash, then of ``order``.
    """
    rows = df.count()
    runs = max(1, round(rows**0.5))
    spread = F.xxhash64(F.lit("line"), *order)
    named = df.withColumn("_run", F.pmod(F.shiftrightunsigned(spread, 20), F.lit(runs))).withColumn("_len", length)
    sums = named.groupBy(key, "_run").agg(F.sum("_len").alias("_sum"))
    before = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.select(
        F.col(key).alias("_key"), F.col("_run").alias("_at"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy(key, "_run").orderBy(spread, *order).rowsBetween(Window.unboundedPreceding, -1)
    inside = named.withColumn("_in", F.coalesce(F.sum("_len").over(within), F.lit(0)))
    joined = inside.join(placed, inside[key].eqNullSafe(placed["_key"]) & (inside["_run"] == placed["_at"]))
    return joined.withColumn(start, F.col("_base") + F.col("_in")).drop("_run", "_len", "_in", "_key", "_at", "_base")
