"""Tables by name, in the session's own catalogue (in memory: no database behind it), and bucketed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def register(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """Give a stored table, or a folder that has yet to be filled, a name."""
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def _known(spark: SparkSession, name: str) -> str:
    if not spark.catalog.tableExists(name):
        there = ", ".join(sorted(t.name for t in spark.catalog.listTables())) or "none"
        raise ValueError(f"there is no table {name!r}; tables: {there}")
    return name


def read_named(spark: SparkSession, name: str) -> DataFrame:
    """A table by its name, which is passed to SQL as a parameter. Files that came since are seen."""
    spark.catalog.refreshTable(_known(spark, name))
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


def latest_named(spark: SparkSession, name: str) -> DataFrame:
    """The latest row of a live table; none if it is empty. Runners at the same time: lowest id."""
    spark.catalog.refreshTable(_known(spark, name))
    latest = "SELECT * FROM IDENTIFIER(:name) ORDER BY time DESC, runner_id LIMIT 1"
    return spark.sql(latest, args={"name": name})


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store a table in buckets of a key and read it: groups and joins by the key then need no shuffle of it.

    Rows are dealt out by bucket before they are written, so a bucket is one file and not one per task. A key
    that holds a large part of the rows makes a large bucket; such a table should stay as it is.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
