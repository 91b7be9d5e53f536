"""Sinks. Each stream is one query with one checkpoint, however many targets it has."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from paceline.sources.jdbc import Database

# A null message is told from an empty one; read CSV files of messages back with the same options.
CSV = {"nullValue": "\\N"}

# Writes one micro-batch, given its number.
Target = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class FileTarget:
    """A table of files. A batch owns the partition of its number and replaces it when it is run
    again after a failure, so every row is there once."""

    path: str
    columns: list[str | Column] | None = None
    format: str = "parquet"

    def __call__(self, batch: DataFrame, number: int) -> None:
        rows = batch.select(*self.columns) if self.columns else batch
        (
            rows.withColumn("batch", F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .format(self.format)
            .options(**(CSV if self.format == "csv" else {}))
            .save(self.path)
        )


@dataclass(frozen=True)
class JdbcTarget:
    """A database table with a column for the number of the batch. What a batch left behind before it failed
    is deleted when it is run again, so every row is there once."""

    database: Database
    table: str
    columns: list[str | Column]

    def clear_statement(self, number: int) -> str:
        return f"DELETE FROM {self.table} WHERE batch = {int(number)}"

    def __call__(self, batch: DataFrame, number: int) -> None:
        rows = batch.select(*self.columns).withColumn("batch", F.lit(number).cast("bigint"))
        self.database.execute(batch.sparkSession, self.clear_statement(number))
        self.database.append(rows, self.table)


@dataclass(frozen=True)
class KafkaTarget:
    """A Kafka topic; the frame must have ``key`` and ``value``, and may have ``topic``.

    A topic cannot take messages back, so each carries the number of its batch as a header, by which
    readers can drop repeats.
    """

    servers: str
    topic: str | None
    columns: list[str | Column]

    @staticmethod
    def with_header(rows: DataFrame, number: int) -> DataFrame:
        mark = F.struct(F.lit("batch").alias("key"), F.lit(str(number)).cast("binary").alias("value"))
        return rows.withColumn("headers", F.array(mark))

    def __call__(self, batch: DataFrame, number: int) -> None:
        writer = self.with_header(batch.select(*self.columns), number).write.format("kafka")
        writer = writer.option("kafka.bootstrap.servers", self.servers)
        (writer.option("topic", self.topic) if self.topic else writer).save()


def fan_out(*targets: Target) -> Target:
    """One target out of several. The batch is computed once and kept for all of them.

    Topics come last: when an earlier target fails, nothing has been sent that cannot be replaced.
    """
    ordered = sorted(targets, key=lambda target: isinstance(target, KafkaTarget))

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for target in ordered:
                target(batch, number)
        finally:
            batch.unpersist()

    return write


def to_target(df: DataFrame, target: Target, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: target(batch, number))
    )


def to_files(
    df: DataFrame, path: str, checkpoint: str, format: str = "parquet", partition_by: str | None = None
) -> DataStreamWriter:
    """Append to files; with their own log of what is complete, so every row is there once."""
    writer = (
        df.writeStream.outputMode("append")
        .format(format)
        .options(**(CSV if format == "csv" else {}))
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return writer.partitionBy(partition_by) if partition_by else writer


def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Append ``key, value`` to a topic. Keyed by runner, so a runner's messages keep their order."""
    return (
        df.select("key", "value")
        .writeStream.outputMode("append")
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
