"""Starting streams, draining them, and the archive of topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from paceline.session import prepare, shared_path
from paceline.streaming.sinks import Target, to_files, to_target
from paceline.streaming.state import StateTable


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for streams.

    A checkpoint keeps the number of state partitions of its first run for good, so it is given and
    never read off the machine: ``state_partitions``, or else as many as the session's shuffles have.
    """
    session = prepare(spark.newSession())
    partitions = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process all that is there now, then stop. Fails if the stream failed."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_forever(spark: SparkSession, *writers: DataStreamWriter, every: str = "1 second") -> None:
    """Start the streams and wait until one of them ends."""
    for writer in writers:
        writer.trigger(processingTime=every).start()
    spark.streams.awaitAnyTermination()


def drain_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """The output of a stream over all that is there now, as a stored table."""
    root = shared_path(spark, name)
    drain(to_files(stream, f"{root}/table", f"{root}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{root}/table")


def drain_to_target(
    spark: SparkSession, stream: DataFrame, target: Target, name: str, mode: str = "append"
) -> None:
    drain(to_target(stream, target, f"{shared_path(spark, name)}/checkpoint", mode))


def drain_last_state(spark: SparkSession, stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """The final state of a stream that gives the rows that changed each time."""
    table = StateTable(f"{shared_path(spark, name)}/table", stream.schema, tuple(keys))
    drain_to_target(spark, stream, table, name, mode="update")
    return table.read(spark)


def archive(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Messages of all topics to one folder per topic, with the time of receipt, one hour ahead."""
    received = messages.select(
        "topic",
        "key",
        (F.current_timestamp() + F.expr("interval 1 hour")).alias("time"),
        F.col("value"),
    )
    return to_files(received, path, checkpoint, partition_by="topic")
