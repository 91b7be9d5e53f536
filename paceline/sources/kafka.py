"""Kafka topics. Needs Spark's Kafka package on the classpath; nothing else in the library does."""

from pyspark.sql import DataFrame, SparkSession


def read_options(servers: str, topics: list[str], starting: str = "latest") -> dict[str, str]:
    """Options of a subscription; data that has expired on the broker is no error."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    starting: str = "latest",
    per_batch: int | None = None,
) -> DataFrame:
    """Stream of ``topic, key, value`` as text from some topics."""
    reader = spark.readStream.format("kafka").options(**read_options(servers, topics, starting))
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load().selectExpr(
        "topic", "cast(key as string) as key", "cast(value as string) as value"
    )
