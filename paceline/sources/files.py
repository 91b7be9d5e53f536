"""Results files, telemetry files, stored tables and topic logs."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.schemas import RAW_FILE, TELEMETRY_FIELDS, TOPIC

_TELEMETRY_TEXT = T.StructType([T.StructField(f, T.StringType()) for f in TELEMETRY_FIELDS])


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Raw results as text columns. The schema is given, so no job runs to infer it, and checked
    against the header."""
    return spark.read.schema(RAW_FILE).csv(path, header=True, enforceSchema=False)


BAD = "bad_row"


def sort_out_results(spark: SparkSession, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Raw results, and apart from them the text of rows that do not fit: with too few or too many fields.

    ``read_results`` fills up the one and cuts the other. Here the file is parsed once and stored in ``target``,
    with a folder for each kind; the bad rows stay there to be mended.
    """
    schema = T.StructType([*RAW_FILE.fields, T.StructField(BAD, T.StringType())])
    rows = spark.read.schema(schema).csv(source, header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD)
    write_table(rows.withColumn("fits", F.col(BAD).isNull()), target, partition_by="fits")
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("fits", T.BooleanType())])).parquet(target)
    return stored.filter("fits").drop(BAD, "fits"), stored.filter("not fits").select(BAD)


def _as_message(rows: DataFrame, runner: Column) -> DataFrame:
    fields = [F.coalesce(F.col(f), F.lit("")) for f in TELEMETRY_FIELDS]
    return rows.select(
        runner.cast("string").alias("key"), F.concat_ws(",", *fields).alias("value")
    )


def stream_telemetry_files(
    spark: SparkSession, folder: str, runner: Column | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of messages from a folder of ``;``-separated telemetry files with a header.

    The files hold no runner; the key is 1 unless a column says otherwise.
    """
    reader = spark.readStream.schema(_TELEMETRY_TEXT).option("sep", ";").option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _as_message(reader.csv(folder), F.lit(1) if runner is None else runner)


def read_telemetry_files(spark: SparkSession, folder: str, runner: Column | None = None) -> DataFrame:
    """The same messages in batch."""
    rows = spark.read.schema(_TELEMETRY_TEXT).csv(folder, sep=";", header=True)
    return _as_message(rows, F.lit(1) if runner is None else runner)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a stored table."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", 5_000_000)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def empty_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create a table without rows, or take all rows out of it."""
    write_table(spark.createDataFrame([], schema), path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_topics(df: DataFrame, path: str) -> None:
    """Messages to a topic log: one folder per topic."""
    df.write.mode("append").partitionBy("topic").parquet(path)


def stream_topics(
    spark: SparkSession, path: str, topics: list[str], files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the messages of some topics of a topic log, from the earliest."""
    reader = spark.readStream.schema(TOPIC)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).filter(F.col("topic").isin(topics))
