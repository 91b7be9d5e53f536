"""Tables of which only the last row of each key counts: changes by batch, folded into snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.operators.running import running_total
from paceline.streaming.sinks import FileTarget


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, of any file system Spark reaches; none if it is not there."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in system.listStatus(folder)] if system.exists(folder) else []


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@dataclass(frozen=True)
class StateTable:
    """The target of a stream in update mode, and the state that it leaves.

    Batch n writes its changes to the folder of its epoch, ``n // every``. The first batch of an epoch folds
    what came before into a snapshot of one row per key: the snapshot before it and the epochs since. A
    snapshot counts once it is complete (``_SUCCESS``), so a fold that fails is done again. A reader needs
    one snapshot and the changes of one epoch, at most ``every`` batches, however long the stream has run.
    A batch that runs again replaces its changes. The two latest snapshots and epochs are kept for readers that
    are under way; what is older is deleted, so folders do not grow in number either.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    every: int = 100

    def __call__(self, batch: DataFrame, number: int) -> None:
        epoch = number // self.every
        self._fold(batch.sparkSession, epoch)
        FileTarget(f"{self.path}/changes/{epoch}", self.schema.names)(batch, number)

    def _snapshots(self, spark: SparkSession) -> list[int]:
        """Epochs that have a complete snapshot of all before them, in order."""
        found = sorted(int(name) for name in _folders(spark, f"{self.path}/snapshots"))
        return [e for e in found if "_SUCCESS" in _folders(spark, f"{self.path}/snapshots/{e}")]

    def _epochs(self, spark: SparkSession) -> list[int]:
        return sorted(int(name) for name in _folders(spark, f"{self.path}/changes"))

    def _fold(self, spark: SparkSession, epoch: int) -> None:
        done = self._snapshots(spark)
        if epoch == 0 or epoch in done or not self._epochs(spark):
            return
        self._read(spark, epoch * self.every).write.mode("overwrite").parquet(f"{self.path}/snapshots/{epoch}")
        for old in done[:-1]:
            _delete(spark, f"{self.path}/snapshots/{old}")
        for old in [e for e in self._epochs(spark) if done and e < done[-1]]:
            _delete(spark, f"{self.path}/changes/{old}")

    def _read(self, spark: SparkSession, before: int | None) -> DataFrame:
        """The last row of each key, of batches below ``before`` or of all."""
        epochs = [e for e in self._epochs(spark) if before is None or e * self.every < before]
        bases = [e for e in self._snapshots(spark) if before is None or e * self.every < before]
        base = bases[-1] if bases else None
        numbered = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        rows = spark.createDataFrame([], numbered)
        if base is not None:
            rows = spark.read.schema(self.schema).parquet(f"{self.path}/snapshots/{base}").withColumn("batch", F.lit(-1).cast("long"))
        for epoch in [e for e in epochs if base is None or e >= base]:
            changes = spark.read.schema(numbered).parquet(f"{self.path}/changes/{epoch}")
            rows = rows.unionByName(changes if before is None else changes.filter(F.col("batch") < before))
        latest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*self.schema.names), "batch").alias("latest"))
        return latest.select("latest.*")

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The last row of each key; with ``before``, of the batches below that number (of the current epoch or
        the end of the one before it), as a batch needs it that may be run again."""
        return self._read(spark, before)

    def input_files(self, spark: SparkSession) -> list[str]:
        """The files that ``read`` takes now."""
        return list(self._read(spark, None).inputFiles())


@dataclass(frozen=True)
class TotalsTarget:
    """A total for each row that comes in, after the row: per key the sum so far, over all batches.

    The totals of the batches before are a state table (one row per key), so a batch reads that and its own
    rows, never the rows of earlier batches; run again, it finds the same totals and replaces its rows. Rows
    of a batch follow each other in order of time. Sums are kept to ``digits`` decimals, as the windows have them.
    """

    path: str
    key: str = "runner_id"
    time: str = "time"
    value: str = "value"
    digits: int = 4
    every: int = 100

    def state(self) -> StateTable:
        schema = T.StructType([T.StructField(self.key, T.LongType()), T.StructField("total", T.DoubleType())])
        return StateTable(f"{self.path}/state", schema, (self.key,), self.every)

    def __call__(self, batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                self._write(batch, number)
        finally:
            batch.unpersist()

    def _write(self, batch: DataFrame, number: int) -> None:
        spark, state = batch.sparkSession, self.state()
        before = state.read(spark, number).select(F.col(self.key).alias("_key"), F.col("total").alias("_before"))
        running = running_total(batch, self.key, self.time, self.value, "_within")
        met = running.join(before, F.col(self.key).eqNullSafe(F.col("_key")), "left")
        total = F.round(F.coalesce("_before", F.lit(0.0)) + F.col("_within"), self.digits)
        rows = met.select(self.key, self.time, total.alias(self.value)).persist()
        try:
            last = rows.groupBy(self.key).agg(F.max_by(self.value, self.time).alias("total"))
            state(last, number)
            FileTarget(f"{self.path}/rows")(rows, number)
        finally:
            rows.unpersist()


def late_counts(spark: SparkSession, checkpoint: str, table: str, read: dict[int, int]) -> DataFrame:
    """(batch, rows_read, rows_kept, rows_dropped) of a stream of ``live.window_rows`` to a ``FileTarget``.

    ``read`` has the rows each batch read, as its progress tells. What a batch kept is what it wrote and what the
    state has more than before; the rest came behind the watermark. The progress itself counts late groups of
    partial sums, not rows. Only as many batches back as the checkpoint keeps.
    """
    written = spark.read.schema("rows long, batch long").parquet(table).groupBy("batch").agg(F.sum("rows").alias("n"))

    def held(batch: int) -> DataFrame:
        if batch < 0:
            return spark.range(0).select(F.lit(0).cast("long").alias("n"))
        state = spark.read.format("statestore").option("batchId", batch).load(checkpoint)
        return state.select(F.col("value.count").alias("n"))

    found = None
    for batch, rows in sorted(read.items()):
        signed = held(batch).union(held(batch - 1).select(-F.col("n"))).union(written.filter(F.col("batch") == batch).select("n"))
        kept = signed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_kept"))
        one = kept.select(F.lit(batch).cast("long").alias("batch"), F.lit(rows).cast("long").alias("rows_read"), "rows_kept")
        found = one if found is None else found.union(one)
    if found is None:
        found = spark.createDataFrame([], "batch long, rows_read long, rows_kept long")
    return found.withColumn("rows_dropped", F.col("rows_read") - F.col("rows_kept"))


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Windows that a stopped stream still holds in its first stateful operator: runner, start and end.

    Read from its checkpoint; nothing is started.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.runner_id", F.col("key.window.start").alias("start"), F.col("key.window.end").alias("time"))
