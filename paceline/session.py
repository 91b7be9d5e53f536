"""Session settings and the shared folder for data that outlives one task."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# HotSpot leaves methods above 8000 bytes of bytecode interpreted, which is several times slower than
# running the operators one by one.
SQL_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows that go to Python can be whole documents.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # State on local disk, so it may outgrow memory; each batch ships its changes, not all files; and
    # a join keeps its four tables in one store per partition instead of four.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def build_session(app: str = "paceline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the library relies on; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return findable(builder.getOrCreate())


def findable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did; executors on other machines need
    it by ``--py-files`` or an installation."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, known]))
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return findable(spark)


# Folders of local sessions that name none; the setting itself cannot be changed once Spark runs.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _LOCAL_ROOTS.setdefault(
        spark.sparkContext.applicationId, f"{tempfile.gettempdir()}/paceline-{uuid.uuid4().hex}"
    )


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/paceline/{name}-{uuid.uuid4().hex}"
