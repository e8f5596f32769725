"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "caremetrics", cpus: int | str = "*") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Runtime sizes are compressed bytes; a tenth of the default keeps tables of
        # many rows out of single-threaded hash builds.
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "1m")
        # No call sites recorded for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CAREMETRICS_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_own_roots: dict[str, str] = {}


def _shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or one kept in the session.

    Only a session that runs in one process may do without the setting: its tasks
    see the driver's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if master not in _own_roots:
        _own_roots[master] = tempfile.mkdtemp(prefix="caremetrics-")
    return _own_roots[master]


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name for one run, below the shared checkpoint folder."""
    return f"{_shared_root(spark).rstrip('/')}/caremetrics-{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared checkpoint folder.

    For small results of large inputs that a later plan reads several times.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(_shared_root(spark))
    return df.checkpoint()


def stored(df: DataFrame, purpose: str = "stored") -> DataFrame:
    """The rows of ``df``, written to the shared folder and read again.

    A checkpoint keeps the size that was estimated for its plan. In a loop that joins a
    table with frames made from itself, estimates multiply from round to round, until
    planning does not end; here the estimate is the size of the files.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
