"""Session settings and materialisation of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lingmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; ``conf`` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # Recording the call site of every Column costs more than planning does.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local-mode session without that setting gets a folder of its own;
    on a cluster a machine-local folder would be lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="lingmill-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_table_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one intermediate table, below a subfolder of this application."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{application}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in storage that survives executor loss. The re-read table
    has true file sizes, so Spark broadcasts it in a later join only when it is
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    path = new_table_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
