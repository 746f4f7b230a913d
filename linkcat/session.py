"""Session helpers: a local session for tests, and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "linkcat", memory: str = "12g") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def _shared(spark: SparkSession) -> str:
    """The folder for intermediate results that the cluster names; only a local session may get one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="linkcat-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_shared(df.sparkSession))
    return df.checkpoint()


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{_shared(spark).rstrip('/')}/{uuid.uuid4()}"
