"""Session settings and the shared folder that cuts lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, scratch: str | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster the session comes from spark-submit.

    ``scratch`` is the folder for intermediate tables where the installation names none.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gritmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Call-site capture makes every column expression several round trips to the JVM.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    session = builder.getOrCreate()
    if scratch and not session.conf.get("spark.checkpoint.dir", None):
        session.stop()
        session = builder.config("spark.checkpoint.dir", scratch).getOrCreate()
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``, which must be set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/gritmill/{uuid.uuid4().hex}/{label}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once, read many times.

    The result has no lineage behind it, so a lost executor never repeats the work above it, its row
    count comes from the file footers, and Catalyst sees its true size when it picks a join.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
