"""Scans and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gritmill.functions.columns import col


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. A given schema saves the extra pass that inference needs."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def overwrite_parquet(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, schema=None) -> DataFrame:
    """Convert once, so that later scans prune columns and push filters down."""
    return overwrite_parquet(read_csv(spark, csv_path, schema), parquet_path)


def bucket_count(spark: SparkSession, wanted: int) -> int:
    """At least one, and no more than the session allows; beyond that the buckets grow instead."""
    return max(1, min(wanted, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))))


def write_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, path: str) -> tuple[DataFrame, str]:
    """The table at ``path`` in buckets of its keys, one file each, and its name in the catalog.

    Grouping by the keys, and joining with a table of as many buckets by the same keys, needs no shuffle. ``DROP TABLE`` takes only the name away, not the files.
    """
    spark, name = df.sparkSession, f"gritmill_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *[col(k) for k in keys])
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return spark.table(name), name


def path_exists(spark: SparkSession, path: str) -> bool:
    """Look through the file system the path belongs to, local or not."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def read_first_present(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first table that exists, such as the pruned variant before the unpruned one."""
    for path in paths:
        if path_exists(spark, path):
            return read_parquet(spark, path)
    raise FileNotFoundError(f"none of these tables exists: {', '.join(paths)}")


def save_model(model: Transformer, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> Transformer:
    """Load a fitted pipeline or a bare model; the class comes from the saved metadata."""
    metadata = DefaultParamsReader.loadMetadata(path, spark)
    if metadata["class"].endswith("PipelineModel"):
        return PipelineModel.load(path)
    return DefaultParamsReader.loadParamsInstance(path, spark)


def save_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
