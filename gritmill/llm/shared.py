"""What the operators share: the given tables and written intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.session import fresh_path


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def with_fields(df: DataFrame, more: str) -> T.StructType:
    """The schema of ``df`` with more nullable fields."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder of ``spark.checkpoint.dir`` and read back: no lineage behind it, true sizes for the optimizer."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def drawn(key: Column, share: float) -> Column:
    """Whether a key is in a sample of about ``share`` of all keys, by 63 bits of its hash: fine enough for a few of 10^17."""
    if share >= 1:
        return F.lit(True)
    return F.shiftrightunsigned(F.xxhash64(key), 1) < F.lit(max(1, int(share * 2**63)))


def discard(df: DataFrame) -> None:
    """Remove a written table that nothing reads any more."""
    spark, at = df.sparkSession, df._written_at
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_groups(batches, key: str, most: int = 4096) -> Iterator[pa.Table]:
    """Sorted batches joined so that none cuts through a group; a piece ends with the first group that fills it."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= most:
            whole = pa.Table.from_batches(held).combine_chunks()
            keys = whole.column(key).to_numpy()
            other = np.flatnonzero(keys != keys[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield whole.slice(0, cut)
            held, rows = whole.slice(cut).to_batches(), len(keys) - cut
            most = max(most, 2 * rows)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
