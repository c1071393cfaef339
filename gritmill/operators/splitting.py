"""Splits, samples and the checks that go with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.functions.columns import col, hash_long, hash_percent
from gritmill.functions.rows import rows_from
from gritmill.operators.ranking import kth_smallest
from gritmill.session import fresh_path


MAX_CLASSES = 1_000


def key_split(df: DataFrame, keys: Sequence[str], train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test by a hash of the key: rows with one key never part, in any partitioning."""
    place = hash_percent(*[col(k) for k in keys])
    return df.filter(place < train_percent), df.filter(place >= train_percent)


def written_key_split(
    df: DataFrame, keys: Sequence[str], train_percent: int = 80, label: str = "split"
) -> tuple[DataFrame, DataFrame]:
    """The same split, written in one pass over ``df``, for work that reads the parts several times."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    train = hash_percent(*[col(k) for k in keys]) < train_percent
    df.withColumn("_train", train.cast("int")).write.partitionBy("_train").parquet(path)
    schema = T.StructType([*df.schema, T.StructField("_train", T.IntegerType())])
    both = spark.read.schema(schema).parquet(path)
    return both.filter("_train = 1").drop("_train"), both.filter("_train = 0").drop("_train")


def random_split(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test


def class_sizes(df: DataFrame, label: str) -> dict[object, int]:
    """Rows per class; more than ``MAX_CLASSES`` distinct values are taken for a mistake and refused."""
    found = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return {r[label]: r["n"] for r in found}


def sample_majority(df: DataFrame, label: str, seed: int = 42) -> DataFrame:
    """Thin every larger class to about the size of the smallest, at random."""
    sizes = class_sizes(df, label)
    floor = min(sizes.values())
    return df.sampleBy(label, fractions={k: floor / n for k, n in sizes.items()}, seed=seed)


def balance_classes(df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Thin every larger class to the size of the smallest by the rank of its key hash.

    The same rows are kept in any partitioning. Rows whose hash ties with the last one kept stay too.
    """
    sizes = class_sizes(df, label)
    floor = min(sizes.values())
    place = hash_long(*[col(k) for k in keys])
    rule = F.lit(False)
    for value, n in sizes.items():
        member = col(label).eqNullSafe(F.lit(value))
        if n > floor:
            limit = kth_smallest(df.filter(member).select(place.alias("place")), "place", floor, of=n)
            member = member & (place <= F.lit(int(limit)))
        rule = rule | member
    return df.filter(rule)


def bernoulli_sample(df: DataFrame, share: float = 0.05, seed: int = 42) -> DataFrame:
    return df.sample(fraction=share, seed=seed)


def schema_parity(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row per column of either split, with what is wrong with it, if anything."""
    left = {f.name: f.dataType.simpleString() for f in train.schema}
    right = {f.name: f.dataType.simpleString() for f in test.schema}
    rows = []
    for name in sorted(left.keys() | right.keys()):
        if name not in right:
            status = "missing_in_test"
        elif name not in left:
            status = "extra_in_test"
        else:
            status = "match" if left[name] == right[name] else "type_differs"
        rows.append((name, left.get(name), right.get(name), status))
    return train.sparkSession.createDataFrame(
        rows, "column_name string, train_type string, test_type string, status string"
    )


def require_same_schema(train: DataFrame, test: DataFrame) -> None:
    wrong = [f"{r['column_name']}: {r['status']}" for r in schema_parity(train, test).filter("status <> 'match'").collect()]
    if wrong:
        raise ValueError("train and test differ: " + ", ".join(wrong))


def split_integrity(whole: DataFrame, train: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys in both splits, and rows lost or invented by the split; all three must be zero.

    Rows are compared as a multiset by a 128-bit hash of all their columns: the whole counts +1, the splits -1. Only hashes are
    shuffled, never the rows.
    """
    names = [col(k) for k in keys]
    sides = train.select(*names, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        test.select(*names, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    shared = sides.groupBy(*names).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    overlap = shared.agg(F.count_if((F.col("_a") == 1) & (F.col("_b") == 1)).alias("rows"))
    mark = F.xxhash64(*[col(c) for c in whole.columns]), F.xxhash64(F.lit(1), *[col(c) for c in reversed(whole.columns)])

    def marked(df: DataFrame, n: int) -> DataFrame:
        return df.select(mark[0].alias("_h"), mark[1].alias("_k"), F.lit(n).alias("_n"))

    signed = marked(whole, 1).unionByName(marked(train, -1)).unionByName(marked(test, -1))
    balance = signed.groupBy("_h", "_k").agg(F.sum("_n").alias("_n"))
    left = balance.agg(
        F.coalesce(F.sum(F.greatest("_n", F.lit(0))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.greatest(-F.col("_n"), F.lit(0))), F.lit(0)).alias("invented"),
    )
    return rows_from(
        overlap, [{"check": F.lit("keys_in_both_splits"), "rows": F.col("rows")}]
    ).unionByName(
        rows_from(
            left,
            [
                {"check": F.lit("rows_lost"), "rows": F.col("lost")},
                {"check": F.lit("rows_invented"), "rows": F.col("invented")},
            ],
        )
    )
