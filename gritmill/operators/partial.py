"""Profiles that merge: what is known of a table's parts is stored, and the profile of the whole comes from that, not from the rows.

A state is a row for each part (a day, a month, a load) and column: counts, extremes, central moments, a quantile sketch and a distinct sketch. New parts add their
states, a part that is loaded again replaces its own, and no other part is read. Counts, extremes and moments of the merged profile are those of
the whole table; quartiles and distinct counts have the error of their sketches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.functions.columns import known_double
from gritmill.operators.ranking import SKETCH_SIZE

#: Rows of state that one part and column has at most; tasks of a part are merged among so many groups, not all in one task.
GROUPS = 16
STATE = """part string, column_name string, row_count long, known long, low double, high double, mean double, m2 double, m3 double, m4 double,
    quantile_sketch binary, distinct_sketch binary"""


def profile_states(df: DataFrame, columns: Sequence[str], part: Column) -> DataFrame:
    """States of every part of ``df`` in one pass: null parts are one part, named ``null``."""
    values = {f"x{i}": known_double(df, c) for i, c in enumerate(columns)}
    spread = F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("_group")
    plain = df.select(F.coalesce(part.cast("string"), F.lit("null")).alias("part"), spread, *[v.alias(x) for x, v in values.items()])
    wanted = {
        "known": lambda x: F.count(x),
        "low": lambda x: F.min(x),
        "high": lambda x: F.max(x),
        "mean": lambda x: F.avg(x),
        "variance": lambda x: F.var_pop(x),
        "skewness": lambda x: F.skewness(x),
        "kurtosis": lambda x: F.kurtosis(x),
        "quantile_sketch": lambda x: F.kll_sketch_agg_double(x, F.lit(SKETCH_SIZE)),
        "distinct_sketch": lambda x: F.hll_sketch_agg(F.col(x).cast("string")),
    }
    wide = plain.groupBy("part", "_group").agg(F.count(F.lit(1)).alias("row_count"), *[f(x).alias(f"{n}_{x}") for x in values for n, f in wanted.items()])
    rows = []
    for x, c in zip(values, columns, strict=True):
        n, variance = F.col(f"known_{x}").cast("double"), F.col(f"variance_{x}")
        spread_out = variance > 0
        m3 = F.when(spread_out, F.col(f"skewness_{x}") * n * F.pow(variance, F.lit(1.5))).otherwise(F.lit(0.0))
        m4 = F.when(spread_out, (F.col(f"kurtosis_{x}") + 3) * n * variance * variance).otherwise(F.lit(0.0))
        same = ("known", "low", "high", "mean", "quantile_sketch", "distinct_sketch")
        named = {k: F.col(f"{k}_{x}") for k in same} | {"column_name": F.lit(c), "row_count": F.col("row_count"), "m2": variance * n, "m3": m3, "m4": m4}
        rows.append(F.struct(*[v.alias(k) for k, v in named.items()]))
    return wide.select("part", F.inline(F.array(*rows))).select(*T.StructType.fromDDL(STATE).names)


def store_states(states: DataFrame, path: str) -> None:
    """Add the states of their parts to those at ``path``; a part that is there already is replaced, others stay."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def stored_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType.fromDDL(STATE)).parquet(path)


def merged_states(states: DataFrame) -> DataFrame:
    """One state a column, of part ``null``: central moments move to the common mean, sketches are united."""
    n = F.col("known").cast("double")
    whole = states.groupBy("column_name").agg(F.try_divide(F.sum(n * F.coalesce("mean", F.lit(0.0))), F.sum(n)).alias("centre"))
    moved = states.join(F.broadcast(whole), "column_name")  # a row a column
    d = F.coalesce(F.col("mean") - F.col("centre"), F.lit(0.0))
    m2, m3, m4 = (F.coalesce(m, F.lit(0.0)) for m in ("m2", "m3", "m4"))
    return moved.groupBy("column_name").agg(
        F.lit("null").alias("part"),
        F.sum("row_count").alias("row_count"),
        F.sum("known").alias("known"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.max("centre").alias("mean"),
        F.sum(m2 + n * d * d).alias("m2"),
        F.sum(m3 + 3 * d * m2 + n * F.pow(d, F.lit(3))).alias("m3"),
        F.sum(m4 + 4 * d * m3 + 6 * d * d * m2 + n * F.pow(d, F.lit(4))).alias("m4"),
        F.kll_merge_agg_double("quantile_sketch", F.lit(SKETCH_SIZE)).alias("quantile_sketch"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
    ).select(*T.StructType.fromDDL(STATE).names)


def merged_profile(states: DataFrame, probabilities: Sequence[float] = (0.25, 0.75), digits: int = 4) -> DataFrame:
    """Counts, gaps, moments, extremes, quantiles ``q0, q1, ...`` and distinct count per column, from states alone."""
    n = F.col("known").cast("double")
    variance = F.try_divide("m2", n)
    quantiles = F.when(F.col("known") > 0, F.kll_sketch_get_quantile_double("quantile_sketch", F.array(*[F.lit(float(p)) for p in probabilities])))
    rounded = {
        "mean": F.col("mean"),
        "std": F.sqrt(F.try_divide("m2", n - 1)),
        "skewness": F.try_divide(F.try_divide("m3", n), F.pow(variance, F.lit(1.5))),
        "kurtosis": F.try_divide(F.try_divide("m4", n), variance * variance) - 3,
        "min": F.col("low"),
        "max": F.col("high"),
    }
    return merged_states(states).select(
        "column_name",
        "row_count",
        (F.col("row_count") - F.col("known")).alias("null_count"),
        *[F.round(v, digits).alias(k) for k, v in rounded.items()],
        *[F.get(quantiles, F.lit(i)).alias(f"q{i}") for i in range(len(probabilities))],
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_about"),
    )


def union_of(states: Sequence[DataFrame]) -> DataFrame:
    """States of several tables as one, such as those of two halves."""
    return reduce(DataFrame.unionByName, states)
