from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gritmill.functions.columns import pearson
from gritmill.operators import exploring as look
from gritmill.operators import profiling as prof

NAN = float("nan")


def by_column(df, key="column_name"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_decimals_and_shorts_are_numbers(spark):
    df = spark.sql("SELECT cast(1 AS decimal(10,2)) AS d, cast(1 AS smallint) AS s, 'x' AS c, true AS b, current_date() AS t, 1 AS t_Year")
    roles = {r["column_name"]: r["role"] for r in prof.column_roles(df, ["t"]).collect()}
    assert roles == {"d": "numerical", "s": "numerical", "c": "categorical", "b": "boolean", "t": "timestamp", "t_Year": "time_derived"}


@pytest.mark.parametrize("gaps,label", [(0, "none"), (5, "low"), (6, "moderate"), (20, "moderate"), (50, "high"), (51, "critical")])
def test_missing_bands_at_their_edges(spark, gaps, label):
    df = spark.range(100).select(F.when(F.col("id") >= gaps, F.col("id").cast("double")).alias("x"))
    row = prof.missing_profile(df).first()
    assert (row["null_count"], row["severity"]) == (gaps, label)


def test_missing_counts_nan_and_empty_table(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, None)], "x double, y string")
    got = by_column(prof.missing_profile(df))
    assert got["x"]["null_count"] == 1 and got["y"]["null_pct"] == 50.0
    assert prof.missing_profile(df.limit(0)).count() == 2


def test_moments_of_a_known_sample(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, None)], "x double, same double")
    got = by_column(prof.numeric_profile(df, ["x", "same"]))
    x = got["x"]
    assert (x["mean"], x["min"], x["max"], x["q25"], x["q75"]) == (4.0, 1.0, 10.0, 1.0, 3.0)
    assert (x["skewness"], x["kurtosis"], x["std"]) == (1.0182, -0.7696, round(float(np.std([1, 2, 3, 10], ddof=1)), 4))
    assert (x["distribution"], x["imputation"], x["outlier_count"]) == ("high_skew", "not needed", 1)
    same = got["same"]
    assert (same["std"], same["skewness"], same["kurtosis"], same["outlier_count"]) == (0.0, 0.0, 0.0, 0)
    assert (same["distribution"], same["imputation"]) == ("normal", "mean")


def test_moments_of_large_offsets(spark):
    rng = np.random.default_rng(1)
    x = 1e9 + rng.gamma(2.0, size=4000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(4)
    row = prof.numeric_profile(df, ["x"]).first()
    c = x - x.mean()
    assert math.isclose(row["skewness"], (c**3).mean() / (c**2).mean() ** 1.5, abs_tol=2e-4)
    assert math.isclose(row["kurtosis"], (c**4).mean() / (c**2).mean() ** 2 - 3, abs_tol=2e-4)


def test_categories_with_null_as_a_value(spark):
    df = spark.createDataFrame([("a", "k", "1")] * 97 + [("B", "k", "2"), ("b", "k", "3"), (None, "k", "4")], "x string, k string, i string")
    counts = prof.category_counts(df, ["x", "k"])
    got = by_column(prof.category_profile(counts))
    assert got["x"]["distinct_count"] == 4 and got["x"]["near_zero_variance"] and got["k"]["zero_variance"]
    assert [(r["label"], r["spellings"]) for r in prof.case_variants(counts).collect()] == [("b", 2)]
    rare = [(r["value"], r["place"]) for r in prof.frequent_values(counts, 2, rarest=True).filter("column_name = 'x'").collect()]
    assert sorted(rare, key=lambda r: r[1]) == [(None, 1), ("B", 2)]


def test_identifier(spark):
    df = spark.range(10).select("id", F.lit(1).alias("one"), (F.col("id") % 3).alias("mod"))
    got = {r["column_name"]: r["recommendation"].split(":")[0] for r in prof.variance_profile(df).collect()}
    assert got == {"id": "drop", "one": "drop", "mod": "keep"}
    assert by_column(prof.variance_profile(df))["id"]["likely_identifier"]


def test_tokens_skip_stop_words_and_numbers(spark):
    df = spark.createDataFrame([("Main St N / I-95",), ("main st, the 95",), (None,)], "s string")
    got = {r["token"]: r["n"] for r in prof.frequent_tokens(df, "s").collect()}
    assert got == {"main": 2, "st": 2, "i": 1}


def test_sparse_years(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 5, F.lit("2019-05-05")).otherwise(F.lit("2020-06-06")).cast("timestamp_ntz").alias("t")
    )
    row = prof.timestamp_profile(df, ["t"]).first()
    assert (row["years"], row["sparse_years"], row["consistency"]) == (2, "2019", "inconsistent")


@pytest.mark.parametrize("small,label,fine", [(100, "balanced", "balanced"), (50, "balanced", "mild_imbalance"), (25, "moderate_imbalance", "moderate_imbalance"), (9, "severe_imbalance", "severe_imbalance")])
def test_imbalance_bands(spark, small, label, fine):
    df = spark.range(100 + small).select((F.col("id") >= 100).cast("int").alias("y"))
    assert prof.target_profile(df, "y").first()["imbalance"] == label
    assert prof.target_profile(df, "y", fine=True).first()["imbalance"] == fine


def test_pairwise_correlation_with_gaps_and_constants(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(1e6, 1.0, 500)
    y = x * 2 + rng.normal(size=500)
    rows = [(float(a), float(b) if i % 3 else None, 0.1, NAN if i % 2 else float(a)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, same double, half double").repartition(5)
    got = {(r["col1"], r["col2"]): (r["correlation"], r["band"]) for r in prof.correlation_pairs(df, ["x", "y", "same", "half"]).collect()}
    keep = np.arange(500) % 3 > 0
    assert math.isclose(got["x", "y"][0], np.corrcoef(x[keep], y[keep])[0, 1], abs_tol=1e-4)
    assert got["x", "half"] == (1.0, "near_duplicate")
    assert got["x", "same"] == (None, "none") and len(got) == 6


def test_constant_columns_do_not_raise(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    assert df.agg(pearson(F.col("a"), F.col("b")).alias("r")).first()["r"] is None
    assert look.correlation_of(df, "b", "b").first()["correlation"] == 1.0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,), (None,)], "x double")
    got = {r["bin"]: r["n"] for r in look.histogram(df, "x", 10).collect()}
    assert got == {**dict.fromkeys(range(10), 0), 0: 1, 1: 1, 9: 2}
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert {r["bin"]: r["n"] for r in look.histogram(same, "x", 2).collect()} == {0: 2, 1: 0}


def test_shares_sum_to_one(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("y"), (F.col("id") % 7).alias("v"))
    got = look.share_within(df, "y", "v", 9).groupBy("y").agg(F.sum("pct").alias("s")).collect()
    assert all(math.isclose(r["s"], 1.0, abs_tol=1e-6) for r in got)


def test_rate_needs_more_than_ten_rows(spark):
    df = spark.createDataFrame([(1.2, 1)] * 11 + [(2.0, 1)] * 10, "x double, y int")
    assert [(r["bucket"], r["rate"]) for r in look.rate_by_rounded(df, "x", "y").collect()] == [(1.0, 1.0)]


def test_matrix_is_symmetric_and_ranked(spark):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("x"), (F.col("id") > 50).alias("f"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"),
        (F.col("id") > 70).cast("int").alias("y"),
    )
    matrix = look.correlation_matrix(df, ["x", "y"], ["f"], ["c"])
    cells = {(r["a"], r["b"]): r["r"] for r in matrix.collect()}
    assert len(cells) == 16 and all(cells[a, b] == cells[b, a] for a, b in cells) and cells["x", "x"] == 1.0
    assert [r["feature"] for r in look.ranked_by_correlation(matrix, "y").collect()][0] == "x"


def test_profile_table_covers_all_sections(spark):
    df = spark.range(200).select(
        F.col("id").cast("double").alias("x"), (F.col("id") % 9).alias("z"), F.lit("2020-01-01").cast("timestamp_ntz").alias("t"),
        (F.col("id") % 3).cast("string").alias("c"), (F.col("id") % 5 == 0).cast("int").alias("y"),
    )
    sections = {r["section"] for r in prof.profile_table(df, "y", ["t"]).select("section").distinct().collect()}
    assert sections == {"structure", "missing", "target", "numeric", "correlation", "category", "timestamp"}
