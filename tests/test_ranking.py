from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gritmill.operators import ranking, splitting


def nearest(sorted_values, p):
    return sorted_values[max(1, math.ceil(len(sorted_values) * p)) - 1]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [(), ("g",)])
def test_ranged_running_totals_equal_brute_force(spark, descending, by):
    seen = random.Random(3)
    rows = [(g, float(v), seen.randint(1, 9)) for g in ("a", "b", None) for v in seen.sample(range(1000), 300)]
    if not by:
        rows = [(None, float(v), seen.randint(1, 9)) for v in seen.sample(range(1000), 700)]
    df = spark.createDataFrame(rows, "g string, v double, n int").repartition(4)
    for size in (50, 10_000):
        got = ranking.running_totals(df, "v", ["n"], by, descending, rows_per_range=size).collect()
        assert len(got) == len(rows)
        for r in got:
            upto = [n for g, v, n in rows if g == r["g"] and (v >= r["v"] if descending else v <= r["v"])]
            assert r["n_run"] == sum(upto)
            assert r["n_all"] == sum(n for g, _, n in rows if g == r["g"])


@pytest.mark.parametrize("size", [1, 2, 5, 5_000])
def test_quantiles_against_numpy(spark, size):
    rng = np.random.default_rng(size)
    x = np.round(rng.lognormal(size=size), 3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(3)
    ps = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = ranking.quantiles(df, ["x"], ps).first()
    assert [got[f"q{i}"] for i in range(5)] == [nearest(sorted(x), p) for p in ps]
    got = ranking.quantiles(df, ["x"], ps, interpolate=True).first()
    assert np.allclose([got[f"q{i}"] for i in range(5)], np.quantile(x, ps))


def test_quantiles_with_one_dominant_value_and_gaps(spark):
    rows = [(1.0,)] * 4000 + [(float(i),) for i in range(2, 2002)] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double").repartition(6)
    got = ranking.quantiles(df, ["x"], [0.25, 0.5, 0.9]).first()
    want = sorted(v for (v,) in rows if v is not None and v == v)
    assert [got["q0"], got["q1"], got["q2"]] == [nearest(want, p) for p in (0.25, 0.5, 0.9)]


def test_rank_outside_its_bracket_is_still_found(spark):
    """Ranks that no bracket covers go through the full counts."""
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    size, found = ranking.values_at_ranks(df, ["x"], [0.5], lambda n: [1, 5_000, 9_000])["x"]
    assert size == 10_000 and found == {1: 0.0, 5_000: 4_999.0, 9_000: 8_999.0}


def test_column_without_values_has_no_quantiles(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    assert [r["measure"] for r in ranking.quantiles(df, ["x", "y"], [0.5]).collect()] == ["y"]


@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.floats(0, 1))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_quantile_property(spark, numbers, p):
    df = spark.createDataFrame([(float(n),) for n in numbers], "x double")
    assert ranking.quantiles(df, ["x"], [p]).first()["q0"] == nearest(sorted(map(float, numbers)), p)


def test_kth_smallest(spark):
    df = spark.range(1, 5001).select((F.col("id") * 7919 % 5003).alias("x"))
    want = sorted(i * 7919 % 5003 for i in range(1, 5001))
    for k in (1, 1234, 5000):
        assert ranking.kth_smallest(df, "x", k, of=5000) == want[k - 1]


# --- splits --------------------------------------------------------------------------------------


def test_split_is_stable_and_complete(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("k"), "id")
    train, test = splitting.key_split(df, ["k"])
    again, _ = splitting.key_split(df.repartition(17), ["k"])
    assert sorted(r["id"] for r in train.collect()) == sorted(r["id"] for r in again.collect())
    assert {r["check"]: r["rows"] for r in splitting.split_integrity(df, train, test, ["k"]).collect()} == {
        "keys_in_both_splits": 0,
        "rows_lost": 0,
        "rows_invented": 0,
    }
    assert 0.75 < train.count() / 5000 < 0.85
    for lazy, written in zip((train, test), splitting.written_key_split(df, ["k"]), strict=True):
        assert lazy.columns == written.columns and lazy.exceptAll(written).count() == written.exceptAll(lazy).count() == 0
    alone, none = splitting.written_key_split(df, ["k"], train_percent=100)
    assert (alone.count(), none.count()) == (5000, 0)


def test_balancing_is_exact_and_stable(spark):
    df = spark.range(3000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    one = splitting.balance_classes(df, "y", ["id"])
    two = splitting.balance_classes(df.repartition(9), "y", ["id"])
    assert splitting.class_sizes(one, "y") == {0: 300, 1: 300}
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_random_balancing_is_close(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    sizes = splitting.class_sizes(splitting.sample_majority(df, "y"), "y")
    assert sizes[1] == 5000 and abs(sizes[0] - 5000) < 300


def test_schema_difference_is_an_error(spark):
    a, b = spark.range(1), spark.range(1).selectExpr("cast(id as int) as id", "1 as extra")
    splitting.require_same_schema(a, a)
    with pytest.raises(ValueError, match="extra: extra_in_test, id: type_differs"):
        splitting.require_same_schema(a, b)


@pytest.mark.parametrize("size", [2_000_000, 25])
@pytest.mark.parametrize("descending", [False, True])
def test_null_and_nan_come_where_spark_sorts_them_at_any_range_size(spark, size, descending):
    values = [float(i % 70) for i in range(200)] + [float("nan"), None, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v, 1) for v in values], "v double, n int").groupBy("v").agg(F.sum("n").alias("n"))
    run = ranking.running_totals(df, "v", ["n"], descending=descending, rows_per_range=size)
    found = {repr(r["v"]): r["n_run"] for r in run.collect()}
    first, last = ("None", "nan") if not descending else ("nan", "None")
    assert found[first] == 1 and found[last] == len(values) and len(found) == 74
    assert found["inf"] == (len(values) - 1 if not descending else 2)


def test_ranges_follow_the_cuts(spark):
    cuts = [float(x) for x in range(0, 100, 7)]
    df = spark.createDataFrame([(float(x),) for x in range(-5, 120)] + [(None,), (float("nan"),)], "v double")
    for r in df.select("v", ranking.range_of(F.col("v"), cuts).alias("r")).collect():
        want = 0 if r["v"] is None else len(cuts) if r["v"] != r["v"] else sum(c < r["v"] for c in cuts)
        assert r["r"] == want
