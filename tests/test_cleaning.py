from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from gritmill.operators import cleaning as clean
from gritmill.operators import imputing, joining
from gritmill.session import materialise

NAN = float("nan")


def values(df, name):
    return [r[name] for r in df.collect()]


def test_bad_timestamp_is_null(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05",), ("bad",), (None,)], "t string")
    got = clean.parse_times(df, ["t"]).select(F.date_format("t", "HH:mm:ss").alias("t"))
    assert values(got, "t") == ["03:04:05", None, None]


def test_calendar_numbers_sunday_as_one(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-07 08:00:00' AS t UNION ALL SELECT timestamp_ntz'2024-01-08 20:00:00'")
    got = {r["t_Day_of_Week"]: r["t_is_Weekend"] for r in clean.add_calendar(df, "t").collect()}
    assert got == {1: 1, 2: 0}


def test_durations(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS a, timestamp_ntz'2024-01-01 01:30:00' AS b")
    row = clean.add_durations(df, "a", "b").first()
    assert (row["Duration_Seconds"], row["Duration_Minutes"], row["Duration_Hours"]) == (5400, 90.0, 1.5)


def test_upper_bound_drops_rows_without_a_value(spark):
    df = spark.createDataFrame([(1.0,), (20.0,), (None,)], "x double")
    assert values(clean.keep_below(df, "x", 20), "x") == [1.0]


def test_range_is_open_below_and_closed_above(spark):
    df = spark.createDataFrame([(5.0,), (5.1,), (9.0,), (9.1,)], "x double")
    assert values(clean.keep_within(df, F.col("x"), 5, 9), "x") == [5.1, 9.0]


def test_gaps_count_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,)], "x double")
    assert clean.drop_missing(df, ["x"]).count() == 1
    assert values(clean.coalesce_known(df, "x", F.lit(7.0)), "x") == [1.0, 7.0, 7.0]


def test_canonical_spelling_keeps_unknown_and_null(spark):
    df = spark.createDataFrame([("Calm",), ("NNE",), ("SW",), (None,)], "w string")
    got = clean.canonicalise(df, "w", {"CALM": ["Calm"], "N": ["North", "NNE", "NNW"]})
    assert values(got, "w") == ["CALM", "N", "SW", None]


def test_target_flag_and_missing(spark):
    df = spark.createDataFrame([(3,), (2,), (None,)], "s int")
    assert values(clean.binarise(df, "s", 3, "y"), "y") == [1, 0, None]
    assert values(clean.binarise(df, "s", 3, "y", missing_is_zero=True), "y") == [1, 0, 0]


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,)], "x double")
    assert values(clean.round_to(df, "x", 0, "r"), "r") == [3.0, -3.0]


def test_accounting_treats_unknown_as_dropped(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (5.0, None)], "a double, b double")
    rows = clean.step_accounting(df, [("a", F.col("a") > 0), ("b", F.col("b") > 0)]).collect()
    assert [(r["rows_in"], r["rows_out"], r["dropped"]) for r in rows] == [(3, 2, 1), (2, 1, 1)]


def test_names_with_dots_and_brackets(spark):
    df = spark.createDataFrame([(1.5, True), (None, None)], "`a.b(mi)` double, `f.g` boolean")
    filled = clean.coalesce_known(df, "a.b(mi)", F.lit(0.0))
    assert [r[0] for r in filled.collect()] == [1.5, 0.0]
    assert [r[1] for r in clean.flags_to_int(df).collect()] == [1, None]


def test_first_per_key_does_not_depend_on_partitioning(spark):
    rows = [(k % 7, (k * 37) % 101, f"v{k}") for k in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    want = {}
    for k, t, v in rows:
        want[k] = min(want.get(k, (t, v)), (t, v))
    for parts in (1, 13):
        got = clean.first_per_key(df.repartition(parts), ["k"], ["t"]).collect()
        assert {r["k"]: (r["t"], r["v"]) for r in got} == want


def test_copies_collapse_and_null_keys_count(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "id int, x string")
    assert clean.drop_copies(df.withColumn("n", F.monotonically_increasing_id()), ["n"]).count() == 2
    assert clean.copy_count(df, ["x"]).first()["surplus_rows"] == 1


# --- lookup joins and medians --------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds more than a third of the rows; some keys are null; some have no entry."""
    keys = [1] * 400 + [k % 50 + 2 for k in range(500)] + [None] * 100
    rows = [(k, i, float(i % 97)) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "k int, i int, x double").repartition(5)


def test_salted_join_equals_broadcast_join(spark, skewed):
    table = materialise(
        skewed.filter("k is not null and k <> 7").groupBy("k").agg(F.count("*").alias("n"), F.avg("x").alias("m")), "t"
    )
    small = joining.lookup_join(skewed, table, ["k"], group_rows="n")
    large = joining.lookup_join(skewed, table, ["k"], group_rows="n", broadcast_rows=0, rows_per_task=50)
    plain = joining.lookup_join(skewed, table.drop("n"), ["k"], broadcast_rows=0)
    assert sorted(large.columns) == sorted(small.columns)
    want = sorted(map(str, small.select("i", "k", "m").collect()))
    assert len(want) == 1000
    assert sorted(map(str, large.select("i", "k", "m").collect())) == want
    assert sorted(map(str, plain.select("i", "k", "m").collect())) == want


def test_heavy_median_equals_median(spark, skewed):
    gappy = skewed.withColumn("x", F.when(F.col("i") % 5 == 0, F.lit(NAN)).when(F.col("i") % 7 == 0, None).otherwise(F.col("x")))
    light = imputing.group_medians(gappy, ["k"], ["x"])
    heavy = imputing.group_medians(gappy, ["k"], ["x"], max_values=0, rows_per_range=100)
    assert sorted(map(str, light.collect())) == sorted(map(str, heavy.collect()))


def test_imputation_uses_train_only_and_drops_hopeless_rows(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None)], "g string, x double")
    test = spark.createDataFrame([("a", None), ("a", 100.0), ("b", None), ("c", NAN)], "g string, x double")
    medians = imputing.fit_group_medians(train, ["g"], ["x"])
    assert sorted(values(imputing.fill_from_medians(train, medians, ["g"], ["x"]), "x")) == [1.0, 2.0, 3.0]
    assert sorted(values(imputing.fill_from_medians(test, medians, ["g"], ["x"]), "x")) == [2.0, 100.0]
    kept = imputing.fill_from_medians(test, medians, ["g"], ["x"], drop_unfilled=False)
    assert kept.count() == 4 and kept.filter("x is null").count() == 2


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert sorted(values(joining.keep_most_frequent(df, "v", 3), "v")) == ["a", "c", "c"]


def test_group_total_matches_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "g string, n int")
    got = joining.with_group_total(df, ["g"], "n", "t").collect()
    assert sorted((r["g"] or "", r["n"], r["t"]) for r in got) == [("", 5, 5), ("a", 1, 3), ("a", 2, 3)]


def test_median_of_mixed_gaps(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (NAN,), (None,)], "x double")
    got = imputing.group_medians(df.withColumn("g", F.lit(1)), ["g"], ["x"]).first()["x_median"]
    assert math.isclose(got, 2.5)


def test_rare_copies_are_reduced_like_all(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, i % 400]), f"k{i % 3}", rng.randrange(3), rng.choice([None, 1.5, float("nan")])) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, t int, v double").repartition(5)
    wanted = sorted(map(repr, clean.first_per_key(df, ["a", "b"], ["t"]).collect()))
    for few in (10_000, 3):
        assert sorted(map(repr, clean.first_of_rare_copies(df, ["a", "b"], ["t"], few).collect())) == wanted
    alone = clean.first_of_rare_copies(df.filter("a is not null").dropDuplicates(["a", "b"]), ["a", "b"], ["t"])
    assert alone.count() == df.filter("a is not null").select("a", "b").distinct().count()
    assert clean.first_of_rare_copies(df.limit(0), ["a", "b"], ["t"]).count() == 0
