"""Counters of bounded size, places in a whole order, short curves, leaks and text types, against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.operators import encoding as encode
from gritmill.operators import evaluating as evaluate
from gritmill.operators import heavy, imputing, leaking, partial
from gritmill.operators import profiling as prof
from gritmill.operators.ranking import numbered
from gritmill.session import fresh_path
from gritmill.sources import tables, text_types


def ranked(df):
    return sorted(map(tuple, df.select("column_name", "place", "value", "n").collect()), key=repr)


def skewed(spark, n=6000):
    rng = random.Random(1)
    rows = [(rng.choice("abcde") if rng.random() < 0.6 else f"v{rng.randrange(900)}", str(i), None if rng.random() < 0.3 else f"{rng.randrange(3)}", "") for i in range(n)]
    return spark.createDataFrame(rows, "mixed string, ident string, gaps string, blank string").repartition(6)


@pytest.mark.parametrize("tracked", [8, 60, 1024])
def test_heavy_values_are_those_of_full_counts(spark, tracked):
    df = skewed(spark)
    wanted = prof.frequent_values(prof.category_counts(df, df.columns), 5)
    assert ranked(heavy.heavy_values(heavy.long_values(df, df.columns), 5, tracked)) == ranked(wanted)


def test_few_columns_go_through_full_counts(spark):
    df = skewed(spark)
    long = heavy.long_values(df, ["mixed", "gaps"])
    plan = heavy.heavy_values(long, 3, 60)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "Union" not in plan  # both are decided by their counters
    plan = heavy.heavy_values(heavy.long_values(df, ["ident"]), 3, 60)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan


def test_counters_never_lie_above_nor_further_below_than_they_say():
    rng = random.Random(4)
    held, truth = heavy.Counters(10), Counter()
    for _ in range(300):
        some = Counter(rng.choice("abc") if rng.random() < 0.5 else f"x{rng.randrange(500)}" for _ in range(20))
        truth += some
        held.add(list(some), list(some.values()))
    held.cut()
    assert len(held.counts) <= 10 and held.lost > 0 and {"a", "b", "c"} <= set(held.counts)
    assert all(n <= truth[v] <= n + held.lost for v, n in held.counts.items()) and all(n <= held.lost for v, n in truth.items() if v not in held.counts)


def test_heavy_values_of_nothing(spark):
    empty = spark.createDataFrame([], "column_name string, value string")
    assert heavy.heavy_values(empty).collect() == []
    assert ranked(heavy.heavy_values(spark.createDataFrame([("c", None)] * 3 + [("c", "")], "column_name string, value string"))) == [("c", 1, None, 3), ("c", 2, "", 1)]


def test_heavy_tokens_are_the_frequent_ones(spark):
    rng = random.Random(2)
    rows = [(" ".join(rng.choice(["road", "the", "ramp,", "12", "x" + str(rng.randrange(400))]) for _ in range(9)),) for _ in range(400)] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "t string").repartition(4)
    assert heavy.heavy_tokens(df, "t", tracked=30).collect() == prof.frequent_tokens(df, "t").collect()


def test_places_in_the_whole_order(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(20), f"k{i}") for i in range(1000)]
    found = numbered(spark.createDataFrame(rows, "n int, k string").repartition(7), [F.desc("n"), F.col("k").asc()], "place").collect()
    wanted = {k: i for i, (_, k) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}
    assert {r["k"]: r["place"] for r in found} == wanted
    assert numbered(spark.createDataFrame([], "n int"), [F.desc("n")], "place").collect() == []


def test_label_tables_index_like_the_indexer(spark):
    rng = random.Random(5)
    train = spark.createDataFrame([(rng.choice(["a", "b", "c", "d e", "Z", "é", None]),) for _ in range(300)], "v string")
    labels = encode.label_table(train, "v")
    rows = train.union(spark.createDataFrame([("new",), (None,)], "v string"))
    own = encode.indexer(["v"]).fit(train.dropna()).transform(rows)
    assert sorted(encode.index_labels(rows, "v", labels).collect(), key=repr) == sorted(own.select("v", "v_idx").collect(), key=repr)


def test_short_curves_state_their_error(spark):
    rng = np.random.default_rng(1)
    n = 200_000
    y = rng.integers(0, 2, n)
    s = rng.normal(size=n) + y
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    scores = evaluate.by_score(df, "y", F.col("s"))
    exact = evaluate.areas(scores).first()["auc_roc"]
    for points in (20, 1000):
        thin = evaluate.thinned_curve(scores, points, rows_per_range=50_000)
        assert points / 3 <= thin.count() <= points
        found = evaluate.thinned_area(thin).first()
        assert abs(found["auc_roc"] - exact) <= found["largest_error"] + 1e-6 and found["largest_error"] <= 2 / points
        last = thin.orderBy(F.desc("tp"), F.desc("fp")).first()
        assert last["tp"] + last["fp"] == n
    one = evaluate.by_score(df.withColumn("s", F.lit(1.0)), "y", F.col("s"))
    assert evaluate.thinned_area(evaluate.thinned_curve(one)).first()["auc_roc"] == 0.5
    only = evaluate.by_score(df.filter("y = 1").limit(5), "y", F.col("s"))
    assert evaluate.thinned_curve(only).count() == 5 and evaluate.thinned_area(evaluate.thinned_curve(only)).first()["auc_roc"] is None


def test_a_copy_of_the_target_is_named(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(3000):
        y = int(rng.random() < 0.3)
        rows.append((y, float(y) * 3 + rng.random(), -float(y), float(rng.normal()), float(rng.normal() + y), None if i % 5 else float(y), None, 1.0, float("nan") if i % 2 else float(y)))
    names = ["copy", "mirror", "noise", "useful", "rare", "empty", "same", "nans"]
    df = spark.createDataFrame(rows, "y int, " + ", ".join(f"{n} double" for n in names))
    bounds = {r["feature"]: r for r in leaking.area_intervals(df, names, "y", 32).collect()}
    exact = {r["feature"]: r["auc"] for r in leaking.exact_areas(df, names, "y").collect()}
    assert set(exact) == set(names) - {"empty"}
    for f, auc in exact.items():
        pos = np.array([r[1 + names.index(f)] for r in rows if r[0] == 1 and r[1 + names.index(f)] is not None], float)
        neg = np.array([r[1 + names.index(f)] for r in rows if r[0] == 0 and r[1 + names.index(f)] is not None], float)
        pos, neg = pos[~np.isnan(pos)], neg[~np.isnan(neg)]
        brute = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
        assert auc == pytest.approx(brute, abs=1e-6) and bounds[f]["low"] - 1e-9 <= auc <= bounds[f]["high"] + 1e-9
    assert bounds["noise"]["high"] - bounds["noise"]["low"] < 0.1
    assert {r["feature"] for r in leaking.leaking_features(df, names, "y", bins=32).collect()} == {"copy", "mirror", "rare", "nans"}
    assert leaking.leaking_features(df, ["noise"], "y").collect() == []


def test_types_are_those_of_sparks_own_scan(spark):
    columns = {
        "i": ["1", "-2", "+3", None, "2147483647"], "l": ["1", "2147483648", None, "-9223372036854775808", "7"], "big": ["9223372036854775808", "1", "2", None, "3"],
        "f": ["1", "2.5", "-.5", "1e3", None], "nan": ["NaN", "1", "2", "3", None], "d": ["2020-01-01", None, "2021-12-31", "1999-02-28", "2000-02-29"],
        "t": ["2020-01-01 10:00:00", "2020-01-01T10:00:00.123", None, "2021-01-01 00:00:00", "1999-01-01 00:00:00"], "b": ["true", "FALSE", None, "True", "false"],
        "s": ["x", "1", "2.5", None, "true"], "late": ["1", "2", "3", "4", "five"], "none": [None] * 5, "bad_day": ["2020-02-30", "2020-01-01", None, None, None],
        "zero": ["007", "0", "00", None, "1"], "space": ["a b", " ", None, "c", "d"],
    }
    texts = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} string" for c in columns))
    path = fresh_path(spark, "csv")
    texts.coalesce(1).write.option("header", True).csv(path)
    own = {f.name: f.dataType.simpleString() for f in tables.read_csv(spark, path).schema}
    found = {f.name: f.dataType.simpleString() for f in text_types.infer_csv(spark, path)}
    assert found == own and found["late"] == "string" and found["l"] == "bigint"
    assert {f.dataType for f in text_types.inferred_types(texts.limit(0))} == {T.StringType()}


def test_lines_that_do_not_fit_are_kept(spark):
    lines = ["a,b,c", "1,x,2.5", "two,x,2.5", "3,x", "4,x,1,9", "5,,", ",y,1", '6,"q, r",0.5', "7,x,1.5e"]
    path = fresh_path(spark, "lines")
    spark.createDataFrame([(v,) for v in lines], "v string").coalesce(1).write.text(path)
    good, bad = text_types.read_with_rejects(spark, path, T.StructType.fromDDL("a int, b string, c double"))
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([(1, "x", 2.5), (5, None, None), (None, "y", 1.0), (6, "q, r", 0.5)], key=repr)
    assert sorted(r["line"] for r in bad.collect()) == sorted(["two,x,2.5", "3,x", "4,x,1,9", "7,x,1.5e"])


def test_merged_profiles_are_those_of_the_whole(spark):
    rng = np.random.default_rng(6)
    rows = [(None if i % 97 == 0 else int(i % 5), float(rng.normal() * 3 + 1e6), None if i % 3 == 0 else float(rng.exponential()), 7.0, None) for i in range(4000)]
    names = ["wide", "gaps", "same", "empty"]
    df = spark.createDataFrame(rows, "p int, " + ", ".join(f"{n} double" for n in names)).repartition(5)
    whole = partial.profile_states(df, names, F.lit("all"))
    parts = partial.profile_states(df, names, F.col("p"))
    assert {r["part"] for r in parts.select("part").collect()} == {"0", "1", "2", "3", "4", "null"}
    a, b = ({r["column_name"]: r.asDict() for r in partial.merged_profile(s).collect()} for s in (whole, parts))
    for name in names:
        values = np.array([r[1 + names.index(name)] for r in rows if r[1 + names.index(name)] is not None])
        for found in (a[name], b[name]):
            assert (found["row_count"], found["null_count"]) == (4000, 4000 - len(values))
            if len(values):
                assert found["mean"] == pytest.approx(values.mean(), abs=1e-3) and (found["min"], found["max"]) == (round(values.min(), 4), round(values.max(), 4))
                assert found["std"] == pytest.approx(values.std(ddof=1), abs=1e-3) and abs(found["distinct_about"] - len(set(values))) <= 0.1 * len(set(values))
                for q, p in (("q0", 0.25), ("q1", 0.75)):
                    low, high = ((values < found[q]).mean(), (values <= found[q]).mean())
                    assert low - 0.01 <= p <= high + 0.01
            else:
                assert found["mean"] is None and found["q0"] is None
        for moment in ("std", "skewness", "kurtosis"):
            assert a[name][moment] == pytest.approx(b[name][moment], abs=1e-3) if a[name][moment] is not None else b[name][moment] is None
    z = np.array([r[2] for r in rows if r[2] is not None])
    c = z - z.mean()
    assert b["gaps"]["skewness"] == pytest.approx((c**3).mean() / (c**2).mean() ** 1.5, abs=1e-3) and b["gaps"]["kurtosis"] == pytest.approx((c**4).mean() / (c**2).mean() ** 2 - 3, abs=1e-3)


def test_a_part_that_is_stored_again_replaces_itself(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 5.0)], "p int, v double")
    path = fresh_path(spark, "states")
    for rows in (df, df.filter("p = 1").limit(1), spark.createDataFrame([(3, 9.0)], "p int, v double")):
        partial.store_states(partial.profile_states(rows, ["v"], F.col("p")), path)
    (r,) = partial.merged_profile(partial.stored_states(spark, path)).collect()
    assert (r["row_count"], r["min"], r["max"]) == (3, 1.0, 9.0)
    assert partial.merged_profile(partial.profile_states(df.limit(0), ["v"], F.col("p"))).collect() == []


def test_buckets_need_no_further_shuffle_and_give_the_same_rows(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", "c", None, f"g{i % 40}"]), i % 3, i, None if rng.random() < 0.3 else rng.random() * 9, float("nan") if rng.random() < 0.2 else float(i % 7)) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, `m(x)` int, i int, u double, v double")
    train, test = df.filter("i % 5 > 0"), df.filter("i % 5 = 0")
    keys, measures = ["g", "m(x)"], ["u", "v"]
    medians = imputing.fit_group_medians(train, keys, measures)
    wanted = [sorted(map(tuple, imputing.fill_from_medians(p, medians, keys, measures).collect()), key=repr) for p in (train, test)]
    for most in (10_000, 20):
        found = imputing.fill_in_buckets(train, test, keys, measures, rows_per_task=most, rows_of_bucket=300)
        assert [sorted(map(tuple, p.collect()), key=repr) for p in found] == wanted
        plan = found[0]._jdf.queryExecution().executedPlan().toString()
        assert ("Bucketed: true" in plan and "Exchange" not in plan) == (most == 10_000)
    assert [p.count() for p in imputing.fill_in_buckets(train.limit(0), test.limit(0), keys, measures)] == [0, 0]


def test_plans_index_wide_columns_by_a_table(spark):
    from gritmill.operators import features as feat
    from gritmill.plans.feature_plan import Encoding, FeaturePlan

    rng = random.Random(9)
    rows = [(i, i % 2, f"k{rng.randrange(200)}", rng.choice("abc")) for i in range(1500)]
    train = spark.createDataFrame(rows, "i int, y int, wide string, few string")
    test = spark.createDataFrame([(1, 0, "new", "a"), (2, 1, None, "zz"), (3, 1, rows[0][2], "b")], "i int, y int, wide string, few string")
    plan = FeaturePlan(target="y", encodings=(Encoding("wide", "string_index_only"), Encoding("few", "string_index_only")), keys=("i",))
    usual = feat.fit_features(train, plan)
    tabled = feat.fit_features(train, plan, index_limit=20)
    assert set(tabled.labels) == {"wide"} and not usual.labels
    path = fresh_path(spark, "fitted")
    tabled.save(spark, path)
    again = feat.FittedFeatures.load(spark, path)
    names = ["i", "wide_idx", "few_idx"]
    for part in (train, test):
        wanted = sorted(map(tuple, usual.transform(part).select(*names).collect()))
        assert sorted(map(tuple, tabled.transform(part).select(*names).collect())) == wanted == sorted(map(tuple, again.transform(part).select(*names).collect()))
    with pytest.raises(ValueError, match="more than 20"):
        feat.fit_features(train, FeaturePlan(target="y", encodings=(Encoding("wide", "string_index_ohe"),)), index_limit=20)


@pytest.mark.parametrize("how", [{}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "rows_per_task": 3}])
def test_marked_rows_are_filled_alike_on_every_path(spark, how):
    nan = float("nan")
    rows = [("a", 1, True, 1.0), ("a", 1, True, 4.0), ("a", 1, False, None), ("a", 1, False, 9.0), ("b", 1, True, nan), ("b", 1, False, None), ("c", 2, True, 2.0), ("c", 2, True, nan)]
    rows += [(None, 1, True, 5.0), (None, 1, True, None), ("d", None, True, 7.0), ("d", None, False, None), ("e", 3, False, None)]
    df = spark.createDataFrame(rows, "k string, j int, in_train boolean, x double")
    got = sorted(map(tuple, imputing.fill_marked(df, "in_train", ["k", "j"], ["x"], **how).select(*df.columns).collect()), key=repr)
    wanted = [("a", 1, True, 1.0), ("a", 1, True, 4.0), ("a", 1, False, 2.5), ("a", 1, False, 9.0), ("c", 2, True, 2.0), ("c", 2, True, 2.0), (None, 1, True, 5.0), ("d", None, True, 7.0)]
    assert got == sorted(wanted, key=repr)
    assert imputing.fill_marked(df.limit(0), "in_train", ["k", "j"], ["x"], **how).count() == 0


def test_many_groups_are_filled_from_one_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("k"), (F.col("id") % 3 > 0).alias("in_train"), F.when(F.col("id") % 7 > 0, F.col("id").cast("double")).alias("x"))
    plan = imputing.fill_marked(df, "in_train", ["k"], ["x"], broadcast_rows=0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
