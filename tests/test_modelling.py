from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gritmill.operators import evaluating as evaluate
from gritmill.operators import encoding as encode
from gritmill.operators import features as feat
from gritmill.operators import gates
from gritmill.operators import training as fit
from gritmill.plans.feature_plan import Binning, Encoding, FeaturePlan, Interaction, RegexFlag
from gritmill.plans.planner import build_plan, pattern_flags, plan_rows
from gritmill.session import fresh_path
from gritmill.sources import tables

NAN = float("nan")


# --- features ------------------------------------------------------------------------------------


def test_rush_hour_and_missing_time(spark):
    df = spark.sql("SELECT cast(concat('2024-01-01 ', h, ':30:00') AS timestamp_ntz) AS t FROM VALUES ('06'),('07'),('09'),('10'),('19'),('20'),(null) AS v(h)")
    plan = FeaturePlan(target="y", rush_hour_from="t")
    assert [r["is_rush_hour"] for r in feat.add_plain_features(df, plan).collect()] == [0, 1, 1, 0, 1, 0, 0]


def test_regex_flag_lowers_text_and_maps_null_to_zero(spark):
    df = spark.createDataFrame([("Heavy RAIN",), ("Fair",), (None,)], "w string")
    assert [r["f"] for r in feat.add_flags(df, [RegexFlag("w", "f", "rain|storm")]).collect()] == [1, 0, 0]


def test_interactions_including_a_ratio_without_divisor(spark):
    df = spark.createDataFrame([(6.0, 2.0), (1.0, -1e-6)], "a double, b double")
    pairs = [Interaction("a", "b", o) for o in ("multiply", "add", "subtract", "ratio")] + [Interaction("a", "zz", "add")]
    one, two = feat.add_interactions(df, pairs).collect()
    assert (one["a_multiply_b"], one["a_add_b"], one["a_subtract_b"]) == (12.0, 8.0, 4.0)
    assert math.isclose(one["a_ratio_b"], 6 / (2 + 1e-6)) and two["a_ratio_b"] is None


def test_bins_send_nan_to_a_bin_of_its_own(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (NAN,), (None,)], "x double")
    edges = feat.bin_edges(df, [Binning("x", "custom_cuts", cuts=(1.0, 3.0))])
    assert [r["x_bin"] for r in feat.bucketizer(edges).transform(df).collect()] == [1, 1, 2, 2, 3, None]


def test_equal_width_of_a_constant_column_is_one_bin(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert feat.bin_edges(df, [Binning("x", "equal_width", bins=3)])["x"] == [-math.inf, math.inf]


def test_index_order_and_one_hot_of_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("a",), ("c",)], "v string")
    test = spark.createDataFrame([("b",), ("zz",), (None,)], "v string")
    plan = FeaturePlan(target="y", encodings=(Encoding("v", "string_index_ohe"),))
    done = feat.fit_features(train, plan).transform(test)
    assert done.columns == ["v_ohe"]
    assert [list(r[0]) for r in done.select(vector_to_array("v_ohe")).collect()] == [[0, 1, 0], [0, 0, 0], [0, 0, 0]]


def test_index_refuses_too_many_values(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("v"))
    with pytest.raises(ValueError, match="more than 100"):
        encode.check_cardinality(["v"], encode.learn(df, distinct_of=["v"]), limit=100)


def test_scaling_learns_on_train_and_handles_constants(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (NAN, 5.0)], "x double, same double")
    test = spark.createDataFrame([(5.0, 7.0), (None, None)], "x double, same double")
    standard = feat.scale(test, feat.scale_parameters(train, ["x", "same"], "standard")).collect()
    assert math.isclose(standard[0]["x"], 3 / math.sqrt(2)) and standard[0]["same"] == 0.0 and standard[1]["same"] is None
    minmax = feat.scale(test, feat.scale_parameters(train, ["x", "same"], "minmax")).first()
    assert (minmax["x"], minmax["same"]) == (2.0, 0.5)


def test_plan_survives_json_and_rejects_unknown_choices():
    plan = FeaturePlan(
        target="y", target_sources=("s",), flags=(RegexFlag("a", "b", "c|d"),), interactions=(Interaction("x", "z", "subtract"),),
        bins=(Binning("x", "custom_cuts", cuts=(1.0, 2.0)), Binning("z", "equal_width", bins=4)),
        encodings=(Encoding("v", "string_index_only"),), scaling="minmax", scaled=("x",), drops=("t",), keys=("id",),
    )
    assert FeaturePlan.from_json(plan.to_json()) == plan
    with pytest.raises(ValueError, match="divide"):
        FeaturePlan(target="y", interactions=(Interaction("a", "b", "divide"),))


def test_target_and_its_descendants_are_not_features(spark):
    df = spark.range(3).selectExpr("id", "1 AS Severity", "1 AS high", "2.0D AS x", "'a' AS c")
    plan = FeaturePlan(
        target="high", target_sources=("Severity",), interactions=(Interaction("Severity", "x", "multiply"), Interaction("Severity_multiply_x", "x", "add")),
        encodings=(Encoding("c", "drop"),), keys=("id",),
    )
    assert feat.feature_columns(df, plan) == ["x"]
    checks = gates.feature_checks(feat.add_plain_features(df, plan), ["x", "Severity_multiply_x_add_x"], plan)
    assert checks.filter("check = 'no_target_leakage'").first()["status"] == "FAIL"


def test_slots_are_named_and_incomplete_rows_skipped(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("b", None, 1), ("b", 2.0, 1)], "c string, x double, y int")
    plan = FeaturePlan(target="y", encodings=(Encoding("c", "string_index_ohe"),))
    done = feat.fit_features(df, plan).transform(df)
    vectors = feat.assemble(done, ["x", "c_ohe"], keep=["y"])
    assert vectors.count() == 2 and feat.slot_names(vectors) == ["x", "c_ohe_b", "c_ohe_a"]
    assert feat.skipped_rows(done, ["x", "c_ohe"]).first()["skipped"] == 1
    assert feat.vector_sizes(vectors, ["features"]).first()["consistent"]


def test_fitted_features_come_back_from_disk(spark):
    train = spark.createDataFrame([("a", 1.0, 0), ("b", 3.0, 1)], "c string, x double, y int")
    plan = FeaturePlan(target="y", encodings=(Encoding("c", "string_index_only"),), scaling="standard", scaled=("x",))
    fitted = feat.fit_features(train, plan)
    path = fresh_path(spark, "fitted")
    fitted.save(spark, path)
    again = feat.FittedFeatures.load(spark, path)
    assert again.features == fitted.features == ["c_idx", "x"]
    assert again.transform(train).collect() == fitted.transform(train).collect()


# --- gates ---------------------------------------------------------------------------------------


def test_continuous_shares_are_not_flags(spark):
    df = spark.createDataFrame([(0.0, 0, 1), (0.5, 1, 0), (1.0, 1, 1)], "share double, flag int, y int")
    kinds = {r["column_name"]: r["kind"] for r in gates.engineered_profile(df, "y").collect()}
    assert kinds == {"share": "number", "flag": "flag"}


def test_gate_rejects_many_suspicious_flags(spark):
    df = spark.range(100).select((F.col("id") % 2).cast("int").alias("y"), *[F.lit(0).alias(f"f{i}") for i in range(4)])
    flags = [RegexFlag("t", f"f{i}", "x") for i in range(4)]
    plan = FeaturePlan(target="y", flags=tuple(flags))
    found = gates.suspicious_flags(gates.engineered_profile(df, "y"), flags)
    checks = gates.feature_checks(df, [f.output for f in flags], plan)
    assert gates.feature_gate(found, checks, 4, 4).first()["decision"] == "reject"
    assert gates.feature_gate(found.limit(3), checks, 4, 4).first()["decision"] == "accept"
    assert gates.feature_gate(found.limit(0), checks, 4, 0).first()["decision"] == "reject"


def test_pruning_keeps_plan_and_tables_in_step(spark):
    df = spark.createDataFrame([("red", 1), ("blue", 0)], "t string, y int")
    plan = FeaturePlan(target="y", flags=(RegexFlag("t", "is_red", "red"), RegexFlag("t", "is_x", "xx")))
    fitted = feat.fit_features(df, plan)
    done = fitted.transform(df)
    bad = gates.suspicious_flags(gates.engineered_profile(done, "y"), plan.flags)
    (pruned,), slim = gates.prune(bad, fitted, done)
    assert pruned.columns == slim.transform(df).columns == ["y", "is_red"] and slim.features == ["is_red"]


def test_rules_write_a_plan(spark):
    categories = spark.createDataFrame([("c", 3), ("d", 50), ("e", 200_000), ("t", 900)], "column_name string, distinct_count long")
    numbers = spark.createDataFrame([("x",), ("z",), ("sev",)], "column_name string")
    tokens = {"t": spark.createDataFrame([("rain", 5)], "token string, n long")}
    rows = plan_rows(categories, numbers, tokens, cuts={"x": (1.0, 2.0)}, pairs=[("x", "z", "ratio"), ("x", "gone", "add")])
    plan = build_plan(rows, "y", ["sev"])
    assert {e.column: e.action for e in plan.encodings} == {"c": "string_index_ohe", "d": "string_index_only", "e": "drop"}
    assert plan.flags == (RegexFlag("t", "is_rain", "rain"),) and plan.interactions == (Interaction("x", "z", "ratio"),)
    assert plan.bins == (Binning("x", "custom_cuts", cuts=(1.0, 2.0)),) and plan.scaled == ("z",)
    assert len(pattern_flags()) == 6


# --- training and evaluation ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 3000)
    s = np.round(np.clip(0.5 * y + rng.normal(0.25, 0.3, 3000), 0, 1), 3)
    rows = [(int(a), float(b), float(b > 0.5)) for a, b in zip(y, s)]
    return spark.createDataFrame(rows, "y int, score double, prediction double").repartition(4).cache()


def test_areas_equal_an_unthinned_evaluator(spark, scored):
    scores = evaluate.by_score(scored, "y", F.col("score"))
    for size in (50, 1_000_000):
        got = evaluate.areas(scores, rows_per_range=size).first()
        for metric, name in (("areaUnderROC", "auc_roc"), ("areaUnderPR", "auc_pr")):
            exact = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", metricName=metric, numBins=0)
            assert math.isclose(got[name], exact.evaluate(scored), abs_tol=1e-5)


def test_curve_is_monotone_and_ends_at_one(spark, scored):
    scores = evaluate.by_score(scored, "y", F.col("score"))
    points = evaluate.curve_points(scores, rows_per_range=100).orderBy(F.desc("score")).collect()
    assert all(a["tpr"] <= b["tpr"] and a["fpr"] <= b["fpr"] for a, b in zip(points, points[1:]))
    assert (points[-1]["tpr"], points[-1]["fpr"]) == (1.0, 1.0)


def test_weighted_metrics_equal_mllib(scored):
    got = evaluate.weighted_report(evaluate.confusion_cells(scored, "y"), digits=9).first()
    pairs = {"f1": "f1", "weightedPrecision": "weighted_precision", "weightedRecall": "weighted_recall", "accuracy": "accuracy"}
    for metric, name in pairs.items():
        want = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction", metricName=metric).evaluate(scored)
        assert math.isclose(got[name], want, abs_tol=1e-8)


def test_rates_without_predictions_are_zero(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.0)], "y int, prediction double")
    row = evaluate.positive_class_report(evaluate.confusion_cells(df, "y")).first()
    assert (row["precision"], row["recall"], row["specificity"], row["accuracy"]) == (0.0, 0.0, 1.0, 0.5)


def test_simpler_model_wins_a_near_tie(spark):
    rows = [("GBTClassifier", 0.83), ("LogisticRegression", 0.815), ("RandomForestClassifier", 0.80)]
    board = spark.createDataFrame(rows, "model string, auc double")
    winner = fit.pick_winner(board)
    assert tuple(winner.first()) == ("LogisticRegression", 0.815)
    assert fit.pick_winner(board.filter("model <> 'LogisticRegression'")).first()["winner"] == "GBTClassifier"
    assert fit.next_action(winner, 1).first()["next_action"] == "accept"
    low = spark.createDataFrame([("LinearSVC", 0.6)], "model string, auc double")
    assert fit.next_action(fit.pick_winner(low), 1).first()["next_action"] == "retrain"
    assert fit.next_action(fit.pick_winner(low), 2).first()["next_action"] == "accept"


def test_unknown_settings_are_reported_and_unknown_models_refused():
    combinations, unknown = fit.grid_for(fit.classifier("LinearSVC", "y"), {"regParam": [0.1, 0.2], "depth": [1]})
    assert len(combinations) == 2 and unknown == ["depth"]
    with pytest.raises(ValueError, match="unknown classifier"):
        fit.classifier("KNN", "y")


def test_importances_carry_slot_names(spark):
    rng = np.random.default_rng(0)
    rows = [(int(v > 0), float(v), "ab"[i % 2], i) for i, v in enumerate(rng.normal(size=300))]
    df = spark.createDataFrame(rows, "y int, x double, c string, id int")
    plan = FeaturePlan(target="y", encodings=(Encoding("c", "string_index_ohe"),), keys=("id",))
    fitted = feat.fit_features(df, plan)
    vectors = feat.assemble(fitted.transform(df), fitted.features, keep=["y"])
    trained = fit.train_classifier(vectors, "RandomForestClassifier", "y", {"numTrees": [5], "maxDepth": [2]})
    top = fit.strongest_features(fit.feature_importances(trained, vectors), 1).first()
    assert top["feature"] == "x" and fit.held_out_auc(trained, vectors, "y") > 0.95
    assert trained.best == {"numTrees": 5, "maxDepth": 2}


# --- sources -------------------------------------------------------------------------------------


def test_csv_with_and_without_a_schema(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([(1, "a,b"), (2, None)], "i int, s string").write.option("header", True).csv(path)
    for schema in ("i int, s string", None):
        assert sorted(map(tuple, tables.read_csv(spark, path, schema).collect())) == [(1, "a,b"), (2, None)]


def test_first_present_variant(spark):
    base = fresh_path(spark, "variants")
    tables.overwrite_parquet(spark.range(3), f"{base}/plain")
    paths = [f"{base}/pruned", f"{base}/plain"]
    assert tables.read_first_present(spark, paths).count() == 3
    tables.overwrite_parquet(spark.range(1), f"{base}/pruned")
    assert tables.read_first_present(spark, paths).count() == 1
    with pytest.raises(FileNotFoundError):
        tables.read_first_present(spark, [f"{base}/none"])


def test_scores_without_a_value_are_counted_apart(spark):
    rows = [(float(i) / 100, i % 2) for i in range(100)]
    plain = evaluate.by_score(spark.createDataFrame(rows, "s double, y int"), "y", F.col("s"))
    odd = evaluate.by_score(spark.createDataFrame([*rows, (NAN, 1), (None, 0), (NAN, 0)], "s double, y int"), "y", F.col("s"))
    for size in (2_000_000, 10):
        assert evaluate.areas(odd, rows_per_range=size).first() == evaluate.areas(plain, rows_per_range=size).first()
        assert evaluate.curve_points(odd, rows_per_range=size).count() == 100
    assert tuple(evaluate.unscored(odd).first()) == (1, 2) and tuple(evaluate.unscored(plain).first()) == (0, 0)


def test_a_grid_of_one_point_is_cross_validated_too(spark):
    df = spark.range(60).selectExpr("cast(id % 2 as int) AS y", "id % 2 + rand(1) AS x").selectExpr("y", "x")
    vectors = feat.assemble(df, ["x"], keep=["y"])
    one = fit.train_classifier(vectors, "LogisticRegression", "y", {"maxIter": [5]})
    assert [s for s, _ in one.fold_scores] == ["maxIter=5"] and one.fold_scores[0][1] > 0.9
    assert fit.train_classifier(vectors, "LogisticRegression", "y", {"maxIter": [5]}, folds=None).fold_scores == []
    with pytest.raises(ValueError, match="folds"):
        fit.train_classifier(vectors, "LogisticRegression", "y", {"maxIter": [5, 6]}, folds=None)


def test_equal_width_of_a_column_without_values_is_one_bin(spark):
    df = spark.createDataFrame([(None,), (NAN,)], "x double")
    assert feat.bin_edges(df, [Binning("x", "equal_width", bins=3)])["x"] == [-math.inf, math.inf]


def test_a_plan_does_not_write_a_column_twice():
    with pytest.raises(ValueError, match="two steps"):
        FeaturePlan(target="y", flags=(RegexFlag("a", "f", "x"), RegexFlag("b", "f", "y")))


def test_aggregates_of_wide_profiles_are_compiled(spark):
    """Spark compiles no aggregate with more than 100 fields in its buffer."""
    df = spark.range(200).select((F.col("id") % 2).alias("y"), *[(F.col("id") % (i + 2)).cast("double").alias(f"n{i}") for i in range(19)], *[(F.col("id") % (i + 5)).alias(f"c{i}_idx") for i in range(3)])
    profile = gates.engineered_profile(df, "y")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = profile.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    partial = [line for line in plan.splitlines() if "HashAggregate" in line and "partial_" in line]
    assert len(partial) == 6 and sum("*(" in line for line in partial) == 3  # the cardinality of an index is never compiled
    found = {r["column_name"]: r for r in profile.collect()}
    assert len(found) == 22 and found["n0"]["kind"] == "flag" and found["n0"]["true_ratio"] == 0.5
    assert found["c2_idx"]["kind"] == "index" and found["c2_idx"]["approx_cardinality"] == 7 and found["n17"]["max"] == 18.0


def test_splits_for_a_plan_have_what_it_reads(spark, monkeypatch):
    from gritmill.workload import featuring, gating

    written = []
    for module in (featuring, gating):
        plain = module.written_splits
        monkeypatch.setattr(module, "written_splits", lambda *a, plain=plain: written.append(plain(*a)) or written[-1])
    gone = {"End_Time", "Airport_Code", "Country", "Flag_Label", "Humidity(%)", "Pressure(in)", "Visibility(mi)"}
    assert featuring.PLAN.unread() == gone
    featuring.vector_slot_names(spark, "/root/testdata/sf0.001")
    gating.pruned_features(spark, "/root/testdata/sf0.001")
    assert len(written) == 2 and not any(gone & set(part.columns) for parts in written for part in parts)


def test_a_plan_is_built_from_the_splits_it_runs_on(spark, monkeypatch):
    from gritmill.workload import featuring

    def refused(*args):
        raise AssertionError("joined once more")

    monkeypatch.setattr(featuring, "written_fact", refused)
    assert featuring.plan_built_and_applied(spark, "/root/testdata/sf0.001").count() == 2


def test_split_documents_are_written_without_texts(spark, monkeypatch):
    from gritmill.workload import modelling

    written, plain = [], modelling.written_key_split
    monkeypatch.setattr(modelling, "written_key_split", lambda *a: written.append(a[0].columns) or plain(*a))
    train, _ = modelling.vectors(spark, "/root/testdata/sf0.001")
    names = modelling.feat.slot_names(train)
    assert "text" not in written[0] and {"has_link", "has_digits", "has_noise", "has_license", "n_lines", "n_chars"} <= {*names}
