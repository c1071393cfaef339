"""Kept runs, the evaluation of a folder, folds by key and the search."""

from __future__ import annotations

import threading
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from gritmill.operators import features as feat
from gritmill.operators import runs as kept
from gritmill.operators import searching as search
from gritmill.operators import training as fit
from gritmill.plans import incidents
from gritmill.session import fresh_path
from gritmill.sources import runs


def made(spark, n, seed, width=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=n) * 0.7 > 0).astype(int)
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(n)]
    table = spark.createDataFrame(rows, "k long, y int, " + ", ".join(f"x{j} double" for j in range(width)))
    return feat.assemble(table, [f"x{j}" for j in range(width)], keep=["k", "y"])


@pytest.fixture(scope="module")
def splits(spark):
    return made(spark, 600, 1).cache(), made(spark, 300, 2).cache()


SMALL = {"LogisticRegression": {"maxIter": [5]}, "LinearSVC": {"maxIter": [5]}, "RandomForestClassifier": {"numTrees": [3], "maxDepth": [2]}, "GBTClassifier": {"maxIter": [2], "maxDepth": [2]}}


def test_a_kept_run_gives_the_same_leaderboard(spark, splits):
    train, test = splits
    root = fresh_path(spark, "runs")
    trained = {n: fit.train_classifier(train, n, "y", g, folds=None) for n, g in SMALL.items()}
    board = kept.keep_training(root, "r1", trained, train, test, "y")
    again = kept.evaluate_saved_models(spark, root, test, "y")
    assert again.drop("run", "problem").orderBy("model").collect() == board.select(*again.drop("run", "problem").columns).orderBy("model").collect()
    assert {r["problem"] for r in again.collect()} == {None} and {r["run"] for r in again.collect()} == {"r1"}
    metrics = runs.stored_report(spark, root, "metrics")
    assert metrics.filter("metric = 'auc_roc'").count() == 4 and {r["run"] for r in metrics.collect()} == {"r1"}
    assert {r["model"] for r in runs.stored_report(spark, root, "importances").collect()} == set(SMALL)
    curve = runs.stored_report(spark, root, "curves").groupBy("model").agg(F.max(F.col("tp") + F.col("fp")).alias("n"))
    assert {r["n"] for r in curve.collect()} == {300}


def test_what_is_not_committed_is_not_seen(spark, splits):
    train, test = splits
    root = fresh_path(spark, "runs")
    assert kept.evaluate_saved_models(spark, root, test, "y").collect() == []
    model = fit.train_classifier(train, "LogisticRegression", "y", SMALL["LogisticRegression"], folds=None).model
    runs.save_run(spark, root, "half", {"a": model}, {"metrics": train.select("k")}, commit=False)
    assert runs.committed_runs(spark, root) == [] and runs.saved_models(spark, root) == []
    with pytest.raises(FileNotFoundError):
        runs.stored_report(spark, root, "metrics")
    runs.save_run(spark, root, "half", {"a": model}, {"metrics": train.select("k")})
    assert [m.name for m in runs.saved_models(spark, root)] == ["a"]
    with pytest.raises(FileExistsError):
        runs.save_run(spark, root, "half", {"a": model}, {})


def test_bare_models_and_models_of_another_table(spark, splits):
    train, test = splits
    root = fresh_path(spark, "runs")
    fits = {n: fit.train_classifier(train, n, "y", SMALL[n], folds=None).model for n in ("LogisticRegression", "LinearSVC")}
    fits["LogisticRegression"].save(f"{root}/plain")
    fits["LinearSVC"].save(f"{root}/nested/model")
    wide = fit.train_classifier(made(spark, 200, 3, width=5), "LogisticRegression", "y", SMALL["LogisticRegression"], folds=None).model
    runs.save_run(spark, root, "old", {"wide": wide}, {})
    found = kept.evaluate_saved_models(spark, root, test, "y").collect()
    assert [(r["run"], r["model"]) for r in found if r["problem"] is None] and {r["model"] for r in found} == {"plain", "nested", "wide"}
    (odd,) = [r for r in found if r["problem"]]
    assert odd["model"] == "wide" and "5 features" in odd["problem"] and odd["auc_roc"] is None and found[-1] == odd


def test_reports_of_different_columns_share_a_table(spark):
    root = fresh_path(spark, "runs")
    runs.save_run(spark, root, "a", {}, {"m": spark.createDataFrame([(1,)], "x int")})
    runs.save_run(spark, root, "b", {}, {"m": spark.createDataFrame([(2, "z")], "x int, y string")})
    assert sorted(map(tuple, runs.stored_report(spark, root, "m").select("run", "x", "y").collect()), key=str) == [("a", 1, None), ("b", 2, "z")]


def test_rows_without_a_score_are_counted(spark):
    rows = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (0, float("nan")), (0, None)], "y int, s double")
    half = SQLTransformer(statement="SELECT *, CASE WHEN s > 0.5 THEN 1.0D ELSE 0.0D END AS prediction, 1 - s AS _low, s AS _high FROM __THIS__")
    model = PipelineModel([half, VectorAssembler(inputCols=["_low", "_high"], outputCol="rawPrediction", handleInvalid="keep")])
    board, _ = kept.evaluated({"m": model}, rows, "y")
    (r,) = board.collect()
    assert (r["unscored_pos"], r["unscored_neg"], r["auc_roc"]) == (1, 2, 1.0)


def test_folds_keep_keys_together_in_any_partitioning(spark):
    rows = spark.range(900).select((F.col("id") % 130).alias("k"), F.col("id").alias("v"))
    sizes = fit.folds_by_key(rows, ["k"]).collect()
    assert sum(r["row_count"] for r in sizes) == 900 and sum(r["key_count"] for r in sizes) == 130 and {r["shared_keys"] for r in sizes} == {0}
    again = fit.folds_by_key(rows.repartition(11), ["k"]).collect()
    assert sorted(sizes) == sorted(again)
    odd = rows.withColumn("k", F.when(F.col("v") % 2 == 0, F.col("k")))
    assert sum(r["row_count"] for r in fit.folds_by_key(odd, ["k"]).collect()) == 900


def test_fold_scores_do_not_depend_on_the_partitioning(spark, splits):
    train, _ = splits
    grid = {"regParam": [0.001, 0.3], "maxIter": [20]}
    scores = [fit.train_classifier(train.repartition(p), "LogisticRegression", "y", grid, fold_keys=["k"]).fold_scores for p in (3, 11)]
    assert scores[0] == scores[1] and len(scores[0]) == 2


def test_classifiers_are_fitted_side_by_side_on_even_parts_and_score_as_plain_fits_do(spark, splits, monkeypatch):
    train, _ = splits
    grids = {n: SMALL[n] | {"regParam": [0.001, 0.3]} for n in ("LogisticRegression", "LinearSVC")}
    keys, label = ["k"], "y"
    plain = {}
    for name, grid in grids.items():
        estimator = fit.classifier(name, label)
        settings, _ = fit.grid_for(estimator, grid)
        plain[name] = []
        for setting in settings:
            areas = []
            for fold in range(fit.FOLDS):
                held = fit.fold_of(keys) == fold
                model = estimator.fit(train.filter(~held), setting)
                areas.append(BinaryClassificationEvaluator(labelCol=label).evaluate(model.transform(train.filter(held))))
            plain[name].append(round(sum(areas) / fit.FOLDS, 4))

    together, parts = threading.Barrier(len(grids), timeout=60), []
    met = {name: threading.Event() for name in grids}

    def watched(name):
        class Watched(fit.CLASSIFIERS[name]):
            def fit(self, dataset, params=None):
                if not met[name].is_set():
                    met[name].set()
                    together.wait()  # breaks unless a fit of the other classifier is under way too
                parts.append(sorted(r["count"] for r in dataset.groupBy(F.spark_partition_id()).count().collect()))
                return super().fit(dataset, params)

        return Watched

    monkeypatch.setattr(fit, "CLASSIFIERS", {n: watched(n) for n in grids})
    monkeypatch.setattr(fit, "LEAST_ROWS", 100)
    fitted = SimpleNamespace(plan=SimpleNamespace(target=label))
    monkeypatch.setattr(incidents, "vectors_of", lambda ready: (train.coalesce(1).withColumnRenamed("k", "_row"), train))
    board, _, models = incidents.compare_models(SimpleNamespace(fitted=fitted), grids)
    assert {n: [a for _, a in m.fold_scores] for n, m in models.items()} == plain
    assert len(parts) == 2 * (2 * fit.FOLDS + 1) and all(len(p) > 1 and p[-1] <= 2 * p[0] for p in parts)
    assert board.count() == 2


def test_fits_wait_for_room_in_memory(spark, splits, monkeypatch):
    """Where the executors' memory holds one form of the rows, one fit runs at a time, on rows kept on disk; areas and settings stay."""
    train, _ = splits
    grids = {n: SMALL[n] | {"regParam": [0.001, 0.3]} for n in ("LogisticRegression", "LinearSVC")}
    wanted = {n: (t.fold_scores, t.best) for n, t in fit.train_classifiers(train, grids, "y", fold_keys=["k"]).items()}
    lock, under_way, most, fits = threading.Lock(), [], [], []

    def watched(name):
        class Watched(fit.CLASSIFIERS[name]):
            def fit(self, dataset, params=None):
                with lock:
                    under_way.append(name)
                    most.append(len(under_way))
                try:
                    return super().fit(dataset, params)
                finally:
                    with lock:
                        under_way.remove(name)
                        fits.append(name)

        return Watched

    levels, persist = [], type(train).persist
    monkeypatch.setattr(type(train), "persist", lambda self, level: levels.append(level) or persist(self, level))
    monkeypatch.setattr(fit, "CLASSIFIERS", {n: watched(n) for n in grids})
    monkeypatch.setattr(fit, "storage_bytes", lambda spark: 1_000)
    found = {n: (t.fold_scores, t.best) for n, t in fit.train_classifiers(train, grids, "y", fold_keys=["k"]).items()}
    assert found == wanted and len(fits) == 2 * (2 * fit.FOLDS + 1) and max(most) == 1
    assert levels == [StorageLevel.DISK_ONLY]


def test_fits_and_parts_are_bounded_by_memory(spark, monkeypatch):
    assert fit.storage_bytes(spark) > 100 << 20
    assert [fit.fits_that_fit(1_000, [300, 700], s, 6) for s in (-1, 499_999, 1_000_000, 2_600_000, 10**9)] == [1, 1, 2, 5, 6]
    monkeypatch.setattr(fit, "MOST_BYTES", 1 << 20)
    assert fit.dealt(spark.range(50_000), 50_000, 10_000).rdd.getNumPartitions() == 50
    assert fit.dealt(spark.range(50_000), 50_000, 1).rdd.getNumPartitions() == min(50, spark.sparkContext.defaultParallelism)


def test_folds_without_rows_are_refused(spark, splits):
    train, _ = splits
    with pytest.raises(ValueError, match="empty"):
        fit.train_classifiers(train.withColumn("k", F.lit(1)), {"LogisticRegression": SMALL["LogisticRegression"]}, "y", fold_keys=["k"])


def test_a_search_finds_the_winner_of_the_whole_grid(spark, splits):
    train, test = splits
    grid = {"regParam": [0.001, 0.01, 0.3, 3.0], "elasticNetParam": [0.0, 1.0], "maxIter": [20]}
    rungs = ((0.34, 0.5), (1.0, 1.0))
    back = search.place(["k"], "validation") * 100 < search.VALIDATION_PERCENT
    fit_rows, held_back = train.filter(~back), train.filter(back)
    best, entries = search.climbed(fit_rows, held_back, "LogisticRegression", "y", ["k"], grid, rungs)
    _, whole = search.climbed(fit_rows, held_back, "LogisticRegression", "y", ["k"], grid, ((1.0, 1.0),))
    assert len([e for e in entries if e[1] == 1]) == 8 and len([e for e in entries if e[1] == 2]) == 3 and len(whole) == 8
    assert max(whole, key=lambda e: e[4])[4] - next(e for e in entries if e[1] == 2 and e[5])[4] < 0.005
    assert search.text_of(best) == next(e[0] for e in entries if e[1] == 2 and e[5])


def test_a_weak_winner_brings_other_classifiers(spark, splits):
    train, test = splits
    found = search.search(train, test, "y", ["k"], SMALL, rungs=((1.0, 1.0),), good_enough=0.999)
    steps = [r.asDict() for r in found.decisions.orderBy("iteration").collect()]
    assert [s["next_action"] for s in steps] == ["retrain", "accept"] and set(found.trained) == set(SMALL)
    by = {(r["iteration"], r["model"]) for r in found.log.collect()}
    assert {m for i, m in by if i == 1} == {"LogisticRegression", "GBTClassifier"}
    assert {m for i, m in by if i == 2} == {"RandomForestClassifier", "LinearSVC", steps[0]["winner"]}
    good = search.search(train, test, "y", ["k"], SMALL, rungs=((1.0, 1.0),), good_enough=0.5)
    assert [r["next_action"] for r in good.decisions.collect()] == ["accept"] and set(good.trained) == {"LogisticRegression", "GBTClassifier"}


def test_refined_grids_go_around_the_best():
    grid = {"regParam": [0.1, 1.0], "elasticNetParam": [0.0, 0.5], "maxIter": [10, 20], "maxDepth": [5]}
    assert search.refined({"regParam": 0.1, "elasticNetParam": 0.5, "maxIter": 20, "maxDepth": 5}, grid) == {
        "regParam": [0.05, 0.1, 0.2], "elasticNetParam": [0.5], "maxIter": [10, 20, 40], "maxDepth": [5]
    }
