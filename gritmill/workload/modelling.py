"""Training and comparing classifiers on labelled documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.operators import evaluating as evaluate
from gritmill.operators import features as feat
from gritmill.operators import searching as search
from gritmill.operators import training as fit
from gritmill.operators.profiling import class_shares
from gritmill.operators.runs import evaluate_saved_models, keep_training
from gritmill.operators.splitting import balance_classes, key_split, written_key_split
from gritmill.plans.feature_plan import Encoding, FeaturePlan, Interaction, RegexFlag
from gritmill.session import fresh_path, materialise
from gritmill.sources.runs import stored_report
from gritmill.sources.tables import load_model, save_model
from gritmill.workload.registry import query
from gritmill.workload.views import DOCS_SQL, doc_quality, hash_sql, table

LABEL = "quality"
DOC_PLAN = FeaturePlan(
    target=LABEL,
    flags=(
        RegexFlag("text", "has_link", "https?://|www"),
        RegexFlag("text", "has_digits", "[0-9]{3,}"),
        RegexFlag("text", "has_noise", "[#$%*&]{2,}"),
        RegexFlag("text", "has_license", "license|copyright"),
    ),
    interactions=(Interaction("n_chars", "n_lines", "ratio"),),
    encodings=(Encoding("lang", "string_index_ohe"), Encoding("source", "string_index_only")),
    scaling="standard",
    scaled=("n_chars",),
    keys=("doc_id", "toxic"),
)
# The default grids with a second point each.
GRIDS = {
    "LogisticRegression": fit.DEFAULT_GRID["LogisticRegression"] | {"regParam": [0.001, 0.01]},
    "RandomForestClassifier": fit.DEFAULT_GRID["RandomForestClassifier"] | {"maxDepth": [3, 5]},
    "GBTClassifier": fit.DEFAULT_GRID["GBTClassifier"] | {"maxDepth": [3, 5]},
    "LinearSVC": fit.DEFAULT_GRID["LinearSVC"] | {"regParam": [0.001, 0.01]},
}


def vectors(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Balanced training vectors and untouched test vectors."""
    docs = doc_quality(spark, sf).withColumn("n_lines", F.size(F.split("text", "\n")))
    # The texts are read once, for the flags; the splits are written, and read, without them.
    docs = feat.add_flags(docs, DOC_PLAN.flags).drop("text")
    train, test = written_key_split(docs, ["doc_id"], 70, "docs")
    train, test, fitted = feat.apply_plan(train, test, DOC_PLAN)
    ready = [feat.assemble(part, fitted.features, keep=["doc_id", LABEL]) for part in (train, test)]
    train = balance_classes(materialise(ready[0], "train_vectors"), LABEL, ["doc_id"])
    return train, materialise(ready[1], "test_vectors")


def train_one(spark, sf, name, folds=None):
    """The classifier at its default settings; without folds where the query is about something else."""
    train, test = vectors(spark, sf)
    return fit.train_classifier(train, name, LABEL, GRIDS[name] if folds else None, folds, fold_keys=["doc_id"]), train, test


def _held_out(spark, sf, name):
    """Every setting tried with its AUC over the folds, and the AUC of the best one on rows that training never saw."""
    trained, _, test = train_one(spark, sf, name, fit.FOLDS)
    auc = fit.held_out_auc(trained, test, LABEL)
    return fit.fold_scores(trained, test).withColumns({"auc": F.lit(auc), "test_rows": F.lit(test.count())})


@query("train_logistic_regression")
def train_logistic_regression(spark, sf):
    return _held_out(spark, sf, "LogisticRegression")


@query("train_random_forest")
def train_random_forest(spark, sf):
    return _held_out(spark, sf, "RandomForestClassifier")


@query("train_boosted_trees")
def train_boosted_trees(spark, sf):
    return _held_out(spark, sf, "GBTClassifier")


@query("train_linear_svc")
def train_linear_svc(spark, sf):
    return _held_out(spark, sf, "LinearSVC")


@query("cross_validated_grid")
def cross_validated_grid(spark, sf):
    """Three folds over a grid; a setting the model lacks is skipped and named."""
    train, test = vectors(spark, sf)
    grid = {"regParam": [0.001, 0.1], "maxIter": [20], "noSuchSetting": [1]}
    trained = fit.train_classifier(train, "LogisticRegression", LABEL, grid, fold_keys=["doc_id"])
    best = fit.best_settings(trained, test).withColumn("auc", F.lit(fit.held_out_auc(trained, test, LABEL)))
    return best.withColumn("skipped", F.lit(",".join(trained.unknown_settings)))


@query("feature_importances")
def feature_importances(spark, sf):
    trained, train, _ = train_one(spark, sf, "RandomForestClassifier")
    return fit.feature_importances(trained, train)


@query("strongest_features")
def strongest_features(spark, sf):
    trained, train, _ = train_one(spark, sf, "LogisticRegression")
    return fit.strongest_features(fit.feature_importances(trained, train), 5)


@query(
    "model_reloaded_scores",
    f"WITH {DOCS_SQL} SELECT count(*) AS n, TRUE AS same FROM docs WHERE {hash_sql('doc_id')} % 100 >= 70",
)
def model_reloaded_scores(spark, sf):
    """A saved model scores the test rows as the fitted one does."""
    trained, _, test = train_one(spark, sf, "GBTClassifier")
    path = fresh_path(spark, "model")
    save_model(trained.model, path)
    again = load_model(spark, path)
    before, after = (fit.score(model, test) for model in (trained.model, again))
    scores = before.select("doc_id", evaluate.positive_score(before).alias("fitted"))
    both = scores.join(after.select("doc_id", evaluate.positive_score(after).alias("loaded")), "doc_id", "full")
    return both.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("fitted").eqNullSafe(F.col("loaded"))).alias("same"))


@query("positive_scores")
def positive_scores(spark, sf):
    """Probability where the model has one, margin otherwise."""
    parts = []
    train, test = vectors(spark, sf)
    for name in ("LogisticRegression", "LinearSVC"):
        scored = fit.train_classifier(train, name, LABEL, folds=None).model.transform(test)
        parts.append(
            scored.select("doc_id", F.lit(name).alias("model"), F.round(evaluate.positive_score(scored), 4).alias("score"))
        )
    return reduce(DataFrame.unionByName, parts)


@query("model_leaderboard")
def model_leaderboard(spark, sf):
    """Train all models, evaluate them on the test split, and decide."""
    train, test = vectors(spark, sf)
    reports = {}
    for name, trained in fit.train_classifiers(train, GRIDS, LABEL, fold_keys=["doc_id"]).items():
        scored = trained.model.transform(test)
        reports[name] = evaluate.evaluate(scored, LABEL, evaluate.positive_score(scored))
    board = materialise(evaluate.leaderboard(reports), "leaderboard")
    decision = fit.next_action(fit.pick_winner(board, "model", "auc_roc"), iteration=1)
    return board.join(F.broadcast(decision), board["model"] == decision["winner"], "left").drop("winner", "winner_auc")


@query(
    "training_run_kept",
    f"""
    WITH {DOCS_SQL}, test AS (SELECT count(*) AS n FROM docs WHERE {hash_sql('doc_id')} % 100 >= 70),
    models AS (SELECT unnest([{", ".join(f"'{n}'" for n in sorted(GRIDS))}]) AS model)
    SELECT 'first' AS run, model, TRUE AS same_after_loading, TRUE AS same_in_report, n AS test_rows, TRUE AS curve_ends_at_all_rows FROM models, test
    """,
)
def training_run_kept(spark, sf):
    """A run of all classifiers is kept with its reports; from the files alone come the same leaderboard, metrics and curves."""
    root = fresh_path(spark, "runs")
    train, test = vectors(spark, sf)
    trained = fit.train_classifiers(train, dict.fromkeys(GRIDS), LABEL, folds=None)
    board = keep_training(root, "first", trained, train, test, LABEL)
    again = materialise(evaluate_saved_models(spark, root, test, LABEL).drop("problem"), "again")
    numbers = [c for c in board.columns if c != "model"]
    same = F.lit(True)
    for c in numbers:
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))
    loaded = again.alias("a").join(board.alias("b"), "model", "left").select(F.col("a.run").alias("run"), "model", same.alias("same_after_loading"))
    metrics = stored_report(spark, root, "metrics").groupBy("run", "model").pivot("metric", numbers).agg(F.first("value"))
    reported = again.alias("a").join(metrics.alias("b"), ["run", "model"], "left").select("run", "model", same.alias("same_in_report"))
    ends = stored_report(spark, root, "curves").groupBy("run", "model").agg((F.max("tp") + F.max("fp")).alias("n"))
    rows = test.count()
    ends = ends.select("run", "model", F.lit(rows).cast("long").alias("test_rows"), (F.col("n") == rows).alias("curve_ends_at_all_rows"))
    return loaded.join(reported, ["run", "model"]).join(ends, ["run", "model"])


@query("training_importances_kept")
def training_importances_kept(spark, sf):
    """Importances and settings of two runs in one table each, as they were stored."""
    root = fresh_path(spark, "runs")
    train, test = vectors(spark, sf)
    for run, name in (("first", "LogisticRegression"), ("second", "RandomForestClassifier")):
        keep_training(root, run, {name: fit.train_classifier(train, name, LABEL, folds=None)}, train, test, LABEL)
    settings = stored_report(spark, root, "settings").groupBy("run", "model").agg(F.sort_array(F.collect_list(F.concat_ws("=", "setting", "value"))).alias("settings"))
    return stored_report(spark, root, "importances").join(F.broadcast(settings), ["run", "model"])


@query(
    "folds_by_key",
    f"""
    WITH split AS (SELECT l_orderkey FROM lineitem WHERE {hash_sql('l_orderkey')} % 100 < 80),
    folded AS (SELECT l_orderkey, CAST({hash_sql("l_orderkey, 'fold'", 13)} % 3 AS INTEGER) AS fold FROM split)
    SELECT fold, count(*) AS row_count, count(DISTINCT l_orderkey) AS key_count, 0::BIGINT AS shared_keys FROM folded GROUP BY 1
    """,
)
def folds_by_key(spark, sf):
    """Folds of the training lines by order: no order is in two folds, whatever the partitioning."""
    train, _ = key_split(table(spark, sf, "lineitem"), ["l_orderkey"])
    return fit.folds_by_key(train, ["l_orderkey"])


# 72 settings of a linear model, as wide as the widest kept search, and small grids of the others.
SEARCHED = {
    "LogisticRegression": {"regParam": [0.0001, 0.001, 0.01, 0.1, 0.3, 1.0], "elasticNetParam": [0.0, 0.25, 0.5, 1.0], "maxIter": [20, 50, 100]},
    "GBTClassifier": {"maxIter": [10, 20], "maxDepth": [3, 5]},
    "RandomForestClassifier": {"numTrees": [50, 100], "maxDepth": [3, 5]},
    "LinearSVC": {"regParam": [0.001, 0.01, 0.1], "maxIter": [100]},
}


def _searched(spark, sf):
    train, test = vectors(spark, sf)
    return search.search(train, test, LABEL, ["doc_id"], SEARCHED)


@query("model_search")
def model_search(spark, sf):
    """Every fit of the search: which iteration, setting and rung, its AUC on the rows held back, and whether it went on."""
    found = _searched(spark, sf)
    return found.log.join(F.broadcast(found.decisions), "iteration")


@query("mllib_evaluator_areas")
def mllib_evaluator_areas(spark, sf):
    trained, _, test = train_one(spark, sf, "LogisticRegression")
    return evaluate.mllib_areas(fit.score(trained.model, test), LABEL)


@query(
    "label_balance",
    """
    WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
    SELECT quality, n, round(n * 100.0 / (SELECT sum(n) FROM c), 5) AS percentage FROM c
    """,
)
def label_balance(spark, sf):
    return class_shares(table(spark, sf, "labels"), LABEL)
