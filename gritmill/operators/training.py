"""Train and compare MLlib binary classifiers."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from gritmill.functions.columns import col, hash_long
from gritmill.operators.features import slot_names
from gritmill.session import materialise, shared_folder

# Settings of every classifier that are not searched, and the default grid of those that are.
FIXED_SETTINGS = {
    "LogisticRegression": {},
    "RandomForestClassifier": {"maxBins": 128},
    "GBTClassifier": {"maxBins": 128, "featureSubsetStrategy": "sqrt"},
    "LinearSVC": {},
}
DEFAULT_GRID = {
    "LogisticRegression": {"regParam": [0.001], "elasticNetParam": [0.0], "maxIter": [100]},
    "RandomForestClassifier": {"numTrees": [100], "maxDepth": [5], "minInstancesPerNode": [10]},
    "GBTClassifier": {
        "maxIter": [20],
        "maxDepth": [5],
        "stepSize": [0.1],
        "subsamplingRate": [1.0],
        "minInstancesPerNode": [1],
    },
    "LinearSVC": {"regParam": [0.001], "maxIter": [100]},
}
FOLDS = 3
FOLD = "_fold"
SEED = 42
#: Fits that are under way at the same time, at most; each keeps its own form of the rows, in memory or on disk.
FITS_AT_ONCE = 6
#: Rows of a task of a fit: at least so many before another core is used, and at most so many, or so many bytes, before each core gets another task.
LEAST_ROWS, MOST_ROWS, MOST_BYTES = 1_000, 250_000, 64 << 20
# Order of preference on a near tie, what counts as one, and when to stop trying.
SIMPLEST_FIRST = ["LogisticRegression", "RandomForestClassifier", "GBTClassifier"]
NEAR_TIE = 0.02
GOOD_ENOUGH = 0.80
MAX_ITERATIONS = 2

CLASSIFIERS = {
    "LogisticRegression": LogisticRegression,
    "RandomForestClassifier": RandomForestClassifier,
    "GBTClassifier": GBTClassifier,
    "LinearSVC": LinearSVC,
}


@dataclass(frozen=True)
class Trained:
    name: str
    model: Model
    best: dict[str, object]
    unknown_settings: list[str]
    fold_scores: list[tuple[str, float]]  # settings that were tried, and their mean AUC over the folds


def classifier(name: str, label: str, features: str = "features"):
    if name not in CLASSIFIERS:
        raise ValueError(f"unknown classifier {name}; choose from {sorted(CLASSIFIERS)}")
    return CLASSIFIERS[name](labelCol=label, featuresCol=features, **FIXED_SETTINGS[name])


def grid_for(estimator, wanted: Mapping[str, Sequence[object]]) -> tuple[list, list[str]]:
    """Combinations of the settings the estimator has, and the names of those it lacks."""
    known = {k: v for k, v in wanted.items() if estimator.hasParam(k)}
    builder = ParamGridBuilder()
    for name, values in known.items():
        builder.addGrid(estimator.getParam(name), list(values))
    return builder.build(), [k for k in wanted if k not in known]


def fold_of(keys: Sequence[str], folds: int = FOLDS) -> Column:
    """Fold of a row by a hash of its key, of other digits than a split by the same key takes, so that folds of a split stay even."""
    return F.pmod(hash_long(*[col(k) for k in keys], F.lit("fold")), F.lit(folds)).cast("int")


def folds_by_key(df: DataFrame, keys: Sequence[str], folds: int = FOLDS) -> DataFrame:
    """``fold, row_count, key_count, shared_keys``: sizes of the folds, and how many of a fold's keys are in another one too, which must be none."""
    per_key = df.groupBy(*[col(k) for k in keys], fold_of(keys, folds).alias("fold")).agg(F.count(F.lit(1)).alias("n"))
    spread = materialise(per_key, "folds")
    twice = spread.groupBy(*[col(k) for k in keys]).agg(F.min("fold").alias("a"), F.max("fold").alias("b")).filter("a < b")
    shared = twice.select(F.explode(F.array("a", "b")).alias("fold")).groupBy("fold").agg(F.count(F.lit(1)).alias("shared_keys"))
    sizes = spread.groupBy("fold").agg(F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("key_count"))
    return sizes.join(F.broadcast(shared), "fold", "left").withColumn("shared_keys", F.coalesce("shared_keys", F.lit(0).cast("long")))


def form_bytes(estimator, combinations: Sequence[Mapping], slots: int) -> int:
    """About what a fit keeps of a row: its slots as doubles, or for trees the bin of each slot, and how often each tree of a forest drew the row."""
    if not estimator.hasParam("maxBins"):
        return 8 * slots + 30
    trees = [c.get(estimator.numTrees, estimator.getOrDefault("numTrees")) for c in combinations] if estimator.hasParam("numTrees") else [1]
    return 4 * slots + 4 * max(trees) + 100


def storage_bytes(spark: SparkSession) -> int:
    """What all executors together may cache in memory."""
    sc = spark.sparkContext._jsc.sc()
    sizes, total = sc.getExecutorMemoryStatus().values().iterator(), 0
    while sizes.hasNext():
        total += sizes.next()._1()
    # The driver is among them, but runs tasks only where it is alone.
    return total if sc.isLocal() else total - sc.env().memoryManager().maxOnHeapStorageMemory()


def fits_that_fit(rows: int, forms: Sequence[int], storage: int, most: int) -> int:
    """How many fits may be under way: as many as can cache their own forms of the rows, and one always, which leaves on disk what does not fit.

    ``forms`` has a row's bytes for every classifier. With so many rows that fewer fits fit, each pass of a single one fills all cores.
    """
    each = rows * sum(forms) // max(1, len(forms))
    return max(1, min(most, storage // max(1, each)))


def dealt(df: DataFrame, rows: int, row_bytes: int = 0) -> DataFrame:
    """The rows in even parts, as many as there are cores or a multiple, however unevenly they were written: every pass of a fit waits for its largest part.

    A part that a task reads from another executor's cache is held whole by both, outside of what Spark accounts for, so parts are bounded in bytes too.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    most = max(LEAST_ROWS, min(MOST_ROWS, MOST_BYTES // max(1, row_bytes)))
    parts = min(max(1, rows // LEAST_ROWS), cores * max(1, math.ceil(rows / (cores * most))))
    return df.repartition(parts)


def _texts(combinations: Sequence[Mapping]) -> list[str]:
    return [", ".join(f"{p.name}={v}" for p, v in sorted(c.items(), key=lambda x: x[0].name)) for c in combinations]


def train_classifiers(
    train: DataFrame,
    grids: Mapping[str, Mapping[str, Sequence[object]] | None],
    label: str,
    folds: int | None = FOLDS,
    fold_keys: Sequence[str] = (),
    at_once: int = FITS_AT_ONCE,
) -> dict[str, Trained]:
    """Grid search of every classifier with cross-validation on AUC over the same folds, also for grids of one point, and the best of each on all rows.

    A hash of ``fold_keys`` decides a row's fold: rows of one key are in one fold, in any partitioning. The rows are read, dealt evenly and cached once for
    all classifiers; fits of any classifier, setting and fold are under way together, so that the many short passes of one fill the cores that
    another leaves idle: ``at_once`` at most, fewer where the executors' memory has no room for so many forms of the rows. A fold is a filter on the
    cached rows: each fit caches its own form of them, so a copy of a fold would be held twice. Rows that would take half of the memory are kept on disk.
    ``folds=None`` says to fit without cross-validation, which takes grids of one point. Long boosting chains are cut by MLlib's own checkpoints in the shared folder.
    """
    spark = train.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    wanted = {name: grid or DEFAULT_GRID[name] for name, grid in grids.items()}
    estimators = {name: classifier(name, label) for name in wanted}
    points = {name: grid_for(estimators[name], grid) for name, grid in wanted.items()}
    for combinations, _ in points.values():
        if folds is None and len(combinations) > 1:
            raise ValueError(f"a grid of {len(combinations)} points needs folds")
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    folded = train.withColumn(FOLD, fold_of(fold_keys, folds) if folds else F.lit(0))
    sizes = {r[FOLD]: r["n"] for r in folded.groupBy(FOLD).agg(F.count(F.lit(1)).alias("n")).collect()}
    if folds and len(sizes) < folds:
        raise ValueError(f"of {folds} folds {folds - len(sizes)} are empty")
    rows, storage = sum(sizes.values()), storage_bytes(spark)
    slots = (folded.select(F.size(vector_to_array("features"))).first() or [0])[0] or 0
    forms = [form_bytes(e, points[name][0], slots) for name, e in estimators.items()]
    plain = rows * (8 * slots + 30)
    apart = plain > storage // 2
    cached = dealt(folded, rows, max(forms, default=0)).persist(StorageLevel.DISK_ONLY if apart else StorageLevel.MEMORY_AND_DISK)
    fitted = rows * (folds - 1) // folds if folds else rows
    at_once = fits_that_fit(fitted, forms, storage if apart else storage - plain, at_once)

    def score_of(task: tuple[int, int, str]) -> float:
        fold, point, name = task
        model = estimators[name].fit(cached.filter(F.col(FOLD) != fold), points[name][0][point])
        return float(evaluator.evaluate(model.transform(cached.filter(F.col(FOLD) == fold))))

    def best_of(name: str) -> Model:
        return estimators[name].fit(cached, points[name][0][best[name]])

    # Classifiers in turn, so that seldom all fits under way are of the one that takes the most memory.
    widest = max((len(c) for c, _ in points.values()), default=0)
    tasks = [(f, i, name) for f in range(folds or 0) for i in range(widest) for name in points if i < len(points[name][0])]
    try:
        with ThreadPool(at_once) as pool:
            scores = dict(zip(tasks, pool.imap(inheritable_thread_target(spark)(score_of), tasks), strict=True))
            means = {name: [sum(scores[f, i, name] for f in range(folds)) / folds for i in range(len(c))] if folds else [] for name, (c, _) in points.items()}
            # Equal areas go to the setting that comes first in the grid.
            best = {name: max(range(len(m)), key=m.__getitem__) if m else 0 for name, m in means.items()}
            models = dict(zip(points, pool.imap(inheritable_thread_target(spark)(best_of), points), strict=True))
    finally:
        cached.unpersist()
    return {name: _trained(name, models[name], wanted[name], *points[name], means[name]) for name in points}


def _trained(name: str, model: Model, wanted: Mapping, combinations: Sequence[Mapping], unknown: list[str], aucs: Sequence[float]) -> Trained:
    best = {p: model.getOrDefault(model.getParam(p)) for p in wanted if model.hasParam(p)}
    scores = [(text, round(float(m), 4)) for text, m in zip(_texts(combinations), aucs, strict=True)] if aucs else []
    return Trained(name, model, best, unknown, scores)


def train_classifier(
    train: DataFrame,
    name: str,
    label: str,
    grid: Mapping[str, Sequence[object]] | None = None,
    folds: int | None = FOLDS,
    parallelism: int = FITS_AT_ONCE,
    seed: int = SEED,
    fold_keys: Sequence[str] | None = None,
) -> Trained:
    """``train_classifiers`` for one classifier. Without ``fold_keys`` folds are random, by MLlib's own cross-validator."""
    if fold_keys or not folds:
        return train_classifiers(train, {name: grid}, label, folds, fold_keys or (), parallelism)[name]
    spark = train.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    estimator = classifier(name, label)
    combinations, unknown = grid_for(estimator, grid or DEFAULT_GRID[name])
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=combinations,
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = search.fit(cached)
    finally:
        cached.unpersist()
    return _trained(name, found.bestModel, grid or DEFAULT_GRID[name], combinations, unknown, found.avgMetrics)


def best_settings(trained: Trained, table_of: DataFrame) -> DataFrame:
    rows = [(trained.name, k, str(v)) for k, v in sorted(trained.best.items())]
    return table_of.sparkSession.createDataFrame(rows, "model string, setting string, value string")


def fold_scores(trained: Trained, table_of: DataFrame) -> DataFrame:
    """``model, settings, fold_auc``: one row for every combination that was cross-validated."""
    rows = [(trained.name, *tried) for tried in trained.fold_scores]
    return table_of.sparkSession.createDataFrame(rows, "model string, settings string, fold_auc double")


def held_out_auc(trained: Trained, test: DataFrame, label: str) -> float:
    scored = trained.model.transform(test)
    return round(BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(scored), 4)


def feature_importances(trained: Trained, vectors: DataFrame, vector: str = "features") -> DataFrame:
    """Importance (trees) or absolute coefficient (linear) per vector slot, under the slot's own name."""
    model = trained.model
    weights = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    names = slot_names(vectors, vector)
    rows = [(trained.name, n, abs(float(w))) for n, w in zip(names, weights.toArray(), strict=True)]
    table = vectors.sparkSession.createDataFrame(rows, "model string, feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def strongest_features(importances: DataFrame, k: int = 10) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(k)


def score(model: Model, vectors: DataFrame) -> DataFrame:
    return model.transform(vectors)


def simplicity(name: Column) -> Column:
    """Position in the order of preference; models outside it come last."""
    place = F.array_position(F.array(*[F.lit(n) for n in SIMPLEST_FIRST]), name)
    return F.when(place > 0, place).otherwise(F.lit(len(SIMPLEST_FIRST) + 1))


def pick_winner(metrics: DataFrame, name: str = "model", auc: str = "auc", order: Column | None = None) -> DataFrame:
    """Highest AUC, unless a simpler model is less than 0.02 behind."""
    best = metrics.agg(F.max(col(auc))).scalar()
    close = metrics.filter((best - col(auc) < NEAR_TIE) | (col(auc) == best))
    preference = order if order is not None else simplicity(col(name))
    return close.orderBy(preference, F.desc(auc), col(name)).limit(1).select(
        col(name).alias("winner"), col(auc).alias("winner_auc")
    )


def next_action(winner: DataFrame, iteration: int) -> DataFrame:
    """Accept a good winner, or any winner when the tries are used up; otherwise train other models."""
    done = (F.col("winner_auc") >= GOOD_ENOUGH) | F.lit(iteration >= MAX_ITERATIONS)
    return winner.withColumn("next_action", F.when(done, F.lit("accept")).otherwise(F.lit("retrain")))
