"""Exact, distributed evaluation of scored rows."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritmill.functions.columns import col
from gritmill.operators.ranking import ROWS_PER_RANGE, running_totals
from gritmill.session import materialise


CURVE_POINTS = 1_000


def positive_score(df: DataFrame) -> Column:
    """Probability of class 1 where the model gives one, else its raw margin."""
    source = "probability" if "probability" in df.columns else "rawPrediction"
    return vector_to_array(col(source))[1]


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.groupBy(col(label).cast("int").alias("actual"), col(prediction).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_cells(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """The four cells of a binary confusion matrix in one row."""
    y, p = col(label).cast("int"), col(prediction).cast("int")
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def _rate(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), digits)


def positive_class_report(cells: DataFrame, digits: int = 4) -> DataFrame:
    """Precision, recall, accuracy, sensitivity and specificity of class 1; 0 where undefined."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return cells.withColumns(
        {
            "precision": _rate(tp, tp + fp, digits),
            "recall": _rate(tp, tp + fn, digits),
            "accuracy": _rate(tp + tn, tp + fp + tn + fn, digits),
            "sensitivity": _rate(tp, tp + fn, digits),
            "specificity": _rate(tn, tn + fp, digits),
        }
    )


def weighted_report(cells: DataFrame, digits: int = 4) -> DataFrame:
    """F1, precision, recall and accuracy, averaged over both classes by their size."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    size = tp + fp + tn + fn
    per_class = [(tp, fp, fn, tp + fn), (tn, fn, fp, tn + fp)]

    def average(of) -> Column:
        parts = [F.coalesce(of(hit, extra, lost), F.lit(0.0)) * weight for hit, extra, lost, weight in per_class]
        return F.round(F.try_divide(reduce(Column.__add__, parts), size), digits)

    return cells.select(
        average(lambda hit, extra, lost: F.try_divide(hit * 2, hit * 2 + extra + lost)).alias("f1"),
        average(lambda hit, extra, lost: F.try_divide(hit, hit + extra)).alias("weighted_precision"),
        average(lambda hit, extra, lost: F.try_divide(hit, hit + lost)).alias("weighted_recall"),
        F.round(F.try_divide(tp + tn, size), digits).alias("accuracy"),
    )


def by_score(df: DataFrame, label: str, score: Column) -> DataFrame:
    """Positives and negatives per distinct score, written once for all curves and areas.

    Rows whose score is null or NaN make one row without a score: curves and areas leave them out, ``unscored`` counts them.
    """
    known = F.nanvl(score.cast("double"), F.lit(None).cast("double"))
    counted = (
        df.select(known.alias("score"), col(label).cast("int").alias("y"))
        .groupBy("score")
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    )
    return materialise(counted, "by_score")


def unscored(scores: DataFrame) -> DataFrame:
    """Positives and negatives that the model gave no score."""
    return scores.agg(*[F.coalesce(F.sum(F.when(F.col("score").isNull(), F.col(c))), F.lit(0)).alias(c) for c in ("pos", "neg")])


def curve_points(scores: DataFrame, rows_per_range: int = ROWS_PER_RANGE, digits: int = 6) -> DataFrame:
    """ROC and PR coordinates at every distinct score, from the highest score down."""
    run = running_totals(scores.filter("score is not null"), "score", ["pos", "neg"], descending=True, rows_per_range=rows_per_range)
    return run.select(
        "score",
        F.col("pos_run").alias("tp"),
        F.col("neg_run").alias("fp"),
        F.round(F.try_divide(F.col("neg_run"), F.col("neg_all")), digits).alias("fpr"),
        F.round(F.try_divide(F.col("pos_run"), F.col("pos_all")), digits).alias("tpr"),
        F.round(F.try_divide(F.col("pos_run"), F.col("pos_run") + F.col("neg_run")), digits).alias("precision"),
    )


def thinned_curve(scores: DataFrame, points: int = CURVE_POINTS, rows_per_range: int = ROWS_PER_RANGE, digits: int = 6) -> DataFrame:
    """At most ``points`` of the points of ``curve_points``, evenly along the curve, whatever the number of distinct scores.

    True and false positives both rise along the curve, so steps in either number the points' stretches in order; the last point of each stretch
    stays, and with it the curve's end.
    """
    run = running_totals(scores.filter("score is not null"), "score", ["pos", "neg"], descending=True, rows_per_range=rows_per_range)
    steps = max(1, (points - 1) // 2)
    stretch = F.coalesce(F.expr(f"pos_run * {steps} div nullif(pos_all, 0)"), F.lit(0)) + F.coalesce(F.expr(f"neg_run * {steps} div nullif(neg_all, 0)"), F.lit(0))
    last = run.groupBy(stretch.alias("stretch")).agg(F.min_by(F.struct("score", "pos_run", "neg_run", "pos_all", "neg_all"), "score").alias("p"))
    tp, fp = F.col("p.pos_run"), F.col("p.neg_run")
    return last.select(
        "p.score",
        tp.alias("tp"),
        fp.alias("fp"),
        F.round(F.try_divide(fp, F.col("p.neg_all")), digits).alias("fpr"),
        F.round(F.try_divide(tp, F.col("p.pos_all")), digits).alias("tpr"),
        F.round(F.try_divide(tp, tp + fp), digits).alias("precision"),
    )


def thinned_area(thinned: DataFrame, digits: int = 6) -> DataFrame:
    """``auc_roc, largest_error``: the area under a thinned curve and how far the exact one can lie from it.

    Between two points that stayed, the exact curve rises somewhere inside their box; the straight line halves that box, so half of all boxes is the most
    it can be off.
    """
    order = Window.orderBy("tp", "fp")  # as many rows as the curve has points
    step = thinned.select(
        "tp", "fp", F.lag("tp", 1, 0).over(order).alias("tp0"), F.lag("fp", 1, 0).over(order).alias("fp0"), F.max("tp").over(Window.partitionBy(F.lit(0))).alias("p"), F.max("fp").over(Window.partitionBy(F.lit(0))).alias("n")
    )
    whole = F.max("p").cast("double") * F.max("n")
    area = F.sum((F.col("fp") - F.col("fp0")) * (F.col("tp") + F.col("tp0")) / F.lit(2.0))
    boxes = F.sum((F.col("fp") - F.col("fp0")) * (F.col("tp") - F.col("tp0")) / F.lit(2.0))
    return step.agg(F.round(F.try_divide(area, whole), digits).alias("auc_roc"), F.round(F.try_divide(boxes, whole), digits).alias("largest_error"))


def areas(scores: DataFrame, rows_per_range: int = ROWS_PER_RANGE, digits: int = 6) -> DataFrame:
    """Exact area under the ROC and the PR curve.

    Every distinct score closes one trapezoid whose other side follows from its own counts, so the areas
    are plain sums. The PR curve starts at recall 0 with the precision of its first point.
    """
    run = running_totals(scores.filter("score is not null"), "score", ["pos", "neg"], descending=True, rows_per_range=rows_per_range)
    tp, fp, pos, neg = F.col("pos_run"), F.col("neg_run"), F.col("pos"), F.col("neg")
    above, wrong_above = tp - pos, fp - neg
    precision = F.try_divide(tp, tp + fp)
    precision_above = F.coalesce(F.try_divide(above, above + wrong_above), precision)
    return run.agg(
        F.round(
            F.try_divide(F.sum(neg * (above + pos / F.lit(2.0))), F.max("pos_all").cast("double") * F.max("neg_all")),
            digits,
        ).alias("auc_roc"),
        F.round(
            F.try_divide(F.sum(pos * (precision + precision_above) / F.lit(2.0)), F.max("pos_all")), digits
        ).alias("auc_pr"),
    )


def mllib_areas(scored: DataFrame, label: str, raw: str = "rawPrediction", digits: int = 4) -> DataFrame:
    """Both areas by MLlib's evaluator, which thins the curve to 1,000 points."""
    found = [
        round(BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName=m).evaluate(scored), digits)
        for m in ("areaUnderROC", "areaUnderPR")
    ]
    return scored.sparkSession.createDataFrame([tuple(found)], "auc_roc double, auc_pr double")


def evaluate(df: DataFrame, label: str, score: Column | None = None, prediction: str = "prediction", scores: DataFrame | None = None) -> DataFrame:
    """All headline metrics of one model in one row, with the rows that it gave no score and that its areas leave out.

    ``scores`` is what ``by_score`` gave for ``df`` where that is there already.
    """
    cells = materialise(confusion_cells(df, label, prediction), "confusion")
    scores = scores if scores is not None else by_score(df, label, score)
    one = positive_class_report(cells).select(
        "tp", "fp", "tn", "fn",
        F.col("precision").alias("true_precision"),
        F.col("recall").alias("true_recall"),
        F.col("accuracy").alias("true_accuracy"),
    )
    metrics = one.withColumn("_one", F.lit(1))
    without = unscored(scores).select(F.col("pos").alias("unscored_pos"), F.col("neg").alias("unscored_neg"))
    for more in (weighted_report(cells), areas(scores, digits=4), without):
        metrics = metrics.join(F.broadcast(more.withColumn("_one", F.lit(1))), "_one")
    return metrics.drop("_one")


def leaderboard(reports: dict[str, DataFrame]) -> DataFrame:
    """One row per model, best area under the ROC curve first."""
    rows = [r.select(F.lit(name).alias("model"), "*") for name, r in reports.items()]
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("auc_roc"), "model")
