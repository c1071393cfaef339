"""Evaluation over rows scored by fixed formulas, so that SQL can check every number."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.operators import evaluating as evaluate
from gritmill.operators import training as fit
from gritmill.operators.runs import evaluate_saved_models
from gritmill.session import fresh_path, materialise
from gritmill.sources.runs import save_run
from gritmill.workload.registry import query
from gritmill.workload.views import table

# The label and four scores of increasing use, as expressions both engines read alike.
TRUTH = "CASE WHEN l_quantity + l_tax * 100 > 28 THEN 1 ELSE 0 END"
SCORES = {
    "by_discount": "l_discount * 10",
    "by_tax": "l_tax * 12 + l_discount",
    "by_quantity": "l_quantity / 50",
    "by_both": "l_quantity / 54 + l_tax",
}
PREFERENCE = ["by_discount", "by_tax", "by_quantity", "by_both"]


def scored(spark, sf, name: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        f"{TRUTH} AS y", f"{SCORES[name]} AS score", f"CASE WHEN {SCORES[name]} >= 0.5 THEN 1.0D ELSE 0.0D END AS prediction"
    )


def scored_sql(name: str, view: str = "s") -> str:
    return (
        f"{view} AS (SELECT {TRUTH} AS y, {SCORES[name]} AS score, "
        f"CASE WHEN {SCORES[name]} >= 0.5 THEN 1 ELSE 0 END AS prediction FROM lineitem)"
    )


CELLS_SQL = """
    c AS (SELECT count(*) FILTER (y = 1 AND prediction = 1) AS tp, count(*) FILTER (y = 0 AND prediction = 1) AS fp,
                 count(*) FILTER (y = 0 AND prediction = 0) AS tn, count(*) FILTER (y = 1 AND prediction = 0) AS fn FROM s)
"""


def curve_sql(view: str = "s", out: str = "r") -> str:
    return f"""
    b{out} AS (SELECT score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM {view} GROUP BY 1),
    {out} AS (SELECT *, CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp, CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
           CAST(sum(pos) OVER () AS BIGINT) AS p, CAST(sum(neg) OVER () AS BIGINT) AS n FROM b{out})
    """


AREAS = """
    round(sum(neg * (tp - pos + pos / 2.0)) / (max(p)::DOUBLE * max(n)), 6) AS auc_roc,
    round(sum(pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN tp / (tp + fp)
          ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2.0) / max(p), 6) AS auc_pr
"""


@query(
    "confusion_matrix",
    f"WITH {scored_sql('by_quantity')} SELECT y AS actual, prediction AS predicted, count(*) AS n FROM s GROUP BY 1, 2",
)
def confusion_matrix(spark, sf):
    return evaluate.confusion(scored(spark, sf, "by_quantity"), "y")


@query(
    "positive_class_report",
    f"""
    WITH {scored_sql('by_quantity')}, {CELLS_SQL}
    SELECT *, round(tp / (tp + fp), 4) AS "precision", round(tp / (tp + fn), 4) AS recall, round((tp + tn) / (tp + fp + tn + fn), 4) AS accuracy,
           round(tp / (tp + fn), 4) AS sensitivity, round(tn / (tn + fp), 4) AS specificity FROM c
    """,
)
def positive_class_report(spark, sf):
    return evaluate.positive_class_report(evaluate.confusion_cells(scored(spark, sf, "by_quantity"), "y"))


@query(
    "weighted_report",
    f"""
    WITH {scored_sql('by_quantity')}, {CELLS_SQL}, t AS (SELECT *, tp + fp + tn + fn AS n FROM c)
    SELECT round((2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fn + fp) * (tn + fp)) / n, 4) AS f1,
           round((tp / (tp + fp) * (tp + fn) + tn / (tn + fn) * (tn + fp)) / n, 4) AS weighted_precision,
           round((tp + tn) / n, 4) AS weighted_recall, round((tp + tn) / n, 4) AS accuracy FROM t
    """,
)
def weighted_report(spark, sf):
    return evaluate.weighted_report(evaluate.confusion_cells(scored(spark, sf, "by_quantity"), "y"))


CURVE_COLUMNS = """
    score, tp, fp, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr, round(tp / (tp + fp), 6) AS "precision"
"""


@query("roc_and_pr_curve", f"WITH {scored_sql('by_both')}, {curve_sql()} SELECT {CURVE_COLUMNS} FROM r")
def roc_and_pr_curve(spark, sf):
    return evaluate.curve_points(evaluate.by_score(scored(spark, sf, "by_both"), "y", F.col("score")))


@query("roc_and_pr_curve_ranged", f"WITH {scored_sql('by_tax')}, {curve_sql()} SELECT {CURVE_COLUMNS} FROM r")
def roc_and_pr_curve_ranged(spark, sf):
    """The path for curves with too many points for one task."""
    scores = evaluate.by_score(scored(spark, sf, "by_tax"), "y", F.col("score"))
    return evaluate.curve_points(scores, rows_per_range=10)


def thinned_sql(name: str, points: int) -> str:
    steps = (points - 1) // 2
    return f"""
    WITH {scored_sql(name)}, {curve_sql()},
    kept AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY tp * {steps} // p + fp * {steps} // n ORDER BY score) = 1)"""


@query("roc_curve_thinned", f"{thinned_sql('by_both', 40)} SELECT {CURVE_COLUMNS} FROM kept")
def roc_curve_thinned(spark, sf):
    """A curve of at most 40 points."""
    return evaluate.thinned_curve(evaluate.by_score(scored(spark, sf, "by_both"), "y", F.col("score")), points=40)


@query(
    "roc_area_thinned",
    f"""
    {thinned_sql("by_both", 40)},
    steps AS (SELECT *, lag(tp, 1, 0) OVER (ORDER BY tp, fp) AS tp0, lag(fp, 1, 0) OVER (ORDER BY tp, fp) AS fp0 FROM kept),
    thin AS (SELECT round(sum((fp - fp0) * (tp + tp0) / 2.0) / (max(p)::DOUBLE * max(n)), 6) AS auc_roc, round(sum((fp - fp0) * (tp - tp0) / 2.0) / (max(p)::DOUBLE * max(n)), 6) AS largest_error FROM steps),
    a AS (SELECT {AREAS} FROM r)
    SELECT thin.auc_roc, largest_error, a.auc_roc AS exact_auc_roc, abs(a.auc_roc - thin.auc_roc) <= largest_error + 0.000001 AS within FROM thin, a
    """,
)
def roc_area_thinned(spark, sf):
    """The area under the short curve, next to the exact one and the largest error that the short one states of itself."""
    scores = evaluate.by_score(scored(spark, sf, "by_both"), "y", F.col("score"))
    thin = evaluate.thinned_area(evaluate.thinned_curve(scores, points=40))
    exact = evaluate.areas(scores).select(F.col("auc_roc").alias("exact_auc_roc"))
    off = F.abs(F.col("exact_auc_roc") - F.col("auc_roc")) <= F.col("largest_error") + 0.000001
    return thin.crossJoin(F.broadcast(exact)).withColumn("within", off)


@query("areas_under_curves", f"WITH {scored_sql('by_quantity')}, {curve_sql()} SELECT {AREAS} FROM r")
def areas_under_curves(spark, sf):
    return evaluate.areas(evaluate.by_score(scored(spark, sf, "by_quantity"), "y", F.col("score")))


def boards(spark, sf) -> DataFrame:
    rows = [
        evaluate.areas(evaluate.by_score(scored(spark, sf, name), "y", F.col("score"))).withColumn("model", F.lit(name))
        for name in SCORES
    ]
    return reduce(DataFrame.unionByName, rows)


BOARD_SQL = (
    ", ".join(f"{scored_sql(n, f's_{n}')}, {curve_sql(f's_{n}', f'r_{n}')}" for n in SCORES)
    + ", board AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS model, {AREAS} FROM r_{n}" for n in SCORES)
    + ")"
)


@query("formula_leaderboard", f"WITH {BOARD_SQL} SELECT * FROM board ORDER BY auc_roc DESC, model")
def formula_leaderboard(spark, sf):
    return boards(spark, sf).orderBy(F.desc("auc_roc"), "model")


WINNER_SQL = f"""
    {BOARD_SQL}, ranked AS (SELECT model AS winner, auc_roc AS winner_auc, list_position([{", ".join(f"'{p}'" for p in PREFERENCE)}], model) AS place
    FROM board WHERE (SELECT max(auc_roc) FROM board) - auc_roc < 0.02 ORDER BY place LIMIT 1)
"""


@query("winner_of_formulas", f"WITH {WINNER_SQL} SELECT winner, winner_auc FROM ranked")
def winner_of_formulas(spark, sf):
    order = F.array_position(F.array(*[F.lit(p) for p in PREFERENCE]), F.col("model"))
    return fit.pick_winner(materialise(boards(spark, sf), "board"), "model", "auc_roc", order)


@query(
    "next_action_after_training",
    f"WITH {WINNER_SQL} SELECT winner, winner_auc, CASE WHEN winner_auc >= 0.8 THEN 'accept' ELSE 'retrain' END AS next_action FROM ranked",
)
def next_action_after_training(spark, sf):
    return fit.next_action(winner_of_formulas(spark, sf), iteration=1)


def summary_sql(name: str) -> str:
    """All headline metrics of one formula."""
    return f"""
    SELECT * FROM (
        WITH {scored_sql(name)}, {CELLS_SQL}, {curve_sql()}, t AS (SELECT *, tp + fp + tn + fn AS total FROM c), a AS (SELECT {AREAS} FROM r)
        SELECT tp, fp, tn, fn, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS true_precision, round(tp / (tp + fn), 4) AS true_recall,
               round((tp + tn) / total, 4) AS true_accuracy,
               round((2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fn + fp) * (tn + fp)) / total, 4) AS f1,
               round((coalesce(tp / nullif(tp + fp, 0), 0) * (tp + fn) + coalesce(tn / nullif(tn + fn, 0), 0) * (tn + fp)) / total, 4) AS weighted_precision,
               round((tp + tn) / total, 4) AS weighted_recall, round((tp + tn) / total, 4) AS accuracy,
               round(auc_roc, 4) AS auc_roc, round(auc_pr, 4) AS auc_pr,
               (SELECT count(*) FROM s WHERE score IS NULL AND y = 1) AS unscored_pos, (SELECT count(*) FROM s WHERE score IS NULL AND y = 0) AS unscored_neg
        FROM t, a
    )"""


@query("evaluation_summary", summary_sql("by_both"))
def evaluation_summary(spark, sf):
    return evaluate.evaluate(scored(spark, sf, "by_both"), "y", F.col("score"))


def formula_model(name: str) -> PipelineModel:
    """A fixed score as a model that can be saved and loaded like any other."""
    statement = f"SELECT *, 1 - {SCORES[name]} AS _low, {SCORES[name]} AS _high, CASE WHEN {SCORES[name]} >= 0.5 THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=statement), VectorAssembler(inputCols=["_low", "_high"], outputCol="rawPrediction")])


RUN_OF = {"by_discount": "monday", "by_tax": "monday", "by_quantity": "tuesday", "by_both": "tuesday"}


@query(
    "saved_models_evaluated",
    " UNION ALL ".join(f"SELECT '{RUN_OF[n]}' AS run, '{n}' AS model, *, CAST(NULL AS VARCHAR) AS problem FROM ({summary_sql(n)})" for n in SCORES),
)
def saved_models_evaluated(spark, sf):
    """Every model under a folder, of two runs, from the saved files alone; a third run that was never committed is not seen."""
    root = fresh_path(spark, "models")
    for run in ("monday", "tuesday"):
        save_run(spark, root, run, {n: formula_model(n) for n in SCORES if RUN_OF[n] == run}, {})
    save_run(spark, root, "wednesday", {"by_tax": formula_model("by_tax")}, {}, commit=False)
    lines = table(spark, sf, "lineitem").withColumn("y", F.expr(TRUTH))
    return evaluate_saved_models(spark, root, lines, "y")
