"""Search over settings and classifiers: rungs of rising rows and iterations, then another try with other classifiers where the result is too weak.

A rung fits every setting that is left on a share of the training rows with a share of its iterations (or trees), ranks them by their exact AUC on rows
held back by a hash of the key, and passes the best on. The samples are nested, as a key's hash decides where it enters, so nothing depends on the partitioning.
The last rung has all rows and all iterations. MLlib's public interface starts no fit from an earlier model, so a rung begins anew; its lower
cost comes from its fewer rows and iterations alone.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from gritmill.functions.columns import col, hash_long
from gritmill.operators.training import (
    GOOD_ENOUGH,
    MAX_ITERATIONS,
    SIMPLEST_FIRST,
    NEAR_TIE,
    Trained,
    classifier,
    grid_for,
    held_out_auc,
)
from gritmill.session import shared_folder

#: Share of the training rows and of the iterations in each rung; the last one is whole.
RUNGS = ((0.11, 0.2), (0.33, 0.5), (1.0, 1.0))
KEPT = 1 / 3
VALIDATION_PERCENT = 25
#: Fits that are under way at the same time; each is a job of its own on the same cached rows.
FITS_AT_ONCE = 6
#: Settings that count iterations or trees.
EFFORT = ("maxIter", "numTrees")
#: Two classifiers at a time, the ones tried first in front.
PORTFOLIO = (("LogisticRegression", "GBTClassifier"), ("RandomForestClassifier", "LinearSVC"))
LOG = "iteration int, model string, settings string, rung int, row_share double, effort_share double, auc double, passed boolean"


@dataclass(frozen=True)
class Found:
    """Every fit of the search, the winner, and the trained models by name."""

    log: DataFrame
    decisions: DataFrame
    winner: str
    trained: dict[str, Trained]


def place(keys: Sequence[str], purpose: str):
    """A number from 0 to 1 for each key, of other digits for each purpose."""
    return hash_long(*[col(k) for k in keys], F.lit(purpose)) / F.lit(float(16**13))


def text_of(setting: Mapping) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(setting.items(), key=lambda x: x[0].name))


def lessened(setting: Mapping, share: float) -> dict:
    """The same setting with a share of its iterations."""
    return {p: max(1, math.ceil(v * share)) if p.name in EFFORT else v for p, v in setting.items()}


def climbed(
    fit_rows: DataFrame,
    held_back: DataFrame,
    name: str,
    label: str,
    keys: Sequence[str],
    grid: Mapping[str, Sequence[object]],
    rungs: Sequence[tuple[float, float]] = RUNGS,
    kept: float = KEPT,
    parallelism: int = FITS_AT_ONCE,
) -> tuple[dict, list[tuple]]:
    """The best setting of a grid, and ``(settings, rung, row share, effort share, auc, passed)`` for every fit.

    Equal values go to the setting that comes first in the grid.
    """
    estimator = classifier(name, label)
    settings, _ = grid_for(estimator, grid)
    # No binning: the area over all distinct scores.
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)
    left, entries = list(range(len(settings))), []
    for rung, (row_share, effort) in enumerate(rungs, 1):
        sample = (fit_rows.filter(place(keys, "rung") < row_share) if row_share < 1 else fit_rows).persist(StorageLevel.MEMORY_AND_DISK)

        def auc_of(i: int, sample=sample, effort=effort) -> float:
            return float(evaluator.evaluate(estimator.fit(sample, lessened(settings[i], effort)).transform(held_back)))

        try:
            with ThreadPool(parallelism) as pool:
                found = dict(zip(left, pool.map(auc_of, left), strict=True))
        finally:
            sample.unpersist()
        ranked = sorted(left, key=lambda i: (-found[i], i))
        going_on = set(ranked[: 1 if rung == len(rungs) else max(1, math.ceil(len(ranked) * kept))])
        entries += [(text_of(settings[i]), rung, row_share, effort, found[i], i in going_on) for i in left]
        left = [i for i in left if i in going_on]
    return settings[left[0]], entries


def refined(best: Mapping[str, object], grid: Mapping[str, Sequence[object]]) -> dict[str, list[object]]:
    """A grid around the best setting: half and twice each positive number that was searched (whole numbers stay whole)."""
    out: dict[str, list[object]] = {}
    for setting, values in grid.items():
        v = best[setting]
        if len(values) > 1 and isinstance(v, (int, float)) and not isinstance(v, bool) and v > 0 and setting not in ("elasticNetParam", "subsamplingRate"):
            around = (max(1, v // 2), v, v * 2) if isinstance(v, int) else (v / 2, v, v * 2)
            out[setting] = list(dict.fromkeys(around))
        else:
            out[setting] = [v]
    return out


def winner_among(aucs: Mapping[str, float]) -> str:
    """Highest AUC, unless a simpler model is less than 0.02 behind."""
    best = max(aucs.values())
    simple = {n: i for i, n in enumerate(SIMPLEST_FIRST)}
    close = [n for n, a in aucs.items() if best - a < NEAR_TIE or a == best]
    return min(close, key=lambda n: (simple.get(n, len(simple)), -aucs[n], n))


def search(
    train: DataFrame,
    test: DataFrame,
    label: str,
    keys: Sequence[str],
    grids: Mapping[str, Mapping[str, Sequence[object]]],
    portfolio: Sequence[Sequence[str]] = PORTFOLIO,
    rungs: Sequence[tuple[float, float]] = RUNGS,
    good_enough: float = GOOD_ENOUGH,
    max_iterations: int = MAX_ITERATIONS,
) -> Found:
    """Try the portfolio's classifiers in turn until the winner is good enough or the iterations are used up.

    A later iteration takes classifiers that were not tried yet, and the best one so far once more over a grid around its best setting. Each classifier's
    best setting is fitted on all training rows and judged on ``test``; the winner is taken among all that were tried.
    """
    spark = train.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    rows = train.persist(StorageLevel.MEMORY_AND_DISK)
    back = place(keys, "validation") * 100 < VALIDATION_PERCENT
    held_back, fit_rows = rows.filter(back).persist(StorageLevel.MEMORY_AND_DISK), rows.filter(~back)
    log, decisions, trained, aucs = [], [], {}, {}
    winner = ""
    try:
        for iteration, names in enumerate(portfolio[:max_iterations], 1):
            tried = {n: grids[n] for n in names}
            if winner:
                tried[winner] = refined(trained[winner].best, grids[winner])
            for name, grid in tried.items():
                best, entries = climbed(fit_rows, held_back, name, label, keys, grid, rungs)
                log += [(iteration, name, *e) for e in entries]
                model = classifier(name, label).fit(rows, best)
                one = Trained(name, model, {p.name: v for p, v in best.items()}, grid_for(classifier(name, label), grid)[1], [(e[0], round(e[4], 4)) for e in entries if e[1] == len(rungs)])
                auc = held_out_auc(one, test, label)
                if auc > aucs.get(name, -1.0):
                    trained[name], aucs[name] = one, auc
            winner = winner_among(aucs)
            accept = aucs[winner] >= good_enough or iteration >= min(max_iterations, len(portfolio))
            decisions.append((iteration, winner, aucs[winner], "accept" if accept else "retrain"))
            if accept:
                break
    finally:
        held_back.unpersist()
        rows.unpersist()
    return Found(
        spark.createDataFrame(log, LOG),
        spark.createDataFrame(decisions, "iteration int, winner string, winner_auc double, next_action string"),
        winner,
        trained,
    )
