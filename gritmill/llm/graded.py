"""Ordinal quality classifier: cumulative-link regression on graded ratings over hashed text.

All grades share one weight vector over hashed words, their shapes and repeats; ordered thresholds cut its score into grades:
P(grade >= k) = 1 / (1 + exp(threshold_k - score)). The expected grade and the probability of the upper tail select documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.llm.mixing_training import mixed
from gritmill.llm.shared import drawn, with_fields, written
from gritmill.llm.words import ALNUM, mix, sliced, words_of

BITS = 17  # hashed words, and as many hashed shapes
SAMPLE = 12_000  # about as many rated documents are learnt from; the only bound, and only on training
RARE = 3  # words of fewer sampled documents don't count
STEPS = 150
RATE = 0.3
PENALTY = 3e-5
SHAPE_SCALE = 3.0
MAX_GRADES = 32
_REPEAT = np.uint64(0xD0B1E)


def _counted(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pairs, counts = np.unique((owner << BITS) + (hashes >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    return pairs >> BITS, pairs & ((1 << BITS) - 1), counts


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, feature, value)`` of all texts and the number of words of each.

    Words are runs of letters and digits; shapes belong to runs of anything but white space, as do repeats of the run before.
    Shapes weigh by the square root of their share of the text; words weigh less in longer texts, but not as much less.
    """
    words = words_of(column, ALNUM)
    n = np.diff(words.first)
    own, feature, counts = _counted(np.repeat(np.arange(len(n)), n), words.hashes())
    value = np.sqrt(counts) / n[own] ** 0.35
    runs = words_of(column)
    n = np.diff(runs.first)
    text, hashes = np.repeat(np.arange(len(n)), n), runs.hashes()
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])) + 1
    repeat = np.full(len(again), mix(np.array([_REPEAT]))[0], np.uint64)
    of, shape, counts = _counted(np.concatenate((text, text[again])), np.concatenate((runs.shapes(), repeat)))
    owner = np.concatenate((own, of))
    order = np.argsort(owner, kind="stable")
    every = np.concatenate((feature, shape + (1 << BITS)))[order]
    return owner[order], every, np.concatenate((value, SHAPE_SCALE * np.sqrt(counts / n[of])))[order], n


def _featured(batches):
    for batch in sliced(batches, "text"):
        owner, feature, value, n = features(batch.column("text"))
        cuts = np.searchsorted(owner, np.arange(len(n) + 1)).tolist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("trainer"), batch.column("id"), batch.column("grade"),
                pa.array([feature[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                pa.array([value[a:b].astype(np.float32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
            ],
            ["trainer", "id", "grade", "features", "values"],
        )


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _thresholds(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds: the first one, then steps that exp keeps positive."""
    return np.cumsum(np.concatenate((free[:1], np.exp(np.clip(free[1:], -8, 8)))))


def odds_scale(owner: np.ndarray, feature: np.ndarray, grade: np.ndarray, grades: int) -> np.ndarray:
    """How much each word tells the best grade from the others: the size of its log odds ratio over sampled documents; shapes keep 1."""
    best = grade[owner] == grades - 1
    inside, outside = (np.bincount(feature[x], minlength=2 << BITS).astype(np.float64) for x in (best, ~best))
    n = np.array([(grade == grades - 1).sum(), (grade < grades - 1).sum()])
    scale = np.abs(np.log((inside + 2) / (n[0] + 4)) - np.log((outside + 2) / (n[1] + 4)))
    scale[inside + outside < RARE] = 0.0
    scale[1 << BITS :] = 1.0
    return scale


def _fit(grades: int):
    def fit(weights: np.ndarray, rows: pa.Table, turn: int) -> np.ndarray:
        """Maximum of the penalised likelihood by gradient steps with running moments, over all rows at a time."""
        rows = rows.sort_by("id")
        parts = [np.frombuffer(x, np.int32) for x in rows.column("features").to_pylist()]
        feature = np.concatenate(parts)
        owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        value = np.concatenate([np.frombuffer(x, np.float32) for x in rows.column("values").to_pylist()]).astype(np.float64)
        y = rows.column("grade").to_numpy()
        scale = odds_scale(owner, feature, y, grades)
        value *= scale[feature]
        x = np.zeros((2 << BITS) + grades - 1)
        mean, square = np.zeros(len(x)), np.zeros(len(x))
        w, free = x[: 2 << BITS], x[2 << BITS :]
        free[0] = -1.0
        for step in range(1, STEPS + 1):
            score = np.bincount(owner, w[feature] * value, len(y))
            cut = np.concatenate(([-np.inf], _thresholds(free), [np.inf]))
            above, below = _sigmoid(cut[y + 1] - score), _sigmoid(cut[y] - score)  # P(grade <= y), P(grade < y)
            above[y == grades - 1], below[y == 0] = 1.0, 0.0
            p = np.maximum(above - below, 1e-9)
            up, low = above * (1 - above) / p, below * (1 - below) / p
            by_cut = np.bincount(y + 1, up, grades + 1) - np.bincount(y, low, grades + 1)
            by_free = np.cumsum(by_cut[1:-1][::-1])[::-1].copy()
            by_free[1:] *= np.exp(np.clip(free[1:], -8, 8))
            g = np.concatenate((np.bincount(feature, value * (low - up)[owner], 2 << BITS), by_free)) / len(y)
            g[: 2 << BITS] -= PENALTY * w
            mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
            x += RATE / (1 + step / 100) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-4)
        return np.concatenate((w * scale, free))

    return fit


@dataclass
class GradedModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """P(grade >= k) for k from 1, one row a text, and the texts' numbers of words."""
        owner, feature, value, n = features(column)
        score = np.bincount(owner, self.weights[feature] * value, len(n))
        return _sigmoid(score[:, None] - self.thresholds[None, :]), n


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", sample: int = SAMPLE) -> GradedModel | None:
    """Fit on about ``sample`` rated documents, chosen by a hash of their id; None without any.

    ``ratings`` holds ``id_col`` and whole grades from 0 on; null grades and ids are left out, and of several ratings of one
    document the lowest counts.
    """
    rated = ratings.select(F.col(id_col).cast("long").alias("id"), F.col(grade_col).cast("int").alias("grade")).dropna()
    count, top = rated.agg(F.count("*"), F.max("grade")).first()
    if not count:
        return None
    if top >= MAX_GRADES:
        raise ValueError(f"grades go up to {top}; at most {MAX_GRADES} grades are supported")
    grades = max(2, top + 1)
    few = rated.filter(drawn(F.col("id"), sample / count)).groupBy("id").agg(F.min("grade").alias("grade"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    chosen = texts.join(F.broadcast(few), "id").withColumn("trainer", F.lit(0))  # few: about ``sample`` rows
    rows = chosen.select("trainer", "id", "grade", "text").mapInArrow(_featured, "trainer int, id long, grade int, features binary, values binary")
    fitted = mixed(written(rows, "rated"), np.zeros((2 << BITS) + grades - 1), _fit(grades), rounds=1)
    return GradedModel(fitted[: 2 << BITS].astype(np.float64), _thresholds(fitted[2 << BITS :].astype(np.float64)))


def _graded(shared, least: float):
    def grade(batches):
        model: GradedModel | None = shared.value
        for batch in sliced(batches, "text"):
            if model is None:
                tails, n = np.ones((batch.num_rows, 1)), np.diff(words_of(batch.column("text")).first)
            else:
                tails, n = model.tails(batch.column("text"))
            tails[n == 0] = 0.0  # nothing to select
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= least)], ["row", "expected_grade", "tail", "selected"]
            )

    return grade


def graded(docs: DataFrame, model: GradedModel | None, keep: list[str], text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``row`` (a struct of the columns ``keep``), ``expected_grade``, ``tail`` = P(best grade) and ``selected`` = tail >= ``least``.

    A text that is null or has no word has grade 0 and isn't selected. Without a model all texts with words are selected.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_graded(shared, least), with_fields(rows.select("row"), "expected_grade double, tail double, selected boolean"))


def rating_grade() -> Column:
    """0 for poor and toxic, 1 for either, 2 for neither, from the columns ``quality`` and ``toxic`` of ratings."""
    return F.col("quality") + 1 - F.col("toxic")
