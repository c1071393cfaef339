"""Training by mixed parameters: trainers fit their own share of a bounded sample, and the means of their weights go on."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def _trainer(shared, fit, turn: int):
    def train(rows: pa.Table) -> pa.Table:
        new = fit(shared.value.copy(), rows, turn)
        return pa.table({"rows": pa.array([rows.num_rows], pa.int64()), "weights": pa.array([new.astype(np.float32).tobytes()], pa.binary())})

    return train


def mixed(sample: DataFrame, start: np.ndarray, fit: Callable[[np.ndarray, pa.Table, int], np.ndarray], rounds: int, trainer: str = "trainer") -> np.ndarray:
    """Weights after ``rounds`` rounds. ``fit(weights, rows of a trainer, round)`` returns the trainer's new weights.

    ``sample`` is bounded and written. Only one vector for each trainer comes back in a round.
    """
    weights = start.astype(np.float32)
    spark = sample.sparkSession
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(weights)
        found = sample.groupBy(trainer).applyInArrow(_trainer(shared, fit, turn), "rows long, weights binary").collect()
        if not found:
            return weights
        shares = np.array([r["rows"] for r in found], np.float64)
        every = np.stack([np.frombuffer(r["weights"], np.float32) for r in found])
        order = np.lexsort(every[:, :8].T)  # the same sum whatever order the rows come in
        weights = ((shares / shares.sum())[order, None] * every[order]).sum(axis=0).astype(np.float32)
        shared.unpersist()
    return weights
