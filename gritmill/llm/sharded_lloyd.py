"""Lloyd's clustering of vectors whose columns are dealt out: each task sees a block of columns and that block's centroids only.

Vectors become whole numbers in chunks, and every chunk is cut into blocks of columns. In a round, tasks compute the exact partial squared
distances of a block against the block's slice of the centroids; the blocks of a chunk are added up by key, which gives the
nearest centroid of each vector; these labels go back to the blocks, and each block sums its own columns and updates its own slice.
No task ever holds a whole vector or a whole centroid, so the width of the vectors is not bounded by a task's memory.

The slices lie in a table bucketed by chunk and block: the labels travel to them, one small number a vector and block, and the slices never move
again. What reaches the driver is the model, ``k`` times the width, whatever the number of vectors.

Rules: a vector that is null, of another length than ``width``, or with null or non-finite components takes no part. Rows that repeat are so many vectors.
Rows whose place in the order of the start is null stand last; equal places go by the components. Fewer vectors than ``k`` make as many
centroids; none, an empty result. Equal distances go to the smaller number. A centroid without vectors stays where it is. Components whose squared
distances don't fit into 64 bits stop the job with a ValueError.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.llm.shared import discard, with_fields, written
from gritmill.llm.slices import finite_vectors, first_vectors, floor_means, narrow, numbers, sliced, squared_distances
from gritmill.session import fresh_path
from gritmill.sources.tables import bucket_count, write_bucketed

BLOCK_COLUMNS = 16
SLICES_OF_BUCKET = 512


def _partial(slices: dict[int, np.ndarray]):
    """Squared distances of a block's columns to the block's slice of every centroid."""

    def compute(batches):
        for batch in batches:
            out = []
            for chunk, block, n, kind, cells in zip(*[batch.column(c).to_pylist() for c in ("chunk", "block", "n", "kind", "cells")], strict=True):
                out.append((chunk, n, *narrow(squared_distances(numbers(kind, cells, n), slices[block]))))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1], pa.int32()), pa.array(columns[2]), pa.array(columns[3], pa.binary())], ["chunk", "n", "kind", "cells"])

    return compute


def _added(whole: pa.Table) -> pa.Table:
    """The blocks of one chunk added up, and the nearest centroid of each of its vectors."""
    total = sum(numbers(r["kind"], r["cells"], r["n"]) for r in whole.to_pylist())
    near = total.argmin(axis=1)  # the first of equal ones
    kind, labels = narrow(near)
    least = total[np.arange(len(near)), near].astype("<i8").tobytes()
    return pa.table({"chunk": whole.column("chunk").slice(0, 1), "label_kind": pa.array([kind]), "labels": pa.array([labels], pa.binary()), "least": pa.array([least], pa.binary())})


def _summed(k: int, widths: list[int]):
    """Each block's sums and counts of every label, added up over the task."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                x, labels = numbers(r["kind"], r["cells"], r["n"]), numbers(r["label_kind"], r["labels"], r["n"])[:, 0]
                b = r["block"]
                sums.setdefault(b, np.zeros((k, widths[b]), np.int64))
                np.add.at(sums[b], labels, x)
                counts[b] = counts.get(b, 0) + np.bincount(labels, minlength=k)
        for b, s in sums.items():
            n = s.shape[1]
            cells = [np.full(s.size, b, np.int32), np.repeat(np.arange(k, dtype=np.int32), n), np.tile(np.arange(n, dtype=np.int32), k), s.ravel(), np.repeat(counts[b], n)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["block", "cluster", "place", "total", "count"])

    return add


def _named(batches):
    """A row for each vector."""
    for batch in batches:
        for i, (kind, labels, least) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("label_kind", "labels", "least")], strict=True)):
            names = batch.column("rows").slice(i, 1).flatten()
            cluster = np.frombuffer(labels, kind).astype(np.int32)
            yield pa.RecordBatch.from_arrays([names, pa.array(cluster), pa.array(np.frombuffer(least, "<i8"))], ["row", "cluster", "distance"])


class BucketedSlices:
    """The slices in a table bucketed by chunk and block, in the shared folder; joins on both columns don't move it."""

    def __init__(self, slices: DataFrame):
        self.spark = slices.sparkSession
        n = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-slices.count() // SLICES_OF_BUCKET))
        path = fresh_path(self.spark, "bucketed")
        self.rows, self.name = write_bucketed(slices, ["chunk", "block"], bucket_count(self.spark, n), path)
        self.rows._written_at = path

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.rows)


def labelled(slices: DataFrame, centroids: list[np.ndarray]) -> DataFrame:
    """``chunk, label_kind, labels, least``: the nearest centroid of every vector of a chunk, and the squared distance."""
    parts = slices.mapInArrow(_partial(dict(enumerate(centroids))), "chunk long, n int, kind string, cells binary")
    return parts.groupBy("chunk").applyInArrow(_added, "chunk long, label_kind string, labels binary, least binary")


def updated(slices: DataFrame, labels: DataFrame, centroids: list[np.ndarray]) -> list[np.ndarray]:
    """Every block's slice of the centroids after a round."""
    k, widths = len(centroids[0]), [c.shape[1] for c in centroids]
    to_blocks = labels.select("chunk", "label_kind", "labels", F.explode(F.sequence(F.lit(0), F.lit(len(widths) - 1))).alias("block"))
    sums = slices.join(to_blocks, ["chunk", "block"]).mapInArrow(_summed(k, widths), "block int, cluster int, place int, total long, count long")
    out = [(np.zeros((k, w), np.int64), np.zeros(k, np.int64)) for w in widths]
    for r in sums.groupBy("block", "cluster", "place").agg(F.sum("total").alias("total"), F.sum("count").alias("count")).toLocalIterator():
        out[r["block"]][0][r["cluster"], r["place"]] = r["total"]
        out[r["block"]][1][r["cluster"]] = r["count"]
    return [floor_means(s, n, c) for (s, n), c in zip(out, centroids, strict=True)]


def clustered(
    rows: DataFrame,
    keep: Sequence[str],
    order: Column,
    *,
    vector_col: str = "embedding",
    width: int = 64,
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
    block_columns: int = BLOCK_COLUMNS,
) -> tuple[DataFrame, list[list[int]]]:
    """``row, cluster, distance`` for every vector that takes part, and the final centroids, in whole numbers of ``1 / scale``.

    ``row`` holds the columns of ``keep``. The first ``k`` vectors by ``order`` are the centroids of the start.
    """
    vectors = finite_vectors(rows, keep, vector_col, order, width)
    start = first_vectors(vectors, k, width, scale)
    blocks = max(1, -(-width // block_columns))
    cuts = [width * b // blocks for b in range(blocks + 1)]
    centroids = [start[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    if not len(start):
        return rows.sparkSession.createDataFrame([], with_fields(vectors.select("row"), "cluster int, distance long")), []
    slices, names = sliced(vectors, width, blocks, scale, "slices")
    table = BucketedSlices(slices)
    for _ in range(rounds):
        centroids = updated(table.rows, labelled(table.rows, centroids), centroids)
    found = names.join(labelled(table.rows, centroids), "chunk").mapInArrow(_named, with_fields(vectors.select("row"), "cluster int, distance long"))
    found = written(found, "clustered")
    table.drop()
    discard(slices)
    return found, np.concatenate(centroids, axis=1).tolist()
