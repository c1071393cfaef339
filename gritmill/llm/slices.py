"""Vectors as whole numbers, in chunks of bounded size, each chunk cut into blocks of columns."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.llm.shared import with_fields, written

#: Whole numbers of a chunk, so that a chunk of wide vectors has fewer of them.
CHUNK_CELLS = 1 << 18
CHUNK_ROWS = 4_096
SLICE = "chunk long, block int, n int, kind string, cells binary"


def finite_vectors(rows: DataFrame, keep: Sequence[str], vector_col: str, order: Column, length: int | None = None) -> DataFrame:
    """``row, turn, v``: rows whose vector has only finite components, and ``length`` of them where that is given.

    ``row`` holds the columns of ``keep``, so no name of the user's table meets one of ours; ``turn`` is where a row stands.
    """
    v = F.col(vector_col).cast("array<double>")
    out = rows.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), order.alias("turn"), v.alias("v"))
    fine = F.expr("v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return out.filter(fine if length is None else fine & (F.size("v") == length))


def most_cell(width: int) -> int:
    """The largest number whose squared distances over ``width`` components fit into a long."""
    return math.isqrt((2**63 - 1) // (4 * max(width, 1)))


def whole_numbers(vectors: list, width: int, scale: int) -> np.ndarray:
    """``floor(scale * x)``, rows filled up with zeros; a ValueError where distances would outgrow a long."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    out = np.floor(out * scale)
    if out.size and np.abs(out).max() > most_cell(width):
        raise ValueError(f"components of {scale} times {np.abs(out).max() / scale:.3g} have squared distances beyond 64 bits")
    return out.astype(np.int64)


def narrow(numbers: np.ndarray) -> tuple[str, bytes]:
    """The narrowest kind that holds all numbers, and their bytes."""
    low, high = (int(numbers.min()), int(numbers.max())) if numbers.size else (0, 0)
    kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return kind, np.ascontiguousarray(numbers, kind).tobytes()


def numbers(kind: str, cells: bytes, n: int) -> np.ndarray:
    return np.frombuffer(cells, kind).astype(np.int64).reshape(n, -1 if n and len(cells) else 0)


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every entry."""
    most = max((int(np.abs(a).max()) if a.size else 0) for a in (x, entries))
    if 4 * x.shape[1] * most * most < 2**53:  # every sum is a whole number that a double holds
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def _chunks(batches, width: int, scale: int, rows: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Chunks of at most ``rows`` vectors, numbered by task and place."""
    first, held, count = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, rows - count)
            held.append(piece)
            at, count = at + piece.num_rows, count + piece.num_rows
            if count == rows:
                yield first, *_joined(held, width, scale)
                first, held, count = first + 1, [], 0
    if held:
        yield first, *_joined(held, width, scale)


def _joined(held: list[pa.RecordBatch], width: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    whole = pa.Table.from_batches(held).combine_chunks()
    lists = whole.column("v").chunk(0)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes == width).all():
        flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)
        return whole.column("row").chunk(0), whole_numbers(flat, width, scale)
    return whole.column("row").chunk(0), whole_numbers(lists.to_pylist(), width, scale)


def sliced(vectors: DataFrame, width: int, blocks: int, scale: int, label: str) -> tuple[DataFrame, DataFrame]:
    """The written slices ``chunk, block, n, kind, cells`` and the names ``chunk, rows`` of all vectors, without a shuffle.

    A chunk holds rows of one task in their order, so copies of a row or of an id never gather anywhere.
    """
    rows = max(1, min(CHUNK_ROWS, CHUNK_CELLS // max(width, 1)))
    cuts = [width * b // blocks for b in range(blocks + 1)]
    source = vectors.select("row", "v")
    named = with_fields(source.select(F.array("row").alias("rows")), SLICE)

    def cut(batches):
        for chunk, names, x in _chunks(batches, width, scale, rows):
            parts = [narrow(x[:, a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            lists = pa.ListArray.from_arrays(pa.array([0, len(x)] + [len(x)] * (blocks - 1), pa.int32()), names)
            arrays = [lists, pa.array([chunk] * blocks), pa.array(range(blocks), pa.int32()), pa.array([len(x)] * blocks, pa.int32())]
            arrays += [pa.array([k for k, _ in parts]), pa.array([c for _, c in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, named.names)

    kept = written(source.mapInArrow(cut, named), label)
    slices = kept.drop("rows")
    slices._written_at = kept._written_at
    return slices, kept.filter("block = 0").select("chunk", "rows")


def first_vectors(vectors: DataFrame, k: int, width: int, scale: int) -> np.ndarray:
    """The ``k`` vectors that stand first, nulls last; equal turns go by the vectors themselves."""
    found = vectors.orderBy(F.col("turn").asc_nulls_last(), "v").limit(k).select("v").collect()
    return whole_numbers([r["v"] for r in found], width, scale)


def floor_means(sums: np.ndarray, counts: np.ndarray, before: np.ndarray) -> np.ndarray:
    """``floor(sum / count)`` of every entry that has rows; others stay."""
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], before)
