"""Vectors as short codes: each part of a vector is replaced by the number of its nearest entry in the part's codebook.

The codebooks are fitted by Lloyd's rounds with the adaptive bounds of Drake and Hamerly. Each part of each vector keeps an upper bound on the distance to its
own entry, its ``b`` next entries in order, a lower bound for each place of that order on the entries there and beyond, and one outer
bound on all others. When the entries have moved, the bounds move with them. A part whose upper bound lies below its first lower bound
keeps its entry without any distance; otherwise the distance to its own entry is taken anew, and only the entries up to the first place whose bound
lies above it are compared, by exact whole-number distances; past the outer bound all of them are. ``b`` is adapted for each part position after each
round: to the fewest places that nearly all vectors needed, and up again where many had to look through everything.

The bounds are single floats rounded outward (upper ones up, lower ones down) and compared strictly, so a skipped part is certain to keep its entry, and every
uncertain case, ties too, is decided by whole numbers: the result is that of plain rounds.

A row of the state is a chunk of vectors with all its bounds, written after each round in the shared folder; a round reads the last state,
writes the next and nothing is shuffled. What reaches the driver is the codebooks and a histogram for each part position.

Rules: a vector that is null or holds null or non-finite components takes no part. Shorter vectors count as filled up with zeros to the longest, and that to a
multiple of ``parts``. Rows that repeat are so many vectors. Rows whose place in the order of the start is null stand last; equal places go
by the components. Fewer vectors than ``entries`` make as many entries; none, an empty result. Equal distances go to the lower index; an entry that
nothing uses stays. Components whose squared distances don't fit into 64 bits stop the job with a ValueError.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.llm.shared import discard, with_fields, written
from gritmill.llm.slices import SLICE, finite_vectors, first_vectors, floor_means, numbers, sliced, squared_distances

#: Share of the vectors that may need more places than are kept.
BEYOND = 0.02
STATE = f"{SLICE}, near array<binary>, bounds array<binary>, sums array<bigint>, needs array<bigint>"


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _searched(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Own entry and the ``b`` next ones of every row, with their bounds, from all distances."""
    d = squared_distances(x, entries)
    order = np.argsort(d, axis=1, kind="stable")  # the lower index first among equal ones
    root = np.sqrt(np.take_along_axis(d, order[:, : b + 2], axis=1).astype(np.float64))
    if root.shape[1] < b + 2:  # no entry is left outside
        root = np.hstack([root, np.full((len(x), 1), np.inf)])
    bounds = np.hstack([_up(root[:, :1]), _down(root[:, 1:])])
    return order[:, : b + 1].astype(np.uint8 if len(entries) < 256 else np.uint16), bounds


def _resized(near: np.ndarray, bounds: np.ndarray, b: int, nobody: int) -> tuple[np.ndarray, np.ndarray]:
    """The same state with ``b`` places. A dropped place's bound becomes the outer one; a new place knows no entry and has the outer bound."""
    had = near.shape[1] - 1
    if b < had:
        return near[:, : b + 1], bounds[:, : b + 2]  # a place's bound holds for all beyond it
    more = b - had
    return np.hstack([near, np.full((len(near), more), nobody, near.dtype)]), np.hstack([bounds, np.repeat(bounds[:, -1:], more, axis=1)])


def _most_outside(near: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """How far any entry that a row doesn't keep has moved at most."""
    out, open_rows = np.zeros(len(near)), np.arange(len(near))
    for e in np.argsort(-moved, kind="stable"):
        kept = (near[open_rows] == e).any(axis=1)
        out[open_rows[~kept]] = moved[e]
        open_rows = open_rows[kept]
        if not len(open_rows):
            break
    return out


def _own(x: np.ndarray, near: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row to its own entry."""
    return ((x - entries[near[:, 0]]) ** 2).sum(axis=1)


def _moved_on(x: np.ndarray, near: np.ndarray, bounds: np.ndarray, entries: np.ndarray, moved: np.ndarray, b: int):
    """The state after the entries have moved by ``moved``, and how many vectors had to look into how many places."""
    k = len(entries)
    near, bounds = _resized(near, bounds, b, k)
    near, most = near.copy(), _most_outside(near, moved)[:, None]
    step = np.append(moved, 0)
    upper = _up(bounds[:, 0] + step[near[:, 0]])
    moves = np.where(near[:, 1:] == k, most, step[near[:, 1:]])  # a place without an entry is bounded like all outside
    lower = _down(bounds[:, 1:] - np.hstack([moves, most]))
    lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1].copy()  # a place's bound holds for all beyond it
    unsure = np.flatnonzero(upper >= lower[:, 0])
    upper[unsure] = _up(np.sqrt(_own(x[unsure], near[unsure], entries).astype(np.float64)))
    need = np.zeros(len(x), np.int64)
    need[unsure] = (upper[unsure, None] >= lower[unsure]).sum(axis=1)
    for z in range(1, b + 1):
        rows = np.flatnonzero(need == z)
        if len(rows):
            some = np.sort(near[rows, : z + 1], axis=1)
            d = ((x[rows, None, :] - entries[some]) ** 2).sum(axis=2)
            order = np.argsort(d, axis=1, kind="stable")
            near[rows, : z + 1] = np.take_along_axis(some, order, axis=1)
            root = np.sqrt(np.take_along_axis(d, order, axis=1).astype(np.float64))
            upper[rows] = _up(root[:, 0])
            lower[rows, :z] = np.minimum(_down(root[:, 1:]), lower[rows, z : z + 1])
    rows = np.flatnonzero(need == b + 1)
    bounds = np.hstack([upper[:, None], lower])
    if len(rows):
        near[rows], bounds[rows] = _searched(x[rows], entries, b)
    return near, bounds, np.bincount(need, minlength=b + 2)


def _round(books: np.ndarray, moved: np.ndarray | None, places: list[int]):
    """A round over chunks: new entries of all parts, with each part's sums, counts and needs."""
    parts, k, w = books.shape

    def go(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                x = numbers(r["kind"], r["cells"], r["n"])
                nears, bounds, sums, needs = [], [], [], []
                for p in range(parts):
                    own, b = x[:, p * w : (p + 1) * w], places[p]
                    if moved is None:
                        near, bound = _searched(own, books[p], b)
                        need = np.zeros(b + 2, np.int64)
                    else:
                        near = np.frombuffer(r["near"][p], np.uint8 if k < 256 else np.uint16).reshape(r["n"], -1)
                        bound = np.frombuffer(r["bounds"][p], np.float32).reshape(r["n"], -1)
                        near, bound, need = _moved_on(own, near, bound, books[p], moved[p], b)
                    total = np.zeros((k, w), np.int64)
                    np.add.at(total, near[:, 0], own)
                    sums += [total.ravel(), np.bincount(near[:, 0], minlength=k)]
                    needs.append(np.pad(need, (0, k + 2 - len(need))))
                    nears.append(np.ascontiguousarray(near).tobytes())
                    bounds.append(np.ascontiguousarray(bound, np.float32).tobytes())
                kept = {c: r[c] for c in ("chunk", "block", "n", "kind", "cells")}
                out.append(kept | {"near": nears, "bounds": bounds, "sums": np.concatenate(sums).tolist(), "needs": np.concatenate(needs).tolist()})
            for row in out:
                yield pa.RecordBatch.from_pylist([row], _ARROW)

    return go


_ARROW = pa.schema(
    [("chunk", pa.int64()), ("block", pa.int32()), ("n", pa.int32()), ("kind", pa.string()), ("cells", pa.binary())]
    + [("near", pa.list_(pa.binary())), ("bounds", pa.list_(pa.binary())), ("sums", pa.list_(pa.int64())), ("needs", pa.list_(pa.int64()))]
)


def _totals(batches):
    """Sums and needs of all chunks of a task."""
    whole = None
    for batch in batches:
        for r in batch.to_pylist():
            row = np.array(r["sums"] + r["needs"], np.int64)
            whole = row if whole is None else whole + row
    if whole is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(whole), dtype=np.int32)), pa.array(whole)], ["place", "total"])


def _gathered(state: DataFrame, parts: int, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, counts and needs of every part over all vectors; as many numbers as the codebooks have."""
    totals = state.select("sums", "needs").mapInArrow(_totals, "place int, total long").groupBy("place").agg(F.sum("total").alias("total"))
    found = np.zeros(parts * (k * w + k) + parts * (k + 2), np.int64)
    for r in totals.toLocalIterator():
        found[r["place"]] = r["total"]
    sums, needs = found[: parts * (k * w + k)].reshape(parts, -1), found[parts * (k * w + k) :].reshape(parts, -1)
    return sums[:, : k * w].reshape(parts, k, w), sums[:, k * w :], needs


def adapted(needs: np.ndarray, b: int, k: int) -> int:
    """The places to keep: the fewest that all but ``BEYOND`` of the vectors needed, two more where that many looked through everything."""
    fewest, most = max(1, k // 8), max(1, (k - 1) // 2)
    if not needs.sum():
        return b
    if needs[b + 1] > BEYOND * needs.sum():
        return max(min(b + 2, most), min(b, most))
    enough = int(np.flatnonzero(np.cumsum(needs) >= (1 - BEYOND) * needs.sum())[0])
    return min(max(enough, fewest), most)


def _coded(books: np.ndarray):
    """A row for each vector: its code in hex digits, two or more for each part, and its squared error."""
    parts, k, w = books.shape
    digits = max(2, len(f"{k - 1:x}"))

    def code(batches):
        for batch in batches:
            for i, r in enumerate(batch.drop_columns(["rows"]).to_pylist()):
                x = numbers(r["kind"], r["cells"], r["n"])
                error, hexed = np.zeros(r["n"], np.int64), []
                for p in range(parts):
                    near = np.frombuffer(r["near"][p], np.uint8 if k < 256 else np.uint16).reshape(r["n"], -1)
                    error += _own(x[:, p * w : (p + 1) * w], near, books[p])
                    hexed.append(near[:, 0].tolist())
                codes = ["".join(f"{e:0{digits}x}" for e in row) for row in zip(*hexed, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("rows").slice(i, 1).flatten(), pa.array(codes, pa.string()), pa.array(error)], ["row", "code", "error"])

    return code


def vector_codes(
    rows: DataFrame,
    keep: Sequence[str],
    order: Column,
    *,
    vector_col: str = "embedding",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> tuple[DataFrame, list[list[list[int]]]]:
    """``row, code, error`` for every vector that takes part, and the final codebooks: entries of every part, in whole numbers of ``1 / scale``.

    ``row`` holds the columns of ``keep``. The first ``entries`` vectors by ``order`` are the codebooks of the start.
    """
    vectors = finite_vectors(rows, keep, vector_col, order)
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    out = with_fields(vectors.select("row"), "code string, error long")
    if longest is None:
        return rows.sparkSession.createDataFrame([], out), []
    w = -(-longest // parts)
    start = first_vectors(vectors, entries, w * parts, scale)
    k = len(start)
    books = start.reshape(k, parts, w).transpose(1, 0, 2)
    slices, names = sliced(vectors, w * parts, 1, scale, "vectors")
    moved, places, state = None, [min(max(1, k // 4), k - 1)] * parts, slices
    for left in range(rounds, -1, -1):
        before, state = state, written(state.mapInArrow(_round(books, moved, places), STATE), "state")
        if before is not slices:
            discard(before)
        if not left:
            break
        sums, counts, needs = _gathered(state, parts, k, w)
        if moved is not None:
            places = [min(adapted(needs[p], places[p], k), k - 1) for p in range(parts)]
        new = np.stack([floor_means(sums[p], counts[p], books[p]) for p in range(parts)])
        # Rounded up, as a sum of squares may be larger than what a double holds exactly.
        moved = np.nextafter(np.sqrt(((new - books) ** 2).sum(axis=2).astype(np.float64)), np.inf)
        books = new
    found = state.select("chunk", "n", "kind", "cells", "near").join(names, "chunk").mapInArrow(_coded(books), out)
    found = written(found, "codes")
    discard(state)
    discard(slices)
    return found, books.tolist()
