"""Most frequent values without a shuffle of all distinct ones, and the same rows as full counts give.

One pass keeps at most ``TRACKED`` counters a task and column (Misra and Gries): when there are too many, the largest that has to go is taken off all, and what is
taken off adds up to how far a counter may lie below the truth. Counters of tasks are merged in two steps and stay small. A value can be among the ``k``
most frequent only if its counter and the error reach the ``k``-th largest counter; these few are counted exactly in a second pass. Where the
error itself reaches that far, as in a column of identifiers, an unseen value could be among them: such columns, and no others, go through
full counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gritmill.functions.columns import col
from gritmill.operators.profiling import STOP_WORDS, TOKEN_BREAK, TOKEN_NOISE, frequent_values
from gritmill.session import materialise

TRACKED = 1_024
GROUPS = 64  # tasks of the first merge
CANDIDATES = 100_000  # beyond so many, full counts are no dearer
COUNTERS = "column_name string, value string, n long, lost boolean, merge int"


class Counters:
    """Counters of one column: ``counts`` lie at most ``lost`` below the true numbers, and what has none was seen at most ``lost`` times."""

    def __init__(self, tracked: int):
        self.tracked, self.lost, self.counts = tracked, 0, {}

    def add(self, values: list, counts: list[int]) -> None:
        for v, n in zip(values, counts, strict=True):
            self.counts[v] = self.counts.get(v, 0) + n
        if len(self.counts) > 2 * self.tracked:
            self.cut()

    def cut(self) -> None:
        if len(self.counts) > self.tracked:
            numbers = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            off = int(np.partition(numbers, len(numbers) - self.tracked - 1)[len(numbers) - self.tracked - 1])
            self.counts = {v: n - off for v, n in self.counts.items() if n > off}
            self.lost += off


def _emitted(held: dict[str, Counters]) -> Iterator[pa.RecordBatch]:
    merge = TaskContext.get().partitionId() % GROUPS
    for name, c in held.items():
        c.cut()
        values, counts = [*c.counts, None], [*c.counts.values(), c.lost]
        size = len(values)
        arrays = [pa.array([name] * size), pa.array(values, pa.string()), pa.array(counts), pa.array([False] * (size - 1) + [True]), pa.array([merge] * size, pa.int32())]
        yield pa.RecordBatch.from_arrays(arrays, ["column_name", "value", "n", "lost", "merge"])


def _count(tracked: int):
    """Counters of a task's rows of ``column_name, value``."""

    def go(batches):
        held: dict[str, Counters] = {}
        for batch in batches:
            names = batch.column("column_name")
            for name in pc.unique(names).to_pylist():
                found = pc.value_counts(batch.column("value").filter(pc.equal(names, name)))
                held.setdefault(name, Counters(tracked)).add(found.field("values").to_pylist(), found.field("counts").to_pylist())
        yield from _emitted(held)

    return go


def _merge(tracked: int):
    """Counters of several tasks as one."""

    def go(batches):
        held: dict[str, Counters] = {}
        for batch in batches:
            for r in batch.to_pylist():
                c = held.setdefault(r["column_name"], Counters(tracked))
                if r["lost"]:
                    c.lost += r["n"]
                else:
                    c.add([r["value"]], [r["n"]])
        yield from _emitted(held)

    return go


def counters(long: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """``column_name, value, n, lost``: merged counters of the rows of ``column_name, value``; a row with ``lost`` holds a column's error."""
    first = long.select("column_name", "value").mapInArrow(_count(tracked), COUNTERS)
    merged = first.repartition(GROUPS, "merge").mapInArrow(_merge(tracked), COUNTERS)
    return merged.groupBy("column_name", "value", "lost").agg(F.sum("n").alias("n"))


def heavy_values(long: DataFrame, k: int = 5, tracked: int = TRACKED) -> DataFrame:
    """``column_name, value, n, place``: the ``k`` most frequent values of each column; ties go to the smaller value, null counts as the smallest.

    ``long`` is read twice and shuffled only for columns that the counters leave open.
    """
    found = materialise(counters(long, tracked), "counters")
    lost = found.filter("lost").select("column_name", F.col("n").alias("error"))
    held = found.filter("not lost").select("column_name", "value", "n")
    falling = Window.partitionBy("column_name").orderBy(F.desc("n"))
    top = held.withColumn("place", F.row_number().over(falling)).filter(F.col("place") <= k)
    least = top.groupBy("column_name").agg(F.count(F.lit(1)).alias("seen"), F.min("n").alias("least"))
    # One row a column; fewer than k counters say everything only where nothing was ever taken off.
    bounds = materialise(lost.join(least, "column_name", "left").select("column_name", "error", F.coalesce("seen", F.lit(0)).alias("seen"), F.coalesce("least", F.lit(0)).alias("least")), "bounds")
    decided = (F.col("error") == 0) | ((F.col("seen") >= k) & (F.col("error") < F.col("least")))
    few = bounds.filter(decided)
    candidates = materialise(held.join(F.broadcast(few), "column_name").filter(F.col("n") + F.col("error") >= F.when(F.col("seen") >= k, F.col("least")).otherwise(0)).select("column_name", "value"), "candidates")
    open_columns = [r["column_name"] for r in bounds.filter(~decided).select("column_name").collect()]
    if candidates.count() > CANDIDATES:
        open_columns, candidates = [r["column_name"] for r in bounds.select("column_name").collect()], candidates.limit(0)
    same = (F.col("l.column_name") == F.col("c.column_name")) & F.col("l.value").eqNullSafe(F.col("c.value"))
    exact = long.alias("l").join(F.broadcast(candidates.alias("c")), same, "left_semi").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    if open_columns:
        full = long.filter(F.col("column_name").isin(open_columns)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        exact = exact.unionByName(full)
    return frequent_values(exact, k)


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, value`` for every cell of the columns, as text."""
    texts = df.select(*[col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], [col(c) for c in columns], "column_name", "value")


def heavy_tokens(df: DataFrame, name: str, scan: int = 20, keep: int = 10, tracked: int = TRACKED) -> DataFrame:
    """The same keywords as ``frequent_tokens``, without a shuffle of all distinct tokens."""
    tokens = df.select(F.explode(F.split(F.lower(col(name)), TOKEN_BREAK)).alias("raw"))
    long = tokens.select(F.lit(name).alias("column_name"), F.regexp_replace("raw", TOKEN_NOISE, "").alias("value"))
    top = heavy_values(long, scan, tracked).select(F.col("value").alias("token"), "n")
    useful = top.filter(~F.col("token").isin(*STOP_WORDS) & ~F.col("token").rlike("^[0-9]+$"))
    return useful.orderBy(F.desc("n"), "token").limit(keep)
