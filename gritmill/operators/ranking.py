"""Exact running totals, quantiles and k-th values without sorting everything in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritmill.functions.columns import col, known_double
from gritmill.session import materialise

ROWS_PER_RANGE = 2_000_000
SKETCH_SIZE = 4_096  # items a sketch keeps; ranks are off by about 0.0013 of the rows
MAX_SKETCH_SIZE = 65_535
SKETCH_GROUPS = 1_000
BRACKET = 0.004  # how far a bracket reaches on either side, as a share of the rows


def sketched_quantiles(df: DataFrame, values: Sequence[Column], probabilities: Sequence[Sequence[float]], k: int = SKETCH_SIZE) -> list[tuple[int, list[float]]]:
    """Number of known values and approximate quantiles of several expressions; no quantiles where nothing is known.

    Sketches are merged in two steps, first among ``SKETCH_GROUPS`` groups of partitions, so no task takes in the sketches of all.
    """
    grouped = df.select(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g"), *[x.alias(f"v{i}") for i, x in enumerate(values)])
    first = grouped.groupBy("_g").agg(*[F.kll_sketch_agg_double(f"v{i}", F.lit(k)).alias(f"s{i}") for i in range(len(values))])
    merged = first.agg(*[F.kll_merge_agg_double(f"s{i}", F.lit(k)).alias(f"s{i}") for i in range(len(values))])
    wanted = [F.array(*[F.lit(float(x)) for x in ps]) for ps in probabilities]
    size = [F.kll_sketch_get_n_double(f"s{i}") for i in range(len(values))]
    found = merged.select(
        *[F.coalesce(n, F.lit(0)).alias(f"n{i}") for i, n in enumerate(size)],
        *[F.when(n > 0, F.kll_sketch_get_quantile_double(f"s{i}", wanted[i])).alias(f"q{i}") for i, n in enumerate(size)],
    ).first()
    return [(found[f"n{i}"], list(found[f"q{i}"] or [])) for i in range(len(values))]


def range_cuts(df: DataFrame, order: str, rows_per_range: int = ROWS_PER_RANGE) -> list[float]:
    """Ascending cut points that split ``df`` into value ranges of roughly equal row counts.

    The cut points only balance the work; any cut points give the same result. One number for every range comes back to the
    driver, none at all for a table that fits one range.
    """
    ranges = math.ceil(df.count() / rows_per_range)
    if ranges <= 1:
        return []
    probabilities = [i / ranges for i in range(1, ranges)]
    value = F.when(~F.isnan(col(order).cast("double")), col(order).cast("double"))
    found = sketched_quantiles(df, [value], [probabilities], max(SKETCH_SIZE, min(MAX_SKETCH_SIZE, 4 * ranges)))
    return sorted(set(found[0][1]))


def range_of(value: Column, cuts: Sequence[float]) -> Column:
    """Number of the range, by halving the sorted cuts: null goes to the first one and NaN to the last, as Spark orders them."""
    edges, n = F.array(*[F.lit(float(c)) for c in cuts]), len(cuts)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])

    def go(at: Column, step: Column) -> Column:
        return F.when((at + step <= n) & (F.get(edges, F.least(at + step, F.lit(n)) - 1) < value), at + step).otherwise(at)

    return F.when(value.isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), go))


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``<sum>_run`` (running total up to and including the row) and ``<sum>_all`` (group total).

    ``df`` holds one row per (by, order) and should be written already. A plain window would put all rows
    of a group in one task, so values are cut into ranges: totals per (group, range) are few and give each range an opening row with what came before it; inside a range
    an ordinary window does the rest. The rows are shuffled and sorted once, and nothing is joined. Null and NaN
    come where Spark sorts them, whether there are ranges or not.
    """
    group = [col(b) for b in by]
    cuts = range_cuts(df, order, rows_per_range)
    direction = (lambda c: c.desc()) if descending else (lambda c: c.asc())
    if not cuts:
        inside = Window.partitionBy(*group) if by else Window.partitionBy(F.lit(0))
        upto = inside.orderBy(direction(col(order))).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns(
            {f"{s}_run": F.sum(col(s)).over(upto) for s in sums} | {f"{s}_all": F.sum(col(s)).over(inside) for s in sums}
        )
    ranged = df.withColumn("_range", range_of(col(order).cast("double"), cuts))
    subtotal = ranged.groupBy(*group, "_range").agg(*[F.sum(col(s)).alias(f"_{s}") for s in sums])
    whole = Window.partitionBy(*group) if by else Window.partitionBy(F.lit(0))
    before = whole.orderBy(direction(F.col("_range"))).rowsBetween(Window.unboundedPreceding, -1)
    openers = subtotal.select(
        *group,
        "_range",
        F.lit(True).alias("_opens"),
        *[F.coalesce(F.sum(f"_{s}").over(before), F.lit(0)).alias(s) for s in sums],
        *[F.sum(f"_{s}").over(whole).alias(f"{s}_all") for s in sums],
    )
    inside = (
        Window.partitionBy(*group, "_range")
        .orderBy(F.col("_opens").desc(), direction(col(order)))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = ranged.withColumn("_opens", F.lit(False)).unionByName(openers, allowMissingColumns=True)
    summed = rows.withColumns(
        {f"{s}_run": F.sum(col(s)).over(inside) for s in sums}
        | {f"{s}_all": F.max(col(f"{s}_all")).over(inside) for s in sums}
    )
    return summed.filter(~F.col("_opens")).drop("_range", "_opens")


def numbered(df: DataFrame, order: Sequence[Column], output: str) -> DataFrame:
    """Add every row's place in the whole order, from 0, without sorting everything in one task.

    Rows are cut into ranges of the order; the sizes of the ranges, one number each, say where a range begins. The ranges are written before they are
    counted, so a task that runs again can't deal them otherwise. Rows that are equal in the order take any of their places.
    """
    ranged = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    starts = materialise(sizes.select("_range", before.alias("_start")), "starts")  # a row a range
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = ranged.join(F.broadcast(starts), "_range").withColumn(output, F.col("_start") + inside - 1)
    return placed.drop("_range", "_start")


def value_counts(df: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per (by, measure, value) over the known values of every measure."""
    plain = df.select(*[col(b) for b in by], *[known_double(df, m).alias(m) for m in measures])
    long = plain.unpivot([col(b) for b in by], [col(m) for m in measures], "measure", "value")
    long = long.filter(F.col("value").isNotNull())
    return long.groupBy(*[col(b) for b in by], "measure", "value").agg(F.count(F.lit(1)).alias("n"))


def _grouped_quantiles(
    df: DataFrame,
    measures: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str],
    interpolate: bool,
    rows_per_range: int,
) -> DataFrame:
    counts = materialise(value_counts(df, measures, by), "value_counts")
    ranked = running_totals(counts, "value", ["n"], [*by, "measure"], rows_per_range=rows_per_range)
    first, last, size = F.col("n_run") - F.col("n") + 1, F.col("n_run"), F.col("n_all")

    def at(rank: Column) -> Column:
        return F.max(F.when(rank.between(first, last), F.col("value")))

    picks: list[Column] = []
    for i, p in enumerate(probabilities):
        if interpolate:
            place = (size - 1) * F.lit(float(p))
            picks += [at(F.floor(place) + 1).alias(f"_lo{i}"), at(F.ceil(place) + 1).alias(f"_hi{i}")]
        else:
            picks.append(at(F.greatest(F.ceil(size * F.lit(float(p))), F.lit(1))).alias(f"q{i}"))
    keys = [*by, "measure"]
    picked = ranked.groupBy(*[col(k) for k in keys]).agg(F.max("n_all").alias("n"), *picks)
    if not interpolate:
        return picked
    place = {i: (F.col("n") - 1) * F.lit(float(p)) for i, p in enumerate(probabilities)}
    blended = [
        F.when(F.floor(place[i]) == F.ceil(place[i]), F.col(f"_lo{i}"))
        .otherwise((F.ceil(place[i]) - place[i]) * F.col(f"_lo{i}") + (place[i] - F.floor(place[i])) * F.col(f"_hi{i}"))
        .alias(f"q{i}")
        for i in place
    ]
    return picked.select(*[col(k) for k in keys], "n", *blended)


def _brackets(around: Sequence[float]) -> list[tuple[float, float]]:
    """Pairs of bounds as sorted ranges that do not overlap."""
    merged: list[tuple[float, float]] = []
    for low, high in sorted(zip(around[::2], around[1::2], strict=True)):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def values_at_ranks(
    df: DataFrame,
    measures: Sequence[str],
    near: Sequence[float],
    ranks: Callable[[int], Sequence[int]],
    rows_per_range: int = ROWS_PER_RANGE,
) -> dict[str, tuple[int, dict[int, float]]]:
    """Number of known values, and the exact values at the given ranks (1-based), per measure.

    ``near`` names shares of the values that the ranks are close to.

    A mergeable sketch brackets each share; then only values inside a bracket, under a hundredth
    of the rows, are counted one by one, while the rest is counted per zone between brackets,
    already in the map stage. A rank outside its bracket would show, and its measure would go through
    the full value counts instead.
    """
    value = {m: known_double(df, m) for m in measures}
    shares = [min(max(p + d, 0.0), 1.0) for p in near for d in (-BRACKET, BRACKET)]
    around = sketched_quantiles(df, list(value.values()), [shares] * len(measures))
    sizes = {m: n for m, (n, _) in zip(measures, around) if n}
    if not sizes:
        return {}
    bounds = {i: _brackets(around[i][1]) for i, m in enumerate(measures) if m in sizes}
    most = max(map(len, bounds.values()))
    unused = (float("inf"), float("inf"))
    table = F.array(
        *[
            F.array(*[F.lit(b) for pair in (bounds.get(i, []) + [unused] * most)[:most] for b in pair])
            for i in range(len(measures))
        ]
    )
    plain = df.select(*[x.alias(str(i)) for i, x in enumerate(value.values()) if i in bounds])
    long = plain.unpivot([], [col(str(i)) for i in bounds], "i", "value").filter(F.col("value").isNotNull())
    long = long.select(F.col("i").cast("int").alias("i"), "value")
    zone, edges = F.lit(0), F.get(table, F.col("i"))
    for j in range(most):
        zone = (
            F.when(F.col("value") > F.get(edges, F.lit(2 * j + 1)), F.lit(2 * j + 2))
            .when(F.col("value") >= F.get(edges, F.lit(2 * j)), F.lit(2 * j + 1))
            .otherwise(zone)
        )
    zoned = long.withColumn("zone", zone).withColumn("value", F.when(F.col("zone") % 2 == 1, F.col("value")))
    counts = materialise(zoned.groupBy("i", "zone", "value").agg(F.count(F.lit(1)).alias("n")), "bracketed")
    totals = {(r["i"], r["zone"]): r["n"] for r in counts.groupBy("i", "zone").agg(F.sum("n").alias("n")).collect()}
    ranked = running_totals(
        counts.filter(F.col("zone") % 2 == 1), "value", ["n"], ["i", "zone"], rows_per_range=rows_per_range
    )
    wanted, unsure = [], set()
    for i, m in enumerate(measures):
        for rank in dict.fromkeys(ranks(sizes[m])) if m in sizes else []:
            before = 0
            for zone in sorted(z for j, z in totals if j == i):
                if before < rank <= before + totals[i, zone]:
                    wanted.append((i, zone, rank - before, rank))
                    if zone % 2 == 0:
                        unsure.add(m)
                before += totals[i, zone]
    found: dict[str, dict[int, float]] = {m: {} for m in sizes}
    sought = df.sparkSession.createDataFrame(wanted, "i int, zone int, inner bigint, rank bigint")
    inside = F.col("inner").between(F.col("n_run") - F.col("n") + 1, F.col("n_run"))
    for r in ranked.join(F.broadcast(sought), ["i", "zone"]).filter(inside).select("i", "rank", "value").collect():
        found[measures[r["i"]]][r["rank"]] = r["value"]
    for m in unsure:
        full = running_totals(
            materialise(value_counts(df, [m]), "value_counts"), "value", ["n"], rows_per_range=rows_per_range
        )
        for rank in ranks(sizes[m]):
            hit = full.filter(F.lit(rank).between(F.col("n_run") - F.col("n") + 1, F.col("n_run")))
            found[m][rank] = hit.first()["value"]
    return {m: (sizes[m], values) for m, values in found.items()}


def quantiles(
    df: DataFrame,
    measures: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    interpolate: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Exact quantiles ``q0, q1, ...`` per (by, measure).

    Without interpolation the quantile is the smallest value that at least that share of the values does
    not exceed; with it, values are interpolated linearly between ranks, as ``median`` does.
    """
    if by:
        return _grouped_quantiles(df, measures, probabilities, by, interpolate, rows_per_range).drop("n")

    def places(size: int) -> list[tuple[int, int, float]]:
        """Lower rank, upper rank and distance from the lower one, per probability."""
        if not interpolate:
            return [(r, r, 0.0) for r in (max(1, math.ceil(size * p)) for p in probabilities)]
        spots = [(size - 1) * p for p in probabilities]
        return [(math.floor(s) + 1, math.ceil(s) + 1, s - math.floor(s)) for s in spots]

    def ranks(size: int) -> list[int]:
        return [r for low, high, _ in places(size) for r in (low, high)]

    found = values_at_ranks(df, measures, probabilities, ranks, rows_per_range)
    rows = [
        (m, *[(1 - gap) * at[low] + gap * at[high] for low, high, gap in places(size)])
        for m, (size, at) in found.items()
    ]
    names = ", ".join(f"q{i} double" for i in range(len(probabilities)))
    return df.sparkSession.createDataFrame(rows, f"measure string, {names}")


def kth_smallest(df: DataFrame, name: str, k: int, of: int, rows_per_range: int = ROWS_PER_RANGE) -> float:
    """The k-th smallest (1-based) of the ``of`` known values of a numeric column, exactly."""
    return values_at_ranks(df, [name], [k / of], lambda size: [k], rows_per_range)[name][1][k]
