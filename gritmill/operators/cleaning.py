"""Projections, filters, predicates and duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.functions.columns import col, known, recode
from gritmill.functions.moments_in_time import calendar_parts, durations, parse_timestamp
from gritmill.functions.rows import rows_from
from gritmill.operators.joining import BROADCAST_ROWS
from gritmill.session import materialise


def drop_prefixed(df: DataFrame, prefixes: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    doomed = [c for c in df.columns if c.startswith(tuple(prefixes))]
    return df.drop(*doomed, *also)


def keep_below(df: DataFrame, name: str, upper: float) -> DataFrame:
    """Rows with a value under the bound; rows without a value go too."""
    return df.filter(col(name) < upper)


def keep_within(df: DataFrame, value: Column, above: float, up_to: float) -> DataFrame:
    return df.filter((value > above) & (value <= up_to))


def parse_times(df: DataFrame, names: Sequence[str], pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    return df.withColumns({n: parse_timestamp(n, pattern) for n in names})


def add_calendar(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({k: v for n in names for k, v in calendar_parts(n).items()})


def add_durations(df: DataFrame, start: str, end: str, prefix: str = "Duration") -> DataFrame:
    return df.withColumns(durations(start, end, prefix))


def canonicalise(df: DataFrame, name: str, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumn(name, recode(col(name), groups))


def drop_missing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop rows that miss (null or NaN) any of the named columns."""
    return df.dropna(subset=list(names))


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def flags_to_int(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    flags = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType) and f.name not in keep]
    return df.withColumns({n: col(n).cast("int") for n in flags}) if flags else df


def binarise(df: DataFrame, name: str, at_least: float, output: str, missing_is_zero: bool = False) -> DataFrame:
    flag = (col(name) >= at_least).cast("int")
    return df.withColumn(output, F.coalesce(flag, F.lit(0)) if missing_is_zero else flag)


def pad_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add every absent column as 0.0, for models trained on a wider table."""
    absent = {n: F.lit(0.0) for n in names if n not in df.columns}
    return df.withColumns(absent) if absent else df


def split_known_unknown(df: DataFrame, names: Sequence[str]) -> tuple[list[str], list[str]]:
    """Names the table has, and names it lacks, both in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have], [n for n in names if n not in have]


def step_accounting(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows in, out and dropped per filter step, from a single pass over the table.

    A step sees only the rows that every earlier step kept.
    """
    kept: list[Column] = []
    passed = F.lit(True)
    for _, rule in steps:
        passed = passed & F.coalesce(rule, F.lit(False))
        kept.append(passed)
    totals = df.agg(F.count(F.lit(1)).alias("k0"), *[F.count_if(p).alias(f"k{i + 1}") for i, p in enumerate(kept)])
    return rows_from(
        totals,
        [
            {
                "step_no": F.lit(i + 1),
                "step": F.lit(name),
                "rows_in": F.col(f"k{i}"),
                "rows_out": F.col(f"k{i + 1}"),
                "dropped": F.col(f"k{i}") - F.col(f"k{i + 1}"),
            }
            for i, (name, _) in enumerate(steps)
        ],
    )


def drop_copies(df: DataFrame, surrogate: Sequence[str] = ()) -> DataFrame:
    """One row per distinct content. Copies collapse in the map stage, before the shuffle."""
    return df.drop(*surrogate).dropDuplicates()


def counted_copies(df: DataFrame, surrogate: Sequence[str], output: str) -> DataFrame:
    """The rows of ``drop_copies`` with the number of rows that each stands for, from the same shuffle."""
    plain = df.drop(*surrogate)
    return plain.groupBy(*[col(c) for c in plain.columns]).agg(F.count(F.lit(1)).alias(output))


def first_per_key(df: DataFrame, keys: Sequence[str], tie_break: Sequence[str], totals: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per key: the smallest by the tie-break columns, then by all others.

    An aggregate rather than a ranking window: a key that owns a third of the rows is reduced to one row per map task before it is shuffled. Its buffer
    holds whole rows, though, so it sorts them on both sides of the shuffle. ``first_of_rare_copies`` spares that where most keys have one row.
    ``totals`` are aggregates over all rows of a key; one that is named like a column takes its place.
    """
    totals = totals or {}
    rest = [c for c in df.columns if c not in keys and c not in tie_break and c not in totals]
    ordered = [*tie_break, *rest]
    least = F.min(F.struct(*[col(c) for c in ordered])).alias("_row")
    best = df.groupBy(*[col(k) for k in keys]).agg(least, *[t.alias(n) for n, t in totals.items()])
    kept = [c for c in df.columns if c not in totals]
    return best.select(*[F.col("_row")[c].alias(c) if c in ordered else col(c) for c in kept], *[col(n) for n in totals])


def first_of_rare_copies(df: DataFrame, keys: Sequence[str], tie_break: Sequence[str], few: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``first_per_key``, for a table that is cheap to read twice and in which few keys have several rows.

    Only rows that may share a key are reduced, each key by itself, so the result is exact.
    """
    alone, several = apart_by_key(df, keys, few)
    if several is None:
        return alone
    reduced = first_per_key(several, keys, tie_break)
    return reduced if alone is None else alone.unionByName(reduced)


def apart_by_key(df: DataFrame, keys: Sequence[str], few: int = BROADCAST_ROWS) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows that are the only ones of their key, and the others; none of a kind is None.

    A first pass reads the keys alone and counts their hashes; only these are shuffled. The hashes of several rows, if no more than ``few``, are
    broadcast: rows without one stay where they are. Keys that merely share a hash are among the others. With more hashes, all rows are.
    """
    place = F.xxhash64(*[col(k) for k in keys])
    shared = materialise(df.groupBy(place.alias("_place")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_place"), "shared_keys")
    n = shared.count()
    if n > few:
        return None, df
    if not n:
        return df, None
    marked = df.withColumn("_place", place)
    alone, several = (marked.join(F.broadcast(shared), "_place", how).select(*[col(c) for c in df.columns]) for how in ("left_anti", "left_semi"))
    return alone, several


def copy_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows beyond the first of each key."""
    return (
        df.groupBy(*[col(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.sum("n").alias("row_count"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.sum(F.col("n") - 1).alias("surplus_rows"),
        )
    )


def coalesce_known(df: DataFrame, name: str, default: Column) -> DataFrame:
    """Fill gaps, NaN included, with a computed default."""
    return df.withColumn(name, F.coalesce(known(name, df.schema[name].dataType), default))


def round_to(df: DataFrame, name: str, digits: int, output: str) -> DataFrame:
    """Half-up rounding, for use as a grouping key."""
    return df.withColumn(output, F.round(col(name), digits))
