"""Joins against tables that are usually small but may not be."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.functions.columns import col
from gritmill.session import materialise

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
ROWS_PER_TASK = 2_000_000
NO_KEY_SALTS = 1_024


def table_bytes(table: DataFrame) -> int:
    """Bytes of a table's values: texts and binaries as long as they are, other types at Spark's size for them."""
    parts, fixed = [], 0
    for f in table.schema:
        if f.dataType.typeName() in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(col(f.name)), F.lit(0)))
        elif f.dataType.typeName() in ("array", "map", "struct", "variant"):
            parts.append(F.octet_length(F.to_json(F.struct(col(f.name)))))
        else:
            fixed += 16
    each = F.lit(fixed)
    for part in parts:
        each = each + part
    return table.agg(F.sum(each.cast("long"))).first()[0] or 0


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    group_rows: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join of ``rows`` with a table that is unique on ``keys``.

    ``table`` should be written already (see ``session.materialise``), so counting it reads footers only. Up to
    ``broadcast_rows`` rows and ``BROADCAST_BYTES`` it is broadcast and ``rows`` is not shuffled at all. Beyond that both sides
    are shuffled, and a key that more than ``rows_per_task`` rows have is spread over as many tasks as that takes, whether
    the table knows the key or not. ``group_rows`` names a column of the table that stays out. The result is the same on every path.
    """
    payload = [c for c in table.columns if c not in keys and c != group_rows]
    wanted = table.select(*[col(c) for c in [*keys, *payload]])
    if table.count() <= broadcast_rows and table_bytes(wanted) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(wanted), list(keys), "left")
    return _salted(rows, wanted, keys, rows_per_task)


def _salted(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], rows_per_task: int) -> DataFrame:
    counts = rows.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_task)
    # At most one entry for every ``rows_per_task`` rows.
    hot = materialise(counts.select(*[col(k) for k in keys], F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts")), "hot_keys")
    no_key: Column = F.lit(False)
    for k in keys:
        no_key = no_key | col(k).isNull()
    spread = F.xxhash64(*[col(c) for c in rows.columns])
    salts = F.when(no_key, F.lit(NO_KEY_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = rows.join(F.broadcast(hot), list(keys), "left").withColumn("_salt", F.pmod(spread, salts).cast("int")).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = wanted.join(F.broadcast(hot), list(keys), "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    joined = left.join(right, [*keys, "_salt"], "left").drop("_salt")
    extra = [c for c in wanted.columns if c not in keys]
    return joined.select(*[col(c) for c in [*keys, *[c for c in rows.columns if c not in keys], *extra]])


def keep_most_frequent(df: DataFrame, name: str, top: int) -> DataFrame:
    """Rows whose value is among the ``top`` most frequent; ties go to the smaller value.

    The right side has ``top`` rows by construction, so the broadcast is bounded. A null value that is
    among the most frequent takes a place but matches no row.
    """
    frequent = (
        df.groupBy(col(name))
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), col(name).asc_nulls_first())
        .limit(top)
        .select(col(name))
    )
    return df.join(F.broadcast(frequent), name, "left_semi")


def with_total(counts: DataFrame, value: str, output: str) -> DataFrame:
    """Add the grand total of ``value`` to every row, as a scalar subquery."""
    return counts.withColumn(output, counts.agg(F.sum(col(value))).scalar())


def with_group_total(counts: DataFrame, by: Sequence[str], value: str, output: str) -> DataFrame:
    """Add the per-group total of ``value``.

    A join with the aggregated totals instead of a window, which would sort every row of a group in one
    task. No hint: adaptive execution sees the size of the totals and broadcasts them when they are small.
    """
    totals = counts.groupBy(*[col(b) for b in by]).agg(F.sum(col(value)).alias(output))
    same = counts.alias("c").join(
        totals.alias("t"),
        [F.col(f"c.`{b}`").eqNullSafe(F.col(f"t.`{b}`")) for b in by],
    )
    return same.select("c.*", F.col(f"t.`{output}`"))
