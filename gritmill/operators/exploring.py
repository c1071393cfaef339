"""Exploratory aggregates: the tables behind distribution, rate and density charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.functions.columns import col, known_double, pearson, share
from gritmill.functions.moments_in_time import seconds_between
from gritmill.operators.encoding import check_cardinality, learn
from gritmill.operators.joining import keep_most_frequent, with_group_total, with_total
from gritmill.operators.profiling import pair_correlations
from gritmill.operators.ranking import ROWS_PER_RANGE, quantiles
from gritmill.session import materialise


def group_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))


def share_of_all(df: DataFrame, keys: Sequence[str], digits: int = 6) -> DataFrame:
    """Group counts with their percentage of the whole table."""
    total = with_total(group_counts(df, keys), "n", "_all")
    return total.withColumn("pct", share(F.col("n"), F.col("_all"), digits, 100.0)).drop("_all")


def share_within(df: DataFrame, by: str, name: str, digits: int = 6, scale: float = 1.0) -> DataFrame:
    """Distribution of one column inside every class of another."""
    total = with_group_total(group_counts(df, [by, name]), [by], "n", "_all")
    return total.withColumn("pct", share(F.col("n"), F.col("_all"), digits, scale)).drop("_all")


def share_within_frequent(df: DataFrame, by: str, name: str, top: int = 20, digits: int = 6) -> DataFrame:
    """As ``share_within``, over the rows that hold one of the ``top`` most frequent values."""
    return share_within(keep_most_frequent(df, name, top), by, name, digits)


def class_means(df: DataFrame, by: str, measures: Sequence[str], digits: int = 4) -> DataFrame:
    """Mean of many measures per class, one row per (measure, class)."""
    wide = df.groupBy(col(by)).agg(*[F.avg(known_double(df, m)).alias(m) for m in measures])
    long = wide.unpivot([col(by)], [col(m) for m in measures], "measure", "mean")
    return long.withColumn("mean", F.round("mean", digits))


def class_means_wide(
    df: DataFrame, by: str, classes: Sequence[object], measures: Sequence[str], digits: int = 4
) -> DataFrame:
    """The same, with one column per class."""
    return class_means(df, by, measures, digits).groupBy("measure").pivot(by, list(classes)).agg(F.first("mean"))


def means_per(df: DataFrame, keys: Sequence[str], measures: Sequence[str], digits: int = 2) -> DataFrame:
    """Rows and mean of every measure per group."""
    return df.groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.avg(known_double(df, m)), digits).alias(f"avg_{m}") for m in measures],
    )


def classes_side_by_side(
    df: DataFrame, key: str, label: str, measures: Sequence[str], digits: int = 2
) -> DataFrame:
    """Counts and means of both classes of a 0/1 label in columns, with the rate of the positive class."""
    known = {m: known_double(df, m) for m in measures}
    hit = {c: col(label) == c for c in (0, 1)}
    wide = df.groupBy(col(key)).agg(
        *[F.count_if(hit[c]).alias(f"n_{c}") for c in hit],
        *[F.round(F.avg(F.when(hit[c], v)), digits).alias(f"avg_{m}_{c}") for m, v in known.items() for c in hit],
    )
    return wide.withColumn("positive_rate", share(F.col("n_1"), F.col("n_0") + F.col("n_1"), 6))


def rate_by_rounded(
    df: DataFrame, measure: str, label: str, digits: int = 0, more_than: int = 10
) -> DataFrame:
    """Rate of the positive class per rounded value of a measure, for values with enough rows."""
    grouped = df.groupBy(F.round(known_double(df, measure), digits).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(col(label)).alias("positives")
    )
    return grouped.withColumn("rate", share(F.col("positives"), F.col("n"), 6)).filter(F.col("n") > more_than)


def flag_rates(df: DataFrame, by: str, flags: Sequence[str], digits: int = 4, scale: float = 1.0) -> DataFrame:
    """Share of true per flag and class, from one aggregate."""
    return df.groupBy(col(by)).agg(
        *[F.round(F.avg(col(f).cast("int")) * F.lit(scale), digits).alias(f) for f in flags]
    )


def point_density(
    df: DataFrame, x: str, y: str, by: str | None = None, digits: int | None = None
) -> DataFrame:
    """Rows per point, or per cell of a grid when ``digits`` rounds the coordinates."""

    def place(name: str) -> Column:
        return (col(name) if digits is None else F.round(col(name), digits)).alias(name)

    keys = ([col(by)] if by else []) + [place(x), place(y)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def month_grid(df: DataFrame, name: str, months: Sequence[str], row: Column, row_name: str) -> DataFrame:
    """Cross-tab of a row key against the given ``yyyy_MM`` months; empty cells are 0."""
    month = F.date_format(col(name), "yyyy_MM")
    fine = df.groupBy(row.alias(row_name), month.alias("_month")).agg(F.count(F.lit(1)).alias("n"))
    wide = fine.groupBy(row_name).pivot("_month", list(months)).agg(F.sum("n"))
    return wide.select(row_name, *[F.coalesce(col(m), F.lit(0)).alias(f"m_{m}") for m in months])


def histogram(df: DataFrame, name: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram from the smallest to the largest value; empty bins are listed with 0."""
    value = known_double(df, name)
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    width = (high - low) / bins
    place = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(bins)).cast("int") if width else F.lit(0)
    counted = (
        df.filter(value.isNotNull())
        .select(F.least(place, F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        F.round(F.lit(low) + F.lit(width) * F.col("bin"), 6).alias("lower"),
        F.round(F.lit(low) + F.lit(width) * (F.col("bin") + 1), 6).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def centre(df: DataFrame, name: str, digits: int = 4, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Mean and exact median of a measure."""
    middle = quantiles(df, [name], [0.5], interpolate=True, rows_per_range=rows_per_range)
    mean = df.agg(F.avg(known_double(df, name)).alias("m"))
    return middle.select(
        F.col("measure").alias("column_name"),
        F.round(mean.scalar(), digits).alias("mean"),
        F.round("q0", digits).alias("median"),
    )


def mean_gap(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.agg(F.round(F.avg(seconds_between(start, end)), 4).alias("mean_diff_seconds"))


def correlation_of(df: DataFrame, a: str, b: str, digits: int = 4) -> DataFrame:
    return df.agg(F.round(pearson(known_double(df, a), known_double(df, b)), digits).alias("correlation"))


def correlation_matrix(
    df: DataFrame,
    numbers: Sequence[str],
    flags: Sequence[str] = (),
    categories: Sequence[str] = (),
    digits: int = 4,
) -> DataFrame:
    """Pearson matrix ``(a, b, r)`` over complete rows: numbers, flags as 0/1, categories by index.

    The columns are written first, as they are passed over several times; the sums behind all pairs then
    come from one pass.
    """
    names = [*numbers, *flags, *categories]
    plain = df.select(
        *[known_double(df, n).alias(f"c{i}") for i, n in enumerate(numbers)],
        *[col(f).cast("double").alias(f"c{len(numbers) + i}") for i, f in enumerate(flags)],
        *[col(c).cast("string").alias(f"t{i}") for i, c in enumerate(categories)],
    )
    complete = materialise(plain.dropna(), "matrix_columns")
    if categories:
        texts = [f"t{i}" for i in range(len(categories))]
        check_cardinality(texts, learn(complete, distinct_of=texts))
        indexed = [f"c{len(numbers) + len(flags) + i}" for i in range(len(categories))]
        complete = StringIndexer(inputCols=texts, outputCols=indexed).fit(complete).transform(complete)
    pairs = pair_correlations(complete, [f"c{i}" for i in range(len(names))])
    both = F.array(F.struct("i", "j", "r"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "r"))
    spark = df.sparkSession
    same = spark.range(len(names)).selectExpr("cast(id AS int) AS i", "cast(id AS int) AS j", "1.0D AS r")
    cells = pairs.select(F.inline(both)).unionByName(same)
    listed = F.array(*[F.lit(n) for n in names])
    return cells.select(
        F.get(listed, F.col("i")).alias("a"), F.get(listed, F.col("j")).alias("b"), F.round("r", digits).alias("r")
    )


def ranked_by_correlation(matrix: DataFrame, target: str) -> DataFrame:
    """Features by their correlation with the target, strongest positive first."""
    ranked = matrix.filter((F.col("a") == target) & (F.col("b") != target))
    return ranked.select(F.col("b").alias("feature"), "r").orderBy(F.desc_nulls_last("r"), "feature")


def impact_summary(df: DataFrame, by: str, duration: Column, distance: str) -> DataFrame:
    """Rows, mean duration and mean distance per class."""
    return df.groupBy(col(by)).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(duration), 2).alias("avg_duration_seconds"),
        F.round(F.avg(known_double(df, distance)), 2).alias("avg_distance"),
    )


def top_groups(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The k largest groups; ties go to the smaller key."""
    return group_counts(df, keys).orderBy(F.desc("n"), *[col(x).asc_nulls_first() for x in keys]).limit(k)
