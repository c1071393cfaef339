"""Whole-table data-quality profile: long tables, a few passes, no per-column jobs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.functions.columns import band, col, known_double, missing, share
from gritmill.functions.rows import rows_from
from gritmill.operators.joining import with_total
from gritmill.operators.ranking import ROWS_PER_RANGE, quantiles, sketched_quantiles

# Missing-rate bands in percent and what to do about each.
MISSING_BANDS = [(0.0, "none"), (5.0, "low"), (20.0, "moderate"), (50.0, "high")]
MISSING_ABOVE = "critical"
MISSING_ADVICE = {
    "none": "keep",
    "low": "impute/drop rows",
    "moderate": "impute",
    "high": "check relevance",
    "critical": "drop",
}
# Bands of absolute skewness.
SKEW_BANDS = [(0.5, "normal"), (1.0, "moderate_skew")]
SKEW_ABOVE = "high_skew"
OUTLIER_FENCE = 1.5
# Distinct-value tiers with their encoding advice.
TIER_BANDS = [(2, "binary"), (10, "low"), (50, "medium"), (200, "high")]
TIER_ABOVE = "very_high"
TIER_ADVICE = {
    "binary": "binary_encode",
    "low": "one_hot_encode",
    "medium": "label_encode or group rare categories",
    "high": "group rare categories then label_encode",
    "very_high": "consider dropping or heavy grouping",
}
ONE_HOT_UP_TO = 10
DOMINANT_SHARE = 0.95
SPARSE_YEAR_SHARE = 0.01
# Words that carry no meaning in street and weather descriptions.
STOP_WORDS = [
    "", "n", "s", "e", "w", "and", "the", "with", "near", "at", "by", "of", "in", "to", "for", "from",
    "mostly", "partly",
]
TOKEN_BREAK = r"[\s,/-]+"
TOKEN_NOISE = r"[^a-z0-9]"
# Class-imbalance bands (largest class / smallest class) and their advice.
IMBALANCE_BANDS = [(3.0, "balanced"), (10.0, "moderate_imbalance")]
IMBALANCE_ABOVE = "severe_imbalance"
IMBALANCE_ADVICE = {
    "balanced": "not needed",
    "moderate_imbalance": "consider SMOTE",
    "severe_imbalance": "strongly recommend SMOTE",
}
FINE_IMBALANCE_BANDS = [(1.5, "balanced"), (3.0, "mild_imbalance"), (10.0, "moderate_imbalance")]
FINE_IMBALANCE_ADVICE = {
    "balanced": "SMOTE not needed",
    "mild_imbalance": "SMOTE optional",
    "moderate_imbalance": "consider SMOTE",
    "severe_imbalance": "strongly recommend SMOTE",
}
RARE_CLASS_SHARE = 0.10
HIGH_CORRELATION = 0.85
NEAR_DUPLICATE = 0.95
ROUNDING_NOISE = 1e-12

ROLE_TIMESTAMP, ROLE_DERIVED, ROLE_FLAG = "timestamp", "time_derived", "boolean"
ROLE_NUMBER, ROLE_CATEGORY = "numerical", "categorical"


def advice(label: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), label)


# --- structure -----------------------------------------------------------------------------------


def role_of(field: T.StructField, timestamps: Sequence[str]) -> str:
    kind = field.dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) or field.name in timestamps:
        return ROLE_TIMESTAMP
    if any(field.name.startswith(f"{t}_") for t in timestamps):
        return ROLE_DERIVED
    if isinstance(kind, T.BooleanType):
        return ROLE_FLAG
    return ROLE_NUMBER if isinstance(kind, T.NumericType) else ROLE_CATEGORY


def columns_with_role(df: DataFrame, role: str, timestamps: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if role_of(f, timestamps) == role]


def column_roles(df: DataFrame, timestamps: Sequence[str] = ()) -> DataFrame:
    """Logical role of every column, with the size of the table."""
    size = df.agg(F.count(F.lit(1)).alias("total_rows"))
    return rows_from(
        size,
        [
            {
                "column_name": F.lit(f.name),
                "role": F.lit(role_of(f, timestamps)),
                "total_rows": F.col("total_rows"),
                "total_columns": F.lit(len(df.columns)),
            }
            for f in df.schema
        ],
    )


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


# --- missing values ------------------------------------------------------------------------------


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count, rate, band and advice per column, from one aggregate over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(missing(f.name, f.dataType)).alias(f"m{i}") for i, f in enumerate(df.schema)],
    )
    long = rows_from(
        counts,
        [
            {"column_name": F.lit(f.name), "null_count": F.col(f"m{i}"), "_rows": F.col("_rows")}
            for i, f in enumerate(df.schema)
        ],
    )
    banded = long.withColumn("null_pct", share(F.col("null_count"), F.col("_rows"), 4, 100.0)).withColumn(
        "severity", band(F.col("null_pct"), MISSING_BANDS, MISSING_ABOVE)
    )
    return banded.withColumn("recommendation", advice(F.col("severity"), MISSING_ADVICE)).drop("_rows")


# --- numbers -------------------------------------------------------------------------------------


def _moments(sums: DataFrame) -> DataFrame:
    """Mean, sample deviation, skewness and excess kurtosis from sums of powers of the distance to ``middle``."""
    n = F.col("n").cast("double")
    a1, a2, a3, a4 = (F.try_divide(F.col(f"s{k}"), n) for k in (1, 2, 3, 4))
    raw = sums.withColumns({f"a{k}": a for k, a in enumerate((a1, a2, a3, a4), start=1)})
    return raw.selectExpr(
        "*",
        "a1 + middle AS mean",
        "greatest(a2 - a1 * a1, 0D) AS m2",
        "a3 - 3 * a1 * a2 + 2 * pow(a1, 3) AS m3",
        "a4 - 4 * a1 * a3 + 6 * a1 * a1 * a2 - 3 * pow(a1, 4) AS m4",
    ).selectExpr(
        "*",
        "sqrt(try_divide(m2 * n, n - 1)) AS std",
        "try_divide(m3, pow(m2, 1.5)) AS skewness",
        "try_divide(m4, m2 * m2) - 3 AS kurtosis",
    )


def numeric_profile(
    df: DataFrame, columns: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Moments, quartiles, outliers, shape and imputation advice per numeric column.

    Three passes whatever the number of columns: two for the exact quartiles, then one aggregate of plain
    sums. The sums are of distances from the middle of the quartiles, so large values lose no digits.
    """
    found = quantiles(df, columns, [0.25, 0.75], rows_per_range=rows_per_range).collect()
    quartiles = {r["measure"]: (r["q0"], r["q1"]) for r in found}
    values, sums, rows = [], [], []
    for i, c in enumerate(columns):
        low, high = quartiles.get(c, (0.0, 0.0))
        reach, middle, x = OUTLIER_FENCE * (high - low), (low + high) / 2, known_double(df, c)
        outside = ~x.between(low - reach, high + reach) if reach else F.lit(False)
        values += [x.alias(f"x{i}"), (x - F.lit(middle)).alias(f"z{i}"), outside.alias(f"o{i}")]
        named = {
            "n": f"count(x{i})",
            "gaps": f"count(*) - count(x{i})",
            "min": f"min(x{i})",
            "max": f"max(x{i})",
            "outlier_count": f"count_if(o{i})",
            **{f"s{k}": f"sum({'*'.join([f'z{i}'] * k)})" for k in (1, 2, 3, 4)},
        }
        sums += [f"{expression} AS {name}{i}" for name, expression in named.items()]
        q25, q75 = quartiles.get(c, (None, None))
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(middle).alias("middle"),
                F.lit(q25).cast("double").alias("q25"),
                F.lit(q75).cast("double").alias("q75"),
                *[F.col(f"{name}{i}").alias(name) for name in named],
            )
        )
    shaped = _moments(df.select(*values).selectExpr(*sums).select(F.inline(F.array(*rows))))
    strategy = (
        F.when(F.col("gaps") == 0, F.lit("not needed"))
        .when(F.col("distribution") == "normal", F.lit("mean"))
        .otherwise(F.lit("median"))
    )
    size = F.abs(F.coalesce(F.col("skewness"), F.lit(0.0)))
    named = shaped.withColumn("distribution", band(size, SKEW_BANDS, SKEW_ABOVE)).withColumn("imputation", strategy)
    return named.selectExpr(
        "column_name",
        *[f"round(coalesce({m}, 0D), 4) AS {m}" for m in ("mean", "std", "min", "max")],
        "q25",
        "q75",
        *[f"round(coalesce({m}, 0D), 4) AS {m}" for m in ("skewness", "kurtosis")],
        "outlier_count",
        "distribution",
        "imputation",
    )


# --- categories ----------------------------------------------------------------------------------


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value); a missing value counts as a value. Everything below builds on it."""
    texts = df.select(*[col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], [col(c) for c in columns], "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def category_profile(counts: DataFrame, token_columns: Sequence[str] = ()) -> DataFrame:
    """Distinct count, dominance, variance flags, cardinality tier and encoding advice per column."""
    per_column = counts.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_count"), F.max("n").alias("top_count"), F.sum("n").alias("_rows")
    )
    distinct = F.col("distinct_count")
    top_share = F.try_divide(F.col("top_count"), F.col("_rows"))
    encoding = (
        F.when(distinct <= ONE_HOT_UP_TO, F.lit("one_hot_encode"))
        .when(F.col("column_name").isin(*(token_columns or [""])), F.lit("extract_binary_features"))
        .otherwise(F.lit("group_rare_categories_and_label_encode"))
    )
    return (
        per_column.withColumn("top_share", F.round(top_share, 6))
        .withColumn("near_zero_variance", top_share > DOMINANT_SHARE)
        .withColumn("zero_variance", distinct == 1)
        .withColumn("likely_identifier", distinct == F.col("_rows"))
        .withColumn("cardinality", band(distinct, TIER_BANDS, TIER_ABOVE))
        .withColumn("tier_encoding", advice(F.col("cardinality"), TIER_ADVICE))
        .withColumn("encoding", encoding)
        .drop("_rows")
    )


def frequent_values(counts: DataFrame, k: int = 5, rarest: bool = False) -> DataFrame:
    """The k most (or least) frequent values per column; ties go to the smaller value.

    Spark cuts each partition to k rows per column before the shuffle, so a column with billions of
    values still sends only k of them per task.
    """
    by_count = F.col("n").asc() if rarest else F.col("n").desc()
    order = Window.partitionBy("column_name").orderBy(by_count, F.col("value").asc_nulls_first())
    return counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def case_variants(counts: DataFrame) -> DataFrame:
    """Labels that differ in case only, over all values of all columns."""
    return (
        counts.filter(F.col("value").isNotNull())
        .groupBy("column_name", F.lower("value").alias("label"))
        .agg(
            F.count(F.lit(1)).alias("spellings"),
            F.min("value").alias("first_spelling"),
            F.max("value").alias("last_spelling"),
            F.sum("n").alias("row_count"),
        )
        .filter(F.col("spellings") > 1)
    )


def frequent_tokens(df: DataFrame, name: str, scan: int = 20, keep: int = 10) -> DataFrame:
    """Keywords of a text column: its ``scan`` most frequent tokens, less stop words and bare numbers.

    Whole texts are split. Tokens are counted in the map stage before they are shuffled, and only distinct
    ones are stripped of punctuation.
    """
    tokens = df.select(F.explode(F.split(F.lower(col(name)), TOKEN_BREAK)).alias("raw"))
    raw = tokens.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    counted = (
        raw.groupBy(F.regexp_replace("raw", TOKEN_NOISE, "").alias("token"))
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(scan)
    )
    useful = counted.filter(~F.col("token").isin(*STOP_WORDS) & ~F.col("token").rlike("^[0-9]+$"))
    return useful.orderBy(F.desc("n"), "token").limit(keep)


def variance_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Constant columns and likely identifiers, over columns of any type."""
    names = list(columns or df.columns)
    per_column = (
        category_counts(df, names)
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("distinct_count"), F.sum("n").alias("_rows"))
    )
    zero = F.col("distinct_count") == 1
    identifier = F.col("distinct_count") == F.col("_rows")
    verdict = (
        F.when(zero, F.lit("drop: zero variance, no information"))
        .when(identifier, F.lit("drop: likely identifier, no predictive value"))
        .otherwise(F.lit("keep"))
    )
    return per_column.select(
        "column_name",
        "distinct_count",
        zero.alias("zero_variance"),
        identifier.alias("likely_identifier"),
        verdict.alias("recommendation"),
    )


# --- time ----------------------------------------------------------------------------------------


def rows_per_year(df: DataFrame, name: str) -> DataFrame:
    """Rows per calendar year with the year's share of the table and whether it is sparse."""
    yearly = df.groupBy(F.year(col(name)).alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.min(col(name)).alias("_first"), F.max(col(name)).alias("_last")
    )
    total = with_total(yearly, "n", "_rows")
    return total.withColumn("sparse", F.col("n") < F.col("_rows") * SPARSE_YEAR_SHARE).drop("_rows")


def timestamp_profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Range, number of years, sparse years and consistency per timestamp column, in one pass."""
    listed = [F.struct(F.lit(n).alias("column_name"), col(n).cast("timestamp_ntz").alias("moment")) for n in names]
    yearly = (
        df.select(F.inline(F.array(*listed)))
        .groupBy("column_name", F.year("moment").alias("year"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("moment").alias("first"), F.max("moment").alias("last"))
    )
    rows = yearly.groupBy("column_name").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("n").alias("_rows"),
        F.sort_array(F.collect_list(F.struct("year", "n"))).alias("years"),
    )
    sparse = F.filter("years", lambda y: y["n"] < F.col("_rows") * SPARSE_YEAR_SHARE)
    stamp = "yyyy-MM-dd HH:mm:ss"
    return rows.select(
        "column_name",
        F.date_format("first", stamp).alias("first_moment"),
        F.date_format("last", stamp).alias("last_moment"),
        F.size("years").alias("years"),
        F.array_join(F.transform(sparse, lambda y: y["year"].cast("string")), ",").alias("sparse_years"),
        F.when(F.size(sparse) > 0, F.lit("inconsistent")).otherwise(F.lit("consistent")).alias("consistency"),
    )


def calendar_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per month and rows per hour, in one pass: ``part`` names the unit, ``slot`` its value."""
    moment = col(name)
    fine = df.groupBy(F.month(moment).alias("m"), F.hour(moment).alias("h")).agg(F.count(F.lit(1)).alias("c"))
    parts = F.array(
        F.struct(F.lit("month").alias("part"), F.col("m").alias("slot"), F.col("c").alias("c")),
        F.struct(F.lit("hour").alias("part"), F.col("h").alias("slot"), F.col("c").alias("c")),
    )
    return fine.select(F.inline(parts)).groupBy("part", "slot").agg(F.sum("c").alias("n"))


# --- target --------------------------------------------------------------------------------------


def class_shares(df: DataFrame, label: str, digits: int = 5) -> DataFrame:
    counted = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n"))
    total = with_total(counted, "n", "_rows")
    return total.withColumn("percentage", share(F.col("n"), F.col("_rows"), digits, 100.0)).drop("_rows")


def target_profile(df: DataFrame, label: str, fine: bool = False) -> DataFrame:
    """Imbalance of the target: ratio of the largest to the smallest class, its band and advice."""
    counted = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.agg(
        F.count(F.lit(1)).alias("classes"),
        F.max("n").alias("largest"),
        F.min("n").alias("smallest"),
        F.sum("n").alias("row_count"),
    )
    ratio = F.try_divide(F.col("largest"), F.col("smallest"))
    bands, advices = (
        (FINE_IMBALANCE_BANDS, FINE_IMBALANCE_ADVICE) if fine else (IMBALANCE_BANDS, IMBALANCE_ADVICE)
    )
    minority = share(F.col("smallest"), F.col("row_count"), 4)
    return (
        sizes.withColumn("imbalance_ratio", F.round(ratio, 2))
        .withColumn("imbalance", band(F.round(ratio, 2) if fine else ratio, bands, IMBALANCE_ABOVE))
        .withColumn("resampling", advice(F.col("imbalance"), advices))
        .withColumn("minority_rate", minority)
        .withColumn("rare_class", minority < RARE_CLASS_SHARE)
        .withColumn("column_name", F.lit(label))
    )


# --- correlation ---------------------------------------------------------------------------------


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(i, j, r)`` for every pair of column positions, over the rows where both are known.

    Hundreds of ``corr`` aggregates in one query outgrow what the JVM compiles, so each partition sums its
    Arrow batches into small d x d matrices and Spark adds those up. Values are taken relative to a
    typical value of their column; a column without spread gives null.
    """
    known = {c: known_double(df, c) for c in columns}
    middles = [m[0] if m else 0.0 for _, m in sketched_quantiles(df, list(known.values()), [[0.5]] * len(columns), k=200)]
    centred = df.select(*[(x - F.lit(middles[i])).alias(f"c{i}") for i, x in enumerate(known.values())])
    sums = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    partial = centred.mapInArrow(pair_sums, "i int, j int, " + ", ".join(f"{s} double" for s in sums))
    total = partial.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in sums])
    n, sx, sy, sxx, syy, sxy = (F.col(s) for s in sums)

    def spread(square: Column, plain: Column) -> Column:
        left = square - F.try_divide(plain * plain, n)
        return F.when(left > square * F.lit(ROUNDING_NOISE), left)

    scale = F.sqrt(spread(sxx, sx)) * F.sqrt(spread(syy, sy))
    return total.select("i", "j", F.try_divide(sxy - F.try_divide(sx * sy, n), scale).alias("r"))


def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over a partition for every pair of columns; a row counts for a pair if both are known."""
    total = None
    for batch in batches:
        values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
        there = ~np.isnan(values)
        filled, present = np.where(there, values, 0.0), there.astype(float)
        both = np.stack(
            [present.T @ present, filled.T @ present, (filled * filled).T @ present, filled.T @ filled]
        )
        total = both if total is None else total + both
    if total is None:
        return
    i, j = np.triu_indices(total.shape[1], 1)
    n, plain, square, product = total
    yield pa.RecordBatch.from_pydict(
        {
            "i": i.astype("int32"),
            "j": j.astype("int32"),
            "n": n[i, j],
            "sx": plain[i, j],
            "sy": plain[j, i],
            "sxx": square[i, j],
            "syy": square[j, i],
            "sxy": product[i, j],
        }
    )


def correlation_pairs(
    df: DataFrame, columns: Sequence[str], high: float = HIGH_CORRELATION, duplicate: float = NEAR_DUPLICATE
) -> DataFrame:
    """Pearson correlation of every pair of columns with its band."""
    names = F.array(*[F.lit(c) for c in columns])
    long = pair_correlations(df, columns).select(
        F.get(names, F.col("i")).alias("col1"), F.get(names, F.col("j")).alias("col2"), F.col("r").alias("_r")
    )
    size = F.abs(F.col("_r"))
    kind = (
        F.when(size > duplicate, F.lit("near_duplicate")).when(size > high, F.lit("high")).otherwise(F.lit("none"))
    )
    todo = F.when(size > duplicate, F.lit("drop one")).when(size > high, F.lit("feature reduction"))
    return long.select(
        "col1",
        "col2",
        F.round("_r", 4).alias("correlation"),
        kind.alias("band"),
        F.coalesce(todo, F.lit("keep")).alias("recommendation"),
    )


# --- everything ----------------------------------------------------------------------------------


def long_section(section: str, table: DataFrame, key: str = "column_name") -> DataFrame:
    """Any report section as ``(section, column_name, metric, value_double, value_string)``."""
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    entries = []
    for f in table.schema:
        if f.name == key:
            continue
        number, text = no_number, no_text
        if isinstance(f.dataType, T.BooleanType):
            number = col(f.name).cast("int").cast("double")
        elif isinstance(f.dataType, T.NumericType):
            number = col(f.name).cast("double")
        else:
            text = col(f.name).cast("string")
        entries.append(
            F.struct(F.lit(f.name).alias("metric"), number.alias("value_double"), text.alias("value_string"))
        )
    label = col(key).cast("string") if key in table.columns else F.lit(None).cast("string")
    return table.select(F.lit(section).alias("section"), label.alias("column_name"), F.inline(F.array(*entries)))


def profile_table(
    df: DataFrame,
    label: str,
    timestamps: Sequence[str] = (),
    token_columns: Sequence[str] = (),
) -> DataFrame:
    """The whole profile as one long table.

    Each section scans the columns it needs, so hand in a written table rather than a long lineage.
    """
    numbers = columns_with_role(df, ROLE_NUMBER, timestamps)
    categories = columns_with_role(df, ROLE_CATEGORY, timestamps)
    sections = [
        long_section("structure", column_roles(df, timestamps)),
        long_section("missing", missing_profile(df)),
        long_section("target", target_profile(df, label)),
    ]
    if numbers:
        sections.append(long_section("numeric", numeric_profile(df, numbers)))
    if len(numbers) > 1:
        pairs = correlation_pairs(df, numbers).withColumn("column_name", F.concat_ws("~", "col1", "col2"))
        sections.append(long_section("correlation", pairs.drop("col1", "col2")))
    if categories:
        sections.append(long_section("category", category_profile(category_counts(df, categories), token_columns)))
    if timestamps:
        sections.append(long_section("timestamp", timestamp_profile(df, timestamps)))
    return reduce(DataFrame.unionByName, sections)
