"""Quality gates: rules over the profile tables, each as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.functions.columns import col, missing
from gritmill.functions.rows import rows_from
from gritmill.operators.features import FittedFeatures, derived_from_target
from gritmill.plans.feature_plan import FeaturePlan, RegexFlag

# A flag that is true for fewer or more rows than this says nothing.
FLAG_TOO_RARE = 0.001
FLAG_TOO_COMMON = 0.995
# Reject when more than 3 flags and more than 40 % of them are suspicious.
SUSPICIOUS_MIN = 3
SUSPICIOUS_SHARE = 0.4
#: Columns of one aggregate of ``engineered_profile``; each takes 12 fields of its buffer.
PROFILED_AT_ONCE = 8


def critical_issues(
    missing_table: DataFrame,
    categories: DataFrame | None = None,
    bands: Sequence[str] = ("critical", "high"),
) -> DataFrame:
    """Columns that stand against accepting the table: many gaps, or one value nearly everywhere."""
    gaps = missing_table.filter(F.col("severity").isin(*bands)).select(F.lit("Critical Nulls").alias("issue"), "column_name")
    if categories is None:
        return gaps
    flat = categories.filter("near_zero_variance").select(F.lit("Near Zero Variance").alias("issue"), "column_name")
    return gaps.unionByName(flat)


def quality_score(issues: DataFrame, moderate_up_to: int = 2) -> DataFrame:
    n = F.col("total_issues")
    score = F.when(n == 0, F.lit("good")).when(n <= moderate_up_to, F.lit("moderate")).otherwise(F.lit("poor"))
    return issues.agg(F.count(F.lit(1)).alias("total_issues")).withColumn("score", score)


def cleaning_gate(score: DataFrame) -> DataFrame:
    """Accept only a good table without critical issues."""
    accepted = (F.col("score") == "good") & (F.col("total_issues") == 0)
    return score.select(
        F.when(accepted, F.lit("accept")).otherwise(F.lit("reject")).alias("decision"),
        F.when(accepted, F.lit("approved")).otherwise(F.lit("rejected")).alias("status"),
        F.col("score").alias("quality_score"),
        "total_issues",
    )


def quality_warnings(missing_table: DataFrame, target: DataFrame, timestamps: DataFrame | None = None) -> DataFrame:
    """What deserves a look without blocking: gaps, class imbalance, sparse years."""
    found = [
        missing_table.filter(F.col("severity").isin("high", "moderate")).select(
            F.lit("missing values").alias("warning"), "column_name", F.col("severity").alias("detail")
        ),
        target.filter(F.col("imbalance").isin("severe_imbalance", "moderate_imbalance")).select(
            F.lit("target imbalance").alias("warning"), "column_name", F.col("resampling").alias("detail")
        ),
    ]
    if timestamps is not None:
        found.append(
            timestamps.filter(F.col("consistency") == "inconsistent").select(
                F.lit("sparse years").alias("warning"), "column_name", F.col("sparse_years").alias("detail")
            )
        )
    return reduce(DataFrame.unionByName, found)


def cleaning_advice(missing_table: DataFrame, numbers: DataFrame, pairs: DataFrame) -> DataFrame:
    """Drop, impute or de-duplicate: one row per piece of advice."""
    hollow = missing_table.filter(F.col("severity") == "critical").select(
        F.lit("drop_column").alias("action"), "column_name", F.lit("critical_null_density").alias("detail")
    )
    strategy = numbers.select("column_name", "imputation")
    gappy = (
        missing_table.filter(F.col("severity").isin("low", "moderate"))
        .join(strategy, "column_name", "left")
        .select(F.lit("impute").alias("action"), "column_name", F.coalesce("imputation", F.lit("mode")).alias("detail"))
    )
    twins = pairs.filter(F.col("band") == "near_duplicate").select(
        F.lit("drop_column").alias("action"),
        F.col("col2").alias("column_name"),
        F.concat(F.lit("redundant_with_"), "col1").alias("detail"),
    )
    return hollow.unionByName(gappy).unionByName(twins)


def feature_advice(categories: DataFrame, target: DataFrame, token_columns: Sequence[str] = ()) -> DataFrame:
    """Expand text columns, encode the other categories, balance the target."""
    texts = F.col("column_name").isin(*(token_columns or [""]))
    expand = categories.filter(texts).select(
        F.lit("extract_binary_features").alias("action"), "column_name", F.lit("string_keyword_extraction").alias("detail")
    )
    encode = categories.filter(~texts & ~F.col("zero_variance") & ~F.col("likely_identifier")).select(
        F.lit("encode").alias("action"), "column_name", F.col("encoding").alias("detail")
    )
    balance = target.filter(F.col("imbalance").isin("severe_imbalance", "moderate_imbalance")).select(
        F.lit("balance_target").alias("action"), "column_name", F.lit("SMOTE").alias("detail")
    )
    return expand.unionByName(encode).unionByName(balance)


# --- engineered features -------------------------------------------------------------------------


def engineered_profile(df: DataFrame, target: str) -> DataFrame:
    """Flags with their true ratio, numbers with their moments, indices with their cardinality.

    A number counts as a flag only if every value is 0 or 1. Each column is read once, a few columns to an aggregate: Spark compiles no aggregate
    with more than 100 fields in its buffer, and one over all columns is several times slower than all of them together. Hand in a written table.
    """
    fields = [
        f for f in df.schema if f.name != target and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]
    # Spark never compiles the aggregate of a cardinality: each index goes by itself.
    indices = [[f] for f in fields if f.name.endswith("_idx")]
    numbers = [f for f in fields if not f.name.endswith("_idx")]
    groups = [numbers[i : i + PROFILED_AT_ONCE] for i in range(0, len(numbers), PROFILED_AT_ONCE)] + indices
    return reduce(DataFrame.unionByName, [_profile_of(df, group) for group in groups or [[]]])


def _profile_of(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    values, sums, rows = [], [], []
    for i, f in enumerate(fields):
        whole = col(f.name).cast("int") if isinstance(f.dataType, T.BooleanType) else col(f.name)
        values.append(F.nanvl(whole.cast("double"), F.lit(None).cast("double")).alias(f"x{i}"))
        index = f.name.endswith("_idx")
        named = {
            "mean": f"avg(x{i})",
            "stddev": f"stddev(x{i})",
            "min": f"min(x{i})",
            "max": f"max(x{i})",
            "skewness": f"skewness(x{i})",
            "is_flag": "false" if index else f"coalesce(bool_and(x{i} IN (0D, 1D)), false)",
            "approx_cardinality": f"approx_count_distinct(x{i})" if index else "CAST(NULL AS BIGINT)",
        }
        sums += [f"{expression} AS {name}{i}" for name, expression in named.items()]
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit("index" if index else "number").alias("plain_kind"),
                *[F.col(f"{name}{i}").alias(name) for name in named],
            )
        )
    long = df.select(*values).selectExpr(*sums).select(F.inline(F.array(*rows)))
    return long.selectExpr(
        "column_name",
        "IF(is_flag, 'flag', plain_kind) AS kind",
        "IF(is_flag, round(mean, 4), NULL) AS true_ratio",
        *[f"round({m}, 4) AS {m}" for m in ("min", "max", "mean", "stddev", "skewness")],
        "coalesce(min < 0, false) AS contains_negatives",
        "approx_cardinality",
    )


def class_weight_ratio(df: DataFrame, label: str) -> DataFrame:
    zero, one = F.count_if(col(label) == 0), F.count_if(col(label) == 1)
    return df.agg(zero.alias("n_0"), one.alias("n_1")).withColumn(
        "class_weight_ratio", F.round(F.col("n_0") / F.greatest(F.col("n_1"), F.lit(1)), 2)
    )


def feature_checks(df: DataFrame, features: Sequence[str], plan: FeaturePlan) -> DataFrame:
    """Leakage, gaps, flag ranges, leftovers and the vector, as ``(check, status, detail)``.

    All gaps and ranges come from one aggregate. Leakage follows the plan's lineage, so a column computed
    from the target is caught under any name.
    """
    present = [f for f in df.schema if f.name in features]
    flags = [f.output for f in plan.flags if f.output in df.columns]
    flags += ["is_rush_hour"] if "is_rush_hour" in df.columns else []
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(missing(f.name, f.dataType)).alias(f"gap{i}") for i, f in enumerate(present)],
        *[F.count_if((col(c) < 0) | (col(c) > 1)).alias(f"range{i}") for i, c in enumerate(flags)],
    )
    leaks = sorted(derived_from_target(plan) & set(features))
    left_over = sorted(plan.consumed() & set(df.columns))

    def verdict(name: str, good: Column, detail: Column) -> dict[str, Column]:
        return {
            "check": F.lit(name),
            "status": F.when(good, F.lit("PASS")).otherwise(F.lit("FAIL")),
            "detail": detail,
        }

    rows = [verdict("no_target_leakage", F.lit(not leaks), F.lit(",".join(leaks)))]
    rows += [
        verdict(f"no_nulls_{f.name}", F.col(f"gap{i}") == 0, F.col(f"gap{i}").cast("string"))
        for i, f in enumerate(present)
    ]
    rows += [
        verdict(f"range_{c}", F.col(f"range{i}") == 0, F.col(f"range{i}").cast("string")) for i, c in enumerate(flags)
    ]
    rows.append(verdict("dropped_columns_removed", F.lit(not left_over), F.lit(",".join(left_over))))
    return rows_from(wide, rows)


def vector_check(df: DataFrame, vector: str = "features") -> DataFrame:
    present = vector in df.columns
    rows = df.agg(F.count(F.lit(1)).alias("row_count"))
    return rows.select(
        F.lit("features_vector_exists").alias("check"),
        F.lit("PASS" if present else "FAIL").alias("status"),
        F.concat(F.col("row_count").cast("string"), F.lit(" rows")).alias("detail"),
    )


def suspicious_flags(profile: DataFrame, flags: Sequence[RegexFlag]) -> DataFrame:
    """Planned flags that are nearly never or nearly always true, or missing from the profile."""
    spark = profile.sparkSession
    planned = spark.createDataFrame([(f.output,) for f in flags], "column_name string")
    found = profile.filter(F.col("kind") == "flag").select("column_name", "true_ratio")
    reason = (
        F.when(F.col("true_ratio").isNull(), F.lit("not found in profile"))
        .when(F.col("true_ratio") < FLAG_TOO_RARE, F.lit("true_ratio too low"))
        .when(F.col("true_ratio") > FLAG_TOO_COMMON, F.lit("true_ratio too high"))
    )
    reviewed = planned.join(found, "column_name", "left").withColumn("reason", reason)
    return reviewed.filter(F.col("reason").isNotNull())


def feature_gate(suspicious: DataFrame, checks: DataFrame, planned: int, features: int) -> DataFrame:
    """Reject on a failed check, on no features, or on too many suspicious flags."""
    too_many = max(SUSPICIOUS_MIN, int(planned * SUSPICIOUS_SHARE))
    failed = checks.filter(F.col("status") == "FAIL").agg(F.count(F.lit(1)).alias("n")).scalar()
    review = suspicious.agg(F.count(F.lit(1)).alias("suspicious_flags")).withColumn("failed_checks", failed)
    accepted = (
        (F.col("failed_checks") == 0)
        & F.lit(features > 0)
        & ((F.col("suspicious_flags") <= too_many) | F.lit(planned == 0))
    )
    return review.select(
        F.when(accepted, F.lit("accept")).otherwise(F.lit("reject")).alias("decision"),
        F.when(accepted, F.lit("approved")).otherwise(F.lit("needs_more_feature_engineering")).alias("status"),
        F.lit(planned).alias("flags_reviewed"),
        "suspicious_flags",
        "failed_checks",
    )


def prune(
    suspicious: DataFrame, fitted: FittedFeatures, *splits: DataFrame
) -> tuple[list[DataFrame], FittedFeatures]:
    """Drop the suspicious flags from every split, from the plan and from the feature list."""
    doomed = {r["column_name"] for r in suspicious.select("column_name").collect()}
    slimmer = FittedFeatures(
        plan=fitted.plan.without(doomed),
        stages=fitted.stages,
        scales=fitted.scales,
        features=[f for f in fitted.features if f not in doomed],
        labels=fitted.labels,
    )
    return [s.drop(*doomed) for s in splits], slimmer
