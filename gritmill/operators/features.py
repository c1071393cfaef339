"""Run a feature plan: learn on train, apply to any split."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.functions.columns import col, known_double
from gritmill.functions.moments_in_time import rush_hour
from gritmill.functions.rows import rows_from
from gritmill.operators.cleaning import flags_to_int
from gritmill.operators.encoding import INDEX_LIMIT, check_cardinality, index_labels, indexer, is_wide, label_table, learn, one_hot
from gritmill.operators.exploring import group_counts
from gritmill.plans.feature_plan import Binning, FeaturePlan, Interaction, RegexFlag

# Fixed value: keeps a ratio finite when its divisor is zero.
RATIO_GUARD = 1e-6
INFINITY = float("inf")


# --- derived without learning --------------------------------------------------------------------


def regex_flag(source: str, pattern: str) -> Column:
    """1 where the lower-cased text matches, else 0; missing text is 0."""
    return F.coalesce(F.lower(col(source)).rlike(pattern).cast("int"), F.lit(0))


def interaction(a: str, b: str, operation: str) -> Column:
    left, right = col(a), col(b)
    return {
        "multiply": left * right,
        "add": left + right,
        "subtract": left - right,
        "ratio": F.try_divide(left.cast("double"), right.cast("double") + F.lit(RATIO_GUARD)),
    }[operation]


def add_flags(df: DataFrame, flags: Sequence[RegexFlag]) -> DataFrame:
    usable = {f.output: regex_flag(f.source, f.pattern) for f in flags if f.source in df.columns}
    return df.withColumns(usable) if usable else df


def add_interactions(df: DataFrame, pairs: Sequence[Interaction]) -> DataFrame:
    usable = {p.output: interaction(p.a, p.b, p.operation) for p in pairs if {p.a, p.b} <= set(df.columns)}
    return df.withColumns(usable) if usable else df


def add_plain_features(df: DataFrame, plan: FeaturePlan) -> DataFrame:
    """Time flag, regex flags, interactions and flags as 0/1: one projection each, no learning."""
    if plan.rush_hour_from:
        df = df.withColumn("is_rush_hour", rush_hour(plan.rush_hour_from))
    df = add_interactions(add_flags(df, plan.flags), plan.interactions)
    return flags_to_int(df, keep=[plan.target, *plan.target_sources])


# --- learned -------------------------------------------------------------------------------------


def edges_from(bins: Sequence[Binning], learned: dict[tuple[str, str], float]) -> dict[str, list[float]]:
    """Edges per column, open at both ends; equal widths lie between the extremes of train."""
    edges = {}
    for b in bins:
        inner = sorted(map(float, b.cuts))
        if b.strategy == "equal_width":
            low, high = learned["min", b.column], learned["max", b.column]
            width = (high - low) / b.bins if low is not None else 0  # no known value: one open bin
            inner = sorted({low + width * step for step in range(1, b.bins)}) if width else []
        edges[b.column] = [-INFINITY, *inner, INFINITY]
    return edges


def bin_edges(train: DataFrame, bins: Sequence[Binning]) -> dict[str, list[float]]:
    even = [b.column for b in bins if b.strategy == "equal_width"]
    return edges_from(bins, learn(train, spread_of=even))


def bucketizer(edges: dict[str, list[float]]) -> Bucketizer:
    names = list(edges)
    return Bucketizer(
        splitsArray=[edges[n] for n in names],
        inputCols=names,
        outputCols=[f"{n}_bin" for n in names],
        handleInvalid="keep",
    )


def bin_description(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Bounds and row count of every bin; an end that is open shows as MIN or MAX."""
    spark = df.sparkSession

    def shown(edge: float) -> str:
        return "MIN" if edge == -INFINITY else "MAX" if edge == INFINITY else f"{edge:.2f}"

    names = [(i, f"Bin {i} [{shown(lo)} to {shown(hi)}]") for i, (lo, hi) in enumerate(zip(edges, edges[1:]))]
    binned = bucketizer({column: list(edges)}).transform(df.withColumn(column, known_double(df, column)))
    counted = group_counts(binned.select(col(f"{column}_bin").cast("int").alias("bin")), ["bin"])
    table = spark.createDataFrame(names, "bin int, description string")
    return table.join(counted, "bin", "left").select("bin", "description", F.coalesce("n", F.lit(0)).alias("n"))


def scales_from(
    columns: Sequence[str], strategy: str, learned: dict[tuple[str, str], float]
) -> dict[str, tuple[float, float]]:
    """Offset and factor per column: ``(x - offset) * factor``.

    A constant column scales to 0 (standard) or 0.5 (minmax), kept as factor 0 with that offset.
    """
    out = {}
    for c in columns:
        if strategy == "standard":
            offset, width, constant = learned["mean", c], learned["std", c] or 0.0, 0.0
        else:
            offset, constant = learned["min", c], 0.5
            width = learned["max", c] - offset if offset is not None else 0.0
        out[c] = (offset, 1.0 / width) if width else (constant, 0.0)
    return out


def scale_parameters(train: DataFrame, columns: Sequence[str], strategy: str) -> dict[str, tuple[float, float]]:
    wanted = {"moments_of" if strategy == "standard" else "spread_of": columns}
    return scales_from(columns, strategy, learn(train, **wanted))


def scale(df: DataFrame, parameters: dict[str, tuple[float, float]]) -> DataFrame:
    """Replace every column by its scaled value."""
    usable = {c: p for c, p in parameters.items() if c in df.columns}
    if not usable:
        return df
    scaled = {}
    for c, (offset, factor) in usable.items():
        x = col(c).cast("double")
        scaled[c] = (x - F.lit(offset)) * F.lit(factor) if factor else F.when(x.isNotNull(), F.lit(offset))
    return df.withColumns(scaled)


# --- the whole plan ------------------------------------------------------------------------------


def feature_columns(train: DataFrame, plan: FeaturePlan) -> list[str]:
    """Columns a model may use: planned ones first, then the numbers left over.

    The target, the columns it was made from, and everything derived from either stay out.
    """
    barred = derived_from_target(plan)
    planned = (["is_rush_hour"] if plan.rush_hour_from else []) + [f.output for f in plan.flags]
    planned += [i.output for i in plan.interactions]
    planned += [f.name for f in train.schema if isinstance(f.dataType, T.BooleanType)]
    planned += [b.output for b in plan.bins]
    planned += [e.output for e in plan.encodings if e.output]
    left = [
        f.name
        for f in train.schema
        if isinstance(f.dataType, T.NumericType) and not f.name.endswith("_idx") and f.name not in plan.keys
    ]
    gone = plan.consumed()
    return [c for c in dict.fromkeys([*planned, *left]) if c not in barred and c not in gone]


def derived_from_target(plan: FeaturePlan) -> set[str]:
    """The target, its sources and every planned column with one of them among its ancestors."""
    tainted = {plan.target, *plan.target_sources}
    parents = plan.parents()
    while True:
        more = {name for name, sources in parents.items() if sources & tainted} - tainted
        if not more:
            return tainted
        tainted |= more


@dataclass(frozen=True)
class FittedFeatures:
    plan: FeaturePlan
    stages: PipelineModel
    scales: dict[str, tuple[float, float]]
    features: list[str]
    labels: dict[str, DataFrame] = field(default_factory=dict)  # label tables of columns with more labels than a driver holds

    def transform(self, df: DataFrame) -> DataFrame:
        """Every split goes through the same projections, edges, labels and scales."""
        plain = add_plain_features(df, self.plan)
        staged = self.stages.transform(plain)
        for name, table in self.labels.items():
            staged = index_labels(staged, name, table)
        encoded = scale(staged, self.scales)
        return encoded.drop(*sorted(self.plan.consumed() & set(encoded.columns)))

    def save(self, spark: SparkSession, path: str) -> None:
        self.stages.write().overwrite().save(f"{path}/stages")
        wide = sorted(self.labels)
        for i, name in enumerate(wide):
            self.labels[name].write.mode("overwrite").parquet(f"{path}/labels/{i}")
        rest = json.dumps({"plan": json.loads(self.plan.to_json()), "scales": self.scales, "features": self.features, "wide": wide})
        spark.createDataFrame([(rest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/plan")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedFeatures:
        rest = json.loads(spark.read.text(f"{path}/plan").first()["value"])
        return FittedFeatures(
            plan=FeaturePlan.from_dict(rest["plan"]),
            stages=PipelineModel.load(f"{path}/stages"),
            scales={k: tuple(v) for k, v in rest["scales"].items()},
            features=rest["features"],
            labels={name: spark.read.parquet(f"{path}/labels/{i}") for i, name in enumerate(rest.get("wide", []))},
        )


def fit_features(train: DataFrame, plan: FeaturePlan, index_limit: int = INDEX_LIMIT) -> FittedFeatures:
    """Learn bin edges, category labels and scales on train.

    Two passes whatever the number of columns: one aggregate, and the label counts of all indices. Hand
    in a written table: passes over a long lineage would repeat it. A column with more labels than ``index_limit`` gets its index from a table
    instead of the driver, at one more pass each; as one column for each label it is refused.
    """
    plain = add_plain_features(train, plan)
    present = set(train.columns)
    bins = [b for b in plan.bins if b.column in present]
    hot = [e.column for e in plan.encodings if e.action == "string_index_ohe" and e.column in present]
    indexed = hot + [e.column for e in plan.encodings if e.action == "string_index_only" and e.column in present]
    scaled = [c for c in plan.scaled if c in plain.columns and c not in plan.consumed()] if plan.scaling else []
    learned = learn(
        plain,
        spread_of=[b.column for b in bins if b.strategy == "equal_width"] + (scaled if plan.scaling == "minmax" else []),
        moments_of=scaled if plan.scaling == "standard" else [],
        distinct_of=indexed,
    )
    check_cardinality(hot, learned, index_limit)
    wide = [c for c in indexed if is_wide(c, learned, index_limit)]
    indexed = [c for c in indexed if c not in wide]
    stages: list = []
    if bins:
        stages.append(bucketizer(edges_from(bins, learned)))
    if indexed:
        stages.append(indexer(indexed))
    if hot:
        stages.append(one_hot(hot))
    return FittedFeatures(
        plan=plan,
        stages=Pipeline(stages=stages).fit(plain),
        scales=scales_from(scaled, plan.scaling, learned) if plan.scaling else {},
        features=feature_columns(train, plan),
        labels={c: label_table(plain, c) for c in wide},
    )


def apply_plan(train: DataFrame, test: DataFrame, plan: FeaturePlan, **how) -> tuple[DataFrame, DataFrame, FittedFeatures]:
    fitted = fit_features(train, plan, **how)
    return fitted.transform(train), fitted.transform(test), fitted


# --- vectors -------------------------------------------------------------------------------------


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), output: str = "features") -> DataFrame:
    """Feature vector of every complete row; rows with a gap are skipped.

    Index columns are passed on as plain numbers, so tree models treat them as ordered; the names of the
    vector's slots stay in its metadata.
    """
    plain = df.select(
        *[col(k) for k in keep if k not in features],
        *[(col(f) + F.lit(0.0)).alias(f) if f.endswith("_idx") else col(f) for f in features],
    )
    vector = VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="skip").transform(plain)
    return vector.select(*[col(k) for k in keep], output)


def skipped_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """How many rows ``assemble`` keeps and skips."""
    complete = F.lit(True)
    for f in df.schema:
        if f.name in features:
            gap = col(f.name).isNull()
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                gap = gap | F.isnan(col(f.name))
            complete = complete & ~gap
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(complete).alias("kept"),
        F.count_if(~complete).alias("skipped"),
    )


def slot_names(df: DataFrame, vector: str = "features") -> list[str]:
    """Name of every slot of an assembled vector, from its metadata."""
    kinds = df.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
    slots = [slot for group in kinds.values() for slot in group]
    return [slot["name"] for slot in sorted(slots, key=lambda s: s["idx"])]


def vector_sizes(df: DataFrame, vectors: Sequence[str]) -> DataFrame:
    """Smallest and largest size of every vector column over all rows."""
    sizes = {v: F.size(vector_to_array(col(v))) for v in vectors}
    wide = df.agg(
        *[F.min(s).alias(f"lo{i}") for i, s in enumerate(sizes.values())],
        *[F.max(s).alias(f"hi{i}") for i, s in enumerate(sizes.values())],
    )
    return rows_from(
        wide,
        [
            {
                "column_name": F.lit(v),
                "smallest": F.col(f"lo{i}"),
                "largest": F.col(f"hi{i}"),
                "consistent": F.col(f"lo{i}") == F.col(f"hi{i}"),
            }
            for i, v in enumerate(sizes)
        ],
    )
