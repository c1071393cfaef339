"""What to learn from train, and how categories become numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.functions.columns import col, known_double
from gritmill.operators.joining import lookup_join
from gritmill.operators.ranking import numbered
from gritmill.plans.feature_plan import Encoding
from gritmill.session import materialise

# Up to 20 categories one column each, up to 100,000 an index, beyond that the column goes.
ONE_HOT_LIMIT = 20
INDEX_LIMIT = 100_000


def learn(
    train: DataFrame,
    spread_of: Sequence[str] = (),
    moments_of: Sequence[str] = (),
    distinct_of: Sequence[str] = (),
) -> dict[tuple[str, str], float]:
    """Everything a plan needs to know about train, by (statistic, column), from one pass."""
    wanted: dict[tuple[str, str], Column] = {}
    for c in spread_of:
        wanted["min", c] = F.min(known_double(train, c))
        wanted["max", c] = F.max(known_double(train, c))
    for c in moments_of:
        wanted["mean", c] = F.avg(known_double(train, c))
        wanted["std", c] = F.stddev(known_double(train, c))
    for c in distinct_of:
        wanted["distinct", c] = F.approx_count_distinct(col(c))
    if not wanted:
        return {}
    found = train.agg(*[w.alias(f"w{i}") for i, w in enumerate(wanted.values())]).first()
    return {key: found[f"w{i}"] for i, key in enumerate(wanted)}


def is_wide(name: str, learned: dict[tuple[str, str], float], limit: int = INDEX_LIMIT) -> bool:
    """Whether a column has more labels than ``indexer`` may hold in the driver, by an estimate; ``label_table`` takes such columns."""
    return learned["distinct", name] > limit * 1.1


def check_cardinality(columns: Sequence[str], learned: dict[tuple[str, str], float], limit: int = INDEX_LIMIT) -> None:
    wide = [c for c in columns if is_wide(c, learned, limit)]
    if wide:
        raise ValueError(f"more than {limit} values, drop or group first: {wide}")


def indexer(columns: Sequence[str]) -> StringIndexer:
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_idx" for c in columns],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def label_table(train: DataFrame, name: str) -> DataFrame:
    """``<name>, <name>_idx, n``: every known label with its index, the most frequent first and equal ones by the label, written.

    The same index as ``indexer`` learns, for columns with more labels than a driver holds.
    """
    counts = train.filter(col(name).isNotNull()).groupBy(col(name)).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), col(name).asc()]
    places = numbered(materialise(counts, "label_counts"), order, "_place")
    return materialise(places.select(col(name), F.col("_place").cast("double").alias(f"{name}_idx"), "n"), "labels")


def index_labels(df: DataFrame, name: str, labels: DataFrame) -> DataFrame:
    """Add ``<name>_idx`` from a ``label_table``; null and labels that train did not have take the number after the last."""
    unseen = float(labels.count())
    joined = lookup_join(df, labels.drop("n"), [name])
    return joined.withColumn(f"{name}_idx", F.coalesce(col(f"{name}_idx"), F.lit(unseen)))


def one_hot(columns: Sequence[str]) -> OneHotEncoder:
    """One slot per known label; the slot for unseen values is the dropped one, so they are all zero."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_ohe" for c in columns])


def encoding_choice(categories: DataFrame, one_hot_limit: int = ONE_HOT_LIMIT, index_limit: int = INDEX_LIMIT) -> DataFrame:
    """Encoding per categorical column from its distinct count."""
    n = F.col("distinct_count")
    action = (
        F.when(n <= one_hot_limit, F.lit("string_index_ohe"))
        .when(n <= index_limit, F.lit("string_index_only"))
        .otherwise(F.lit("drop"))
    )
    return categories.select("column_name", "distinct_count", action.alias("action"))


def encodings_from(choice: DataFrame) -> tuple[Encoding, ...]:
    """Plan entries from ``encoding_choice``; one row per column."""
    return tuple(Encoding(r["column_name"], r["action"]) for r in choice.orderBy("column_name").collect())
