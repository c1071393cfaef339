"""The four stages for the traffic-incident table: clean, review, engineer, compare.

Each stage is a few operators in a row; a table that several later steps read is written in between.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from gritmill.functions.columns import col, hash_percent, missing
from gritmill.functions.moments_in_time import seconds_between
from gritmill.operators import cleaning as clean
from gritmill.operators import features as feat
from gritmill.operators import gates, imputing
from gritmill.operators import profiling as prof
from gritmill.operators import training as fit
from gritmill.operators.leaking import leaking_features
from gritmill.operators.runs import evaluated, keep_training
from gritmill.operators.searching import Found, search
from gritmill.operators.splitting import balance_classes
from gritmill.plans.feature_plan import FeaturePlan, RegexFlag
from gritmill.plans.planner import build_plan, pattern_flags, plan_rows
from gritmill.session import materialise
from gritmill.sources.tables import csv_to_parquet

# The columns of the raw file, in its order.
RAW_SCHEMA = """
    `ID` string, `Source` string, `Severity` int, `Start_Time` timestamp_ntz, `End_Time` timestamp_ntz,
    `Start_Lat` double, `Start_Lng` double, `End_Lat` double, `End_Lng` double, `Distance(mi)` double,
    `Description` string, `Street` string, `City` string, `County` string, `State` string, `Zipcode` string,
    `Country` string, `Timezone` string, `Airport_Code` string, `Weather_Timestamp` timestamp_ntz,
    `Temperature(F)` double, `Wind_Chill(F)` double, `Humidity(%)` double, `Pressure(in)` double,
    `Visibility(mi)` double, `Wind_Direction` string, `Wind_Speed(mph)` double, `Precipitation(in)` double,
    `Weather_Condition` string, `Amenity` boolean, `Bump` boolean, `Crossing` boolean, `Give_Way` boolean,
    `Junction` boolean, `No_Exit` boolean, `Railway` boolean, `Roundabout` boolean, `Station` boolean,
    `Stop` boolean, `Traffic_Calming` boolean, `Traffic_Signal` boolean, `Turning_Loop` boolean,
    `Sunrise_Sunset` string, `Civil_Twilight` string, `Nautical_Twilight` string, `Astronomical_Twilight` string
"""


@dataclass(frozen=True)
class Recipe:
    """Names and thresholds of the cleaning stage; the defaults are fixed values for this table."""

    surrogate: tuple[str, ...] = ("ID",)
    unused: tuple[str, ...] = (
        "Country", "Turning_Loop", "Source", "End_Lat", "End_Lng", "Description", "Wind_Chill(F)", "Weather_Timestamp",
    )
    distance: str = "Distance(mi)"
    distance_below: float = 20.0
    start: str = "Start_Time"
    end: str = "End_Time"
    seconds_above: int = 5 * 60
    seconds_up_to: int = 288 * 3600
    wind: str = "Wind_Direction"
    wind_groups: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("CALM", ("Calm",)),
        ("N", ("North", "NNE", "NNW")),
        ("E", ("East", "ENE", "ESE")),
        ("S", ("South", "SSE", "SSW")),
        ("W", ("West", "WNW", "WSW")),
        ("VAR", ("Variable",)),
    )
    group: tuple[str, ...] = ("Airport_Code", "Start_Time_Month")
    measures: tuple[str, ...] = (
        "Temperature(F)", "Humidity(%)", "Pressure(in)", "Visibility(mi)", "Wind_Speed(mph)", "Precipitation(in)",
    )
    required: tuple[str, ...] = (
        "City", "Zipcode", "Airport_Code", "Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight",
        "Astronomical_Twilight", "Street", "Weather_Condition",
    )
    key: tuple[str, ...] = ("Start_Time", "Start_Lat", "Start_Lng", "Street")
    late_prefixes: tuple[str, ...] = ("End_Time", "Duration")
    late: tuple[str, ...] = (
        "Distance(mi)", "Amenity", "Bump", "Give_Way", "No_Exit", "Railway", "Roundabout", "Traffic_Calming",
    )
    severity: str = "Severity"
    high_from: int = 3
    target: str = "high_severity"


def ingest(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    return csv_to_parquet(spark, csv_path, parquet_path, RAW_SCHEMA)


def row_rules(df: DataFrame, recipe: Recipe) -> list[tuple[str, Column]]:
    """Conditions a raw row must meet, each looking at that row only."""
    seconds = seconds_between(recipe.start, recipe.end)
    there = F.lit(True)
    for name in recipe.required:
        there = there & ~missing(name, df.schema[name].dataType)
    return [
        ("distance", col(recipe.distance) < recipe.distance_below),
        ("duration", (seconds > recipe.seconds_above) & (seconds <= recipe.seconds_up_to)),
        ("wind", col(recipe.wind).isNotNull()),
        ("required", there),
    ]


def account(raw: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """Rows each rule drops, from one pass over the raw table."""
    return clean.step_accounting(raw, row_rules(raw, recipe))


def clean_incidents(
    raw: DataFrame, recipe: Recipe = Recipe(), train_percent: int = 80, ledger: list[tuple[str, int, int, int]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cleaned train and test.

    ``ledger`` takes in (step, rows before, rows after, gaps after) of every step. A row carries the number of rows it stands for through
    de-duplication and reduction to the key, so the written splits tell what these steps dropped, also when tasks ran twice; the row rules take one
    more scan of the columns they look at.

    Row rules come first: they commute with de-duplication, which then shuffles fewer rows. Incidents
    are reduced to one row per natural key before the split, which hashes that key, so no incident is in
    both splits; among its rows the one with the fewest gaps is kept. Medians come from train alone.
    """
    kept = raw
    for _, rule in row_rules(raw, recipe):
        kept = kept.filter(rule)
    counted = ledger is not None
    plain = kept.drop(*recipe.surrogate)
    if counted:
        one = _counted_firsts(plain, recipe)
    else:
        # Copies are equal in the key as well, so the reduction to the key takes them in; only the ledger has to tell the two apart.
        one = clean.first_per_key(_prepared(plain, recipe), recipe.key, ["_gaps"])
    one = one.drop("_gaps")
    slim = clean.drop_prefixed(one, recipe.late_prefixes, recipe.late)
    target = clean.binarise(slim, recipe.severity, recipe.high_from, recipe.target)
    split = hash_percent(*[col(k) for k in recipe.key]) < train_percent
    marked = materialise(target.withColumn("_train", split), "cleaned")
    if counted:
        raw_rows, rows, n, gaps_left = _sums(marked, recipe, F.sum("_raw"), F.sum("_distinct"), F.count(F.lit(1)))
        after_rules = [(r["step"], r["rows_in"], r["rows_out"], 0) for r in account(raw, recipe).orderBy("step_no").collect()]
        ledger += [*after_rules, ("copies", raw_rows, rows, 0), ("key", rows, n, gaps_left)]
        marked = marked.drop("_raw", "_distinct")
    filled = materialise(imputing.fill_marked(marked, "_train", recipe.group, recipe.measures), "filled")
    if counted:
        rows, gaps_left = _sums(filled, recipe, F.count(F.lit(1)))
        ledger.append(("medians", n, rows, gaps_left))
    return filled.filter("_train").drop("_train"), filled.filter("NOT _train").drop("_train")


def _prepared(df: DataFrame, recipe: Recipe) -> DataFrame:
    """The rows without unused columns, with durations, wind groups and the number of gaps in the measures."""
    slim = df.drop(*recipe.unused)
    timed = clean.add_durations(clean.add_calendar(slim, recipe.start, recipe.end), recipe.start, recipe.end)
    named = clean.canonicalise(timed, recipe.wind, dict(recipe.wind_groups))
    gaps = F.lit(0)
    for m in recipe.measures:
        gaps = gaps + missing(m, named.schema[m].dataType).cast("int")
    return named.withColumn("_gaps", gaps)


def _counted_firsts(plain: DataFrame, recipe: Recipe) -> DataFrame:
    """One row per key with the number of rows, ``_raw``, and of distinct rows, ``_distinct``, that it stands for.

    The rows are written, so that their keys can be counted first: a row that is alone with its key is no copy either, and is neither shuffled nor
    sorted. A key that the preparation makes or changes is not known before it: then all rows are shuffled.
    """
    written = materialise(plain, "kept")
    known = all(k in plain.columns and k != recipe.wind for k in recipe.key)
    alone, several = clean.apart_by_key(written, recipe.key) if known else (None, written)
    parts = []
    if alone is not None:
        one = F.lit(1).cast("long")
        parts.append(_prepared(alone, recipe).withColumns({"_raw": one, "_distinct": one}))
    if several is not None:
        totals = {"_raw": F.sum("_raw"), "_distinct": F.count(F.lit(1))}
        parts.append(clean.first_per_key(_prepared(clean.counted_copies(several, (), "_raw"), recipe), recipe.key, ["_gaps"], totals))
    return reduce(DataFrame.unionByName, parts)


def _sums(df: DataFrame, recipe: Recipe, *sums: Column) -> tuple[int, ...]:
    """The sums, and the gaps in the measures; 0 for an empty table."""
    gaps = F.lit(0)
    for m in recipe.measures:
        gaps = gaps + missing(m, df.schema[m].dataType).cast("long")
    return tuple(x or 0 for x in df.agg(*[s.alias(f"s{i}") for i, s in enumerate([*sums, F.sum(gaps)])]).first())


def ledger_table(spark: SparkSession, ledger: Sequence[tuple[str, int, int, int]]) -> DataFrame:
    """``step_no, step, rows_in, rows_out, dropped, gaps`` of the cleaning steps."""
    rows = [(i, step, before, after, before - after, gaps) for i, (step, before, after, gaps) in enumerate(ledger, 1)]
    return spark.createDataFrame(rows, "step_no int, step string, rows_in long, rows_out long, dropped long, gaps long")


@dataclass(frozen=True)
class Review:
    missing: DataFrame
    numbers: DataFrame
    categories: DataFrame
    pairs: DataFrame
    target: DataFrame
    timestamps: DataFrame
    decision: DataFrame
    cleaning: DataFrame
    features: DataFrame
    warnings: DataFrame


TEXTS = ("Street", "Weather_Condition")


def review(train: DataFrame, recipe: Recipe = Recipe(), texts: Sequence[str] = TEXTS) -> Review:
    """Profile of the cleaned table and the decision whether to go on."""
    times = [recipe.start]
    numbers = prof.columns_with_role(train, prof.ROLE_NUMBER, times)
    categories = prof.columns_with_role(train, prof.ROLE_CATEGORY, times)
    gaps = materialise(prof.missing_profile(train), "missing")
    number_table = materialise(prof.numeric_profile(train, numbers), "numbers")
    counts = prof.category_counts(train, categories)
    category_table = materialise(prof.category_profile(counts, texts), "categories")
    pairs = materialise(prof.correlation_pairs(train, numbers), "pairs")
    target = materialise(prof.target_profile(train, recipe.target), "target")
    years = materialise(prof.timestamp_profile(train, times), "timestamps")
    score = gates.quality_score(gates.critical_issues(gaps, category_table))
    return Review(
        missing=gaps,
        numbers=number_table,
        categories=category_table,
        pairs=pairs,
        target=target,
        timestamps=years,
        decision=gates.cleaning_gate(score),
        cleaning=gates.cleaning_advice(gaps, number_table, pairs),
        features=gates.feature_advice(category_table, target, texts),
        warnings=gates.quality_warnings(gaps, target, years),
    )


def plan_features(
    train: DataFrame,
    found: Review,
    recipe: Recipe = Recipe(),
    texts: Sequence[str] = TEXTS,
    extra_flags: Sequence[RegexFlag] = pattern_flags(),
) -> FeaturePlan:
    """The plan the rules write: known word groups and discovered keywords become flags.

    A known group keeps its name and pattern; a keyword whose flag would take a name that is given already is named after its column too.
    """
    tokens: Mapping[str, DataFrame] = {t: prof.frequent_tokens(train, t) for t in texts}
    plan = build_plan(
        materialise(plan_rows(found.categories, found.numbers, tokens), "plan"),
        recipe.target,
        [recipe.severity],
        rush_hour_from=recipe.start,
        drops=[recipe.start],
    )
    named = {f.output: f for f in extra_flags}
    for f in plan.flags:
        output = f.output if f.output not in named else f"{f.source}_{f.output}"
        if not any((f.source, f.pattern) == (g.source, g.pattern) for g in named.values()):
            named[output] = RegexFlag(f.source, output, f.pattern)
    return FeaturePlan.from_dict({**plan.as_dict(), "flags": [vars(f) for f in named.values()]})


@dataclass(frozen=True)
class Engineered:
    train: DataFrame
    test: DataFrame
    fitted: feat.FittedFeatures
    checks: DataFrame
    decision: DataFrame
    leaks: DataFrame  # features that tell the target by themselves, whatever their lineage says


def engineer(train: DataFrame, test: DataFrame, plan: FeaturePlan) -> Engineered:
    """Both splits through the plan, checked, and without the flags that say nothing."""
    train, test, fitted = feat.apply_plan(train, test, plan)
    train, test = materialise(train, "engineered_train"), materialise(test, "engineered_test")
    checks = materialise(gates.feature_checks(train, fitted.features, plan), "checks")
    odd = materialise(gates.suspicious_flags(gates.engineered_profile(train, plan.target), plan.flags), "odd_flags")
    decision = gates.feature_gate(odd, checks, len(plan.flags), len(fitted.features))
    (train, test), fitted = gates.prune(odd, fitted, train, test)
    numbers = [f.name for f in train.schema if f.name in fitted.features and isinstance(f.dataType, NumericType)]
    leaks = materialise(leaking_features(train, numbers, plan.target), "leaks")
    return Engineered(train, test, fitted, checks, decision, leaks)


def vectors_of(ready: Engineered) -> tuple[DataFrame, DataFrame]:
    """Balanced training vectors with ``_row``, a hash of all plain columns that tells nearly all rows apart, and test vectors."""
    label, names = ready.fitted.plan.target, ready.fitted.features
    plain = [col(f.name) for f in ready.train.schema if not isinstance(f.dataType, VectorUDT)]
    hashed = ready.train.withColumn("_row", F.xxhash64(*plain))
    vectors = materialise(feat.assemble(hashed, names, keep=[label, "_row"]), "vectors")
    train = materialise(balance_classes(vectors, label, ["_row"]), "balanced")
    return train, materialise(feat.assemble(clean.pad_columns(ready.test, names), names, keep=[label]), "test_vectors")


def compare_models(
    ready: Engineered,
    grids: Mapping[str, Mapping[str, Sequence[object]]],
    iteration: int = 1,
    keep: tuple[str, str] | None = None,
) -> tuple[DataFrame, DataFrame, dict[str, fit.Trained]]:
    """Leaderboard on the test split, the decision, and the trained models.

    ``keep`` names a folder and a run: models, metrics, importances, curves, folds and settings are stored there.
    """
    label = ready.fitted.plan.target
    train, test = vectors_of(ready)
    models = fit.train_classifiers(train, grids, label, fold_keys=["_row"])
    if keep:
        board = keep_training(*keep, models, train, test, label)
    else:
        board, _ = evaluated({name: m.model for name, m in models.items()}, test, label)
    return board, fit.next_action(fit.pick_winner(board, "model", "auc_roc"), iteration), models


def search_models(ready: Engineered, grids: Mapping[str, Mapping[str, Sequence[object]]], keep: tuple[str, str] | None = None, **how) -> Found:
    """The search with its second try on the engineered splits; ``keep`` stores what it trained, as in ``compare_models``."""
    label = ready.fitted.plan.target
    train, test = vectors_of(ready)
    found = search(train, test, label, ["_row"], grids, **how)
    if keep:
        keep_training(*keep, found.trained, train, test, label)
    return found
