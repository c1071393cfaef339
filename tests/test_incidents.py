"""The four stages on a small made-up incident file with the real columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gritmill.operators import leaking
from gritmill.operators.runs import evaluate_saved_models
from gritmill.plans import incidents
from gritmill.session import fresh_path

FLAGS = [
    "Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout", "Station", "Stop",
    "Traffic_Calming", "Traffic_Signal",
]


@pytest.fixture(scope="module")
def raw(spark):
    i = F.col("id")

    def pick(values, step=1):
        return F.element_at(F.array(*[F.lit(v) for v in values]), ((i * step) % len(values) + 1).cast("int"))

    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    start = F.timestamp_add("MINUTE", i * 97, F.lit("2021-01-01 00:05:00").cast("timestamp_ntz"))
    columns = {
        "ID": F.concat(F.lit("A-"), i),
        "Source": F.lit("Source1"),
        "Severity": F.when(noise > 0.72, 3).when(noise > 0.02, 2).otherwise(4),
        "Start_Time": start,
        "End_Time": F.timestamp_add("MINUTE", F.when(i % 50 == 0, 4).otherwise(30 + i % 90), start),
        "Start_Lat": F.round(33 + noise, 4),
        "Start_Lng": F.round(-84 - noise, 4),
        "Distance(mi)": F.when(i % 40 == 0, 25.0).otherwise(noise * 3),
        "Street": pick(["Main St", "I-95 N", "Oak Ave", "State Highway 7", "County Rd 12", "5th Blvd"], 7),
        "City": F.when(i % 60 == 0, None).otherwise(pick(["Atlanta", "Macon"])),
        "County": pick(["Fulton", "Bibb", "Cobb"]),
        "State": pick(["GA", "FL"]),
        "Zipcode": pick(["30301", "31201", "30060"]),
        "Country": F.lit("US"),
        "Timezone": pick(["US/Eastern", "US/Central"]),
        "Airport_Code": pick(["KATL", "KMCN"]),
        "Temperature(F)": F.when(i % 11 == 0, None).otherwise(F.round(30 + noise * 60, 0)),
        "Humidity(%)": F.when(i % 13 == 0, None).otherwise(F.round(20 + noise * 70, 0)),
        "Pressure(in)": F.round(29 + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(100)) / 100, 2),
        "Visibility(mi)": pick([10.0, 0.2, 3.0, 7.0, 10.0]),
        "Wind_Direction": F.when(i % 70 == 0, None).otherwise(pick(["Calm", "NNE", "South", "SW", "Variable"])),
        "Wind_Speed(mph)": pick([0.0, 7.0, 18.0, 33.0], 3),
        "Precipitation(in)": F.when(i % 3 == 0, 0.1).otherwise(0.0),
        "Weather_Condition": pick(["Fair", "Light Rain", "Fog", "Mostly Cloudy", "Heavy Snow"], 3),
        **{f: F.pmod(F.xxhash64("id", F.lit(f)), F.lit(7)) == 0 for f in FLAGS},
        "Turning_Loop": F.lit(False),
        **{c: pick(["Day", "Night"]) for c in ("Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight")},
    }
    base = spark.range(900).select(*[c.alias(n) for n, c in columns.items()])
    empty = spark.createDataFrame([], incidents.RAW_SCHEMA)
    first = base.unionByName(empty.limit(0), allowMissingColumns=True).select(*empty.columns)
    copies = first.limit(0).union(first.filter(F.col("ID").isin("A-1", "A-2", "A-3"))).withColumn("ID", F.concat(F.lit("B"), "ID"))
    return first.union(copies)


@pytest.fixture(scope="module")
def stored(spark, raw):
    csv, parquet = fresh_path(spark, "csv"), fresh_path(spark, "parquet")
    raw.write.option("header", True).csv(csv)
    return incidents.ingest(spark, csv, parquet)


@pytest.fixture(scope="module")
def splits(stored):
    return incidents.clean_incidents(stored)


def test_ingest_keeps_every_value(raw, stored):
    assert stored.schema.simpleString() == raw.schema.simpleString()
    assert stored.exceptAll(raw).count() == raw.exceptAll(stored).count() == 0


def test_rows_are_accounted_for(stored, splits):
    steps = {r["step"]: r for r in incidents.account(stored).collect()}
    assert steps["distance"]["rows_in"] == 903 and all(r["dropped"] > 0 for r in steps.values())
    train, test = splits
    assert train.count() + test.count() == steps["required"]["rows_out"] - 3


def test_every_step_is_in_the_ledger(spark, stored, splits):
    ledger = []
    again = incidents.clean_incidents(stored, ledger=ledger)
    for a, b in zip(again, splits, strict=True):
        assert a.columns == b.columns and a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    steps = {r["step"]: r for r in incidents.ledger_table(spark, ledger).collect()}
    assert list(steps) == ["distance", "duration", "wind", "required", "copies", "key", "medians"]
    rows = [r["rows_in"] for r in steps.values()] + [steps["medians"]["rows_out"]]
    assert rows[0] == stored.count() and all(r["rows_out"] == after for r, after in zip(steps.values(), rows[1:], strict=True))
    assert steps["medians"]["rows_out"] == sum(p.count() for p in splits) and steps["copies"]["dropped"] + steps["key"]["dropped"] == 3
    assert steps["key"]["gaps"] > 0 and steps["medians"]["gaps"] == 0
    empty = []
    incidents.clean_incidents(stored.limit(0), ledger=empty)
    assert [x[1:3] for x in empty] == [(0, 0)] * 7


def test_splits_are_clean(splits):
    train, test = splits
    assert train.columns == test.columns and "ID" not in train.columns and "Duration_Seconds" not in train.columns
    key = list(incidents.Recipe().key)
    assert train.select(key).intersect(test.select(key)).count() == 0
    for part in splits:
        measures = list(incidents.Recipe().measures)
        assert part.dropna(subset=measures).count() == part.count()
        assert {r[0] for r in part.select("Wind_Direction").distinct().collect()} <= {"CALM", "N", "S", "SW", "VAR"}
        assert part.filter((F.col("Severity") >= 3).cast("int") != F.col("high_severity")).count() == 0


def test_all_stages(spark, splits):
    train, test = splits
    found = incidents.review(train)
    assert found.decision.first()["decision"] == "accept"
    assert found.missing.filter("null_count > 0").count() == 0
    plan = incidents.plan_features(train, found)
    outputs = {f.output for f in plan.flags}
    assert {f.pattern for f in plan.flags if f.output == "is_rain"} == {"rain|storm|drizzle|shower|thunder"} and len(outputs) == len(plan.flags)
    assert {"is_rain", "is_highway"} <= outputs and {b.column for b in plan.bins} == {
        "Temperature(F)", "Visibility(mi)", "Wind_Speed(mph)"
    }
    ready = incidents.engineer(train, test, plan)
    assert ready.checks.filter("status = 'FAIL'").count() == 0
    assert "Severity" not in ready.fitted.features and "high_severity" not in ready.fitted.features
    assert ready.train.count() == train.count()
    grids = {"LogisticRegression": {"regParam": [0.01], "maxIter": [10]}, "RandomForestClassifier": {"numTrees": [5], "maxDepth": [3]}}
    board, decision, models = incidents.compare_models(ready, grids)
    assert set(models) == set(grids) and board.count() == 2
    assert decision.first()["winner"] in grids and ready.leaks.columns == ["feature", "auc", "strength"]
    root = fresh_path(spark, "runs")
    found = incidents.search_models(ready, grids, (root, "first"), portfolio=(tuple(grids),), rungs=((1.0, 1.0),))
    again = evaluate_saved_models(spark, root, incidents.vectors_of(ready)[1], "high_severity").collect()
    assert {r["model"] for r in again} == set(found.trained) == set(grids) and found.winner in grids


def test_raw_table_is_rejected(stored):
    raw_target = stored.withColumn("high_severity", (F.col("Severity") >= 3).cast("int"))
    assert incidents.review(raw_target).decision.first()["decision"] == "reject"


def test_registered_comparison_searches_all_classifiers(spark, monkeypatch):
    from gritmill.operators import training
    from gritmill.workload import staging

    board = spark.createDataFrame([("LogisticRegression", 0.5)], "model string, auc_roc double")
    given = []

    def compared(ready, grids):
        given.append(grids)
        return board, spark.createDataFrame([("LogisticRegression", 0.5, "retrain")], "winner string, winner_auc double, next_action string"), {}

    monkeypatch.setattr(staging, "_engineered", lambda spark, sf: (None, None))
    monkeypatch.setattr(staging.incidents, "compare_models", compared)
    assert staging.incidents_compared(spark, "").count() == 1
    (grids,) = given
    assert set(grids) == set(training.CLASSIFIERS)
    for name, default in training.DEFAULT_GRID.items():
        assert all(set(values) <= set(grids[name][setting]) for setting, values in default.items())
        assert len(training.grid_for(training.classifier(name, "label"), grids[name])[0]) >= 2


def test_cleaning_shuffles_copies_only_with_their_key(stored, splits, monkeypatch):
    def refused(*args):
        raise AssertionError("a shuffle of whole rows that the key's reduction makes needless")

    monkeypatch.setattr(incidents.clean, "drop_copies", refused)
    for a, b in zip(incidents.clean_incidents(stored), splits, strict=True):
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_leak_bins_are_searched_for_and_hold_equal_and_infinite_values(spark, monkeypatch):
    searched = []

    def recording(**settings):
        searched.extend(settings["inputCols"])
        return bucketizer(**settings)

    bucketizer = leaking.Bucketizer
    monkeypatch.setattr(leaking, "Bucketizer", recording)
    odd = [float("inf"), float("-inf"), 0.0, -0.0, None, float("nan"), 1.0, -1.0]
    rows = [(odd[i % 8], -0.0 if i % 2 else 0.0, None, i % 3 % 2) for i in range(96)]
    df = spark.createDataFrame(rows, "odd double, zeros double, nothing double, y int")
    names = ["odd", "zeros", "nothing"]
    exact = {r["feature"]: r["auc"] for r in leaking.exact_areas(df, names, "y").collect()}
    bounds = {r["feature"]: r for r in leaking.area_intervals(df, names, "y", 8).collect()}
    assert searched
    for name, auc in exact.items():
        if auc is not None:
            assert bounds[name]["low"] - 1e-6 <= auc <= bounds[name]["high"] + 1e-6
    assert exact["zeros"] == 0.5


def test_ledger_sorts_only_rows_that_share_a_key(stored, splits, monkeypatch):
    reduced = []

    def recording(df, *how):
        reduced.append(df.count())
        return first(df, *how)

    first = incidents.clean.first_per_key
    monkeypatch.setattr(incidents.clean, "first_per_key", recording)
    ledger = []
    again = incidents.clean_incidents(stored, ledger=ledger)
    rows = {step: after for step, _, after, _ in ledger}
    assert rows["copies"] >= rows["key"] > sum(reduced)
    for a, b in zip(again, splits, strict=True):
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
