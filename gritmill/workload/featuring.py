"""Feature operators and whole feature plans over the given tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gritmill.functions.columns import col
from gritmill.functions.moments_in_time import rush_hour
from gritmill.operators import encoding as encode
from gritmill.operators import features as feat
from gritmill.operators import profiling as prof
from gritmill.operators.splitting import key_split
from gritmill.plans.feature_plan import Binning, Encoding, FeaturePlan, Interaction, RegexFlag
from gritmill.plans.planner import build_plan, plan_rows
from gritmill.session import fresh_path, materialise
from gritmill.workload.profiling import CATEGORIES, CATEGORY_SQL, NUMBERS, token_sql
from gritmill.workload.registry import query
from gritmill.workload.views import (
    FACT_SQL,
    LINES_SQL,
    fact,
    hash_sql,
    lines,
    table,
    written_fact,
    written_splits,
)

RUSH_SQL = "CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 THEN 1 ELSE 0 END"


@query("rush_hour_flag", f"SELECT event_id, {RUSH_SQL} AS is_rush_hour FROM events")
def rush_hour_flag(spark, sf):
    return table(spark, sf, "events").select("event_id", rush_hour("ts").alias("is_rush_hour"))


NAME_FLAGS = {"is_color": "red|blue|green", "is_tool": "bolt|gear|ring", "is_small": "small|tiny"}


@query(
    "regex_flags",
    "SELECT p_partkey, "
    + ", ".join(f"coalesce(regexp_matches(lower(p_name), '{p}')::INT, 0) AS {n}" for n, p in NAME_FLAGS.items())
    + " FROM part",
)
def regex_flags(spark, sf):
    flags = [RegexFlag("p_name", n, p) for n, p in NAME_FLAGS.items()]
    return feat.add_flags(table(spark, sf, "part"), flags).select("p_partkey", *NAME_FLAGS)


TEXT_FLAGS = {"has_year": "(19|20)[0-9][0-9]", "has_link": "https?://", "has_license": "license|copyright"}


@query(
    "regex_flags_documents",
    "SELECT lang, "
    + ", ".join(f"CAST(sum(regexp_matches(lower(text), '{p}')::INT) AS BIGINT) AS {n}" for n, p in TEXT_FLAGS.items())
    + " FROM documents GROUP BY 1",
)
def regex_flags_documents(spark, sf):
    flags = [RegexFlag("text", n, p) for n, p in TEXT_FLAGS.items()]
    flagged = feat.add_flags(table(spark, sf, "documents"), flags)
    return flagged.groupBy("lang").agg(*[F.sum(n).alias(n) for n in TEXT_FLAGS])


PAIRS = [
    Interaction("l_quantity", "l_tax", "multiply"),
    Interaction("l_quantity", "l_discount", "add"),
    Interaction("l_extendedprice", "l_quantity", "subtract"),
    Interaction("l_extendedprice", "l_tax", "ratio"),
]


@query(
    "interactions",
    """
    SELECT l_suppkey, round(sum(l_quantity * l_tax), 4) AS l_quantity_multiply_l_tax,
           round(sum(l_quantity + l_discount), 4) AS l_quantity_add_l_discount,
           round(sum(l_extendedprice - l_quantity), 2) AS l_extendedprice_subtract_l_quantity,
           round(avg(log10(l_extendedprice / (l_tax + 1e-6))), 6) AS l_extendedprice_ratio_l_tax
    FROM lineitem GROUP BY 1
    """,
)
def interactions(spark, sf):
    made = feat.add_interactions(table(spark, sf, "lineitem"), PAIRS)
    multiply, add, subtract, ratio = [p.output for p in PAIRS]
    return made.groupBy("l_suppkey").agg(
        F.round(F.sum(multiply), 4).alias(multiply),
        F.round(F.sum(add), 4).alias(add),
        F.round(F.sum(subtract), 2).alias(subtract),
        F.round(F.avg(F.log10(ratio)), 6).alias(ratio),
    )


@query(
    "bins_custom_cuts",
    f"""
    WITH {LINES_SQL}
    SELECT order_key, line_no, part_key,
           CASE WHEN "Temperature(F)" < 10 THEN 0.0::DOUBLE WHEN "Temperature(F)" < 25 THEN 1 WHEN "Temperature(F)" < 40 THEN 2
                WHEN "Temperature(F)" IS NOT NULL THEN 3 END AS "Temperature(F)_bin"
    FROM lines
    """,
)
def bins_custom_cuts(spark, sf):
    source = lines(spark, sf)
    edges = feat.bin_edges(source, [Binning("Temperature(F)", "custom_cuts", cuts=(10.0, 25.0, 40.0))])
    binned = feat.bucketizer(edges).transform(source)
    return binned.select("order_key", "line_no", "part_key", col("Temperature(F)_bin"))


@query(
    "bins_equal_width",
    """
    WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    w AS (SELECT lo, (hi - lo) / 5 AS width FROM e)
    SELECT CAST((value >= lo + width)::INT + (value >= lo + width * 2)::INT + (value >= lo + width * 3)::INT
           + (value >= lo + width * 4)::INT AS DOUBLE) AS value_bin, count(*) AS n, min(value) AS smallest, max(value) AS largest
    FROM events, w GROUP BY 1
    """,
)
def bins_equal_width(spark, sf):
    events = table(spark, sf, "events")
    edges = feat.bin_edges(events, [Binning("value", "equal_width", bins=5)])
    return feat.bucketizer(edges).transform(events).groupBy("value_bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("smallest"), F.max("value").alias("largest")
    )


@query(
    "bin_descriptions",
    """
    SELECT 0 AS bin, 'Bin 0 [MIN to 10.00]' AS description, count(*) FILTER (value < 10) AS n FROM events
    UNION ALL SELECT 1, 'Bin 1 [10.00 to 50.00]', count(*) FILTER (value >= 10 AND value < 50) FROM events
    UNION ALL SELECT 2, 'Bin 2 [50.00 to MAX]', count(*) FILTER (value >= 50) FROM events
    """,
)
def bin_descriptions(spark, sf):
    events = table(spark, sf, "events")
    edges = feat.bin_edges(events, [Binning("value", "custom_cuts", cuts=(10.0, 50.0))])
    return feat.bin_description(events, "value", edges["value"])


def index_sql(column: str, source: str, name: str) -> str:
    return (
        f"{name} AS (SELECT {column} AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS i "
        f"FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"
    )


@query(
    "string_index",
    f"""
    WITH {index_sql("p_brand", "part", "b")}, {index_sql("p_type", "part", "t")}
    SELECT p_partkey, b.i AS p_brand_idx, t.i AS p_type_idx FROM part JOIN b ON p_brand = b.value JOIN t ON p_type = t.value
    """,
)
def string_index(spark, sf):
    part = table(spark, sf, "part")
    indexed = encode.indexer(["p_brand", "p_type"]).fit(part).transform(part)
    return indexed.select("p_partkey", "p_brand_idx", "p_type_idx")


@query(
    "string_index_table",
    f"""
    WITH {index_sql("CAST(l_partkey AS VARCHAR)", f"(SELECT * FROM lineitem WHERE {hash_sql('l_orderkey')} % 100 < 80)", "b")}
    SELECT l_orderkey, l_linenumber, coalesce(b.i, (SELECT CAST(count(*) AS DOUBLE) FROM b)) AS part_idx
    FROM lineitem LEFT JOIN b ON CAST(l_partkey AS VARCHAR) = b.value
    """,
)
def string_index_table(spark, sf):
    """A column of many labels, indexed by a table that train makes and that no driver holds; labels train did not have take the last number."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    train, _ = key_split(rows, ["l_orderkey"])
    return encode.index_labels(rows, "part", encode.label_table(train, "part")).drop("part")


SLOTS = 6


@query(
    "one_hot_slots",
    f"""
    WITH {index_sql("p_type", "part", "t")}
    SELECT p_partkey, {", ".join(f"(t.i = {i})::INT AS slot_{i}" for i in range(SLOTS))} FROM part JOIN t ON p_type = t.value
    """,
)
def one_hot_slots(spark, sf):
    part = table(spark, sf, "part")
    indexed = encode.indexer(["p_type"]).fit(part).transform(part)
    encoded = encode.one_hot(["p_type"]).fit(indexed).transform(indexed)
    slots = vector_to_array("p_type_ohe")
    return encoded.select("p_partkey", *[slots[i].cast("int").alias(f"slot_{i}") for i in range(SLOTS)])


@query(
    "encoding_choice",
    f"""
    WITH {FACT_SQL}, {CATEGORY_SQL}
    SELECT column_name, distinct_count, CASE WHEN distinct_count <= 20 THEN 'string_index_ohe'
           WHEN distinct_count <= 100000 THEN 'string_index_only' ELSE 'drop' END AS action FROM categories
    """,
)
def encoding_choice(spark, sf):
    return encode.encoding_choice(prof.category_profile(prof.category_counts(fact(spark, sf), CATEGORIES)))


def _scaled(spark, sf, strategy):
    source = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    train, _ = key_split(source, ["l_orderkey", "l_linenumber"])
    scaled = feat.scale(source, feat.scale_parameters(train, ["l_quantity", "l_extendedprice"], strategy))
    return scaled.groupBy("l_linenumber").agg(
        *[F.round(f(c), 6).alias(f"{n}_{c}") for c in ("l_quantity", "l_extendedprice") for n, f in
          (("avg", F.avg), ("lo", F.min), ("hi", F.max))]
    )


def _scaled_sql(centre: str, spread: str) -> str:
    columns = ("l_quantity", "l_extendedprice")
    learned = ", ".join(f"{centre.format(c)} AS a_{c}, {spread.format(c)} AS b_{c}" for c in columns)
    shown = ", ".join(
        f"round({f}(({c} - a_{c}) / b_{c}), 6) AS {n}_{c}"
        for c in columns
        for n, f in (("avg", "avg"), ("lo", "min"), ("hi", "max"))
    )
    return f"""
    WITH p AS (SELECT {learned} FROM lineitem WHERE {hash_sql('l_orderkey, l_linenumber')} % 100 < 80)
    SELECT l_linenumber, {shown} FROM lineitem, p GROUP BY 1
    """


@query("scale_standard", _scaled_sql("avg({})", "stddev({})"))
def scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query("scale_minmax", _scaled_sql("min({})", "(max({0}) - min({0}))"))
def scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


# --- a whole plan --------------------------------------------------------------------------------

PLAN = FeaturePlan(
    target="high_severity",
    target_sources=("Severity",),
    rush_hour_from="Start_Time",
    flags=(RegexFlag("Street", "is_color", "red|blue|green"), RegexFlag("Street", "is_tool", "bolt|gear|ring")),
    interactions=(Interaction("Distance(mi)", "Month", "multiply"), Interaction("Distance(mi)", "Toll", "ratio")),
    bins=(
        Binning("Temperature(F)", "custom_cuts", cuts=(10.0, 25.0)),
        Binning("Toll", "equal_width", bins=4),
    ),
    encodings=(
        Encoding("Wind_Direction", "string_index_ohe"),
        Encoding("Brand", "string_index_only"),
        Encoding("Month", "passthrough"),
        Encoding("Country", "drop"),
        Encoding("Airport_Code", "drop"),
        Encoding("Flag_Label", "drop"),
    ),
    scaling="standard",
    scaled=("Distance(mi)",),
    drops=("Start_Time", "End_Time", "Humidity(%)", "Pressure(in)", "Visibility(mi)"),
    keys=("order_key", "line_no", "part_key"),
)


def planned_splits(spark, sf):
    return feat.apply_plan(*written_splits(spark, sf, PLAN.unread()), PLAN)


PLAN_SQL = f"""
    {FACT_SQL},
    f AS (SELECT *, {hash_sql('order_key, line_no')} % 100 < 80 AS in_train FROM fact),
    tr AS (SELECT * FROM f WHERE in_train),
    {index_sql('"Wind_Direction"', 'tr', 'wi')}, {index_sql('"Brand"', 'tr', 'bi')},
    p AS (SELECT min("Toll") AS lo, (max("Toll") - min("Toll")) / 4 AS w, avg("Distance(mi)") AS m, stddev("Distance(mi)") AS s FROM tr),
    engineered AS (
      SELECT order_key, line_no, part_key, in_train, high_severity, "Month",
        CASE WHEN hour("Start_Time") BETWEEN 7 AND 9 OR hour("Start_Time") BETWEEN 17 AND 19 THEN 1 ELSE 0 END AS is_rush_hour,
        regexp_matches(lower("Street"), 'red|blue|green')::INT AS is_color,
        regexp_matches(lower("Street"), 'bolt|gear|ring')::INT AS is_tool,
        "Distance(mi)" * "Month" AS mult, "Distance(mi)" / ("Toll" + 1e-6) AS ratio,
        "Junction"::INT AS "Junction", "Crossing"::INT AS "Crossing", "Stop"::INT AS "Stop",
        CASE WHEN "Temperature(F)" < 10 THEN 0 WHEN "Temperature(F)" < 25 THEN 1 WHEN "Temperature(F)" IS NOT NULL THEN 2 END AS temp_bin,
        ("Toll" >= lo + w)::INT + ("Toll" >= lo + w * 2)::INT + ("Toll" >= lo + w * 3)::INT AS toll_bin,
        coalesce(wi.i, (SELECT count(*) FROM wi)) AS wind, coalesce(bi.i, (SELECT count(*) FROM bi)) AS brand,
        ("Distance(mi)" - m) / s AS distance
      FROM f LEFT JOIN wi ON "Wind_Direction" = wi.value LEFT JOIN bi ON "Brand" = bi.value, p)
"""


@query(
    "feature_plan_applied",
    f"""
    WITH {PLAN_SQL}
    SELECT in_train::INT AS in_train, "Month", count(*) AS n, CAST(sum(is_rush_hour) AS BIGINT) AS rush, CAST(sum(is_color) AS BIGINT) AS color,
           CAST(sum(is_tool) AS BIGINT) AS tool, round(sum(mult), 2) AS mult, round(sum(ratio), 6) AS ratio,
           CAST(sum("Junction") AS BIGINT) AS junction, CAST(sum("Crossing" + "Stop") AS BIGINT) AS crossing_stop,
           CAST(sum(temp_bin) AS DOUBLE) AS temp_bin, CAST(sum(toll_bin) AS DOUBLE) AS toll_bin, count(temp_bin) AS temp_known,
           CAST(sum((wind = 0)::INT) AS BIGINT) AS wind_0, CAST(sum((wind = 3)::INT) AS BIGINT) AS wind_3,
           sum(brand) AS brand, round(avg(distance), 6) AS distance
    FROM engineered GROUP BY 1, 2
    """,
)
def feature_plan_applied(spark, sf):
    train, test, _ = planned_splits(spark, sf)
    both = train.withColumn("in_train", F.lit(1)).unionByName(test.withColumn("in_train", F.lit(0)))
    wind = vector_to_array("Wind_Direction_ohe")
    return both.groupBy("in_train", "Month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_rush_hour").alias("rush"),
        F.sum("is_color").alias("color"),
        F.sum("is_tool").alias("tool"),
        F.round(F.sum(col("Distance(mi)_multiply_Month")), 2).alias("mult"),
        F.round(F.sum(col("Distance(mi)_ratio_Toll")), 6).alias("ratio"),
        F.sum("Junction").alias("junction"),
        F.sum(F.col("Crossing") + F.col("Stop")).alias("crossing_stop"),
        F.sum(col("Temperature(F)_bin")).alias("temp_bin"),
        F.sum("Toll_bin").alias("toll_bin"),
        F.count(col("Temperature(F)_bin")).alias("temp_known"),
        F.sum(wind[0].cast("int")).alias("wind_0"),
        F.sum(wind[3].cast("int")).alias("wind_3"),
        F.sum("Brand_idx").alias("brand"),
        F.round(F.avg(col("Distance(mi)")), 6).alias("distance"),
    )


@query(
    "consumed_columns_dropped",
    f"""
    WITH {FACT_SQL} SELECT 'Brand_idx,Crossing,Distance(mi),Distance(mi)_multiply_Month,Distance(mi)_ratio_Toll,Junction,Month,Severity,'
      || 'Stop,Temperature(F)_bin,Toll_bin,Wind_Direction_ohe,high_severity,is_color,is_rush_hour,is_tool,line_no,order_key,part_key' AS columns_left,
      count(*) AS n FROM fact
    """,
)
def consumed_columns_dropped(spark, sf):
    source = written_fact(spark, sf)
    fitted = feat.fit_features(source, PLAN)
    done = fitted.transform(source)
    return done.agg(F.lit(",".join(sorted(done.columns))).alias("columns_left"), F.count(F.lit(1)).alias("n"))


@query("feature_list")
def feature_list(spark, sf):
    source = fact(spark, sf)
    names = feat.feature_columns(source, PLAN)
    known = source.agg(F.count(F.lit(1)).alias("row_count"))
    return known.select(F.posexplode(F.array(*[F.lit(n) for n in names])).alias("place", "feature"), "row_count")


@query(
    "fitted_features_reloaded",
    f"WITH {FACT_SQL} SELECT count(*) AS n, TRUE AS same FROM fact WHERE {hash_sql('order_key, line_no')} % 100 >= 80",
)
def fitted_features_reloaded(spark, sf):
    """A saved plan gives the same table after it is loaded again."""
    train, test = written_splits(spark, sf)
    fitted = feat.fit_features(train, PLAN)
    path = fresh_path(spark, "fitted")
    fitted.save(spark, path)
    again = feat.FittedFeatures.load(spark, path)
    sums = [F.round(F.sum(col(c)), 4).alias(c) for c in ("Brand_idx", "Distance(mi)", "Toll_bin", "is_tool")]
    parts = [plan.transform(test).agg(F.count(F.lit(1)).alias("n"), F.struct(*sums).alias(name)) for plan, name in ((fitted, "fitted"), (again, "loaded"))]
    both = parts[0].join(parts[1], "n")
    return both.select("n", F.col("fitted").eqNullSafe(F.col("loaded")).alias("same"))


MODEL_FEATURES = [
    "is_color", "is_tool", "Distance(mi)", "Month", "Junction", "Temperature(F)_bin", "Toll_bin", "Brand_idx",
    "Wind_Direction_ohe",
]


@query(
    "assembled_rows_kept",
    f"""
    WITH {PLAN_SQL}
    SELECT count(*) AS row_count, count(temp_bin) AS kept, count(*) - count(temp_bin) AS skipped FROM engineered WHERE in_train
    """,
)
def assembled_rows_kept(spark, sf):
    train, _, _ = planned_splits(spark, sf)
    return feat.skipped_rows(train, MODEL_FEATURES)


@query("vector_sizes")
def vector_sizes(spark, sf):
    train, _, _ = planned_splits(spark, sf)
    vectors = feat.assemble(train, MODEL_FEATURES, keep=["Wind_Direction_ohe"])
    return feat.vector_sizes(vectors, ["features", "Wind_Direction_ohe"])


@query("vector_slot_names")
def vector_slot_names(spark, sf):
    train, _, _ = planned_splits(spark, sf)
    vectors = feat.assemble(train, MODEL_FEATURES)
    names = feat.slot_names(vectors)
    kept = vectors.agg(F.count(F.lit(1)).alias("row_count"))
    return kept.select(F.posexplode(F.array(*[F.lit(n) for n in names])).alias("slot", "feature"), "row_count")


PLAN_PAIRS = [("Distance(mi)", "Toll", "ratio"), ("Distance(mi)", "Humidity(%)", "multiply"), ("Toll", "Absent", "add")]
PLAN_CUTS = {"Temperature(F)": (10.0, 25.0), "Absent": (1.0,)}


def _planned_rows(source):
    categories = prof.category_profile(prof.category_counts(source, CATEGORIES), ["Street"])
    numbers = prof.numeric_profile(source, NUMBERS)
    tokens = {"Street": prof.frequent_tokens(source, "Street")}
    return plan_rows(categories, numbers, tokens, cuts=PLAN_CUTS, pairs=PLAN_PAIRS)


@query(
    "plan_from_profile",
    f"""
    WITH {FACT_SQL}, {CATEGORY_SQL}, tok AS ({token_sql("fact", '"Street"')}),
    names AS (SELECT unnest([{", ".join(f"'{n}'" for n in NUMBERS)}]) AS column_name FROM (SELECT count(*) FROM fact))
    SELECT 'encoding' AS kind, column_name, CASE WHEN distinct_count <= 20 THEN 'string_index_ohe'
           WHEN distinct_count <= 100000 THEN 'string_index_only' ELSE 'drop' END AS choice, '' AS detail
    FROM categories WHERE column_name <> 'Street'
    UNION ALL SELECT 'flag', 'Street', 'is_' || token, token FROM tok
    UNION ALL SELECT 'bin', column_name, 'custom_cuts', '10.0,25.0' FROM names WHERE column_name = 'Temperature(F)'
    UNION ALL SELECT 'interaction', 'Distance(mi)', 'ratio', 'Toll' FROM names WHERE column_name = 'Toll'
    UNION ALL SELECT 'interaction', 'Distance(mi)', 'multiply', 'Humidity(%)' FROM names WHERE column_name = 'Toll'
    UNION ALL SELECT 'scale', column_name, 'standard', '' FROM names
    """,
)
def plan_from_profile(spark, sf):
    return _planned_rows(written_fact(spark, sf))


@query("plan_built_and_applied")
def plan_built_and_applied(spark, sf):
    """The plan the rules write, run on both splits: rows, columns and flags per split."""
    parts = written_splits(spark, sf)
    # The parts lie in one table, so the profile needs no other join.
    rows = materialise(_planned_rows(parts[0].unionByName(parts[1])), "plan")
    plan = build_plan(
        rows,
        "high_severity",
        ["Severity"],
        rush_hour_from="Start_Time",
        drops=["Start_Time", "End_Time"],
        keys=["order_key", "line_no", "part_key"],
    )
    train, test, fitted = feat.apply_plan(*parts, plan)
    flags = [f.output for f in plan.flags]
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(len(fitted.features)).alias("features"),
        *[F.round(F.avg(f), 4).alias(f) for f in flags],
    )
