"""Scans, projections, filters, duplicates, joins and imputation over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.functions.columns import col, hash_percent
from gritmill.operators import cleaning as clean
from gritmill.operators import imputing, joining
from gritmill.operators.exploring import means_per, share_of_all
from gritmill.operators.splitting import key_split
from gritmill.session import fresh_path, materialise
from gritmill.sources import tables, text_types
from gritmill.workload.registry import query
from gritmill.workload.views import FACT_SQL, LINES_SQL, fact, hash_sql, lines, table

# Recoding of the part types, in the manner of compass points.
TYPE_GROUPS = {"CALM": ["ECONOMY"], "N": ["SMALL", "MEDIUM"], "VAR": ["PROMO"]}
MEASURES = ["Temperature(F)", "Humidity(%)", "Pressure(in)", "Visibility(mi)"]
GROUP = ["Airport_Code", "Month"]


# --- scans and sinks -----------------------------------------------------------------------------


@query(
    "scan_csv_typed",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty,
           round(avg(l_extendedprice), 4) AS avg_price, strftime(max(l_shipdate), '%Y-%m-%d') AS last_ship
    FROM lineitem GROUP BY 1, 2
    """,
)
def scan_csv_typed(spark, sf):
    source = table(spark, sf, "lineitem")
    path = fresh_path(spark, "lineitem_csv")
    source.write.option("header", True).csv(path)
    read = tables.read_csv(spark, path, source.schema)
    return read.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last_ship"),
    )


ORDER_TYPES_SQL = " UNION ALL ".join(
    [f"SELECT '{c}' AS column_name, CASE WHEN max(abs({c})) <= 2147483647 THEN 'int' ELSE 'bigint' END AS type, TRUE AS as_spark FROM orders" for c in ("o_orderkey", "o_custkey")]
    + [f"SELECT '{c}', CASE WHEN bool_and(try_cast({c} AS DOUBLE) IS NULL) THEN 'string' END, TRUE FROM orders" for c in ("o_orderstatus", "o_orderpriority")]
    + ["SELECT 'o_totalprice', CASE WHEN bool_or(o_totalprice <> floor(o_totalprice)) THEN 'double' ELSE 'int' END, TRUE FROM orders"]
    + ["SELECT 'o_orderdate', CASE WHEN typeof(any_value(o_orderdate)) = 'DATE' THEN 'date' ELSE 'timestamp' END, TRUE FROM orders"]
)


@query("csv_types_inferred", ORDER_TYPES_SQL)
def csv_types_inferred(spark, sf):
    """Types of a CSV file from all its rows by one aggregate, next to whether Spark's own scan finds the same."""
    path = fresh_path(spark, "orders_csv")
    table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority").write.option("header", True).csv(path)
    own = {f.name: f.dataType for f in tables.read_csv(spark, path).schema}
    found = text_types.infer_csv(spark, path)
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), own[f.name] == f.dataType) for f in found], "column_name string, type string, as_spark boolean")


BAD_LINE = "o_orderkey % 50 = 0 OR o_orderkey % 70 = 1"


@query(
    "csv_rejects_kept",
    f"""
    SELECT CASE WHEN {BAD_LINE} THEN 'rejected' ELSE 'kept' END AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys,
           CAST(sum(CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS without_price FROM orders GROUP BY 1
    """,
)
def csv_rejects_kept(spark, sf):
    """Lines with a text for a price, or with a cell too many, are kept beside the rows that fit."""
    price = "CASE WHEN o_orderkey % 50 = 0 THEN 'none' ELSE CAST(o_totalprice AS STRING) END"
    more = "CASE WHEN o_orderkey % 70 = 1 THEN ',x' ELSE '' END"
    path = fresh_path(spark, "orders_lines")
    table(spark, sf, "orders").selectExpr(f"concat_ws(',', o_orderkey, o_custkey, {price}) || {more} AS line").write.text(path)
    schema = T.StructType.fromDDL("o_orderkey bigint, o_custkey bigint, o_totalprice double")
    good, bad = text_types.read_with_rejects(spark, path, schema, header=False)
    key = F.split_part("line", F.lit(","), F.lit(1)).cast("bigint").alias("o_orderkey")
    both = good.select("o_orderkey", F.lit("kept").alias("part"), F.col("o_totalprice").isNull().alias("gap"))
    both = both.union(bad.select(key, F.lit("rejected"), F.col("line").contains(",none")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.sum(F.col("gap").cast("long")).alias("without_price"))


@query(
    "scan_parquet_pruned",
    """
    SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
    FROM lineitem WHERE l_quantity < 10 AND l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1
    """,
)
def scan_parquet_pruned(spark, sf):
    read = tables.read_parquet(spark, f"{sf}/lineitem.parquet")
    some = read.filter((F.col("l_quantity") < 10) & (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")))
    return some.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")
    )


@query(
    "csv_to_parquet",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
    FROM orders
    """,
)
def csv_to_parquet(spark, sf):
    source = table(spark, sf, "orders")
    csv_path, parquet_path = fresh_path(spark, "orders_csv"), fresh_path(spark, "orders_parquet")
    source.write.option("header", True).csv(csv_path)
    back = tables.csv_to_parquet(spark, csv_path, parquet_path, source.schema)
    return back.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("overwrite_parquet", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def overwrite_parquet(spark, sf):
    path = fresh_path(spark, "customer")
    customer = table(spark, sf, "customer")
    tables.overwrite_parquet(customer, path)
    return tables.overwrite_parquet(customer.drop("c_nationkey"), path)


@query("read_newest_variant", "SELECT 'plain' AS variant, s_suppkey, s_name FROM supplier UNION ALL SELECT 'pruned', s_suppkey, NULL FROM supplier")
def read_newest_variant(spark, sf):
    """The plain table while it is the only one, the pruned one as soon as that is there too."""
    base, supplier = fresh_path(spark, "supplier"), table(spark, sf, "supplier")
    variants = [f"{base}/pruned", f"{base}/plain"]
    tables.overwrite_parquet(supplier.select("s_suppkey", "s_name"), variants[1])
    before = tables.read_first_present(spark, variants).withColumn("variant", F.lit("plain"))
    tables.overwrite_parquet(supplier.select("s_suppkey"), variants[0])
    after = tables.read_first_present(spark, variants).withColumn("variant", F.lit("pruned"))
    return before.unionByName(after, allowMissingColumns=True)


# --- projections and filters ---------------------------------------------------------------------


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def drop_columns(spark, sf):
    return table(spark, sf, "orders").drop("o_orderstatus", "o_orderdate")


@query("drop_columns_by_prefix", "SELECT p_partkey, p_size, p_retailprice FROM part")
def drop_columns_by_prefix(spark, sf):
    return clean.drop_prefixed(table(spark, sf, "part"), ["p_n", "p_t"], also=["p_brand"])


@query(
    "keep_below",
    f"""
    WITH {LINES_SQL}
    SELECT "Airport_Code", count(*) AS n, round(sum("Temperature(F)"), 2) AS total
    FROM lines WHERE "Temperature(F)" < 20 GROUP BY 1
    """,
)
def keep_below(spark, sf):
    kept = clean.keep_below(lines(spark, sf), "Temperature(F)", 20)
    return kept.groupBy("Airport_Code").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(col("Temperature(F)")), 2).alias("total")
    )


DURATION_SQL = 'CAST(epoch("End_Time") - epoch("Start_Time") AS BIGINT)'


@query(
    "keep_within",
    f"""
    WITH {FACT_SQL}
    SELECT order_key, line_no, part_key, {DURATION_SQL} AS "Duration_Seconds"
    FROM fact WHERE {DURATION_SQL} / 60.0 > 5 AND {DURATION_SQL} / 3600.0 <= 288
    """,
)
def keep_within(spark, sf):
    timed = clean.add_durations(fact(spark, sf), "Start_Time", "End_Time")
    kept = clean.keep_within(timed, F.col("Duration_Seconds"), above=5 * 60, up_to=288 * 3600)
    return kept.select("order_key", "line_no", "part_key", "Duration_Seconds")


@query(
    "parse_timestamps",
    """
    SELECT event_id, strftime(CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END, '%Y-%m-%d %H:%M:%S') AS parsed
    FROM events
    """,
)
def parse_timestamps(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("bad "), stamp)).otherwise(stamp)
    parsed = clean.parse_times(table(spark, sf, "events").select("event_id", text.alias("parsed")), ["parsed"])
    return parsed.withColumn("parsed", F.date_format("parsed", "yyyy-MM-dd HH:mm:ss"))


@query(
    "calendar_parts",
    """
    SELECT event_id, CAST(year(ts) AS INT) AS "ts_Year", CAST(month(ts) AS INT) AS "ts_Month",
           CAST(dayofweek(ts) + 1 AS INT) AS "ts_Day_of_Week", CAST(hour(ts) AS INT) AS "ts_Hour",
           CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS "ts_is_Weekend"
    FROM events
    """,
)
def calendar_parts(spark, sf):
    return clean.add_calendar(table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


@query(
    "durations",
    f"""
    WITH {FACT_SQL}
    SELECT "Airport_Code", CAST(min({DURATION_SQL}) AS BIGINT) AS shortest,
           CAST(max({DURATION_SQL}) AS BIGINT) AS longest, round(avg({DURATION_SQL} / 60.0), 4) AS avg_minutes,
           round(avg({DURATION_SQL} / 3600.0), 4) AS avg_hours
    FROM fact GROUP BY 1
    """,
)
def durations(spark, sf):
    timed = clean.add_durations(fact(spark, sf), "Start_Time", "End_Time")
    return timed.groupBy("Airport_Code").agg(
        F.min("Duration_Seconds").alias("shortest"),
        F.max("Duration_Seconds").alias("longest"),
        F.round(F.avg("Duration_Minutes"), 4).alias("avg_minutes"),
        F.round(F.avg("Duration_Hours"), 4).alias("avg_hours"),
    )


@query(
    "canonicalise_category",
    """
    SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'CALM' WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'N'
                           WHEN p_type = 'PROMO' THEN 'VAR' ELSE p_type END AS p_type
    FROM part
    """,
)
def canonicalise_category(spark, sf):
    return clean.canonicalise(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", TYPE_GROUPS)


@query(
    "drop_rows_with_gaps",
    f"""
    WITH {LINES_SQL}
    SELECT "Month", count(*) AS n, round(sum("Temperature(F)"), 2) AS total FROM lines
    WHERE "Temperature(F)" IS NOT NULL AND "Pressure(in)" IS NOT NULL GROUP BY 1
    """,
)
def drop_rows_with_gaps(spark, sf):
    kept = clean.drop_missing(lines(spark, sf), ["Temperature(F)", "Pressure(in)"])
    return kept.groupBy("Month").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(col("Temperature(F)")), 2).alias("total")
    )


@query(
    "coalesce_computed",
    f"""
    WITH {LINES_SQL}
    SELECT "Month", count("Temperature(F)") AS known_before, round(sum(coalesce("Temperature(F)", line_no * 1.5)), 2) AS total
    FROM lines GROUP BY 1
    """,
)
def coalesce_computed(spark, sf):
    source = lines(spark, sf).withColumn("before", col("Temperature(F)"))
    filled = clean.coalesce_known(source, "Temperature(F)", F.col("line_no") * 1.5)
    return filled.groupBy("Month").agg(
        F.count("before").alias("known_before"), F.round(F.sum(col("Temperature(F)")), 2).alias("total")
    )


@query(
    "fill_constant",
    f"""
    WITH {LINES_SQL}
    SELECT "Month", round(sum(coalesce("Humidity(%)", 0.5)), 4) AS total, count(*) AS n FROM lines GROUP BY 1
    """,
)
def fill_constant(spark, sf):
    filled = clean.fill_missing(lines(spark, sf), {"Humidity(%)": 0.5})
    return filled.groupBy("Month").agg(
        F.round(F.sum(col("Humidity(%)")), 4).alias("total"), F.count(F.lit(1)).alias("n")
    )


@query(
    "flags_to_int",
    f"""
    WITH {LINES_SQL}
    SELECT "Junction"::INT AS "Junction", "Crossing"::INT AS "Crossing", count(*) AS n FROM lines GROUP BY 1, 2
    """,
)
def flags_to_int(spark, sf):
    return clean.flags_to_int(lines(spark, sf)).groupBy("Junction", "Crossing").agg(F.count(F.lit(1)).alias("n"))


@query(
    "binarise_target",
    """
    SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS severity,
           CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INT) >= 3 THEN 1 ELSE 0 END AS high, count(*) AS n
    FROM orders GROUP BY 1, 2
    """,
)
def binarise_target(spark, sf):
    graded = table(spark, sf, "orders").select(F.substring("o_orderpriority", 1, 1).cast("int").alias("severity"))
    return clean.binarise(graded, "severity", 3, "high").groupBy("severity", "high").agg(F.count(F.lit(1)).alias("n"))


@query(
    "step_accounting",
    f"""
    WITH {FACT_SQL}, flags AS (
      SELECT coalesce("Distance(mi)" < 80000, false) AS a,
             {DURATION_SQL} / 60.0 > 5 AND {DURATION_SQL} / 3600.0 <= 1440 AS b,
             "Temperature(F)" IS NOT NULL AS c FROM fact),
    k AS (SELECT count(*) AS k0, count(*) FILTER (a) AS k1, count(*) FILTER (a AND b) AS k2,
                 count(*) FILTER (a AND b AND c) AS k3 FROM flags)
    SELECT 1 AS step_no, 'distance' AS step, k0 AS rows_in, k1 AS rows_out, k0 - k1 AS dropped FROM k
    UNION ALL SELECT 2, 'duration', k1, k2, k1 - k2 FROM k
    UNION ALL SELECT 3, 'temperature', k2, k3, k2 - k3 FROM k
    """,
)
def step_accounting(spark, sf):
    timed = clean.add_durations(fact(spark, sf), "Start_Time", "End_Time")
    return clean.step_accounting(
        timed,
        [
            ("distance", col("Distance(mi)") < 80000),
            ("duration", (F.col("Duration_Minutes") > 5) & (F.col("Duration_Hours") <= 1440)),
            ("temperature", col("Temperature(F)").isNotNull()),
        ],
    )


@query(
    "round_to_bucket",
    """
    SELECT round(value, 0) AS bucket, count(*) AS n FROM events GROUP BY 1
    """,
)
def round_to_bucket(spark, sf):
    rounded = clean.round_to(table(spark, sf, "events"), "value", 0, "bucket")
    return rounded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query(
    "pad_missing_features",
    "SELECT c_custkey, c_acctbal, 0.0::DOUBLE AS extra_one, 0.0::DOUBLE AS extra_two FROM customer",
)
def pad_missing_features(spark, sf):
    wanted = ["c_acctbal", "extra_one", "extra_two"]
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return clean.pad_columns(customer, wanted)


@query(
    "known_features_only",
    "SELECT c_mktsegment, round(sum(c_acctbal), 2) AS c_acctbal, 'no_such_column' AS unknown FROM customer GROUP BY 1",
)
def known_features_only(spark, sf):
    customer = table(spark, sf, "customer")
    known, unknown = clean.split_known_unknown(customer, ["c_acctbal", "no_such_column"])
    return customer.groupBy("c_mktsegment").agg(
        *[F.round(F.sum(col(k)), 2).alias(k) for k in known], F.lit(",".join(unknown)).alias("unknown")
    )


# --- duplicates ----------------------------------------------------------------------------------


@query(
    "drop_exact_copies",
    """
    WITH twice AS (SELECT * FROM lineitem UNION ALL SELECT * REPLACE (l_orderkey + 1 AS l_orderkey) FROM lineitem WHERE l_linenumber % 2 = 0)
    SELECT DISTINCT * EXCLUDE (l_orderkey, l_shipdate), strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM twice
    """,
)
def drop_exact_copies(spark, sf):
    """Whole rows but for the surrogate; every second line comes again under another surrogate."""
    lines = table(spark, sf, "lineitem")
    again = lines.filter("l_linenumber % 2 = 0").withColumn("l_orderkey", F.col("l_orderkey") + 1)
    found = clean.drop_copies(lines.unionByName(again), surrogate=["l_orderkey"])
    return found.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


NATURAL_KEY = ["l_orderkey", "l_linenumber"]
TIE_BREAK = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
REST = ["l_discount", "l_tax", "l_returnflag", "l_linestatus"]


FIRST_SQL = f"""
    SELECT * EXCLUDE (place, l_shipdate), strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM (
      SELECT *, row_number() OVER (PARTITION BY {{keys}} ORDER BY {", ".join([*TIE_BREAK, *REST])}) AS place
      FROM {{source}}) WHERE place = 1
    """


@query("first_per_natural_key", FIRST_SQL.format(keys=", ".join(NATURAL_KEY), source="lineitem"))
def first_per_natural_key(spark, sf):
    found = clean.first_per_key(table(spark, sf, "lineitem"), NATURAL_KEY, TIE_BREAK)
    return found.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


AGAIN_SQL = "(SELECT * FROM lineitem UNION ALL SELECT * REPLACE (l_partkey + 1 AS l_partkey) FROM lineitem WHERE l_orderkey % 97 = 0)"


@query("first_of_rare_copies", FIRST_SQL.format(keys=", ".join(NATURAL_KEY), source=AGAIN_SQL))
def first_of_rare_copies(spark, sf):
    """One order in 97 has each of its lines twice: only those lines are reduced, all others stay where they are."""
    source = table(spark, sf, "lineitem")
    again = source.filter("l_orderkey % 97 = 0").withColumn("l_partkey", F.col("l_partkey") + 1)
    found = clean.first_of_rare_copies(source.unionByName(again), NATURAL_KEY, TIE_BREAK)
    return found.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query(
    "copy_count",
    """
    WITH k AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM k
    """,
)
def copy_count(spark, sf):
    return clean.copy_count(table(spark, sf, "lineitem"), NATURAL_KEY)


# --- joins and imputation ------------------------------------------------------------------------


@query(
    "join_group_aggregate",
    """
    WITH g AS (SELECT l_suppkey, CAST(month(l_shipdate) AS INT) AS m, avg(l_quantity) AS mean_qty FROM lineitem GROUP BY 1, 2)
    SELECT l.l_returnflag, count(*) AS n, round(avg(l.l_quantity - g.mean_qty), 4) AS avg_gap,
           count(*) FILTER (l.l_quantity > g.mean_qty) AS above
    FROM lineitem l LEFT JOIN g ON l.l_suppkey = g.l_suppkey AND month(l.l_shipdate) = g.m GROUP BY 1
    """,
)
def join_group_aggregate(spark, sf):
    source = table(spark, sf, "lineitem").withColumn("m", F.month("l_shipdate"))
    means = source.groupBy("l_suppkey", "m").agg(F.avg("l_quantity").alias("mean_qty"), F.count(F.lit(1)).alias("rows"))
    table_of_means = materialise(means, "means")
    joined = joining.lookup_join(source, table_of_means, ["l_suppkey", "m"], group_rows="rows")
    gap = F.col("l_quantity") - F.col("mean_qty")
    return joined.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(gap), 4).alias("avg_gap"), F.count_if(gap > 0).alias("above")
    )


IMPUTE_SQL = f"""
    {LINES_SQL},
    split AS (SELECT *, {hash_sql('order_key, line_no')} % 100 < 80 AS in_train FROM lines),
    med AS (SELECT "Airport_Code", "Month", {", ".join(f'median("{m}") AS "{m}_median"' for m in MEASURES)}
            FROM split WHERE in_train GROUP BY 1, 2),
    filled AS (SELECT s.order_key, s.line_no, s.part_key, s."Airport_Code", s."Month", s.in_train, s."End_Time",
               {", ".join(f'coalesce(s."{m}", "{m}_median") AS "{m}"' for m in MEASURES)}
               FROM split s LEFT JOIN med USING ("Airport_Code", "Month")),
    complete AS (SELECT * FROM filled WHERE {" AND ".join(f'"{m}" IS NOT NULL' for m in MEASURES)})
"""


def imputed_rows(spark, sf):
    marked = lines(spark, sf).withColumn("_train", hash_percent(F.col("order_key"), F.col("line_no")) < 80)
    return imputing.fill_marked(marked, "_train", GROUP, MEASURES)


IMPUTED_SQL = f"""
    WITH {IMPUTE_SQL}
    SELECT CASE WHEN in_train THEN 'train' ELSE 'test' END AS split, "Airport_Code", count(*) AS n,
           {", ".join(f'round(sum("{m}"), 3) AS "{m}"' for m in MEASURES)}
    FROM complete GROUP BY 1, 2
    """


@query("impute_group_median", IMPUTED_SQL)
def impute_group_median(spark, sf):
    return _sums_of_marked(imputed_rows(spark, sf).withColumn("split", F.when(F.col("_train"), "train").otherwise("test")))


@query("impute_in_buckets", IMPUTED_SQL)
def impute_in_buckets(spark, sf):
    """The same from tables in buckets of the group: medians and fill without another shuffle of the rows."""
    splits = key_split(lines(spark, sf), ["order_key", "line_no"])
    return _imputed_sums(*imputing.fill_in_buckets(*splits, GROUP, MEASURES))


def _imputed_sums(train, test):
    return _sums_of_marked(train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test"))))


def _sums_of_marked(both):
    return both.groupBy("split", "Airport_Code").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.sum(col(m)), 3).alias(m) for m in MEASURES]
    )


@query(
    "imputed_means_by_month",
    f"""
    WITH {IMPUTE_SQL}
    SELECT "Month", in_train::INT AS in_train, count(*) AS n,
           {", ".join(f'round(avg("{m}"), 2) AS "avg_{m}"' for m in MEASURES)}
    FROM complete GROUP BY 1, 2
    """,
)
def imputed_means_by_month(spark, sf):
    return means_per(imputed_rows(spark, sf).withColumn("in_train", F.col("_train").cast("int")), ["Month", "in_train"], MEASURES)


@query(
    "group_median_wide",
    f"""
    WITH {LINES_SQL}
    SELECT "Airport_Code", "Month", count(*) AS group_rows,
           {", ".join(f'round(median("{m}"), 4) AS "{m}_median"' for m in MEASURES)}
    FROM lines GROUP BY 1, 2
    """,
)
def group_median_wide(spark, sf):
    medians = imputing.group_medians(lines(spark, sf), GROUP, MEASURES)
    return medians.withColumns({f"{m}_median": F.round(col(f"{m}_median"), 4) for m in MEASURES})


@query(
    "group_median_ranked",
    f"""
    WITH {LINES_SQL}
    SELECT "Airport_Code", count(*) AS group_rows, round(median("Distance(mi)"), 4) AS "Distance(mi)_median"
    FROM lines GROUP BY 1
    """,
)
def group_median_ranked(spark, sf):
    """The path for measures with too many values to count in memory."""
    medians = imputing.group_medians(
        lines(spark, sf), ["Airport_Code"], ["Distance(mi)"], max_values=1_000, rows_per_range=20_000
    )
    return medians.withColumn("Distance(mi)_median", F.round(col("Distance(mi)_median"), 4))


@query(
    "keep_most_frequent",
    f"""
    WITH {FACT_SQL}, top AS (SELECT "Brand" FROM fact GROUP BY 1 ORDER BY count(*) DESC, "Brand" LIMIT 5)
    SELECT "Brand", high_severity, count(*) AS n FROM fact WHERE "Brand" IN (SELECT "Brand" FROM top) GROUP BY 1, 2
    """,
)
def keep_most_frequent(spark, sf):
    kept = joining.keep_most_frequent(fact(spark, sf), "Brand", 5)
    return kept.groupBy("Brand", "high_severity").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ratio_to_total",
    """
    WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT l_returnflag, l_linestatus, n, round(n * 100.0 / (SELECT sum(n) FROM c), 6) AS pct FROM c
    """,
)
def ratio_to_total(spark, sf):
    return share_of_all(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])
