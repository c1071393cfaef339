"""The data-quality profile over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gritmill.operators import heavy, partial
from gritmill.operators import profiling as prof
from gritmill.operators.cleaning import add_calendar
from gritmill.session import fresh_path, materialise
from gritmill.sources.tables import read_report, save_report
from gritmill.workload.registry import query
from gritmill.workload.views import FACT_COLUMNS, FACT_SQL, fact, long_sql, table

NUMBERS = ["Temperature(F)", "Humidity(%)", "Pressure(in)", "Visibility(mi)", "Distance(mi)", "Toll"]
CATEGORIES = ["Airport_Code", "Wind_Direction", "Street", "Brand", "Country", "Flag_Label"]
TEXTS = ["Street"]
STOP_LIST = ", ".join(f"'{w}'" for w in prof.STOP_WORDS)


# --- SQL fragments -------------------------------------------------------------------------------


def severity_sql(pct: str) -> str:
    return (
        f"CASE WHEN {pct} <= 0 THEN 'none' WHEN {pct} <= 5 THEN 'low' WHEN {pct} <= 20 THEN 'moderate' "
        f"WHEN {pct} <= 50 THEN 'high' ELSE 'critical' END"
    )


MISSING_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS null_count, count(*) AS total FROM fact"
    for c in FACT_COLUMNS
)
MISSING_SQL = f"""
    {FACT_SQL}, m AS ({MISSING_LONG}),
    banded AS (SELECT column_name, null_count, round(null_count * 100.0 / total, 4) AS null_pct FROM m),
    missing AS (SELECT *, {severity_sql("null_pct")} AS severity FROM banded)
"""
NUMERIC_SQL = f"""
    v AS ({long_sql("fact", NUMBERS)}),
    s AS (SELECT column_name, avg(v) AS mean, stddev(v) AS std, min(v) AS lo, max(v) AS hi,
                 quantile_disc(v, 0.25) AS q25, quantile_disc(v, 0.75) AS q75, kurtosis_pop(v) AS kurt,
                 var_pop(v) AS var, count(*) - count(v) AS gaps FROM v GROUP BY 1),
    t AS (SELECT v.column_name, avg(pow(v - mean, 3)) / pow(any_value(var), 1.5) AS skew,
                 count(*) FILTER (q75 > q25 AND (v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25))) AS outliers
          FROM v JOIN s ON v.column_name = s.column_name GROUP BY 1),
    numbers AS (SELECT s.column_name, round(coalesce(mean, 0), 4) AS mean, round(coalesce(std, 0), 4) AS std,
           round(lo, 4) AS min, round(hi, 4) AS max, q25, q75, round(coalesce(skew, 0), 4) AS skewness,
           round(coalesce(kurt, 0), 4) AS kurtosis, outliers AS outlier_count,
           CASE WHEN abs(skew) <= 0.5 THEN 'normal' WHEN abs(skew) <= 1 THEN 'moderate_skew' ELSE 'high_skew' END AS distribution,
           CASE WHEN gaps = 0 THEN 'not needed' WHEN abs(skew) <= 0.5 THEN 'mean' ELSE 'median' END AS imputation
           FROM s JOIN t USING (column_name))
"""
COUNTS_SQL = f"""
    cv AS ({long_sql("fact", CATEGORIES, "VARCHAR")}),
    cc AS (SELECT column_name, v AS value, count(*) AS n FROM cv GROUP BY 1, 2)
"""
CATEGORY_SQL = f"""
    {COUNTS_SQL},
    cp AS (SELECT column_name, count(*) AS distinct_count, max(n) AS top_count, CAST(sum(n) AS BIGINT) AS total FROM cc GROUP BY 1),
    categories AS (
    SELECT column_name, distinct_count, top_count, round(top_count / total, 6) AS top_share,
           top_count / total > 0.95 AS near_zero_variance, distinct_count = 1 AS zero_variance,
           distinct_count = total AS likely_identifier,
           CASE WHEN distinct_count <= 2 THEN 'binary' WHEN distinct_count <= 10 THEN 'low'
                WHEN distinct_count <= 50 THEN 'medium' WHEN distinct_count <= 200 THEN 'high' ELSE 'very_high' END AS cardinality,
           CASE WHEN distinct_count <= 2 THEN 'binary_encode' WHEN distinct_count <= 10 THEN 'one_hot_encode'
                WHEN distinct_count <= 50 THEN 'label_encode or group rare categories'
                WHEN distinct_count <= 200 THEN 'group rare categories then label_encode'
                ELSE 'consider dropping or heavy grouping' END AS tier_encoding,
           CASE WHEN distinct_count <= 10 THEN 'one_hot_encode' WHEN column_name IN ('Street') THEN 'extract_binary_features'
                ELSE 'group_rare_categories_and_label_encode' END AS encoding
    FROM cp)
"""


def target_sql(source: str, label: str, fine: bool = False) -> str:
    ratio = "round(largest / smallest, 2)" if fine else "largest / smallest"
    if fine:
        name = (
            f"CASE WHEN {ratio} <= 1.5 THEN 'balanced' WHEN {ratio} <= 3 THEN 'mild_imbalance' "
            f"WHEN {ratio} <= 10 THEN 'moderate_imbalance' ELSE 'severe_imbalance' END"
        )
        words = {"balanced": "SMOTE not needed", "mild_imbalance": "SMOTE optional"}
    else:
        name = (
            f"CASE WHEN {ratio} <= 3 THEN 'balanced' WHEN {ratio} <= 10 THEN 'moderate_imbalance' "
            "ELSE 'severe_imbalance' END"
        )
        words = {"balanced": "not needed"}
    words |= {"moderate_imbalance": "consider SMOTE", "severe_imbalance": "strongly recommend SMOTE"}
    tips = " ".join(f"WHEN imbalance = '{k}' THEN '{v}'" for k, v in words.items())
    return f"""
    SELECT *, CASE {tips} END AS resampling, round(smallest / row_count, 4) AS minority_rate,
           round(smallest / row_count, 4) < 0.10 AS rare_class, '{label}' AS column_name
    FROM (SELECT *, round(largest / smallest, 2) AS imbalance_ratio, {name} AS imbalance
          FROM (SELECT count(*) AS classes, max(n) AS largest, min(n) AS smallest, CAST(sum(n) AS BIGINT) AS row_count
                FROM (SELECT {label}, count(*) AS n FROM {source} GROUP BY 1)))
    """


def correlation_sql(source: str, columns: list[str]) -> str:
    parts = [
        f"SELECT '{a}' AS col1, '{b}' AS col2, corr(\"{a}\", \"{b}\") AS r FROM {source}"
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    ]
    return f"""
    SELECT col1, col2, round(r, 4) AS correlation,
           CASE WHEN abs(r) > 0.95 THEN 'near_duplicate' WHEN abs(r) > 0.85 THEN 'high' ELSE 'none' END AS band,
           CASE WHEN abs(r) > 0.95 THEN 'drop one' WHEN abs(r) > 0.85 THEN 'feature reduction' ELSE 'keep' END AS recommendation
    FROM ({" UNION ALL ".join(parts)})
    """


# --- queries -------------------------------------------------------------------------------------


@query("table_shape", f"WITH {FACT_SQL} SELECT count(*) AS row_count, CAST({len(FACT_COLUMNS)} AS INT) AS column_count FROM fact")
def table_shape(spark, sf):
    return prof.table_shape(fact(spark, sf))


EVENT_ROLES = {
    "event_id": "numerical", "ts": "timestamp", "user_id": "numerical", "event_type": "categorical",
    "value": "numerical", "ts_Year": "time_derived", "ts_Month": "time_derived",
    "ts_Day_of_Week": "time_derived", "ts_Hour": "time_derived", "ts_is_Weekend": "time_derived", "big": "boolean",
}


@query(
    "column_roles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{r}' AS role, count(*) AS total_rows, CAST({len(EVENT_ROLES)} AS INT) AS total_columns FROM events"
        for c, r in EVENT_ROLES.items()
    ),
)
def column_roles(spark, sf):
    moments = add_calendar(table(spark, sf, "events").drop("props"), "ts").withColumn("big", F.col("value") > 100)
    return prof.column_roles(moments, ["ts"])


@query(
    "missing_profile",
    f"""WITH {MISSING_SQL}
    SELECT column_name, null_count, null_pct, severity,
           CASE severity WHEN 'none' THEN 'keep' WHEN 'low' THEN 'impute/drop rows' WHEN 'moderate' THEN 'impute'
                         WHEN 'high' THEN 'check relevance' ELSE 'drop' END AS recommendation FROM missing""",
)
def missing_profile(spark, sf):
    return prof.missing_profile(fact(spark, sf))


@query("numeric_profile", f"WITH {FACT_SQL}, {NUMERIC_SQL} SELECT * FROM numbers")
def numeric_profile(spark, sf):
    return prof.numeric_profile(materialise(fact(spark, sf).select(*NUMBERS), "numbers"), NUMBERS)


@query(
    "numeric_profile_events",
    f"WITH fact AS (SELECT value AS \"value\", CAST(user_id AS DOUBLE) AS user_id FROM events), "
    f"{NUMERIC_SQL.replace(long_sql('fact', NUMBERS), long_sql('fact', ['value', 'user_id']))} SELECT * FROM numbers",
)
def numeric_profile_events(spark, sf):
    return prof.numeric_profile(table(spark, sf, "events"), ["value", "user_id"])


@query(
    "profile_merged_from_parts",
    f"""
    WITH {FACT_SQL}, v AS ({long_sql("fact", NUMBERS)}),
    s AS (SELECT column_name, count(*) AS row_count, count(*) - count(v) AS null_count, avg(v) AS mean, stddev(v) AS std, min(v) AS lo, max(v) AS hi, var_pop(v) AS var, kurtosis_pop(v) AS kurt FROM v GROUP BY 1),
    t AS (SELECT v.column_name, avg(pow(v - mean, 3)) / pow(any_value(var), 1.5) AS skew FROM v JOIN s ON v.column_name = s.column_name GROUP BY 1)
    SELECT column_name, row_count, null_count, round(mean, 4) AS mean, round(std, 4) AS std, round(skew, 4) AS skewness, round(kurt, 4) AS kurtosis, round(lo, 4) AS min, round(hi, 4) AS max
    FROM s JOIN t USING (column_name)
    """,
)
def profile_merged_from_parts(spark, sf):
    """Months are profiled in two loads, one of them once more; the profile of the whole table comes from the stored states."""
    path = fresh_path(spark, "states")
    rows = materialise(fact(spark, sf).select("Month", *NUMBERS), "numbers")
    for load in ("Month <= 6", "Month > 6", "Month = 3"):
        partial.store_states(partial.profile_states(rows.filter(load), NUMBERS, F.col("Month")), path)
    return partial.merged_profile(partial.stored_states(spark, path)).drop("q0", "q1", "distinct_about")


@query("category_profile", f"WITH {FACT_SQL}, {CATEGORY_SQL} SELECT * FROM categories")
def category_profile(spark, sf):
    return prof.category_profile(prof.category_counts(fact(spark, sf), CATEGORIES), TEXTS)


@query(
    "category_distinct_counts",
    f"WITH {FACT_SQL}, {COUNTS_SQL} SELECT column_name, count(*) AS distinct_count FROM cc GROUP BY 1",
)
def category_distinct_counts(spark, sf):
    counts = prof.category_counts(fact(spark, sf), CATEGORIES)
    return prof.category_profile(counts).select("column_name", "distinct_count")


def _frequent_sql(direction: str) -> str:
    return f"""
    WITH {FACT_SQL}, {COUNTS_SQL}
    SELECT column_name, value, n, CAST(place AS INT) AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n {direction}, value NULLS FIRST) AS place FROM cc)
    WHERE place <= 5
    """


@query("most_frequent_values", _frequent_sql("DESC"))
def most_frequent_values(spark, sf):
    return prof.frequent_values(prof.category_counts(fact(spark, sf), CATEGORIES), 5)


@query("heavy_values", _frequent_sql("DESC"))
def heavy_values(spark, sf):
    """The same rows from counters of bounded size."""
    return heavy.heavy_values(heavy.long_values(fact(spark, sf), CATEGORIES), 5)


KEYS = ["l_orderkey", "l_partkey", "l_shipdate", "l_returnflag"]


@query(
    "heavy_values_of_keys",
    f"""
    WITH cc AS (SELECT column_name, v AS value, count(*) AS n FROM ({long_sql("lineitem", KEYS, "VARCHAR")}) GROUP BY 1, 2)
    SELECT column_name, value, n, CAST(place AS INT) AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value NULLS FIRST) AS place FROM cc)
    WHERE place <= 5
    """,
)
def heavy_values_of_keys(spark, sf):
    """Keys beside a few-valued column, with few counters: some columns are decided by them, the others by full counts."""
    return heavy.heavy_values(heavy.long_values(table(spark, sf, "lineitem"), KEYS), 5, tracked=64)


@query("rarest_values", _frequent_sql("ASC"))
def rarest_values(spark, sf):
    return prof.frequent_values(prof.category_counts(fact(spark, sf), CATEGORIES), 5, rarest=True)


@query(
    "near_zero_variance",
    f"WITH {FACT_SQL}, {CATEGORY_SQL} SELECT column_name, top_share FROM categories WHERE near_zero_variance",
)
def near_zero_variance(spark, sf):
    profile = prof.category_profile(prof.category_counts(fact(spark, sf), CATEGORIES))
    return profile.filter("near_zero_variance").select("column_name", "top_share")


@query(
    "variance_and_identifiers",
    f"""
    WITH d AS (SELECT *, 'x' AS constant FROM documents),
    v AS ({long_sql("d", ["doc_id", "lang", "source", "n_chars", "constant"], "VARCHAR")}),
    c AS (SELECT column_name, count(DISTINCT v) AS distinct_count, count(*) AS total FROM v GROUP BY 1)
    SELECT column_name, distinct_count, distinct_count = 1 AS zero_variance, distinct_count = total AS likely_identifier,
           CASE WHEN distinct_count = 1 THEN 'drop: zero variance, no information'
                WHEN distinct_count = total THEN 'drop: likely identifier, no predictive value' ELSE 'keep' END AS recommendation
    FROM c
    """,
)
def variance_and_identifiers(spark, sf):
    documents = table(spark, sf, "documents").withColumn("constant", F.lit("x"))
    return prof.variance_profile(documents, ["doc_id", "lang", "source", "n_chars", "constant"])


@query(
    "case_variants",
    f"""
    WITH {FACT_SQL}, {COUNTS_SQL}
    SELECT column_name, lower(value) AS label, count(*) AS spellings, min(value) AS first_spelling,
           max(value) AS last_spelling, CAST(sum(n) AS BIGINT) AS row_count
    FROM cc WHERE value IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def case_variants(spark, sf):
    return prof.case_variants(prof.category_counts(fact(spark, sf), CATEGORIES))


def token_sql(source: str, text: str) -> str:
    return f"""
    SELECT token, n FROM (
      SELECT token, count(*) AS n FROM (
        SELECT regexp_replace(raw, '[^a-z0-9]', '', 'g') AS token FROM (
          SELECT unnest(string_split_regex(lower({text}), '[\\s,/-]+')) AS raw FROM {source}))
      GROUP BY 1 ORDER BY n DESC, token LIMIT 20)
    WHERE token NOT IN ({STOP_LIST}) AND NOT regexp_matches(token, '^[0-9]+$') ORDER BY n DESC, token LIMIT 10
    """


@query("frequent_tokens_names", token_sql("part", "p_name"))
def frequent_tokens_names(spark, sf):
    return prof.frequent_tokens(table(spark, sf, "part"), "p_name")


@query("frequent_tokens_documents", token_sql("documents", "text"))
def frequent_tokens_documents(spark, sf):
    return prof.frequent_tokens(table(spark, sf, "documents"), "text")


@query("heavy_tokens_documents", token_sql("documents", "text"))
def heavy_tokens_documents(spark, sf):
    return heavy.heavy_tokens(table(spark, sf, "documents"), "text")


YEARS = """
    y AS (SELECT 'l_shipdate' AS column_name, CAST(year(l_shipdate) AS INT) AS y, count(*) AS n, min(l_shipdate) AS a, max(l_shipdate) AS b
          FROM lineitem GROUP BY 2)
"""


@query(
    "timestamp_profile",
    f"""
    WITH {YEARS}, t AS (SELECT sum(n) AS total FROM y)
    SELECT column_name, strftime(min(a), '%Y-%m-%d %H:%M:%S') AS first_moment, strftime(max(b), '%Y-%m-%d %H:%M:%S') AS last_moment,
           CAST(count(*) AS INT) AS years, coalesce(string_agg(CASE WHEN n < total * 0.01 THEN y::VARCHAR END, ',' ORDER BY y), '') AS sparse_years,
           CASE WHEN bool_or(n < total * 0.01) THEN 'inconsistent' ELSE 'consistent' END AS consistency
    FROM y, t GROUP BY 1
    """,
)
def timestamp_profile(spark, sf):
    return prof.timestamp_profile(table(spark, sf, "lineitem"), ["l_shipdate"])


@query(
    "rows_per_year",
    f"WITH {YEARS} SELECT y AS year, n, n < (SELECT sum(n) FROM y) * 0.01 AS sparse FROM y",
)
def rows_per_year(spark, sf):
    return prof.rows_per_year(table(spark, sf, "lineitem"), "l_shipdate").select("year", "n", "sparse")


@query(
    "calendar_counts",
    """
    SELECT 'month' AS part, CAST(month(ts) AS INT) AS slot, count(*) AS n FROM events GROUP BY 2
    UNION ALL SELECT 'hour', CAST(hour(ts) AS INT), count(*) FROM events GROUP BY 2
    """,
)
def calendar_counts(spark, sf):
    return prof.calendar_counts(table(spark, sf, "events"), "ts")


@query(
    "class_shares",
    f"""
    WITH {FACT_SQL}, c AS (SELECT "Severity", count(*) AS n FROM fact GROUP BY 1)
    SELECT "Severity", n, round(n * 100.0 / (SELECT sum(n) FROM c), 5) AS percentage FROM c
    """,
)
def class_shares(spark, sf):
    return prof.class_shares(fact(spark, sf), "Severity")


@query("target_profile", target_sql("labels", "quality"))
def target_profile(spark, sf):
    return prof.target_profile(table(spark, sf, "labels"), "quality")


@query("target_profile_fine", f"WITH {FACT_SQL} {target_sql('fact', 'high_severity', fine=True)}")
def target_profile_fine(spark, sf):
    return prof.target_profile(fact(spark, sf), "high_severity", fine=True)


@query("correlation_pairs", f"WITH {FACT_SQL} {correlation_sql('fact', NUMBERS)}")
def correlation_pairs(spark, sf):
    return prof.correlation_pairs(materialise(fact(spark, sf).select(*NUMBERS), "numbers"), NUMBERS)


@query("profile_table_long")
def profile_table_long(spark, sf):
    """Every section of the profile of labelled order lines."""
    source = fact(spark, sf).select("Severity", "high_severity", "Start_Time", "End_Time", *NUMBERS, *CATEGORIES, "Stop")
    source = materialise(source, "profiled")
    return prof.profile_table(source, "high_severity", ["Start_Time", "End_Time"], TEXTS)


@query(
    "report_round_trip",
    f"WITH {MISSING_SQL} SELECT column_name, null_count, null_pct, severity FROM missing",
)
def report_round_trip(spark, sf):
    report = prof.missing_profile(fact(spark, sf)).drop("recommendation")
    path = fresh_path(spark, "report")
    save_report(report, path)
    return read_report(spark, path, report.schema)
