"""Exploratory aggregates over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gritmill.functions.moments_in_time import rush_hour, seconds_between
from gritmill.operators import exploring as look
from gritmill.operators.cleaning import add_calendar
from gritmill.workload.registry import query
from gritmill.workload.views import FACT_SQL, fact, table

MEASURES = ["Temperature(F)", "Humidity(%)", "Pressure(in)", "Visibility(mi)", "Distance(mi)"]
FLAGS = ["Junction", "Crossing", "Stop"]
SECONDS = 'CAST(epoch("End_Time") - epoch("Start_Time") AS BIGINT)'


@query(
    "group_counts",
    f'WITH {FACT_SQL} SELECT "Country", "Stop", "Severity", count(*) AS n FROM fact GROUP BY 1, 2, 3',
)
def group_counts(spark, sf):
    return look.group_counts(fact(spark, sf), ["Country", "Stop", "Severity"])


@query(
    "rush_hour_distribution",
    """
    SELECT CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 THEN 1 ELSE 0 END AS is_rush_hour, count(*) AS n
    FROM events GROUP BY 1
    """,
)
def rush_hour_distribution(spark, sf):
    flagged = table(spark, sf, "events").withColumn("is_rush_hour", rush_hour("ts"))
    return look.group_counts(flagged, ["is_rush_hour"])


def within_sql(by: str, name: str, scale: str, source: str = "fact") -> str:
    return f"""
    c AS (SELECT "{by}", "{name}", count(*) AS n FROM {source} GROUP BY 1, 2)
    SELECT "{by}", "{name}", n, round(n * {scale} / sum(n) OVER (PARTITION BY "{by}"), 6) AS pct FROM c
    """


@query("share_within_class", f"WITH {FACT_SQL}, {within_sql('high_severity', 'Month', '1.0')}")
def share_within_class(spark, sf):
    return look.share_within(fact(spark, sf), "high_severity", "Month")


@query("category_within_class_pct", f"WITH {FACT_SQL}, {within_sql('Severity', 'Wind_Direction', '100.0')}")
def category_within_class_pct(spark, sf):
    return look.share_within(fact(spark, sf), "Severity", "Wind_Direction", scale=100.0)


@query(
    "share_within_class_top",
    f"""
    WITH {FACT_SQL}, top AS (SELECT "Street" FROM fact GROUP BY 1 ORDER BY count(*) DESC, "Street" LIMIT 20),
    kept AS (SELECT * FROM fact WHERE "Street" IN (SELECT "Street" FROM top)),
    {within_sql('high_severity', 'Street', '1.0', 'kept')}
    """,
)
def share_within_class_top(spark, sf):
    return look.share_within_frequent(fact(spark, sf), "high_severity", "Street", 20)


def means_sql(measure: str, label: str) -> str:
    return f"SELECT '{measure}' AS measure, \"{label}\", round(avg(\"{measure}\"), 4) AS mean FROM fact GROUP BY 2"


@query("class_means", f"WITH {FACT_SQL} {' UNION ALL '.join(means_sql(m, 'high_severity') for m in MEASURES)}")
def class_means(spark, sf):
    return look.class_means(fact(spark, sf), "high_severity", MEASURES)


@query(
    "class_means_wide",
    f"WITH {FACT_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, round(avg("{m}") FILTER (high_severity = 0), 4) AS "0",
            round(avg("{m}") FILTER (high_severity = 1), 4) AS "1" FROM fact"""
        for m in MEASURES
    ),
)
def class_means_wide(spark, sf):
    return look.class_means_wide(fact(spark, sf), "high_severity", [0, 1], MEASURES)


@query(
    "means_per_month_and_class",
    f"""
    WITH {FACT_SQL}
    SELECT "Month", high_severity, count(*) AS n, {", ".join(f'round(avg("{m}"), 2) AS "avg_{m}"' for m in MEASURES)}
    FROM fact GROUP BY 1, 2
    """,
)
def means_per_month_and_class(spark, sf):
    return look.means_per(fact(spark, sf), ["Month", "high_severity"], MEASURES)


@query(
    "classes_side_by_side",
    f"""
    WITH {FACT_SQL}
    SELECT "Month", count(*) FILTER (high_severity = 0) AS n_0, count(*) FILTER (high_severity = 1) AS n_1,
           round(avg("Temperature(F)") FILTER (high_severity = 0), 2) AS "avg_Temperature(F)_0",
           round(avg("Temperature(F)") FILTER (high_severity = 1), 2) AS "avg_Temperature(F)_1",
           round(count(*) FILTER (high_severity = 1) / count(*), 6) AS positive_rate
    FROM fact GROUP BY 1
    """,
)
def classes_side_by_side(spark, sf):
    return look.classes_side_by_side(fact(spark, sf), "Month", "high_severity", ["Temperature(F)"])


@query(
    "rate_by_rounded_measure",
    f"""
    WITH {FACT_SQL}
    SELECT round("Temperature(F)", 0) AS bucket, count(*) AS n, CAST(sum(high_severity) AS BIGINT) AS positives,
           round(sum(high_severity) / count(*), 6) AS rate
    FROM fact GROUP BY 1 HAVING count(*) > 10
    """,
)
def rate_by_rounded_measure(spark, sf):
    return look.rate_by_rounded(fact(spark, sf), "Temperature(F)", "high_severity")


@query(
    "flag_rates_per_class",
    f"""
    WITH {FACT_SQL}
    SELECT "Severity", {", ".join(f'round(avg("{f}"::INT) * 100, 4) AS "{f}"' for f in FLAGS)} FROM fact GROUP BY 1
    """,
)
def flag_rates_per_class(spark, sf):
    return look.flag_rates(fact(spark, sf), "Severity", FLAGS, scale=100.0)


@query(
    "point_density",
    f'WITH {FACT_SQL} SELECT "Severity", "Temperature(F)", "Pressure(in)", count(*) AS n FROM fact GROUP BY 1, 2, 3',
)
def point_density(spark, sf):
    return look.point_density(fact(spark, sf), "Temperature(F)", "Pressure(in)", by="Severity")


@query(
    "grid_density",
    """
    SELECT round(value, -1) AS value, round(CAST(user_id AS DOUBLE), -1) AS user_id, count(*) AS n FROM events GROUP BY 1, 2
    """,
)
def grid_density(spark, sf):
    events = table(spark, sf, "events").withColumn("user_id", F.col("user_id").cast("double"))
    return look.point_density(events, "value", "user_id", digits=-1)


MONTHS = [f"{y}_{m:02d}" for y in range(1995, 2002) for m in range(1, 13)]


@query(
    "month_grid",
    "SELECT CAST(dayofweek(l_shipdate) + 1 AS INT) AS weekday, "
    + ", ".join(f"count(*) FILTER (strftime(l_shipdate, '%Y_%m') = '{m}') AS \"m_{m}\"" for m in MONTHS)
    + " FROM lineitem GROUP BY 1",
)
def month_grid(spark, sf):
    return look.month_grid(table(spark, sf, "lineitem"), "l_shipdate", MONTHS, F.dayofweek("l_shipdate"), "weekday")


@query(
    "hour_by_month_counts",
    """
    SELECT CAST(year(ts) AS INT) AS "ts_Year", CAST(month(ts) AS INT) AS "ts_Month", CAST(hour(ts) AS INT) AS "ts_Hour", count(*) AS n
    FROM events GROUP BY 1, 2, 3
    """,
)
def hour_by_month_counts(spark, sf):
    return look.group_counts(add_calendar(table(spark, sf, "events"), "ts"), ["ts_Year", "ts_Month", "ts_Hour"])


@query(
    "histogram_50",
    """
    WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    b AS (SELECT least(CAST(floor((value - lo) / (hi - lo) * 50) AS INT), 49) AS bin, count(*) AS n FROM events, e GROUP BY 1)
    SELECT CAST(g.bin AS INT) AS bin, round(lo + (hi - lo) / 50 * g.bin, 6) AS lower, round(lo + (hi - lo) / 50 * (g.bin + 1), 6) AS upper,
           coalesce(n, 0) AS n
    FROM (SELECT unnest(range(50)) AS bin) g CROSS JOIN e LEFT JOIN b ON g.bin = b.bin
    """,
)
def histogram_50(spark, sf):
    return look.histogram(table(spark, sf, "events"), "value", 50)


@query(
    "mean_and_median",
    """
    SELECT 'l_extendedprice' AS column_name, round(avg(l_extendedprice), 4) AS mean, round(median(l_extendedprice), 4) AS median
    FROM lineitem
    """,
)
def mean_and_median(spark, sf):
    return look.centre(table(spark, sf, "lineitem"), "l_extendedprice")


@query("mean_gap_seconds", f"WITH {FACT_SQL} SELECT round(avg({SECONDS}), 4) AS mean_diff_seconds FROM fact")
def mean_gap_seconds(spark, sf):
    return look.mean_gap(fact(spark, sf), "Start_Time", "End_Time")


@query(
    "correlation_of_two",
    f"""
    WITH {FACT_SQL} SELECT round(corr("Visibility(mi)", "Toll"), 4) AS correlation FROM fact
    """,
)
def correlation_of_two(spark, sf):
    return look.correlation_of(fact(spark, sf), "Visibility(mi)", "Toll")


MATRIX_NUMBERS = ["Distance(mi)", "Toll", "Month", "high_severity"]
MATRIX_SQL = f"""
    {FACT_SQL},
    ranked AS (SELECT "Wind_Direction" AS w, row_number() OVER (ORDER BY count(*) DESC, "Wind_Direction") - 1 AS i FROM fact GROUP BY 1),
    x AS (SELECT "Distance(mi)", "Toll", CAST("Month" AS DOUBLE) AS "Month", CAST(high_severity AS DOUBLE) AS high_severity,
                 CAST("Junction"::INT AS DOUBLE) AS "Junction", CAST("Stop"::INT AS DOUBLE) AS "Stop", CAST(i AS DOUBLE) AS "Wind_Direction"
          FROM fact JOIN ranked ON "Wind_Direction" = w)
"""
MATRIX_ALL = [*MATRIX_NUMBERS, "Junction", "Stop", "Wind_Direction"]


@query(
    "correlation_matrix",
    f"WITH {MATRIX_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, "
        + ("1.0::DOUBLE AS r" if a == b else f'round(corr("{a}", "{b}"), 4) AS r FROM x')
        for a in MATRIX_ALL
        for b in MATRIX_ALL
    ),
)
def correlation_matrix(spark, sf):
    return look.correlation_matrix(fact(spark, sf), MATRIX_NUMBERS, ["Junction", "Stop"], ["Wind_Direction"])


@query(
    "features_by_correlation",
    f"WITH {MATRIX_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{b}' AS feature, round(corr(high_severity, \"{b}\"), 4) AS r FROM x"
        for b in MATRIX_ALL
        if b != "high_severity"
    ),
)
def features_by_correlation(spark, sf):
    matrix = look.correlation_matrix(fact(spark, sf), MATRIX_NUMBERS, ["Junction", "Stop"], ["Wind_Direction"])
    return look.ranked_by_correlation(matrix, "high_severity")


@query(
    "impact_summary",
    f"""
    WITH {FACT_SQL}
    SELECT high_severity, count(*) AS n, round(avg({SECONDS}), 2) AS avg_duration_seconds, round(avg("Distance(mi)"), 2) AS avg_distance
    FROM fact GROUP BY 1
    """,
)
def impact_summary(spark, sf):
    return look.impact_summary(
        fact(spark, sf), "high_severity", seconds_between("Start_Time", "End_Time"), "Distance(mi)"
    )


@query(
    "ordered_by_keys",
    f'WITH {FACT_SQL} SELECT "Month", "Severity", count(*) AS n FROM fact GROUP BY 1, 2 ORDER BY 1, 2',
)
def ordered_by_keys(spark, sf):
    return look.group_counts(fact(spark, sf), ["Month", "Severity"]).orderBy("Month", "Severity")


@query(
    "top_groups",
    f"""
    WITH {FACT_SQL} SELECT "Street", "Brand", count(*) AS n FROM fact GROUP BY 1, 2 ORDER BY n DESC, "Street", "Brand" LIMIT 10
    """,
)
def top_groups(spark, sf):
    return look.top_groups(fact(spark, sf), ["Street", "Brand"], 10)


@query("first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def first_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5)
