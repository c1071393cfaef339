"""Quality gates over the profile of the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from gritmill.functions.columns import col
from gritmill.operators import encoding as encode
from gritmill.operators import features as feat
from gritmill.operators import gates, leaking
from gritmill.operators import profiling as prof
from gritmill.operators.exploring import group_counts
from gritmill.plans.feature_plan import Interaction, RegexFlag
from gritmill.session import materialise
from gritmill.workload.featuring import MODEL_FEATURES, PLAN, PLAN_SQL, planned_splits
from gritmill.workload.profiling import (
    CATEGORIES,
    CATEGORY_SQL,
    MISSING_SQL,
    NUMBERS,
    NUMERIC_SQL,
    correlation_sql,
    target_sql,
)
from gritmill.workload.registry import query
from gritmill.workload.views import FACT_SQL, fact, table, written_fact, written_splits

CATEGORY_ONLY = CATEGORY_SQL
ISSUES_SQL = f"""
    {MISSING_SQL}, {CATEGORY_ONLY},
    issues AS (SELECT 'Critical Nulls' AS issue, column_name FROM missing WHERE severity IN ('critical', 'high')
               UNION ALL SELECT 'Near Zero Variance', column_name FROM categories WHERE near_zero_variance)
"""


def _categories(spark, sf):
    return prof.category_profile(prof.category_counts(fact(spark, sf), CATEGORIES), ["Street"])


def _issues(spark, sf):
    source = written_fact(spark, sf)
    categories = prof.category_profile(prof.category_counts(source, CATEGORIES), ["Street"])
    return gates.critical_issues(prof.missing_profile(source), categories)


@query("critical_issues", f"WITH {ISSUES_SQL} SELECT * FROM issues")
def critical_issues(spark, sf):
    return _issues(spark, sf)


@query(
    "quality_score",
    f"""
    WITH {ISSUES_SQL} SELECT count(*) AS total_issues,
    CASE WHEN count(*) = 0 THEN 'good' WHEN count(*) <= 2 THEN 'moderate' ELSE 'poor' END AS score FROM issues
    """,
)
def quality_score(spark, sf):
    return gates.quality_score(_issues(spark, sf))


@query(
    "quality_score_lenient",
    f"""
    WITH {MISSING_SQL} SELECT count(*) FILTER (severity = 'critical') AS total_issues,
    CASE WHEN count(*) FILTER (severity = 'critical') = 0 THEN 'good' WHEN count(*) FILTER (severity = 'critical') <= 3 THEN 'moderate'
         ELSE 'poor' END AS score FROM missing
    """,
)
def quality_score_lenient(spark, sf):
    issues = gates.critical_issues(prof.missing_profile(fact(spark, sf)), bands=["critical"])
    return gates.quality_score(issues, moderate_up_to=3)


@query(
    "cleaning_gate_reject",
    f"""
    WITH {ISSUES_SQL}, n AS (SELECT count(*) AS n FROM issues)
    SELECT CASE WHEN n = 0 THEN 'accept' ELSE 'reject' END AS decision, CASE WHEN n = 0 THEN 'approved' ELSE 'rejected' END AS status,
           CASE WHEN n = 0 THEN 'good' WHEN n <= 2 THEN 'moderate' ELSE 'poor' END AS quality_score, n AS total_issues FROM n
    """,
)
def cleaning_gate_reject(spark, sf):
    return gates.cleaning_gate(gates.quality_score(_issues(spark, sf)))


@query(
    "cleaning_gate_accept",
    "SELECT 'accept' AS decision, 'approved' AS status, 'good' AS quality_score, count(*) FILTER (o_orderkey IS NULL) AS total_issues FROM orders",
)
def cleaning_gate_accept(spark, sf):
    orders = table(spark, sf, "orders")
    categories = prof.category_profile(prof.category_counts(orders, ["o_orderstatus", "o_orderpriority"]))
    return gates.cleaning_gate(gates.quality_score(gates.critical_issues(prof.missing_profile(orders), categories)))


@query(
    "quality_warnings",
    f"""
    WITH {MISSING_SQL}, tp AS ({target_sql('labels', 'quality')}),
    y AS (SELECT CAST(year("End_Time") AS INT) AS y, count(*) AS n FROM fact GROUP BY 1),
    sparse AS (SELECT coalesce(string_agg(CASE WHEN n < (SELECT sum(n) FROM y) * 0.01 THEN y::VARCHAR END, ',' ORDER BY y), '') AS years FROM y)
    SELECT 'missing values' AS warning, column_name, severity AS detail FROM missing WHERE severity IN ('high', 'moderate')
    UNION ALL SELECT 'target imbalance', column_name, resampling FROM tp WHERE imbalance IN ('severe_imbalance', 'moderate_imbalance')
    UNION ALL SELECT 'sparse years', 'End_Time', years FROM sparse WHERE years <> ''
    """,
)
def quality_warnings(spark, sf):
    source = written_fact(spark, sf)
    return gates.quality_warnings(
        prof.missing_profile(source),
        prof.target_profile(table(spark, sf, "labels"), "quality"),
        prof.timestamp_profile(source, ["End_Time"]),
    )


@query(
    "cleaning_advice",
    f"""
    WITH {MISSING_SQL}, {NUMERIC_SQL}, pairs AS ({correlation_sql('fact', NUMBERS)})
    SELECT 'drop_column' AS action, column_name, 'critical_null_density' AS detail FROM missing WHERE severity = 'critical'
    UNION ALL SELECT 'impute', m.column_name, coalesce(imputation, 'mode') FROM missing m LEFT JOIN numbers n ON m.column_name = n.column_name
      WHERE severity IN ('low', 'moderate')
    UNION ALL SELECT 'drop_column', col2, 'redundant_with_' || col1 FROM pairs WHERE band = 'near_duplicate'
    """,
)
def cleaning_advice(spark, sf):
    source = written_fact(spark, sf)
    return gates.cleaning_advice(
        prof.missing_profile(source), prof.numeric_profile(source, NUMBERS), prof.correlation_pairs(source, NUMBERS)
    )


@query(
    "feature_advice",
    f"""
    WITH {FACT_SQL}, {CATEGORY_ONLY}, tp AS ({target_sql('labels', 'quality')})
    SELECT 'extract_binary_features' AS action, column_name, 'string_keyword_extraction' AS detail FROM categories WHERE column_name = 'Street'
    UNION ALL SELECT 'encode', column_name, encoding FROM categories WHERE column_name <> 'Street' AND NOT zero_variance AND NOT likely_identifier
    UNION ALL SELECT 'balance_target', column_name, 'SMOTE' FROM tp WHERE imbalance IN ('severe_imbalance', 'moderate_imbalance')
    """,
)
def feature_advice(spark, sf):
    target = prof.target_profile(table(spark, sf, "labels"), "quality")
    return gates.feature_advice(_categories(spark, sf), target, ["Street"])


# --- engineered features -------------------------------------------------------------------------

ENGINEERED = {
    "is_color": "is_color", "is_tool": "is_tool", "is_rush_hour": "is_rush_hour", "Junction": '"Junction"',
    "Month": '"Month"', "Distance(mi)": "distance", "Toll_bin": "toll_bin", "Temperature(F)_bin": "temp_bin",
}


def _engineered_sql(name: str, x: str) -> str:
    flag = f"bool_and({x} IN (0, 1))"
    return f"""
    SELECT '{name}' AS column_name, CASE WHEN {flag} THEN 'flag' ELSE 'number' END AS kind,
           CASE WHEN {flag} THEN round(avg({x}), 4) END AS true_ratio, round(min({x})::DOUBLE, 4) AS min, round(max({x})::DOUBLE, 4) AS max,
           round(avg({x}), 4) AS mean, round(stddev({x}), 4) AS stddev, min({x}) < 0 AS contains_negatives
    FROM tr2
    """


@query(
    "engineered_profile",
    f"WITH {PLAN_SQL}, tr2 AS (SELECT * FROM engineered WHERE in_train) "
    + " UNION ALL ".join(_engineered_sql(n, x) for n, x in ENGINEERED.items()),
)
def engineered_profile(spark, sf):
    train, _, _ = planned_splits(spark, sf)
    profile = gates.engineered_profile(train.select("high_severity", *[col(n) for n in ENGINEERED]), "high_severity")
    return profile.drop("approx_cardinality", "skewness")


@query("engineered_index_cardinality")
def engineered_index_cardinality(spark, sf):
    train, _, _ = planned_splits(spark, sf)
    profile = gates.engineered_profile(train, "high_severity")
    return profile.filter(F.col("kind") == "index").select("column_name", "approx_cardinality")


@query(
    "index_cardinality_exact",
    f"WITH {PLAN_SQL} SELECT count(DISTINCT brand) AS brands, count(DISTINCT wind) AS winds FROM engineered WHERE in_train",
)
def index_cardinality_exact(spark, sf):
    train, _ = written_splits(spark, sf)
    indexed = encode.indexer(["Brand", "Wind_Direction"]).fit(train).transform(train)
    return indexed.agg(
        F.count_distinct("Brand_idx").alias("brands"), F.count_distinct("Wind_Direction_idx").alias("winds")
    )


@query(
    "flag_columns_found",
    f"""WITH {PLAN_SQL} SELECT 'is_color' AS column_name, round(avg(is_color), 4) AS true_ratio FROM engineered WHERE in_train HAVING bool_and(is_color IN (0, 1))
    UNION ALL SELECT 'is_tool', round(avg(is_tool), 4) FROM engineered WHERE in_train HAVING bool_and(is_tool IN (0, 1))
    UNION ALL SELECT 'Month', round(avg("Month"), 4) FROM engineered WHERE in_train HAVING bool_and("Month" IN (0, 1))
    """,
)
def flag_columns_found(spark, sf):
    train, _, _ = planned_splits(spark, sf)
    profile = gates.engineered_profile(train.select("high_severity", "is_color", "is_tool", "Month"), "high_severity")
    return profile.filter(F.col("kind") == "flag").select("column_name", "true_ratio")


@query(
    "class_weight_ratio",
    f"""
    WITH {FACT_SQL}, c AS (SELECT count(*) FILTER (high_severity = 0) AS n_0, count(*) FILTER (high_severity = 1) AS n_1 FROM fact)
    SELECT n_0, n_1, round(n_0 / greatest(n_1, 1), 2) AS class_weight_ratio FROM c
    """,
)
def class_weight_ratio(spark, sf):
    return gates.class_weight_ratio(fact(spark, sf), "high_severity")


@query(
    "engineered_class_balance",
    f'WITH {PLAN_SQL} SELECT is_rush_hour, high_severity, count(*) AS n FROM engineered WHERE in_train GROUP BY 1, 2',
)
def engineered_class_balance(spark, sf):
    train, _, _ = planned_splits(spark, sf)
    return group_counts(train, ["is_rush_hour", "high_severity"])


@query(
    "feature_checks",
    f"""
    WITH {PLAN_SQL}, g AS (SELECT count(*) - count(temp_bin) AS gaps FROM engineered WHERE in_train)
    SELECT 'no_target_leakage' AS "check", 'PASS' AS status, '' AS detail
    """
    + "".join(
        f""" UNION ALL SELECT 'no_nulls_{c}', {"CASE WHEN gaps = 0 THEN 'PASS' ELSE 'FAIL' END, gaps::VARCHAR FROM g" if c == "Temperature(F)_bin" else "'PASS', '0'"}"""
        for c in MODEL_FEATURES
    )
    + "".join(f" UNION ALL SELECT 'range_{c}', 'PASS', '0'" for c in ("is_color", "is_tool", "is_rush_hour"))
    + " UNION ALL SELECT 'dropped_columns_removed', 'PASS', ''",
)
def feature_checks(spark, sf):
    train, _, _ = planned_splits(spark, sf)
    return gates.feature_checks(train, MODEL_FEATURES, PLAN)


@query(
    "target_leakage_by_lineage",
    f"WITH {FACT_SQL} SELECT 'no_target_leakage' AS \"check\", 'FAIL' AS status, 'Severity_multiply_Month' AS detail FROM fact LIMIT 1",
)
def target_leakage_by_lineage(spark, sf):
    """A column computed from the source of the target is caught though its name is neither's."""
    leak = Interaction("Severity", "Month", "multiply")
    plan = feat.FeaturePlan(target="high_severity", target_sources=("Severity",), interactions=(leak,))
    leaky = feat.add_interactions(fact(spark, sf), [leak])
    return gates.feature_checks(leaky, ["Month", leak.output], plan).filter(F.col("check") == "no_target_leakage")


@query("vector_present", f"""WITH {PLAN_SQL} SELECT 'features_vector_exists' AS "check", 'PASS' AS status,
    count(temp_bin)::VARCHAR || ' rows' AS detail FROM engineered WHERE in_train""")
def vector_present(spark, sf):
    train, _, _ = planned_splits(spark, sf)
    return gates.vector_check(feat.assemble(train, MODEL_FEATURES))


ODD_FLAGS = (
    RegexFlag("p_name", "is_color", "red|blue|green"),
    RegexFlag("p_name", "never", "no such word"),
    RegexFlag("p_name", "always", "[a-z]"),
)


def _flag_review(spark, sf):
    part = table(spark, sf, "part").withColumn("y", (F.col("p_size") > 25).cast("int"))
    flagged = feat.add_flags(part, ODD_FLAGS).select("y", *[f.output for f in ODD_FLAGS])
    planned = [*ODD_FLAGS, RegexFlag("p_comment", "absent", "x")]
    return flagged, planned, gates.suspicious_flags(gates.engineered_profile(flagged, "y"), planned)


SUSPICIOUS_SQL = """
    s AS (SELECT 'never' AS column_name, round(avg(regexp_matches(lower(p_name), 'no such word')::INT), 4) AS true_ratio, 'true_ratio too low' AS reason FROM part
    UNION ALL SELECT 'always', round(avg(regexp_matches(lower(p_name), '[a-z]')::INT), 4), 'true_ratio too high' FROM part
    UNION ALL SELECT 'absent', NULL, 'not found in profile')
"""


@query("suspicious_flags", f"WITH {SUSPICIOUS_SQL} SELECT * FROM s")
def suspicious_flags(spark, sf):
    return _flag_review(spark, sf)[2]


@query(
    "feature_gate",
    f"""WITH {SUSPICIOUS_SQL} SELECT CASE WHEN count(*) <= 3 THEN 'accept' ELSE 'reject' END AS decision,
    CASE WHEN count(*) <= 3 THEN 'approved' ELSE 'needs_more_feature_engineering' END AS status,
    CAST(4 AS INT) AS flags_reviewed, count(*) AS suspicious_flags, 0::BIGINT AS failed_checks FROM s""",
)
def feature_gate(spark, sf):
    flagged, planned, found = _flag_review(spark, sf)
    plan = feat.FeaturePlan(target="y", flags=tuple(planned))
    checks = gates.feature_checks(flagged, ["is_color", "never", "always"], plan)
    return gates.feature_gate(found, checks, len(planned), 3)


@query(
    "pruned_features",
    f"""
    WITH {PLAN_SQL} SELECT in_train::INT AS in_train, count(*) AS n, CAST(sum(is_color) AS BIGINT) AS is_color,
    'Brand_idx,Crossing,Distance(mi),Distance(mi)_multiply_Month,Distance(mi)_ratio_Toll,Junction,Month,Stop,'
    || 'Temperature(F)_bin,Toll_bin,Wind_Direction_ohe,is_color,is_rush_hour,is_tool' AS features
    FROM engineered GROUP BY 1
    """,
)
def pruned_features(spark, sf):
    """A flag that never holds is dropped from both splits, the plan and the feature list."""
    plan = replace(PLAN, flags=(*PLAN.flags, RegexFlag("Street", "is_nothing", "no such word")))
    train, test, fitted = feat.apply_plan(*written_splits(spark, sf, plan.unread()), plan)
    train, test = materialise(train, "train"), materialise(test, "test")
    found = gates.suspicious_flags(gates.engineered_profile(train, "high_severity"), plan.flags)
    (train, test), slim = gates.prune(found, fitted, train, test)
    both = train.withColumn("in_train", F.lit(1)).unionByName(test.withColumn("in_train", F.lit(0)))
    return both.groupBy("in_train").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_color").alias("is_color"),
        F.lit(",".join(sorted(slim.features))).alias("features"),
    )


PLANTED = {"Copied": 'high_severity * 3 + "Humidity(%)"', "Mirrored": '5 - "Severity"'}
JUDGED = [*NUMBERS, "Severity", *PLANTED]


@query(
    "leaking_features",
    f"""
    WITH {FACT_SQL}, planted AS (SELECT *, {", ".join(f'{e} AS "{n}"' for n, e in PLANTED.items())} FROM fact),
    v AS ({" UNION ALL ".join(f"""SELECT '{c}' AS feature, CAST("{c}" AS DOUBLE) AS v, high_severity AS y FROM planted WHERE "{c}" IS NOT NULL""" for c in JUDGED)}),
    b AS (SELECT feature, v, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM v GROUP BY 1, 2),
    r AS (SELECT *, sum(neg) OVER (PARTITION BY feature ORDER BY v) - neg AS below FROM b),
    a AS (SELECT feature, round(sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS auc FROM r GROUP BY 1)
    SELECT feature, auc, round(greatest(auc, 1 - auc), 6) AS strength FROM a WHERE greatest(auc, 1 - auc) >= 0.98
    """,
)
def leaking_features(spark, sf):
    """Features that tell the target by themselves, the target's copy under another name among them."""
    planted = written_fact(spark, sf).withColumns({n: F.expr(e.replace('"', "`")) for n, e in PLANTED.items()})
    return leaking.leaking_features(planted, JUDGED, "high_severity")
