"""Splits and samples over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.operators import splitting as split
from gritmill.operators.profiling import long_section, missing_profile
from gritmill.workload.registry import query
from gritmill.workload.views import LINES_SQL, hash_sql, lines, table

KEY = ["l_orderkey", "l_linenumber"]


@query(
    "key_hash_split",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN {hash_sql('l_orderkey, l_linenumber')} % 100 < 80 THEN 'train' ELSE 'test' END AS split
    FROM lineitem
    """,
)
def key_hash_split(spark, sf):
    source = table(spark, sf, "lineitem").select(*KEY, "l_partkey")
    train, test = split.key_split(source, KEY)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("random_split_sizes")
def random_split_sizes(spark, sf):
    parts = split.random_split(table(spark, sf, "lineitem"))
    counted = [
        p.agg(F.count(F.lit(1)).alias("n")).withColumn("split", F.lit(name))
        for name, p in zip(("train", "test"), parts, strict=True)
    ]
    return reduce(DataFrame.unionByName, counted)


@query(
    "balanced_classes",
    f"""
    WITH c AS (SELECT event_id, event_type = 'error' AS label, {hash_sql('event_id', 13)} AS h FROM events),
    s AS (SELECT label, count(*) AS n FROM c GROUP BY 1),
    r AS (SELECT *, rank() OVER (PARTITION BY label ORDER BY h) AS place FROM c)
    SELECT event_id, label FROM r WHERE place <= (SELECT min(n) FROM s)
    """,
)
def balanced_classes(spark, sf):
    events = table(spark, sf, "events").select("event_id", (F.col("event_type") == "error").alias("label"))
    return split.balance_classes(events, "label", ["event_id"])


@query("majority_sample_sizes")
def majority_sample_sizes(spark, sf):
    events = table(spark, sf, "events").select("event_id", (F.col("event_type") == "error").cast("int").alias("label"))
    return split.sample_majority(events, "label").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("bernoulli_sample")
def bernoulli_sample(spark, sf):
    return split.bernoulli_sample(table(spark, sf, "lineitem"), 0.05, 42).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("split_schema_parity")
def split_schema_parity(spark, sf):
    """Parity of names and types, next to the gaps of the test split, which the parity check guards."""
    train, test = split.key_split(lines(spark, sf), ["order_key", "line_no"])
    split.require_same_schema(train, test)
    odd = test.drop("Toll").withColumn("Month", F.col("Month").cast("bigint")).withColumn("extra", F.lit(1))
    parity = long_section("schema", split.schema_parity(train, odd))
    return parity.unionByName(long_section("missing", missing_profile(test)))


@query(
    "split_integrity",
    f"""
    WITH {LINES_SQL}, s AS (SELECT *, {hash_sql('order_key, line_no')} % 100 < 80 AS t FROM lines)
    SELECT 'keys_in_both_splits' AS "check", count(*) AS "rows" FROM
      (SELECT order_key, line_no FROM s WHERE t INTERSECT SELECT order_key, line_no FROM s WHERE NOT t)
    UNION ALL SELECT 'rows_lost', count(*) FROM (SELECT * FROM s EXCEPT ALL (SELECT * FROM s WHERE t UNION ALL SELECT * FROM s WHERE NOT t))
    UNION ALL SELECT 'rows_invented', count(*) FROM ((SELECT * FROM s WHERE t UNION ALL SELECT * FROM s WHERE NOT t) EXCEPT ALL SELECT * FROM s)
    """,
)
def split_integrity(spark, sf):
    whole = lines(spark, sf)
    train, test = split.key_split(whole, ["order_key", "line_no"])
    return split.split_integrity(whole, train, test, ["order_key", "line_no"])
