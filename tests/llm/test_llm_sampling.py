from __future__ import annotations

from pyspark.sql import functions as F

from gritmill.llm.shared import drawn


def test_shares_of_any_size(spark):
    ids = spark.range(200_000)
    for share in (1e-1, 1e-3, 1e-4):
        n = ids.filter(drawn(F.col("id"), share)).count()
        assert abs(n - share * 200_000) <= 5 * (share * 200_000) ** 0.5
    assert ids.filter(drawn(F.col("id"), 2.0)).count() == 200_000


def test_no_count_makes_the_chance_nothing(spark):
    """Samples of 300 in 10^9 and of 12,000 in 10^15: the lowest hash passes, so a label with that many rows isn't left without any."""
    for share in (300 / 1e9, 12_000 / 1e15, 1e-17):
        plan = spark.range(1).select(drawn(F.col("id"), share).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
        threshold = int(plan.split(" < ")[1].split(")")[0].split(" ")[0].rstrip("L"))
        assert threshold >= max(1, int(share * 2**63)) > 0


def test_null_keys_are_drawn_like_any_other(spark):
    assert spark.range(3).select(F.lit(None).cast("long").alias("id")).filter(drawn(F.col("id"), 1.0)).count() == 3
