from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from gritmill.llm import mixing
from llm_cases import DOCS, WORD, clashing, docs, odd_rows, prose


def brute(sizes):
    """Targets by source, from sizes by source."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        level = rest / sum(weight[s] for s in order if s not in full) if len(full) < len(order) else 0
        more = {s for s in order if s not in full and weight[s] * level > 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in full else weight[s] * level for s in order}
        full |= more


def checked(spark, rows):
    found = mixing.mixed_copies(clashing(docs(spark, rows)), ["doc_id", "source", "text"]).collect()
    assert len(found) == len(rows)
    sizes, taken = {}, {}
    for r in found:
        assert r["size"] == len(WORD.findall(r["row"]["text"] or "")) and 0 <= r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        s = r["row"]["source"]
        sizes[s], taken[s] = sizes.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"]
    targets = brute(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["row"]["source"]] and r["target"] == pytest.approx(targets[r["row"]["source"]], rel=1e-12)
    return targets, taken, found


def test_each_source_comes_near_its_target(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randrange(1, 60)), "en", rng.choice(["src0", "src0", "src1", "src2", "src10", "Ä", None])) for i in range(1500)]
    targets, taken, found = checked(spark, rows)
    assert all(abs(taken[s] - t) <= 0.01 * t for s, t in targets.items())
    again = mixing.mixed_copies(docs(spark, rows).repartition(5), ["doc_id"]).collect()
    assert sorted((r["row"]["doc_id"], r["taken"]) for r in again) == sorted((r["row"]["doc_id"], r["taken"]) for r in found)


def test_strata_of_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRATUM", 50)
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randrange(1, 30)), "en", "hot" if i % 3 else f"s{i % 4}") for i in range(1200)]
    targets, taken, _ = checked(spark, rows)
    assert all(abs(taken[s] - t) <= 0.03 * t for s, t in targets.items())


def test_many_ranges_of_sources(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"{i % 97:x}") for i in range(400)]
    checked(spark, rows)


def test_odd_rows(spark):
    checked(spark, odd_rows(random.Random(3)))
    checked(spark, [(1, None), (2, "")])
    checked(spark, [(1, "one two three", "en", None)])
    assert mixing.mixed_copies(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0


def test_newton_with_unequal_priors(spark):
    cells = spark.createDataFrame([("a", 0.2, 100), ("a", 1.0, 50), ("a", 3.0, 10), ("b", 1.0, 7), (None, 0.5, 9)], "source string, prior double, mass long")
    targets = spark.createDataFrame([("a", 160, 250.0), ("b", 7, 14.0), (None, 9, 1.0)], "source string, source_size long, target double")
    found = {r["source"]: r["tilt"] for r in mixing.balanced_rates(cells, targets).collect()}
    words = lambda t: sum(m * min(2.0, p * math.exp(t)) for p, m in ((0.2, 100), (1.0, 50), (3.0, 10)))
    assert words(found["a"]) == pytest.approx(250) and math.exp(found["b"]) >= 2 - 1e-9 and math.exp(found[None]) * 4.5 == pytest.approx(1)


def test_prior_rates_shift_the_mix(spark):
    rows = [(i, "w " * 10, "en", "s") for i in range(200)] + [(1000 + i, "w " * 10, "en", "t") for i in range(400)]
    found = mixing.mixed_copies(docs(spark, rows), ["doc_id"], prior=F.when(F.col("doc_id") % 2 == 0, 0.25).otherwise(1.0)).collect()
    even = sum(r["taken"] for r in found if r["row"]["doc_id"] % 2 == 0)
    assert even < sum(r["taken"] for r in found) / 2
