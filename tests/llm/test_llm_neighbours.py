from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gritmill.llm.neighbours import nearest
from llm_cases import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def brute(rows, k, is_query):
    width = max(len(v) for _, v in rows)
    ids = np.array([i for i, _ in rows])
    x = np.zeros((len(rows), width))
    for i, (_, v) in enumerate(rows):
        x[i, : len(v)] = np.asarray(v, np.float32)
    out = {}
    for i in range(len(rows)):
        if is_query(ids[i]):
            s = x @ x[i]
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
            out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def by_query(found):
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, wanted):
    assert set(found) == set(wanted)
    hits = [len({v for v, _ in found[q]} & {v for v, _ in w}) / len(w) for q, w in wanted.items()]
    return float(np.mean(hits))


@pytest.mark.parametrize("shard_rows", [8192, 500])
def test_recall_and_exact_scores(spark, shard_rows):
    rng = np.random.default_rng(1)
    rows = [(i * 3, rng.normal(size=32)) for i in range(1500)]
    found = by_query(nearest(table(spark, rows), F.col("vec_id") % 20 == 0, shard_rows=shard_rows).collect())
    wanted = brute(rows, 20, lambda i: i % 20 == 0)
    assert recall(found, wanted) > 0.95
    exact = {q: dict(w) for q, w in brute(rows, len(rows), lambda i: i % 20 == 0).items()}
    assert all(len(w) == 20 and all(s == pytest.approx(exact[q][v], abs=1e-12) for v, s in w) for q, w in found.items())


@pytest.mark.parametrize("group, shard_rows", [(17, 8192), (30, 8192), (30, 1500), (100, 8192), (200, 3000)])
def test_recall_on_clustered_vectors(spark, group, shard_rows):
    rng = np.random.default_rng(group)
    centres = rng.normal(size=(6000 // group + 1, 64))
    x = centres[np.arange(6000) % len(centres)] + 0.5 * rng.normal(size=(6000, 64))
    rows = list(enumerate(x / np.linalg.norm(x, axis=1, keepdims=True)))
    found = by_query(nearest(table(spark, rows), F.col("vec_id") % 20 == 0, shard_rows=shard_rows).collect())
    wanted = brute(rows, 20, lambda i: i % 20 == 0)
    assert recall(found, wanted) > 0.95
    assert min(len({v for v, _ in found[q]} & {v for v, _ in w}) for q, w in wanted.items()) >= 10


def test_many_copies_of_one_vector(spark):
    rng = np.random.default_rng(2)
    one = rng.normal(size=8)
    rows = [(i, one if i % 3 == 0 else rng.normal(size=8)) for i in range(300)]
    found = by_query(nearest(clashing(table(spark, rows)), F.col("vec_id") % 20 == 0, k=5).collect())
    assert found[0] == [(i, pytest.approx(float((one.astype(np.float32).astype(float) ** 2).sum()))) for i in (3, 6, 9, 12, 15)]
    wanted = brute(rows, 5, lambda i: i % 20 == 0)
    assert recall(found, wanted) == 1 and {q: [v for v, _ in w] for q, w in found.items()} == {q: [v for v, _ in w] for q, w in wanted.items()}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1, 0]), (20, [0, 1, 5]), (40, [1, 1]), (60, [-1, -1]), (5, [0.5, 0])]
    bad = [(0, None), (2, []), (100, [0, 0]), (3, [nan, 1]), (120, [1, None]), (4, [inf, 1]), (None, [1, 1])]
    found = by_query(nearest(table(spark, good + bad + good[:3]), F.col("vec_id") % 20 == 0, k=20).collect())
    assert found == brute(good, 20, lambda i: i % 20 == 0)


def test_few_rows(spark):
    assert nearest(table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(table(spark, [(20, [1, 2])]), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(table(spark, [(1, [1, 2]), (2, [1, 2])]), F.col("vec_id") % 20 == 0).count() == 0
    assert by_query(nearest(table(spark, [(20, [1, 2]), (2, [1, 0])]), F.col("vec_id") % 20 == 0).collect()) == {20: [(2, 1.0)]}


def test_recall_on_the_given_vectors(spark):
    from gritmill.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = by_query(QUERIES["op8_neighbours"](spark, sf).collect())
    assert recall(found, brute(rows, 20, lambda i: i % 20 == 0)) >= 0.9
