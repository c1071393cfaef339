"""Column-sharded Lloyd and vector codes against plain rounds."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gritmill.llm import vector_codes as codes
from gritmill.llm.sharded_lloyd import BucketedSlices, clustered, labelled, updated
from gritmill.llm.slices import finite_vectors, most_cell, sliced
from llm_cases import clashing

SCHEMA = "vec_id long, embedding array<double>, label int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], k) for i, v, k in rows], schema)


def rounds(x, start, n):
    """Plain Lloyd in whole numbers: centroids, labels and squared distances."""
    c = [list(map(int, r)) for r in start]
    for left in range(n, -1, -1):
        d = [[sum((a - b) ** 2 for a, b in zip(r, e, strict=True)) for e in c] for r in x]
        near = [min(range(len(c)), key=lambda i: (row[i], i)) for row in d]
        if not left:
            return c, near, [row[i] for row, i in zip(d, near, strict=True)]
        for k in range(len(c)):
            mine = [r for r, i in zip(x, near, strict=True) if i == k]
            if mine:
                c[k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]


def whole(v, scale, width):
    return [int(np.floor(float(x) * scale)) for x in v] + [0] * (width - len(v))


def by_hash(i):
    return hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "~"


ORDER = "sha2(concat('1:', cast(vec_id as string)), 256)"


def odd_vectors(rng, n, width):
    rows = [(i, (rng.normal(size=width) * 0.3).round(2), int(i % 3) if i % 7 else None) for i in range(n)]
    rows += [rows[3], rows[3], rows[5]]  # repeated rows
    rows += [(1000 + i, rows[0][1], 1) for i in range(20)]  # one very common vector
    rows += [(None, rows[8][1], 2), (7, rows[9][1], 2)]
    odd = list(rows[1][1])
    bad = [(2000, None, 1), (2001, odd[:-1] + [None], 1), (2002, odd[:-1] + [NAN], 1), (2003, odd[:-1] + [-INF], 1)]
    return rows, bad


def clusters_of(found):
    return sorted((str(r["row"]["vec_id"]), r["cluster"], r["distance"]) for r in found.collect())


@pytest.mark.parametrize("width, k, block", [(64, 16, 16), (10, 5, 3), (5, 3, 16), (4, 300, 2)])
def test_lloyd_agrees_with_plain_rounds(spark, width, k, block):
    rows, bad = odd_vectors(np.random.default_rng(width), 150, width)
    short = [(3000, [1.0] * (width - 1), 1), (3001, [], 1)]
    found, centroids = clustered(table(spark, rows + bad + short), ["vec_id"], F.expr(ORDER), width=width, k=k, block_columns=block)
    ranked = sorted(rows, key=lambda r: (by_hash(r[0]), list(map(float, r[1]))))
    x = [whole(v, 64, width) for _, v, _ in ranked]
    c, near, d = rounds(x, x[:k], 3)
    assert centroids == c
    assert clusters_of(found) == sorted((str(r[0]), n, e) for r, n, e in zip(ranked, near, d, strict=True))


def test_lloyd_in_small_chunks_and_many_partitions(spark, monkeypatch):
    rows, _ = odd_vectors(np.random.default_rng(2), 120, 8)
    wanted = clusters_of(clustered(table(spark, rows), ["vec_id"], F.expr(ORDER), width=8, k=4, block_columns=3)[0])
    monkeypatch.setattr("gritmill.llm.slices.CHUNK_ROWS", 7)
    again, _ = clustered(table(spark, rows).repartition(5), ["vec_id"], F.expr(ORDER), width=8, k=4, block_columns=3)
    assert clusters_of(again) == wanted


def test_slices_never_move_and_empty_centroids_stay(spark):
    x = table(spark, [(i, [float(i % 4), 0.0, 1.0, 2.0], 0) for i in range(40)])
    vectors = finite_vectors(x, ["vec_id"], "embedding", F.col("vec_id"), 4)
    slices, _ = sliced(vectors, 4, 2, 1, "s")
    held = BucketedSlices(slices)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        far = [np.array([[0, 0], [900, 0]]), np.array([[0, 0], [900, 0]])]
        labels = labelled(held.rows, far)
        new = updated(held.rows, labels, far)
        blocks = labels.select("chunk", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("block"))
        plan = held.rows.join(blocks, ["chunk", "block"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(chunk") == 2  # the partial distances and the labels, not the slices
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        held.drop()
    assert [c[1].tolist() for c in new] == [[900, 0], [900, 0]] and new[0][0].tolist() == [1, 0]


def test_nothing_to_cluster(spark):
    empty = table(spark, [(1, None, 0), (2, [1.0], 0)])
    found, centroids = clustered(empty, ["vec_id"], F.expr(ORDER))
    assert found.collect() == [] and centroids == [] and found.columns == ["row", "cluster", "distance"]


def test_more_columns_and_other_types(spark):
    rows, _ = odd_vectors(np.random.default_rng(4), 30, 4)
    df = clashing(table(spark, rows)).withColumns({c: F.lit(5) for c in ("chunk", "block", "n", "kind", "cells", "turn", "v", "cluster")})
    df = df.withColumn("embedding", F.col("embedding").cast("array<float>"))
    found, _ = clustered(df, ["vec_id", "turn", "a b"], F.expr(ORDER), width=4, k=3)
    assert found.count() == len(rows) and {r["row"]["turn"] for r in found.collect()} == {5}
    coded, _ = codes.vector_codes(df, ["vec_id", "cluster"], F.col("vec_id"), parts=2, entries=3)
    assert coded.count() == len(rows) and {r["row"]["cluster"] for r in coded.collect()} == {5}


def test_numbers_that_outgrow_a_long_are_refused(spark):
    large = most_cell(64) / 64 * 0.99
    fine = table(spark, [(i, [large * (-1) ** i] * 64, 0) for i in range(3)])
    found, _ = clustered(fine, ["vec_id"], F.expr(ORDER), k=1)
    x = [int(np.floor(large * 64 * (-1) ** i)) for i in range(3)]
    _, _, d = rounds([[v] * 64 for v in x], [[x[min(range(3), key=by_hash)]] * 64], 3)
    assert sorted(r["distance"] for r in found.collect()) == sorted(d)
    with pytest.raises(Exception, match="beyond 64 bits"):
        clustered(table(spark, [(1, [1e300] * 64, 0)]), ["vec_id"], F.expr(ORDER))


def plain_codes(rows, width, parts, entries, n=6):
    ranked = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, list(map(float, r[1]))))
    x = [whole(v, 4096, width) for _, v, _ in ranked]
    w, books, code, error = width // parts, [], [""] * len(x), [0] * len(x)
    for p in range(parts):
        part = [r[p * w : (p + 1) * w] for r in x]
        c, near, d = rounds(part, part[:entries], n)
        books.append(c)
        code = [a + f"{b:02x}" for a, b in zip(code, near, strict=True)]
        error = [a + b for a, b in zip(error, d, strict=True)]
    return sorted((str(r[0]), c, e) for r, c, e in zip(ranked, code, error, strict=True)), books


def codes_of(found):
    return sorted((str(r["row"]["vec_id"]), r["code"], r["error"]) for r in found.collect())


@pytest.mark.parametrize("width, parts, entries", [(64, 8, 16), (8, 2, 5), (6, 3, 1), (4, 4, 2)])
def test_codes_agree_with_plain_rounds(spark, width, parts, entries):
    rows, bad = odd_vectors(np.random.default_rng(width + entries), 150, width)
    found, books = codes.vector_codes(table(spark, rows + bad), ["vec_id", "label"], F.col("vec_id"), parts=parts, entries=entries)
    wanted, wanted_books = plain_codes(rows, width, parts, entries)
    assert books == wanted_books and codes_of(found) == wanted


def test_codes_of_clustered_vectors_with_many_ties(spark, monkeypatch):
    monkeypatch.setattr("gritmill.llm.slices.CHUNK_ROWS", 64)
    rng = np.random.default_rng(9)
    centres = rng.integers(-2, 3, size=(12, 8)) / 4
    rows = [(i, centres[rng.integers(12)] + rng.integers(-1, 2, size=8) / 4096, 0) for i in range(500)]
    found, books = codes.vector_codes(table(spark, rows).repartition(3), ["vec_id"], F.col("vec_id"), parts=4, entries=16)
    wanted, wanted_books = plain_codes(rows, 8, 4, 16)
    assert books == wanted_books and codes_of(found) == wanted


def test_unequal_lengths_are_filled_up(spark):
    rows = [(1, [0.1, 0.2, 0.3], 0), (2, [0.5], 0), (3, [], 0), (4, [0.1] * 5, 0)]
    found, books = codes.vector_codes(table(spark, rows), ["vec_id"], F.col("vec_id"), parts=4, entries=2, rounds=1)
    wanted, wanted_books = plain_codes(rows, 8, 4, 2, 1)
    assert books == wanted_books and codes_of(found) == wanted
    empty, none = codes.vector_codes(table(spark, [(1, [], 0), (2, [], 0)]), ["vec_id"], F.col("vec_id"))
    assert [(r["code"], r["error"]) for r in empty.collect()] == [("00" * 8, 0)] * 2 and none == [[[], []]] * 8
    nothing, none = codes.vector_codes(table(spark, [(1, None, 0)]), ["vec_id"], F.col("vec_id"))
    assert nothing.collect() == [] and none == [] and nothing.columns == ["row", "code", "error"]


def test_bounds_hold_and_save_distances():
    """Every bound is a true one after each move, whatever ``b`` does meanwhile, and near entries that stay put need no distance."""
    rng = np.random.default_rng(0)
    x = rng.integers(-500, 500, size=(400, 4))
    entries = rng.integers(-500, 500, size=(16, 4))
    near, bounds = codes._searched(x, entries, 4)
    for b in (4, 6, 3, 7, 7, 2):
        new = entries + rng.integers(-30, 30, size=entries.shape)
        moved = np.nextafter(np.sqrt(((new - entries) ** 2).sum(1).astype(float)), np.inf)
        entries = new
        near, bounds, needs = codes._moved_on(x, near, bounds, entries, moved, b)
        d = ((x[:, None] - entries) ** 2).sum(2)
        assert (near[:, 0] == d.argmin(1)).all() and needs.sum() == len(x) and near.shape[1] == b + 1
        root = np.sqrt(d.astype(float))
        own = root[np.arange(len(x)), near[:, 0]]
        assert (bounds[:, 0] >= own).all()
        for i in range(b + 1):  # the bound of a place holds for the entries there, beyond, and outside
            before = np.array([[e in row[: i + 1] for e in range(16)] for row in near])
            rest = np.where(before, np.inf, root).min(1)
            assert (bounds[:, i + 1] <= rest).all()
    _, _, needs = codes._moved_on(x, near, bounds, entries, np.zeros(16), 2)
    assert needs[0] > 300


def test_places_adapt():
    assert codes.adapted(np.array([90, 10, 0, 0, 0, 0]), 4, 32) == 4  # no fewer than an eighth of the entries
    assert codes.adapted(np.array([900, 60, 30, 10, 0, 0]), 4, 16) == 2
    assert codes.adapted(np.array([10, 0, 0, 0, 0, 90]), 4, 16) == 6 and codes.adapted(np.array([0] * 8 + [9]), 7, 16) == 7
    assert codes.adapted(np.zeros(6, int), 4, 16) == 4
