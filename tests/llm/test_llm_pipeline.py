from __future__ import annotations

import random

import pytest

import corpus_pipeline as cp
from llm_cases import clashing, docs, odd_rows, prose
from test_llm_graded import rated
from test_llm_leaks import brute as leaks_of
from test_llm_mixing import brute as targets_of
from test_llm_near_copies import brute as groups_of
from test_llm_personal_data import base_spans


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small set of given tables: rated texts, near copies, leaks, personal data and odd rows."""
    rng = random.Random(1)
    sf = str(tmp_path_factory.mktemp("tables"))
    items = [(i, prose(rng, 15)) for i in range(5)]
    rows, grades = rated(rng, 300)
    rows = [(5000 + i, t, "en", f"s{i % 5}") for i, t in rows]
    for i in range(60):
        text = rng.choice(rows[:300])[1]
        rows.append((1000 + i, text + " end" * (i % 3), "en", "s1"))
        rows.append((2000 + i, f"{prose(rng, 20)} {items[i % 5][1]} {prose(rng, 9)}", "de", "s2"))
        rows.append((3000 + i, f"{prose(rng, 20)} x{i}@y.com {prose(rng, 9)}", "de", None))
    rows += odd_rows(rng)
    clashing(docs(spark, rows)).coalesce(2).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(5000 + i, int(g != 0 or i % 2), int(g == 0 or (g == 1 and i % 2))) for i, g in grades], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, items


def test_each_stage_against_its_plain_version(spark, folder):
    sf, items = folder
    before = spark.read.parquet(f"{sf}/documents.parquet")
    names = before.columns
    for name, stage in cp.STAGES:
        after = cp.written(stage(spark, before, sf), name)
        rows, left = [(r["doc_id"], r["text"]) for r in before.collect()], [(r["doc_id"], r["text"]) for r in after.collect()]
        if name != "mixing":
            assert after.columns == names
        if name == "quality":
            assert set(left) <= set(rows) and not any(not (t or "").split() for _, t in left)
        elif name == "near_copies":
            kept = {(r[0], r[1]) for r, g in zip(rows, groups_of(rows)) if g[3]}
            assert sorted(map(repr, left)) == sorted(map(repr, kept))
        elif name == "leaks":
            assert sorted(map(repr, left)) == sorted(repr(r) for r, x in zip(rows, leaks_of(rows, items)) if not x[5])
            assert len(left) < len(rows)
        elif name == "personal_data":
            old = dict(rows)
            assert len(left) == len(rows) and not any(base_spans(t) for _, t in left)
            assert all(t == old[k] for k, t in left if not base_spans(old[k]))
            assert all(r["n_chars"] == len(r["text"] or "") for r in after.collect())
        else:
            sizes, taken = {}, {}
            for r in before.collect():
                sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").split())
            for r in after.collect():
                taken[r["source"]] = taken.get(r["source"], 0) + len((r["text"] or "").split())
                assert 1 <= r["copy_"] <= 2
            assert all(abs(taken[s] - t) <= 0.05 * t + 20 for s, t in targets_of(sizes).items())
        before = after


def test_run_gives_what_the_stages_give(spark, folder):
    sf, _ = folder
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in cp.STAGES:
        docs = cp.written(stage(spark, docs, sf), name)
    found = cp.run(spark, sf)
    # ``copy`` is a column of the documents here, so the number of a copy takes the next name; no column of theirs is changed.
    assert found.columns == [*spark.read.parquet(f"{sf}/documents.parquet").columns, "copy_"]
    assert [tuple(r) for r in found.select("row", "copy", "Before", "_before", "`a.b`").distinct().collect()] == [(0, 9, 10, 11, 12)]
    assert sorted(map(repr, found.select("doc_id", "copy_").collect())) == sorted(map(repr, docs.select("doc_id", "copy_").collect()))


def test_empty_tables(spark, folder, tmp_path):
    sf, _ = folder
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
