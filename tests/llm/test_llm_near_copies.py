from __future__ import annotations

import random

import numpy as np
import pytest

from gritmill.llm import near_copies as nc
from gritmill.llm.components import components
from llm_cases import DOCS, WORD, clashing, docs, lower, odd_rows, prose, same


def shingles(text):
    words = WORD.findall(lower(text))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    rows = list(rows)
    sets, top = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                top[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(s), least.get(find(i)), r[0] is None or least[find(i)] == r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


def groups(rng, n, size, words=60):
    rows = []
    for g in range(n):
        base = prose(rng, words).split()
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randrange(99))
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    return rows


def test_agrees_with_all_pairs(spark):
    rng = random.Random(5)
    line = prose(rng, 12)
    rows = groups(rng, 15, 6) + [(1000 + i, line + " " + prose(rng, 15)) for i in range(40)] + [(2000 + i, prose(rng, rng.randrange(9))) for i in range(30)]
    same(map(tuple, nc.near_copies(docs(spark, rows)).collect()), brute(rows))


@pytest.mark.parametrize("small", [2, 5])
def test_large_nodes_branch_or_go_by_blocks(spark, monkeypatch, small):
    monkeypatch.setattr(nc, "SMALL", small)
    rng = random.Random(6)
    line = prose(rng, 20)
    rows = groups(rng, 2, 25, 40) + [(1000 + i, line + " " + prose(rng, 20)) for i in range(40)]
    same(map(tuple, nc.near_copies(docs(spark, rows)).collect()), brute(rows))


def test_heavy_nodes_go_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(nc, "SMALL_WEIGHT", 150)
    rows = groups(random.Random(7), 2, 12, 40)
    same(map(tuple, nc.near_copies(docs(spark, rows)).collect()), brute(rows))


def test_odd_rows_and_more_columns(spark):
    rows = odd_rows(random.Random(8))
    same(map(tuple, nc.near_copies(clashing(docs(spark, rows))).collect()), brute(rows))


def test_empty_table(spark):
    found = nc.near_copies(spark.createDataFrame([], DOCS))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"] and found.count() == 0


def test_exactly_three_quarters_links(spark):
    # 7 shingles each, 6 shared: 6 of 8
    a = "a b c d e f g h i j k".split()
    b, c = a[:-1] + ["z"], a[:-2] + ["y", "z"]
    found = {r["doc_id"]: r["component_id"] for r in nc.near_copies(docs(spark, [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))])).collect()}
    assert found[2] == 1 and nc.similar(np.arange(3), np.arange(4), 75) and not nc.similar(np.arange(3), np.arange(1, 5), 75)
    assert brute([(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))])[2][2] == found[3]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5001), (5001, 5000), (7, 7)]
    rng.shuffle(links)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1050), 1000), 5000: 5000, 5001: 5000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
