from __future__ import annotations

import hashlib
import random

import pytest

from gritmill.llm import leaks
from llm_cases import ALNUM, DOCS, clashing, docs, lower, odd_rows, prose, same


def words(text):
    return ALNUM.findall(lower(text))


def brute(rows, items):
    out = []
    cut = [(i, words(t)) for i, t in items]
    wins = [(i, w[k : k + 10]) for i, w in cut if w for k in range(max(1, len(w) - 9))]
    for key, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for item, win in wins:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    hit.update(range(k, k + len(win)))
                    found.add(item)
        ids = sorted(str(i) for i in found if i is not None)
        out.append((key, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def made(rng):
    items = [(i, prose(rng, rng.randrange(3, 25))) for i in range(12)] + [(50, None), (51, "..."), (52, "x"), (None, prose(rng, 14)), (2, "again the same id with other words here and there")]
    rows = odd_rows(rng)
    for i in range(60):
        text = prose(rng, rng.randrange(40))
        item = rng.choice(items)[1] or ""
        cut = item.split()[rng.randrange(3) :]
        rows.append((100 + i, text + " " + rng.choice([" ", ", ", "-"]).join(cut).upper() + " " + prose(rng, 5)))
    return rows, items


@pytest.mark.parametrize("pieces", [200_000, 20])
def test_agrees_with_all_windows(spark, monkeypatch, pieces):
    monkeypatch.setattr(leaks, "MAX_BROADCAST", pieces)
    rows, items = made(random.Random(11))
    found = leaks.contamination(clashing(docs(spark, rows)), spark.createDataFrame(items, "item_id long, text string"))
    same(map(tuple, found.collect()), brute(rows, items))


def test_removal(spark):
    rows, items = made(random.Random(12))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = clashing(docs(spark, rows))
    clean = leaks.decontaminated(table, benchmark)
    dirty = [r[5] for r in brute(rows, items)]
    assert clean.columns == table.columns
    same([(r["doc_id"], r["text"]) for r in clean.collect()], [r[:2] for r, d in zip(rows, dirty) if not d])
    cut = leaks.decontaminated(table, benchmark, remove="spans").collect()
    assert len(cut) == len(rows)
    untouched = [r[:2] for r, d in zip(rows, dirty) if not d]
    assert all(repr(u) in set(map(repr, [(r["doc_id"], r["text"]) for r in cut])) for u in untouched)
    left = {(r["doc_id"]): len(words(r["text"])) for r in cut if (r["doc_id"] or 0) >= 100}
    assert left == {k: n - hit for k, n, hit, *_ in brute(rows, items) if (k or 0) >= 100}
    with pytest.raises(ValueError):
        leaks.decontaminated(table, benchmark, remove="all")


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], DOCS), docs(spark, [(1, "a b")])
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert leaks.contamination(none, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    assert [tuple(r)[1:4] for r in leaks.contamination(some, no_items).collect()] == [(2, 0, 0)]
    assert leaks.decontaminated(some, no_items).count() == 1
