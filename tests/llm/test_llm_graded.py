from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from gritmill.llm import graded
from llm_cases import DOCS, clashing, docs, odd_rows, prose


def rated(rng, n):
    """Texts by grade: 0 shouts and insults, 1 does either, 2 neither."""
    rows, grades = [], []
    for i in range(n):
        shout, insult = rng.random() < 0.25, rng.random() < 0.25
        words = prose(rng, rng.randrange(30, 80)).split()
        for _ in range(4 * insult):
            words[rng.randrange(len(words))] = rng.choice(["rotten", "wicked", "vile"])
        text = " ".join(words)
        rows.append((i, "".join(c.upper() + "!!" if c == "a" else c.upper() for c in text) if shout else text))
        grades.append((i, 2 - shout - insult))
    return rows, grades


@pytest.fixture(scope="module")
def fitted(spark):
    rows, grades = rated(random.Random(1), 500)
    return graded.train(docs(spark, rows), spark.createDataFrame(grades, "doc_id long, grade int"))


def test_grades_of_new_texts(spark, fitted):
    rows, grades = rated(random.Random(2), 300)
    found = graded.graded(docs(spark, rows), fitted, ["doc_id"]).collect()
    want = dict(grades)
    expected = {r["row"]["doc_id"]: r["expected_grade"] for r in found}
    means = [np.mean([expected[i] for i, g in grades if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]
    right = [r["selected"] == (want[r["row"]["doc_id"]] == 2) for r in found]
    assert np.mean(right) > 0.93
    assert all(r["selected"] == (r["tail"] >= 0.5) and 0 <= r["tail"] <= 1 and r["tail"] <= r["expected_grade"] <= 2 for r in found)


def test_thresholds_are_ordered_and_tails_shrink(fitted):
    assert (np.diff(fitted.thresholds) > 0).all()
    tails, _ = fitted.tails(pa.array(["some text of words", "ROTTEN!! VILE!!"]))
    assert (np.diff(tails, axis=1) <= 0).all()


def test_a_text_weighs_the_same_in_any_batch(fitted):
    texts = [t for _, t in odd_rows(random.Random(3))]
    alone = np.concatenate([fitted.tails(pa.array([t], pa.string()))[0] for t in texts])
    assert alone == pytest.approx(fitted.tails(pa.array(texts))[0])


def test_odd_rows(spark, fitted):
    rows = odd_rows(random.Random(4))
    found = graded.graded(clashing(docs(spark, rows)), fitted, ["doc_id", "selected", "row"]).collect()
    assert len(found) == len(rows)
    by = {r["row"]["doc_id"]: r for r in found}
    assert all((by[k]["expected_grade"], by[k]["tail"], by[k]["selected"]) == (0.0, 0.0, False) for k in (1, 2, 3))


def test_odd_ratings(spark):
    rows, grades = rated(random.Random(5), 60)
    odd = grades + [(None, 1), (3, None), (0, 0), (0, 2), (999, 1)]
    assert graded.train(docs(spark, rows), spark.createDataFrame(odd, "doc_id long, grade int")) is not None
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert graded.train(docs(spark, rows), none) is None
    assert all(r["selected"] == bool((r["row"]["text"] or "").split()) for r in graded.graded(docs(spark, rows + [(900, "")]), None, ["text"]).collect())
    assert graded.graded(spark.createDataFrame([], DOCS), None, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        graded.train(docs(spark, rows), spark.createDataFrame([(1, 99)], "doc_id long, grade int"))
    unread = graded.train(docs(spark, [(1, "a")]), spark.createDataFrame([(2, 1)], "doc_id long, grade int"))
    assert graded.graded(docs(spark, [(1, "a")]), unread, ["doc_id"]).count() == 1


def test_selection_on_the_given_ratings(spark):
    from gritmill.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [(r["selected"], labels[r["doc_id"]]) for r in QUERIES["op7_graded"](spark, sf).collect() if r["doc_id"] in labels]
    clean = [s for s, r in found if r["quality"] == 1 and r["toxic"] == 0]
    poor = [s for s, r in found if r["quality"] == 0]
    assert np.mean(clean) > 0.97 and np.mean(poor) < 0.1
