from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from gritmill.llm import languages
from llm_cases import DOCS, clashing, docs, odd_rows


def test_forward_backward_agrees_with_all_paths():
    rng = np.random.default_rng(1)
    scores, moves, first = rng.normal(size=(9, 3)), rng.normal(size=(3, 3)), np.array([0, 4, 4, 9])
    found = languages.forward_backward(scores, first, moves)
    inner = np.setdiff1d(np.arange(1, 9), first)
    expected = np.zeros((3, 3))
    for a, b in ((0, 4), (4, 9)):
        total, by_word = 0.0, np.zeros((b - a, 3))
        pairs = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=b - a):
            weight = np.exp(sum(scores[a + i, k] for i, k in enumerate(path)) + sum(moves[j, k] for j, k in zip(path, path[1:])))
            total += weight
            for i, k in enumerate(path):
                by_word[i, k] += weight
            for j, k in zip(path, path[1:]):
                pairs[j, k] += weight
        assert found[a:b] == pytest.approx(by_word / total)
        expected += pairs / total
    assert languages.expected_moves(scores, np.array([0, 4, 9]), moves, inner) == pytest.approx(expected)


@pytest.mark.parametrize("chunk", [1, 3, 32])
def test_chunks_do_not_matter(monkeypatch, chunk):
    rng = np.random.default_rng(2)
    scores, moves, first = rng.normal(size=(500, 4)) * 5, rng.normal(size=(4, 4)), np.array([0, 1, 1, 40, 250, 250, 251, 500])
    whole = languages.forward_backward(scores, first, moves)
    monkeypatch.setattr(languages, "CHUNK", chunk)
    assert languages.forward_backward(scores, first, moves) == pytest.approx(whole)
    assert whole.sum(axis=1) == pytest.approx(1)


def sentence(rng, lang, n):
    parts = {"en": ["the", "th", "ing", "er", "wh", "ou"], "de": ["ei", "sch", "ung", "ver", "ö", "pf"], "fr": ["eau", "é", "oi", "que", "ç", "ais"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_learns_texts_and_words(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, lang, 30), lang) for i, lang in enumerate(["en", "de", "fr"] * 40)]
    model = languages.train(docs(spark, rows))
    assert model.languages == ["de", "en", "fr"]
    fresh = [(1000 + i, sentence(rng, lang, 20), lang) for i, lang in enumerate(["en", "de", "fr"] * 10)]
    found = languages.identified(docs(spark, fresh), model, ["lang"]).collect()
    assert all(r["lang_pred"] == r["row"]["lang"] and 0.5 < r["score"] <= 1 for r in found)
    import pyarrow as pa

    words = languages.words_of(pa.array([sentence(rng, "en", 12) + " " + sentence(rng, "fr", 12)]), languages.LETTERS)
    best = model.words(words).argmax(axis=1)
    assert (best[:10] == 1).mean() > 0.8 and (best[-10:] == 2).mean() > 0.8
    switch = np.exp(model.transitions - model.transitions.max())
    assert (np.diag(switch) > 1.5 * (switch.sum(axis=1) - np.diag(switch)) / 2).all()


def test_odd_rows(spark):
    rng = random.Random(5)
    model = languages.train(docs(spark, [(i, sentence(rng, lang, 20), lang) for i, lang in enumerate(["en", "de"] * 20)]))
    rows = odd_rows(rng) + [(50, "…—“”"), (51, "123 456"), (52, "… é"), (53, "Ж")]
    found = languages.identified(clashing(docs(spark, rows)), model, ["doc_id", "row"]).collect()
    assert len(found) == len(rows)
    by = {r["row"]["doc_id"]: r for r in found}
    for key in (1, 2, 3, 10, 50, 51):
        assert (by[key]["lang_pred"], by[key]["score"]) == ("und", 0.0)
    assert all(by[k]["lang_pred"] in ("en", "de") and 0 <= by[k]["score"] <= 1 for k in (4, 5, 8, 11, 52, 53))


def test_spans_label_the_words_of_code_switched_text(spark):
    import re

    import pyarrow as pa

    rng = random.Random(6)
    model = languages.train(docs(spark, [(i, sentence(rng, lang, 30), lang) for i, lang in enumerate(["en", "de", "fr"] * 40)]))
    mixed = [(i, " \U0001f600 12, ".join(sentence(rng, rng.choice(["en", "de", "fr"]), rng.randrange(8, 20)) for _ in range(rng.randrange(1, 6)))) for i in range(60)]
    rows = mixed + [(100, None), (101, "12 …"), (102, ""), (103, "thing"), (104, "\n… é… ing")]
    found = {r["row"]["doc_id"]: r for r in languages.identified(docs(spark, rows), model, ["doc_id"]).collect()}
    right = total = 0
    for i, text in rows:
        text = text or ""
        places = [m.span() for m in re.finditer("[A-Za-z\x80-\U0010ffff]+", text)]
        best = model.words(languages.words_of(pa.array([text]), languages.LETTERS)).argmax(axis=1).tolist() if places else []
        assert len(best) == len(places)
        wanted = []
        for (a, b), k in zip(places, best, strict=True):
            if wanted and wanted[-1][2] == model.languages[k]:
                wanted[-1] = (wanted[-1][0], b, model.languages[k])
            else:
                wanted.append((a, b, model.languages[k]))
        assert [tuple(x) for x in found[i]["spans"]] == (wanted if found[i]["lang_pred"] != "und" else [])
    pairs = [(*rng.sample(["en", "de", "fr"], 2), i) for i in range(30)]
    halves = {i: (sentence(rng, a, 25), sentence(rng, b, 25)) for a, b, i in pairs}
    found = {r["row"]["doc_id"]: r["spans"] for r in languages.identified(docs(spark, [(i, " ".join(h)) for i, h in halves.items()]), model, ["doc_id"]).collect()}
    for a, b, i in pairs:
        cut, end = len(halves[i][0]), len(" ".join(halves[i]))
        for lang, (x, y) in ((a, (0, cut)), (b, (cut + 1, end))):
            right += sum(max(0, min(e, y) - max(s, x)) for s, e, k in map(tuple, found[i]) if k == lang)
            total += y - x
    assert right > 0.85 * total


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], DOCS)
    assert languages.train(none) is None
    assert languages.train(docs(spark, [(1, "abc", None), (None, "abc", "en")])) is None
    found = languages.identified(docs(spark, [(1, "abc")]), None, ["doc_id"]).collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [("und", 0.0)]
    assert languages.identified(none, None, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        languages.train(docs(spark, [(i, "abc", f"l{i}") for i in range(70)]))


def test_a_seen_text_of_no_words_does_not_stop_training(spark):
    model = languages.train(docs(spark, [(1, "the then", "en"), (2, "", "en"), (3, "...", "de"), (4, "schein", "de")]))
    assert model.languages == ["de", "en"]


def test_held_out_accuracy(spark):
    from gritmill.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    found = QUERIES["op1_languages"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r["lang"] == r["lang_pred"] for r in found if r["held_out"]]
    assert len(held) > 200 and sum(held) >= 0.97 * len(held)
