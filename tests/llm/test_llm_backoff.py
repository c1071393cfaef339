from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gritmill.llm import backoff
from llm_cases import DOCS, WORD, clashing, docs, lower, odd_rows, prose


class Plain:
    """The same model with dictionaries."""

    def __init__(self, rows, held):
        self.word, self.pair, self.state = Counter(), Counter(), Counter()
        for key, text, *_ in rows:
            if not held(key):
                w = self.tokens(text)
                self.word.update(w)
                self.pair.update(zip(["<s>", *w], w))
                self.state.update(["<s>", *w[:-1]])
        self.n, self.v = sum(self.word.values()), len(self.word)
        classes = [0.0] * (2 * backoff._CLASSES)
        for c in self.state.values():
            classes[math.floor(math.log2(c) * 8)] += 1
            classes[backoff._CLASSES + math.floor(math.log2(c) * 8)] += c
        self.k = backoff.prior_weight(classes, sum(c == 1 for c in self.pair.values())) if self.n else 1.0

    @staticmethod
    def tokens(text):
        return [*WORD.findall(lower(text)), "</s>"]

    def root(self, w):
        return (self.word[w] + 1) / (self.n + self.v + 1)

    def p(self, h, w):
        return (self.pair[h, w] + self.k * self.root(w)) / (self.state[h] + self.k) if self.state[h] else self.root(w)

    def row(self, key, text, held):
        w = self.tokens(text)
        base = sum(math.log10(self.root(x)) for x in w)
        score = sum(math.log10(self.p(h, x)) for h, x in zip(["<s>", *w], w))
        return key, held(key), len(w), sum(self.word[x] > 0 for x in w), self.n, base, score


@pytest.mark.parametrize("block, share", [(2_000_000, 1_000_000), (300, 500)])
def test_agrees_with_dictionaries(spark, monkeypatch, block, share):
    monkeypatch.setattr(backoff, "BLOCK_TOKENS", block)
    monkeypatch.setattr(backoff, "SHARE_TOKENS", share)
    rng = random.Random(13)
    rows = odd_rows(rng) + [(100 + i, prose(rng, rng.randrange(60))) for i in range(80)]
    held = lambda key: key is None or key % 5 == 2
    plain = Plain(rows, held)
    found = backoff.backoff_scores(clashing(docs(spark, rows)).repartition(3), F.col("doc_id") % 5 != 2).collect()
    order = lambda r: (str(r[0]), r[2], round(r[6], 6))
    for a, b in zip(sorted(map(tuple, found), key=order), sorted((plain.row(k, t, held) for k, t, *_ in rows), key=order), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-9)


def test_probabilities_of_a_state_sum_to_one():
    rng = random.Random(14)
    plain = Plain([(i, prose(rng, 40)) for i in range(20)], lambda _: False)
    for h in ["<s>", "nothing", *list(plain.state)[:20]]:
        assert sum(plain.p(h, w) for w in [*plain.word, "never seen"]) == pytest.approx(1)


def test_known_passages_score_better_than_words_alone(spark):
    rng = random.Random(15)
    passage = prose(rng, 80)
    rows = [(i, passage if i % 2 else prose(rng, 80)) for i in range(1, 40)] + [(100, passage)]
    found = {r["doc_id"]: r for r in backoff.backoff_scores(docs(spark, rows), F.col("doc_id") < 100).collect()}
    assert found[100]["score"] > found[100]["base_score"] / 2 and found[100]["held_out"]


def test_nothing_to_learn_from(spark):
    found = backoff.backoff_scores(docs(spark, [(1, "a b")]), F.lit(False)).collect()
    assert [tuple(r) for r in found] == [(1, True, 3, 0, 0, 0.0, 0.0)]
    assert backoff.backoff_scores(spark.createDataFrame([], DOCS), F.lit(True)).count() == 0


def test_small_blocks_among_many_shares(spark, monkeypatch):
    """A block of few words has none in most shares, and still gets the counts of the whole corpus."""
    monkeypatch.setattr(backoff, "BLOCK_TOKENS", 3)
    monkeypatch.setattr(backoff, "SHARE_TOKENS", 1)
    rows = [(i, text) for i, text in enumerate(["a b", "a b c", "", None, "b c a b", "c", "a d", "d d a"])]
    held = lambda key: key == 5
    plain = Plain(rows, held)
    found = backoff.backoff_scores(docs(spark, rows).repartition(2), F.col("doc_id") != 5).collect()
    for a, b in zip(sorted(map(tuple, found)), sorted(plain.row(k, t, held) for k, t in rows), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-9)
