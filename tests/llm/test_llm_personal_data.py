from __future__ import annotations

import hashlib
import random
import re

import pytest

from gritmill.llm import personal_data as pd_
from llm_cases import DOCS, clashing, docs, odd_rows, same

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def valid(kind, v):
    digits = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in v.split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


CARD = "4111111111111111"
TEXTS = [
    "Mail a.b@c.example.com or x@y now, \U0001f600 a@b.c%d@e.f and q@w.e.", "ip 1.2.3.4 and 256.1.1.1 1.2.3.4.5.6.7.8 00012.1.1.1 999999999999999999999999.1.1.1 é 9.9.9.9",
    f"card {CARD} 4111-1111-1111-1111 4111111111111112 {CARD}0000 é{CARD}", "call +1 (017) 555-7713 or +12 34 or +1234567890123456 +49 30 1234567.",
    f"both {CARD} {CARD} here", "+1 (826) 555-4081 190.137.22.1", "me [at] site [dot] com and (212) 555-0100", "fe80:0:0:0:1:2:3:4", "@@@ ++ .. 1.1 -@-.-",
]


def test_strict_spans_agree_with_patterns_and_stay(spark):
    rng = random.Random(1)
    signs = ["1", "23", "456", ".", "@", "+", "-", " ", "(", ")", "a", "é", "\U0001f600", CARD, "x@y.zz", "+1 (555) 555-5555"]
    rows = odd_rows(rng) + list(enumerate(TEXTS, 100)) + [(200 + i, "".join(rng.choice(signs) for _ in range(rng.randrange(25)))) for i in range(400)]
    rows.append((9000, " ".join(["1.2.3.4", CARD, "a@b.cd"] * 400)))
    found = pd_.personal_data(clashing(docs(spark, rows))).collect()
    wanted = []
    for key, text in rows:
        spans = base_spans(text)
        wanted.append((key, *(sum(s[0] == k for s in spans) for k in BASE), hashlib.sha256(listed(spans).encode()).hexdigest()))
    same([tuple(r)[:6] for r in found], wanted)
    texts = dict(rows)
    for r in found:
        if r["doc_id"] is not None:
            every = [x for x in r["spans"].split(",") if x]
            assert set(listed(base_spans(texts[r["doc_id"]])).split(",")) - {""} <= set(every)
            order = [(list(BASE).index(k), int(a)) for k, a, _ in (x.split(":") for x in every)]
            assert order == sorted(order) and all(int(b) <= len(texts[r["doc_id"]]) for _, _, b in (x.split(":") for x in every))


def test_numbers_side_by_side_are_added(spark):
    rows = [(i, f"some words before {CARD}. And then {'more ' * i} 1234567812345678.") for i in range(40)] + [(100, f"both {CARD} {CARD} here")]
    found = {r["doc_id"]: r for r in pd_.personal_data(docs(spark, rows)).collect()}
    assert found[100]["n_card"] == 0 and found[100]["spans"] == "card:5:21,card:22:38"
    assert all(len(found[i]["spans"].split(",")) == 1 for i in range(40))


def test_expectation_maximisation_finds_the_reliable_labelers():
    rng = random.Random(2)
    patterns: dict[tuple[int, ...], int] = {}
    real = {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = tuple((1 if (rng.random() < right) == truth else -1) if rng.random() < 0.8 else 0 for right in (0.95, 0.9, 0.85, 0.8, 0.5, 0.55))
        patterns[votes] = patterns.get(votes, 0) + 1
        real[votes] = real.get(votes, 0) + truth
    found = pd_.reliabilities(list(patterns.items()))
    right = sum(real[v] if found[v] > 0.5 else n - real[v] for v, n in patterns.items())
    assert right / 4000 > 0.9


def test_redaction(spark):
    rows = odd_rows(random.Random(3)) + [(100, f"\U0001f600 write a@b.com, card {CARD}!"), (101, "nothing here"), (102, "+1 212.212.212.212 x")]
    table = clashing(docs(spark, rows))
    found = pd_.redacted(table)
    assert found.columns == table.columns
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert texts[100] == "\U0001f600 write [EMAIL], card [CARD]!" and texts[101] == "nothing here" and texts[1] is None
    assert texts[102] == "[PHONE] x"
    assert all(texts[k] == t for k, t in rows if not base_spans(t) and k is not None and k < 100)


def test_empty_table(spark):
    assert pd_.personal_data(spark.createDataFrame([], DOCS)).count() == 0 and pd_.redacted(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("sign", ["a", "1", "1.", "a@", "+1", "1 "])
def test_long_runs_take_no_more_than_their_length(spark, sign):
    import time

    start = time.time()
    pd_.personal_data(docs(spark, [(1, sign * 60_000)])).collect()
    assert time.time() - start < 60


def test_a_text_of_many_spans(spark):
    """A contact list: the same spans as the patterns give, with context from the right places, in a time that follows its length."""
    import time

    lines = [f"é{i} user{i}@mail{i % 97}.com, +1 555 {100 + i % 900} {1000 + i % 9000} \U0001f600" if i % 3 == 0 else f"u{i}@x.org;10.0.{i % 256}.1" for i in range(12_000)]
    text = "\n".join(lines)
    took = {}
    for n in (3_000, 12_000):
        part = "\n".join(lines[:n])
        start = time.time()
        (r,) = pd_.personal_data(docs(spark, [(1, part)])).collect()
        took[n] = time.time() - start
    strict = listed(base_spans(text)).split(",")
    assert set(strict) <= set(r["spans"].split(",")) and r["n_email"] == 12_000 and len(strict) > 20_000
    assert took[12_000] < 90
    (r,) = pd_.redacted(docs(spark, [(1, text)])).collect()
    at, wanted = 0, []
    spans = sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in pd_.personal_data(docs(spark, [(1, text)])).first()["spans"].split(",")))
    for a, b, k in spans:
        if a >= at:
            wanted += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    assert r["text"] == "".join(wanted) + text[at:]
