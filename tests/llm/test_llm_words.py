from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from gritmill.llm.words import ALNUM, NOT_SPACE, sliced, windows, words_of
from llm_cases import ALNUM as ALNUM_PATTERN
from llm_cases import WORD, lower, odd_rows, prose


def texts():
    rng = random.Random(3)
    signs = "aZ9 \t\n.é\U0001f600%"
    return [t for _, t in odd_rows(rng)] + ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(200)] + [prose(rng, 30)]


def test_words_are_those_of_the_pattern():
    for table, pattern in ((NOT_SPACE, WORD), (ALNUM, ALNUM_PATTERN)):
        words = words_of(pa.array(texts()), table)
        for i, text in enumerate(texts()):
            a, b = words.first[i], words.first[i + 1]
            assert words.text(a, b).split(" ") == (pattern.findall(lower(text)) or [""])


def test_equal_words_hash_alike_and_others_apart():
    words = words_of(pa.array(texts()))
    hashes, seen = words.hashes(), {}
    for i, h in enumerate(hashes.tolist()):
        assert seen.setdefault(words.text(i, i + 1), h) == h
    assert len(set(seen.values())) == len(seen)


def test_hashes_do_not_depend_on_the_batch():
    some = texts()
    alone = np.concatenate([words_of(pa.array([t], pa.string())).hashes() for t in some])
    assert (alone == words_of(pa.array(some)).hashes()).all()
    part = pa.array(["zzz", *some, "yyy"]).slice(1, len(some))
    assert (alone == words_of(part).hashes()).all()
    shapes = np.concatenate([words_of(pa.array([t], pa.string())).shapes() for t in some])
    assert (shapes == words_of(pa.array(some)).shapes()).all()


def test_windows_tell_order_and_length():
    h = words_of(pa.array(["a b c a b c b a"])).hashes()
    assert windows(h, 3)[0] == windows(h, 3)[3] != windows(h, 3)[1]
    assert windows(h[:2], 2)[0] != windows(h[[1, 0]], 2)[0]
    assert len(windows(h, 9)) == 0


def test_slices_keep_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(texts())], ["text"])
    parts = list(sliced([batch], "text", most=500))
    assert len(parts) > 3 and pa.Table.from_batches(parts).column(0).to_pylist() == texts()


def test_shapes():
    s = words_of(pa.array(["abc Abc ABC xyz a%% b%% 1 22"])).shapes().tolist()
    assert s[0] == s[3] and s[4] == s[5] and s[6] == s[7] and len(set(s)) == 5
