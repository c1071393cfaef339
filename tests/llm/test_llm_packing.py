from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gritmill.llm import packing
from gritmill.llm.shared import written
from llm_cases import clashing, docs, odd_rows, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
END = 2


def ids_of(text):
    return packing._tokenizer(PATH).encode(text or "", add_special_tokens=False).ids + [END]


def pack(df, most=packing.SEQUENCE, keep=("doc_id",), **how):
    cut = written(packing.pieces(df, list(keep), PATH, END, ranks=RANKS, most=most), "pieces")
    return packing.packed(cut, most=most, **how)


def check(rows, found, most):
    """Pieces are cut by the rule and hold the right ids; every sequence is gapless from 0 and not too long."""
    texts, by = defaultdict(list), defaultdict(list)
    for i, text in rows:
        texts[i].append(text)
    for r in found:
        by[r["row"]["doc_id"]].append(r)
    assert set(by) == set(texts)
    for i, mine in by.items():
        wanted = []
        for text in texts[i]:
            ids = ids_of(text)
            first = len(ids) - (max(1, math.ceil(len(ids) / most)) - 1) * most
            cuts = [0, *range(first, len(ids) + 1, most)]
            wanted += [(p, a, b - a, np.asarray(ids[a:b], "<u4").tobytes()) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        assert sorted((r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in mine) == sorted(wanted)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= most
    return len(sequences)


@pytest.mark.parametrize("most", [1024, 37])
def test_pieces_and_sequences(spark, most):
    rng = random.Random(3)
    rows = odd_rows(rng) + [(i, prose(rng, rng.choice([1, 5, 40, 300]))) for i in range(100, 160)]
    found = pack(docs(spark, rows), most).collect()
    n = check(rows, found, most)
    assert n <= 1.1 * math.ceil(sum(r["length"] for r in found) / most) + 1


def test_an_empty_table_has_no_pieces(spark):
    assert pack(docs(spark, []).filter("doc_id < 0")).collect() == []


def test_more_columns_with_names_of_ours(spark):
    rows = [(1, "a b"), (2, None)]
    df = clashing(docs(spark, rows)).withColumns({c: F.lit(7) for c in ("spot", "length", "piece", "run", "ids", "sequence_id")})
    found = pack(df, keep=("doc_id", "spot", "length", "a b")).collect()
    assert check(rows, found, 1024) == 1 and {r["row"]["spot"] for r in found} == {7}


def test_many_copies_are_spread_over_tasks(spark):
    rows = [(1, "one two three")] * 3000 + [(None, None)] * 500
    found = pack(docs(spark, rows), 64, most_open=64, run=64, pieces_of_task=500)
    per_task = found.groupBy((F.col("sequence_id") / (1 << 33)).cast("long")).count().collect()
    assert len(per_task) > 4
    rows_found = found.collect()
    assert check(rows, rows_found, 64) <= 1.05 * math.ceil(sum(r["length"] for r in rows_found) / 64) + 8


def test_both_libraries_give_the_same_ids():
    rng = random.Random(5)
    signs = "aZ09 \t\n.,;'\"-_()<>|äßéñŁЖя–—“”…€  "
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["it's we'll  I'M 12ab\n\n x", "<|endoftext|> a", "", " ", "\n" * 30, "x" * 5000, " " * 5000 + "a", "東京 hello", "\U0001f600", "͸ \x1c a\x85b", "\x00\x7f"]
    wanted = [ids_of(t)[:-1] for t in texts]
    assert [x.tolist() for x in packing.token_ids(texts, PATH, RANKS)] == wanted
    assert sum(map(packing.plain, texts)) > 2500 and not any(packing.plain(t) for t in texts[3001:] if len(t) > 1000 or "<|" in t or ord(max(t, default="a")) > 0x2200)
    assert packing.token_ids(["東京 <|endoftext|>"], PATH)[0].tolist()[-1] == 50256  # a special token's string counts as the token, as the library has it


def test_long_texts_go_in_portions():
    rng = random.Random(11)
    text = " ".join(rng.choice(["word", "12", "it's", "é", "x ", "\n\n", "東京", "<|endoftext|>", "a.b", "\t"]) for _ in range(3000))
    for most in (1, 50, 1000):
        parts = list(packing.portions(text, most))
        assert "".join(parts) == text and (len(parts) > 2 or most == 1000)
        assert [i for p in parts for i in ids_of(p)[:-1]] == ids_of(text)[:-1]
    assert list(packing.portions("x" * 100, 10)) == ["x" * 100] and list(packing.portions("", 10)) == [""]


def test_best_fit_against_a_plain_search():
    rng = random.Random(1)
    for most_open in (1, 3, 20):
        packer, open_bins, count = packing.BestFit(100, most_open), {}, 0
        for _ in range(2000):
            size = rng.randrange(1, 101)
            number, offset = packer.place(size)
            fitting = [f for f in open_bins.values() if f >= size]
            if fitting:
                assert open_bins[number] == min(fitting) and offset == 100 - min(fitting)
            else:
                assert number == count and offset == 0
                count += 1
                if len(open_bins) == most_open:
                    fullest = min(open_bins.values())
                    # Of equally full ones the last that came to that fill closes; any of them is right.
                    gone = {i for i, f in open_bins.items() if f == fullest} - {i for at in packer.open for i in at}
                    assert len(gone) == 1
                    del open_bins[gone.pop()]
                open_bins[number] = 100
            open_bins[number] -= size
            if not open_bins[number]:
                del open_bins[number]
            assert {i for at in packer.open for i in at} == set(open_bins)


def test_nearly_as_few_sequences_as_there_can_be(spark):
    rng = random.Random(8)
    lengths = [min(1023, max(1, int(rng.lognormvariate(6, 0.8)))) for _ in range(20_000)]
    cut = written(spark.createDataFrame(list(enumerate(lengths)), "spot long, length long"), "lengths")
    found = packing.placed(cut)
    assert found.count() == 20_000 and found.select("sequence_id").distinct().count() <= 1.005 * math.ceil(sum(lengths) / 1024)


def test_sequences_hold_their_ids(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 20)) for i in range(30)]
    found = pack(docs(spark, rows), 256)
    whole = {r["sequence_id"]: r for r in packing.sequences(found).collect()}
    for r in found.collect():
        s = whole[r["sequence_id"]]
        assert bytes(s["ids"])[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"]) and r["offset"] in s["offsets"]
    assert sum(len(s["ids"]) for s in whole.values()) == 4 * sum(len(ids_of(t)) for _, t in rows)


def test_registered_query(spark):
    from gritmill.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    found = QUERIES["op13_packed"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"] for r in found} == set(texts)
    for r in found:
        ids = np.asarray(ids_of(texts[r["doc_id"]]), "<u4")[r["start"] : r["start"] + r["length"]]
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
    assert len({r["sequence_id"] for r in found}) <= 1.01 * sum(r["length"] for r in found) / 1024 + 1
