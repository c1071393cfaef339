"""Benchmark decontamination: broadcast hash set of benchmark n-grams, scanned over every window of every document.

Words are runs of ASCII letters, digits and all beyond ASCII, A-Z in lower case. A benchmark item of at least ``WINDOW``
words gives one window for each run of that many words, a shorter one gives a single window of all its words. Windows
are looked up by a rolling hash, and every hit is verified word by word.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.llm.shared import with_fields, written
from gritmill.llm.words import ALNUM, sliced, windows, words_of

WINDOW = 10
MAX_BROADCAST = 200_000  # windows in one broadcast set; more of them are scanned set by set
_BITS = 22


def _item_windows(size: int):
    def cut(batches):
        for batch in sliced(batches, "text"):
            words = words_of(batch.column("text"), ALNUM)
            item, text = [], []
            for key, a, b in zip(batch.column("item").to_pylist(), words.first[:-1].tolist(), words.first[1:].tolist()):
                for i in range(a, max(b - size, a) + 1 if b > a else a):
                    item.append(key)
                    text.append(words.text(i, min(i + size, b)))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(text, pa.string())], ["item", "words"])

    return cut


class WindowSet:
    """Windows by the hash of their words, kept apart by length; ``items`` of each window."""

    def __init__(self, rows: list[tuple[str | None, str]]):
        found: dict[int, dict[int, dict[str, list]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
        for item, text in rows:
            words = words_of(pa.array([text]), ALNUM)
            n = int(words.first[-1])
            found[n][int(windows(words.hashes(), n)[0])][text].append(item)
        self.by_size = {}
        for n, windows_of in found.items():
            keys = np.array(sorted(windows_of), np.uint64)
            marks = np.zeros(1 << _BITS, bool)
            marks[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.by_size[n] = (keys, marks, {k: dict(v) for k, v in windows_of.items()})

    def hits(self, words, hashes: np.ndarray):
        """``(text, first word, words, items)`` of each occurrence of a window inside one text."""
        for n, (keys, marks, known) in self.by_size.items():
            runs = windows(hashes, n)
            at = np.flatnonzero(marks[(runs >> np.uint64(64 - _BITS)).astype(np.int64)])
            place = np.minimum(np.searchsorted(keys, runs[at]), len(keys) - 1)
            at = at[keys[place] == runs[at]]
            text = np.searchsorted(words.first, at, "right") - 1
            inside = at + n <= words.first[text + 1]
            for i, doc in zip(at[inside].tolist(), text[inside].tolist()):
                if items := known[int(runs[i])].get(words.text(i, i + n)):
                    yield doc, i, n, items


_HITS = "array<struct<from:int,until:int>>"
_SPANS = pa.list_(pa.struct([("from", pa.int32()), ("until", pa.int32())]))


def _scan(shared):
    def scan(batches):
        held: WindowSet = shared.value
        for batch in sliced(batches, "text"):
            words = words_of(batch.column("text"), ALNUM)
            first = words.first
            covered = np.zeros(int(first[-1]) + 1, np.int64)
            items = [set(x) for x in batch.column("items").to_pylist()]
            for doc, spans in enumerate(batch.column("hits").to_pylist()):
                for span in spans:
                    covered[first[doc] + span["from"]] += 1
                    covered[first[doc] + span["until"]] -= 1
            for doc, i, n, keys in held.hits(words, words.hashes()):
                covered[i] += 1
                covered[i + n] -= 1
                items[doc].update(k for k in keys if k is not None)
            hit = np.cumsum(covered)[:-1] > 0
            spans = []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                if not hit[a:b].any():
                    spans.append([])
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[a:b].astype(np.int8), [0]))))
                spans.append([{"from": x, "until": y} for x, y in edge.reshape(-1, 2).tolist()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("text"),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(spans, _SPANS),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ],
                ["row", "text", "n_words", "hits", "items"],
            )

    return scan


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``row`` (a struct of the columns ``keep``), ``text``, ``n_words``, ``hits`` and ``items`` of every document.

    ``hits`` are the runs of words inside any window, merged; ``items`` the ids, as text, of the items whose windows occur.
    Null or empty texts have no words; items without words give no window; items without an id hit, but aren't listed.
    The set is broadcast in pieces of ``MAX_BROADCAST`` windows at most, one scan for each piece.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).cast("string").alias("text"))
    every = written(items.mapInArrow(_item_windows(WINDOW), "item string, words string").distinct(), "windows")
    pieces = max(1, math.ceil(every.count() / MAX_BROADCAST))
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    none = F.array()
    found = docs.select(kept, F.col(text_col).cast("string").alias("text"), none.cast(_HITS).alias("hits"), none.cast("array<string>").alias("items"))
    schema = with_fields(found.select("row", "text"), f"n_words long, hits {_HITS}, items array<string>")
    for piece in range(pieces):
        rows = every.filter(F.pmod(F.xxhash64("words"), F.lit(pieces)) == piece).collect()  # a bounded piece
        shared = docs.sparkSession.sparkContext.broadcast(WindowSet([(r["item"], r["words"]) for r in rows]))
        found = found.select("row", "text", "hits", "items").mapInArrow(_scan(shared), schema)
        if piece < pieces - 1:
            found = written(found, "scanned")
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``. Repeated rows are judged each by itself."""
    n_hit = F.expr("aggregate(hits, 0L, (n, x) -> n + x.until - x.from)")
    return scan(docs, benchmark, [id_col], text_col).select(
        F.col(f"row.`{id_col}`").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _without_spans(batches):
    for batch in sliced(batches, "text"):
        words = words_of(batch.column("text"), ALNUM)
        texts = []
        for text, spans, a, begin in zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist(), words.first.tolist(), words.begin.tolist()):
            if spans:
                raw, parts, upto = text.encode(), [], 0
                for span in spans:
                    i, j = a + span["from"], a + span["until"] - 1
                    parts.append(raw[upto : int(words.start[i]) - begin])
                    upto = int(words.start[j] + words.length[j]) - begin
                text = (b"".join(parts) + raw[upto:]).decode()
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", remove: str = "documents") -> DataFrame:
    """The documents without benchmark passages, all columns kept.

    ``remove="documents"`` drops a document with any hit; ``"spans"`` cuts the hit words, and what stands between them, out
    of its text and leaves every other text as it is.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove}")
    rest = docs.columns
    found = scan(docs, benchmark, rest, text_col)
    if remove == "documents":
        return found.filter(F.size("hits") == 0).select(*[F.col(f"row.`{c}`").alias(c) for c in rest])
    cut = found.select("row", "text", "hits").mapInArrow(_without_spans, found.select("row", "text").schema)
    return cut.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in rest])
