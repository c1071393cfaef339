"""Language of words and texts by a linear-chain conditional random field.

Words are runs of letters. Features of a word are itself (the lexicon) and its byte n-grams with marked ends, so affixes are
the n-grams that hold a mark. Learned transitions tie neighbouring words, and forward-backward gives each word's
probability of each language. A text's language is the one with the largest mean over its words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.llm.mixing_training import mixed
from gritmill.llm.shared import drawn, with_fields, written
from gritmill.llm.words import Words, mix, sliced, words_of

LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
BITS = 16  # hashed features
GRAMS = (1, 2, 3, 4)  # lengths of n-grams
SAMPLE = 300  # about as many labelled texts of each language are learnt from; the only bound, and only on training
MAX_LANGUAGES = 64
TRAINERS = 4
ROUNDS = 4
SPAN = 64  # words of a training sequence
SWITCH = 16  # words of one text in a row, on average, in code-switched training sequences
CHUNK = 32
SLICE = 1 << 22
_MARK = np.uint64(0x100)


def word_features(words: Words, which: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of some words, one word after the other, and where each word's begin."""
    n = words.length[which]
    size = n + 2
    begin = np.cumsum(size) - size
    own = np.repeat(np.arange(len(which)), size)
    place = np.arange(int(size.sum())) - begin[own]
    letters = np.full(len(own), _MARK, np.uint64)
    inside = (place > 0) & (place <= n[own])
    letters[inside] = words.data[(words.start[which][own] + place - 1)[inside]]
    found, owner = [mix(hashes[which] + np.uint64(77))], [np.arange(len(which))]
    for gram in GRAMS:
        last = place + gram <= size[own]
        at = np.flatnonzero(last)
        value = letters[at].copy()
        for k in range(1, gram):
            value = value * np.uint64(512) + letters[at + k]
        found.append(mix(value + np.uint64(gram << 40)))
        owner.append(own[at])
    every, of = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(of, kind="stable")
    return (every[order] >> np.uint64(64 - BITS)).astype(np.int64), np.searchsorted(of[order], np.arange(len(which)))


def emissions(weights: np.ndarray, words: Words) -> np.ndarray:
    """Score of each language for each word; equal words are scored once."""
    if not len(words.start):
        return np.zeros((0, weights.shape[1]))
    hashes = words.hashes()
    _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    features, begin = word_features(words, first, hashes)
    n = np.diff(np.append(begin, len(features)))
    return (np.add.reduceat(weights[features], begin, axis=0) / np.sqrt(n)[:, None])[place].astype(np.float64)


def forward_backward(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probability of each label for each step of each sequence ``first[i]:first[i + 1]``.

    Sequences are cut into chunks. Every chunk's product of steps is taken at once, a short pass over the products gives
    the messages between chunks, and the messages inside all chunks follow at once: the exact result, in steps of a chunk.
    """
    labels = scores.shape[1]
    n = np.diff(first)
    pieces = -(-n // CHUNK)
    total = int(pieces.sum())
    if not total:
        return np.zeros_like(scores)
    sequence = np.repeat(np.arange(len(n)), pieces)
    opening = np.cumsum(pieces) - pieces
    number = np.arange(total) - opening[sequence]
    at = (first[sequence] + number * CHUNK)[None, :] + np.arange(CHUNK)[:, None]
    real = at < first[sequence + 1][None, :]
    at = np.where(real, at, 0)
    step = np.exp(scores - scores.max(axis=1, keepdims=True))[at]  # chunk position, chunk, label
    moves = np.exp(transitions - transitions.max())
    head = number == 0

    def ahead(before: np.ndarray, t: int) -> np.ndarray:
        """Messages one step on; the first word of a sequence has no word before it."""
        moved = (before.reshape(-1, labels) @ moves).reshape(before.shape)
        if t == 0:
            moved[head] = 1.0
        shape = (total,) + (1,) * (before.ndim - 2) + (labels,)
        moved = moved * step[t].reshape(shape)
        moved /= moved.sum(axis=-1, keepdims=True) if before.ndim == 2 else moved.sum(axis=(-2, -1), keepdims=True)
        keep = real[t].reshape((total,) + (1,) * (before.ndim - 1))
        return np.where(keep, moved, before)

    product = np.broadcast_to(np.eye(labels), (total, labels, labels)).copy()
    for t in range(CHUNK):
        product = ahead(product, t)
    entering = np.full((total, labels), 1.0 / labels)
    leaving = np.full((total, labels), 1.0 / labels)
    for k in range(1, int(pieces.max())):
        now = np.flatnonzero(number == k) if k == 1 else now[number[np.minimum(now + 1, total - 1)] == k] + 1
        message = np.einsum("ij,ijk->ik", entering[now - 1], product[now - 1])
        entering[now] = message / message.sum(axis=1, keepdims=True)
    ends = opening + pieces - 1
    behind = np.flatnonzero(pieces > 1)
    for k in range(1, int(pieces.max())):
        behind = behind[pieces[behind] > k]
        here = ends[behind] - k
        message = np.einsum("ijk,ik->ij", product[here + 1], leaving[here + 1])
        leaving[here] = message / message.sum(axis=1, keepdims=True)
    forward = np.empty((CHUNK, total, labels))
    message = entering
    for t in range(CHUNK):
        message = forward[t] = ahead(message, t)
    out = np.empty_like(scores)
    message = leaving
    for t in reversed(range(CHUNK)):
        both = forward[t] * message
        out[at[t][real[t]]] = (both / both.sum(axis=1, keepdims=True))[real[t]]
        back = (step[t] * message) @ moves.T
        message = np.where(real[t][:, None], back / back.sum(axis=1, keepdims=True), message)
    return out


def _lexed(batches):
    """Labelled texts as words' features."""
    for batch in sliced(batches, "text"):
        words = words_of(batch.column("text"), LETTERS)
        hashes = words.hashes()
        features, begin = word_features(words, np.arange(len(hashes)), hashes) if len(hashes) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        size = np.diff(np.append(begin, len(features)))
        cut, at = words.first.tolist(), np.append(begin, len(features))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("trainer"), batch.column("id"), batch.column("label"),
                pa.array([size[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                pa.array([features[at[a] : at[b]].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
            ],
            ["trainer", "id", "label", "sizes", "features"],
        )


def _code_switched(sizes: list[np.ndarray], rng) -> np.ndarray:
    """``(text, word)`` in an order that switches between texts after runs of random length; every word comes once."""
    left = [i for i in range(len(sizes)) if len(sizes[i])]
    at, out = [0] * len(sizes), []
    while left:
        k = int(rng.integers(len(left)))
        i = left[k]
        n = min(1 + int(rng.geometric(1 / SWITCH)), len(sizes[i]) - at[i])
        out.append(np.stack((np.full(n, i), np.arange(at[i], at[i] + n)), axis=1))
        at[i] += n
        if at[i] == len(sizes[i]):
            left[k] = left[-1]
            left.pop()
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _fit(labels: int):
    def fit(weights: np.ndarray, rows: pa.Table, turn: int) -> np.ndarray:
        rows = rows.sort_by("id")
        split = labels << BITS
        w, moves = weights[:split].reshape(-1, labels).astype(np.float64), weights[split:].reshape(labels, labels).astype(np.float64)
        sizes = [np.frombuffer(x, np.int32) for x in rows.column("sizes").to_pylist()]
        features = np.concatenate([np.frombuffer(x, np.int32) for x in rows.column("features").to_pylist()])
        label = rows.column("label").to_numpy()
        opening = np.cumsum([0, *(len(x) for x in sizes)])
        size = np.concatenate(sizes)
        begin = np.cumsum(size) - size
        order = _code_switched(sizes, np.random.default_rng(500 + turn))
        word = opening[order[:, 0]] + order[:, 1]
        truth = label[order[:, 0]]
        squares, move_squares = np.full(w.shape, 1e-3), np.full(moves.shape, 1e-1)
        for a in range(0, len(word), SPAN * 32):
            of, y = word[a : a + SPAN * 32], truth[a : a + SPAN * 32]
            n = size[of]
            on = np.repeat(begin[of] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            on = features[on]
            scale = 1 / np.sqrt(n)
            owner = np.repeat(np.arange(len(of)), n)
            scores = np.add.reduceat(w[on], np.cumsum(n) - n, axis=0) * scale[:, None]
            first = np.append(np.arange(0, len(of), SPAN), len(of))
            p = forward_backward(scores, first, moves)
            error = -p
            error[np.arange(len(of)), y] += 1
            error *= scale[:, None] / len(of)
            at, place = np.unique(on, return_inverse=True)
            g = np.stack([np.bincount(place, error[owner, k], len(at)) for k in range(labels)], axis=1)
            squares[at] += g * g
            w[at] += 0.5 * g / np.sqrt(squares[at])
            # Transitions: seen against expected moves between neighbours of a sequence.
            inner = np.setdiff1d(np.arange(1, len(of)), first)
            seen = np.bincount(y[inner - 1] * labels + y[inner], minlength=labels**2).reshape(labels, labels)
            g = (seen - expected_moves(scores, first, moves, inner)) / len(of)
            move_squares += g * g
            moves += 0.2 * g / np.sqrt(move_squares)
        return np.concatenate((w.ravel(), moves.ravel()))

    return fit


def expected_moves(scores: np.ndarray, first: np.ndarray, moves: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Expected number of each move into the steps ``inner``, from plain messages in steps of a sequence."""
    step = np.exp(scores - scores.max(axis=1, keepdims=True))
    turn = np.exp(moves - moves.max())
    forward, back = step.copy(), np.ones_like(step)
    longest = int(np.diff(first).max())
    for t in range(1, longest):
        at = first[:-1][np.diff(first) > t] + t
        forward[at] = (forward[at - 1] @ turn) * step[at]
        forward[at] /= forward[at].sum(axis=1, keepdims=True)
        at = first[1:][np.diff(first) > t] - 1 - t
        back[at] = (step[at + 1] * back[at + 1]) @ turn.T
        back[at] /= back[at].sum(axis=1, keepdims=True)
    both = forward[inner - 1][:, :, None] * turn[None] * (step[inner] * back[inner])[:, None, :]
    return (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # features by languages
    transitions: np.ndarray

    def words(self, words: Words) -> np.ndarray:
        """Probability of each language for each word."""
        return forward_backward(emissions(self.weights, words), words.first, self.transitions)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> LanguageModel | None:
    """Fit on about ``sample`` texts of each language, chosen by a hash of their id; null labels, texts and ids are left out."""
    rows = labelled.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = {r["lang"]: r["count"] for r in rows.filter("lang is not null and id is not null").groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if not counts:
        return None
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(counts)
    chosen_one = F.lit(False)
    label = F.lit(0)
    for i, name in enumerate(languages):
        here = F.col("lang") == name
        chosen_one = F.when(here, drawn(F.col("id"), sample / counts[name])).otherwise(chosen_one)
        label = F.when(here, i).otherwise(label)
    chosen = rows.filter("id is not null and text is not null and lang is not null").filter(chosen_one)
    chosen = chosen.select(F.pmod(F.hash("id"), F.lit(TRAINERS)).alias("trainer"), "id", label.alias("label"), "text")
    sampled = written(chosen.mapInArrow(_lexed, "trainer int, id long, label int, sizes binary, features binary"), "lexed")
    n = len(languages)
    start = np.zeros((n << BITS) + n * n)
    weights = mixed(sampled, start, _fit(n), ROUNDS)
    return LanguageModel(languages, weights[: n << BITS].reshape(-1, n), weights[n << BITS :].reshape(n, n).astype(np.float64))


SPANS = "array<struct<start:int,end:int,lang:string>>"


def _runs(words: Words, label: np.ndarray, languages: list[str], some: np.ndarray) -> pa.Array:
    """Runs of words of one label, as (start, end, language) in code points of their text, for the texts marked in ``some``."""
    n = len(words.first) - 1
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
    if not len(label):
        return pa.array([[]] * n, kind)
    opens = np.ones(len(label), bool)
    opens[1:] = label[1:] != label[:-1]
    opens[words.first[:-1][words.first[:-1] < len(label)]] = True
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(label)) - 1
    owner = np.searchsorted(words.first, first, "right") - 1
    kept = some[owner]
    first, last, owner = first[kept], last[kept], owner[kept]
    points = np.concatenate(([0], np.cumsum((words.raw & 0xC0) != 0x80)))  # code points before each byte
    base = points[words.begin[owner]]
    start, end = points[words.start[first]] - base, points[words.start[last] + words.length[last]] - base
    names = pa.DictionaryArray.from_arrays(pa.array(label[first].astype(np.int32)), pa.array(languages, pa.string())).cast(pa.string())
    runs = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), names], ["start", "end", "lang"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)), runs)


def _identified(shared):
    def identify(batches):
        model: LanguageModel | None = shared.value
        for batch in sliced(batches, "text", SLICE):
            words = words_of(batch.column("text"), LETTERS)
            n = np.diff(words.first)
            ascii_letter = np.concatenate(([0], np.cumsum(LETTERS[words.raw] & (words.raw < 128))))[words.begin]
            some = np.diff(ascii_letter) > 0
            for i in np.flatnonzero(~some & (n > 0)).tolist():  # no ASCII letter: signs beyond ASCII need not be letters
                some[i] = any(c.isalpha() for c in batch.column("text")[i].as_py())
            langs, scores, label = ["und"] * len(n), np.zeros(len(n)), np.zeros(0, np.int64)
            if model is not None and len(words.start):
                p = model.words(words)
                label = p.argmax(axis=1)
                has = np.flatnonzero(some)
                running = np.concatenate((np.zeros((1, p.shape[1])), np.cumsum(p, axis=0)))
                mean = (running[words.first[has + 1]] - running[words.first[has]]) / n[has, None]
                best = mean.argmax(axis=1)
                for i, k in zip(has.tolist(), best.tolist()):
                    langs[i] = model.languages[k]
                scores[has] = np.clip(mean[np.arange(len(has)), best], 0, 1)
            spans = _runs(words, label, model.languages if model is not None else [], some)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(langs, pa.string()), pa.array(scores), spans], ["row", "lang_pred", "score", "spans"])

    return identify


def identified(docs: DataFrame, model: LanguageModel | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (a struct of the columns ``keep``), ``lang_pred`` and ``score``, the mean probability of that language over the words, and ``spans``.

    ``spans`` labels the words of code-switched text: (start, end, language) of each run of words whose most probable language is the same, in code
    points, from the first sign of the run's first word to the end of its last one; none for texts that are ``und``.
    A text that is null or has no letter is ``und`` with score 0, and so is every text without a model. Ties go to the
    language that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_identified(shared), with_fields(rows.select("row"), f"lang_pred string, score double, spans {SPANS}"))
