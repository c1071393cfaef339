"""Language-model scores from a weighted backoff automaton over words.

States are the root and one for each word of the training texts. From the state of word h an arc for each word w that
followed h carries log10 p(w | h); all others take h's failure arc, whose weight goes to the root, and the root's arc of w.
With c counting training tokens, p(w | h) = (c(hw) + K p(w)) / (c(h) + K) and p(w) = (c(w) + 1) / (N + V + 1), so the failure
arc weighs K / (c(h) + K) and all probabilities of a state sum to 1. K makes the mass that failure arcs take over all training tokens
equal to the share of word pairs seen once (Good and Turing's estimate of what is unseen).

The automaton grows with the corpus, so no task holds all of it. Documents are packed into blocks; a block asks for the
counts of its own words and pairs, tasks that own a share of the hashes add all blocks' counts up and answer each block, and
the block's part of the automaton is then walked left to right over its documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.llm.shared import whole_groups, written
from gritmill.llm.words import mix, sliced, words_of

BLOCK_TOKENS = 1_000_000
SHARE_TOKENS = 1_000_000  # training tokens for each share of the hashes
END, START = (np.uint64(x) for x in (0x5DEECE66D1CE4E5B, 0x1F83D9ABFB41BD6B))
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers, byte planes compressed apart; a small block asks many shares for nothing."""
    if not len(values):
        return b""
    values = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, n: int, kind) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    raw = pa.decompress(blob, decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def _gaps(values: np.ndarray) -> np.ndarray:
    out = values.copy()
    out[1:] -= values[:-1]
    return out


_BLOCK = "block long, ids array<long>, train binary, lengths binary, n_tokens long, tokens binary, n_words long, words binary"


def _blocks(most: int):
    """Documents packed into blocks: every token as the rank of its word in the block, most frequent first."""

    def block_of(key, ids, train, lengths, hashes):
        words, rank, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        lengths = np.concatenate(lengths).astype(np.uint32)
        row = [key, [x for part in ids for x in part], np.concatenate(train).tobytes(), lengths.tobytes(), len(rank), packed(place[rank]), len(words), words[order].tobytes()]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        names = ["block", "ids", "train", "lengths", "n_tokens", "tokens", "n_words", "words"]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)

    def pack(batches):
        part, sequence, held, rows = TaskContext.get().partitionId(), 0, [], 0
        for batch in sliced(batches, "text"):
            words = words_of(batch.column("text"))
            n = np.diff(words.first)
            hashes = np.insert(words.hashes(), words.first[1:], END)  # an end after each text
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(np.uint8)
            held.append((batch.column("id").to_pylist(), train, n + 1, hashes))
            rows += len(hashes)
            if rows >= most:
                yield block_of((part << 32) + sequence, *zip(*held))
                sequence, held, rows = sequence + 1, [], 0
        if held:
            yield block_of((part << 32) + sequence, *zip(*held))

    return pack


class Block:
    """A packed block and the words and pairs that it asks for, in order of their hashes."""

    def __init__(self, row: dict):
        self.lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        self.train = np.frombuffer(row["train"], np.uint8) > 0
        self.tokens = unpacked(row["tokens"], row["n_tokens"], np.uint32).astype(np.int64)
        words = np.frombuffer(row["words"], np.uint64)
        self.n_words = len(words)
        # Word n_words is the start, which only stands before other words.
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = self.n_words
        self.before = before
        known = np.append(words, START)
        pairs, self.pair = np.unique(before * (self.n_words + 1) + self.tokens, return_inverse=True)
        asked = mix(known[pairs // (self.n_words + 1)] * _PAIR + known[pairs % (self.n_words + 1)])
        self.pair_order, self.word_order = np.argsort(asked), np.argsort(known)
        self.pairs, self.words = asked[self.pair_order], known[self.word_order]

    def train_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of ``words`` (the start counts training documents) and of ``pairs``."""
        trained = np.repeat(self.train, self.lengths)
        words = np.bincount(self.tokens[trained], minlength=self.n_words + 1)
        words[self.n_words] = self.train.sum()
        return words[self.word_order], np.bincount(self.pair[trained], minlength=len(self.pairs))[self.pair_order]


def _bounds(values: np.ndarray, shares: int) -> np.ndarray:
    """Where each share of the hash range begins among sorted hashes."""
    step = 2**64 // shares + 1
    return np.searchsorted(values, np.array([min(i * step, 2**64 - 1) for i in range(1, shares)], np.uint64)) if shares > 1 else np.zeros(0, np.int64)


_ASKED = "block long, share int, n_words long, words binary, word_counts binary, n_pairs long, pairs binary, pair_counts binary"


def _asked(shares: int):
    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block(row)
                word_counts, pair_counts = block.train_counts()
                a, b = ([0, *_bounds(x, shares).tolist(), len(x)] for x in (block.words, block.pairs))
                out = []
                for share in range(shares):
                    w, p = slice(a[share], a[share + 1]), slice(b[share], b[share + 1])
                    out.append(
                        (
                            row["block"], share,
                            w.stop - w.start, packed(_gaps(block.words[w])), packed(word_counts[w].astype(np.uint32)),
                            p.stop - p.start, packed(_gaps(block.pairs[p])), packed(pair_counts[p].astype(np.uint32)),
                        )
                    )
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
                names = ["block", "share", "n_words", "words", "word_counts", "n_pairs", "pairs", "pair_counts"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return ask


_ANSWERED = "block long, share int, words binary, pairs binary, stats array<double>, classes array<double>"
_CLASSES = 8 * 64  # words by the logarithm of their count, eight to a doubling


def _totals(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Total count of each asked hash in the order of asking; then each hash once, and its total."""
    every = np.concatenate(hashes)
    known, place = np.unique(every, return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(known)).astype(np.uint64)
    return total[place], known, total


def _answered(batches):
    """Add the counts of a share up and answer each block that asked; one more row holds what the whole share adds to the model."""
    for whole in whole_groups(batches, "share", most=1):
        share = whole.column("share").to_numpy()
        for s in np.unique(share).tolist():
            rows = whole.filter(pa.array(share == s)).to_pylist()
            out = {}
            for kind, size in (("words", "n_words"), ("pairs", "n_pairs")):
                hashes = [np.cumsum(unpacked(r[kind], r[size], np.uint64), dtype=np.uint64) for r in rows]
                counts = [unpacked(r["word_counts" if kind == "words" else "pair_counts"], r[size], np.uint32) for r in rows]
                each, known, total = _totals(hashes, counts)
                cuts = np.cumsum([0, *(len(h) for h in hashes)])
                out[kind] = [packed(each[a:b].astype(np.uint64)) for a, b in zip(cuts[:-1], cuts[1:])]
                out[f"{kind}_total"], out[f"{kind}_known"] = total, known
            seen = out["words_total"][(out["words_total"] > 0) & (out["words_known"] != START)].astype(np.float64)
            as_state = out["words_total"][(out["words_total"] > 0) & (out["words_known"] != END)].astype(np.float64)
            place = np.floor(np.log2(as_state) * 8).astype(np.int64)
            classes = np.concatenate((np.bincount(place, minlength=_CLASSES), np.bincount(place, as_state, _CLASSES)))
            stats = [float(len(seen)), float(seen.sum()), float((out["pairs_total"] == 1).sum())]
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*(r["block"] for r in rows), None], pa.int64()),
                    pa.array([s] * (n + 1), pa.int32()),
                    pa.array([*out["words"], None], pa.binary()),
                    pa.array([*out["pairs"], None], pa.binary()),
                    pa.array([*[None] * n, stats], pa.list_(pa.float64())),
                    pa.array([*[None] * n, classes.tolist()], pa.list_(pa.float64())),
                ],
                ["block", "share", "words", "pairs", "stats", "classes"],
            )


def prior_weight(classes: list[float], once: float) -> float:
    """K with sum of c(h) K / (c(h) + K) over all states = pairs seen once, from words grouped by their count."""
    words, tokens = np.array(classes[:_CLASSES]), np.array(classes[_CLASSES:])
    mean = tokens[words > 0] / words[words > 0]
    tokens = tokens[words > 0]
    low, high = 1e-3, 1e9
    for _ in range(100):
        middle = math.sqrt(low * high)
        low, high = (middle, high) if (tokens * middle / (mean + middle)).sum() < once else (low, middle)
    return math.sqrt(low * high)


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(shares: int, n: float, v: float, k: float):
    def score(batches):
        for whole in whole_groups(batches, "block", most=1):
            key = whole.column("block").to_numpy()
            for b in np.unique(key).tolist():
                rows = whole.filter(pa.array(key == b)).to_pylist()
                row = next(r for r in rows if r["share"] < 0)
                answers = sorted((r for r in rows if r["share"] >= 0), key=lambda r: r["share"])
                yield walk(Block(row), row["ids"], answers)

    def walk(block: Block, ids: list, answers: list):
        def count(kind: str, hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
            cuts = [0, *_bounds(hashes, shares).tolist(), len(hashes)]
            found = np.concatenate([unpacked(r[kind], cuts[r["share"] + 1] - cuts[r["share"]], np.uint64) for r in answers])
            out = np.empty(len(found))
            out[order] = found
            return out

        words = count("answer_words", block.words, block.word_order)
        pairs = count("answer_pairs", block.pairs, block.pair_order)
        # The block's part of the automaton: the root's arcs, each state's failure arc, and the arcs of the pairs seen.
        root = np.log10((words + 1) / (n + v + 1))
        failure = np.log10(k / (words + k))
        failure[words == 0] = 0.0  # not a state: the walk already stands at the root
        state, word = block.before, block.tokens
        seen = pairs[block.pair]
        step = np.where(
            seen > 0,
            np.log10((seen + k * (words[word] + 1) / (n + v + 1)) / (words[state] + k)),
            failure[state] + root[word],
        )
        first = np.cumsum(block.lengths) - block.lengths
        whole = [np.add.reduceat(x, first) if len(x) else x for x in (step, root[word], (words[word] > 0).astype(np.int64))]
        size = len(block.lengths)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array(~block.train), pa.array(block.lengths), pa.array(whole[2]),
                pa.array(np.full(size, int(n))), pa.array(whole[1]), pa.array(whole[0]),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return score


def backoff_scores(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``train`` is a boolean column: the rows that the automaton learns from (null: none). Null texts count as empty: one token, the end.
    Repeated rows count each time. Without training rows every token scores log10 of 1, as there is nothing but the unknown.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    blocks = written(rows.mapInArrow(_blocks(BLOCK_TOKENS), _BLOCK), "blocks")
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    shares = max(1, math.ceil(tokens / SHARE_TOKENS))
    asked = blocks.mapInArrow(_asked(shares), _ASKED)
    answered = written(asked.repartition("share").sortWithinPartitions("share", "block").mapInArrow(_answered, _ANSWERED), "answers")
    of_shares = answered.filter("block is null")
    v, n, once = (x or 0.0 for x in of_shares.agg(*[F.sum(F.col("stats")[i]) for i in range(3)]).first())
    classes = [0.0] * (2 * _CLASSES)
    for i, x in of_shares.select(F.posexplode("classes")).groupBy("pos").agg(F.sum("col")).collect():  # a fixed number of classes
        classes[i] = x
    k = prior_weight(classes, once) if n else 1.0
    programs = blocks.withColumn("share", F.lit(-1))
    answers = answered.filter("block is not null").select("block", "share", F.col("words").alias("answer_words"), F.col("pairs").alias("answer_pairs"))
    together = programs.unionByName(answers, allowMissingColumns=True)
    return together.repartition("block").sortWithinPartitions("block", "share").mapInArrow(_scored(shares, n, v, k), _SCORED)

