"""Documents as token ids, packed into sequences of a fixed length by best fit in bounded space.

Tokenising is a map over the documents. A document that is longer than a sequence, its end id included, is cut into pieces of a sequence's length, the
first of which may be shorter; shorter documents are never cut. Only the pieces' numbers and lengths move on: they are dealt in runs of about
``RUN`` pieces, by a hash of a piece's number, to tasks of at most about ``PIECES_OF_TASK``, and each task packs online, run by run, the longest first.
A task keeps a fixed number of sequences open. A bitset has a bit for each free space that an open sequence has; the lowest bit at or above
a piece's length is the best fit. If nothing fits, a sequence is opened, and if that is one too many, the fullest one closes first. As
many sequences may be open as a run has pieces, so each run is packed like best fit with falling lengths over all of it, and what it leaves
open goes on taking pieces of later runs. Each task leaves some sequences part full at its end, about one in a thousand.

Rules: a null text counts as empty; an empty text is one piece that holds the end id alone. Rows that repeat are packed each by itself, wherever
their copies go. An empty table has no pieces. Sequence numbers have gaps; places within a sequence don't.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.llm.shared import with_fields, written

SEQUENCE = 1_024
OPEN = 4_096  # sequences that a task keeps open
RUN = 4_096
PIECES_OF_TASK = 1 << 18
CHARS_AT_ONCE = 1 << 21

#: Signs whose Unicode class no library disagrees on; other texts take the reference library.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-¬®-ɏЀ-ԯ‐-‧‰-⁞€]")
LONG_WORD = 400  # longer words or gaps make the quicker library slow
NO_SPECIAL = "<|"
PORTION = 1 << 20
BOUNDARY = re.compile("[A-Za-z0-9] (?=[A-Za-z])")


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _ranks(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def plain(text: str) -> bool:
    """Whether both libraries are sure to agree: usual signs, no special token, no very long word or gap."""
    if UNUSUAL.search(text) or NO_SPECIAL in text:
        return False
    words = text.split()
    letters = sum(map(len, words))
    return max(map(len, words), default=0) < LONG_WORD and len(text) - letters - len(words) < LONG_WORD


def portions(text: str, most: int = PORTION) -> Iterator[str]:
    """A text in portions of about ``most`` signs, cut where a token ends whatever comes before: between a letter or digit and the space before a letter."""
    start = 0
    while len(text) - start > most and (found := BOUNDARY.search(text, start + most)):
        yield text[start : found.start() + 1]
        start = found.start() + 1
    yield text[start:]


def _ids(text: str, tokenizer: str, quick) -> np.ndarray:
    if quick is not None and plain(text):
        return quick.encode_to_numpy(text, disallowed_special=())
    # One at a time: a batch would start threads of its own in each task.
    return np.asarray(_tokenizer(tokenizer).encode(text, add_special_tokens=False).ids, np.uint32)


def token_ids(texts: list[str], tokenizer: str, ranks: tuple[str, str] | None = None) -> list[np.ndarray]:
    """Ids of every text by the tokenizer file. ``ranks`` names the same vocabulary for a quicker library and its pattern; plain texts take it."""
    quick = _ranks(*ranks) if ranks else None
    return [np.concatenate([_ids(p, tokenizer, quick) for p in portions(text)]) for text in texts]


def cut_lengths(n: int, most: int) -> list[int]:
    """Lengths of a document's pieces: full ones, the first of which may be shorter."""
    k = max(1, -(-n // most))
    return [n - (k - 1) * most] + [most] * (k - 1)


def pieces(
    docs: DataFrame,
    keep: Sequence[str],
    tokenizer: str,
    end_id: int,
    *,
    ranks: tuple[str, str] | None = None,
    text_col: str = "text",
    most: int = SEQUENCE,
) -> DataFrame:
    """``row, piece, start, length, ids, spot`` for every piece; ``ids`` are little-endian 32-bit numbers, ``spot`` numbers the pieces of all tasks.

    ``row`` holds the columns of ``keep``. Write the result before use: ``spot`` goes by task, so it is fixed only once written.
    """
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = with_fields(source.select("row"), "piece int, start long, length long, ids binary, spot long")

    def cut(batches):
        spot = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            share = np.cumsum(sizes) // CHARS_AT_ONCE
            for some in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(share)) + 1):
                if len(some):
                    texts = batch.column("text").slice(some[0], len(some)).to_pylist()
                    ids = [np.append(x, end_id).astype("<u4") for x in token_ids(texts, tokenizer, ranks)]
                    lengths = [cut_lengths(len(x), most) for x in ids]
                    owner = np.repeat(some, [len(x) for x in lengths])
                    length = np.concatenate([np.asarray(x, np.int64) for x in lengths])
                    place = np.concatenate([np.arange(len(x), dtype=np.int32) for x in lengths])
                    start = np.concatenate([np.cumsum([0, *x[:-1]]) for x in lengths]).astype(np.int64)
                    ends = np.concatenate([[0], np.cumsum(length * 4)]).astype(np.int32)
                    data = pa.BinaryArray.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(ids))])
                    spots = spot + np.arange(len(length), dtype=np.int64)
                    spot += len(length)
                    rows = batch.column("row").take(pa.array(owner))
                    yield pa.RecordBatch.from_arrays([rows, pa.array(place), pa.array(start), pa.array(length), data, pa.array(spots)], schema.names)

    return source.mapInArrow(cut, schema)


class BestFit:
    """Online best fit with a fixed number of open sequences, found by a bitset over their free space."""

    def __init__(self, space: int, most_open: int):
        self.space, self.most_open = space, most_open
        self.bits = 0  # bit f: some open sequence has f free
        self.open: list[list[int]] = [[] for _ in range(space + 1)]
        self.opened = self.count = 0

    def _take(self, free: int) -> int:
        at = self.open[free]
        number = at.pop()
        if not at:
            self.bits ^= 1 << free
        self.opened -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The sequence that a piece goes to and its place there."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.opened == self.most_open:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.space, self.count
            self.count += 1
        left = free - length
        if left:
            if not self.open[left]:
                self.bits |= 1 << left
            self.open[left].append(number)
            self.opened += 1
        return number, self.space - free


def placed(cut: DataFrame, most: int = SEQUENCE, most_open: int = OPEN, run: int = RUN, pieces_of_task: int = PIECES_OF_TASK) -> DataFrame:
    """``spot, sequence_id, offset`` for every piece of a written table of ``spot`` and ``length``; full pieces are sequences of their own."""
    full = cut.filter(F.col("length") >= most).select("spot", F.col("spot").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = cut.filter(F.col("length") < most).select("spot", "length")
    n = rest.count()
    runs = max(1, -(-n // run))
    dealt = rest.withColumn("run", F.pmod(F.xxhash64("spot"), F.lit(runs)))
    tasks = -(-n // pieces_of_task)
    dealt = dealt.repartition(tasks, "run") if tasks > 1 else dealt.repartition(1)

    def pack(batches) -> Iterator[pa.RecordBatch]:
        # Below zero, so that they never meet the numbers of full pieces.
        first, packer = -1 - (TaskContext.get().partitionId() << 33), BestFit(most, most_open)
        for batch in batches:
            found = np.array([packer.place(x) for x in batch.column("length").to_pylist()], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("spot"), pa.array(first - found[:, 0]), pa.array(found[:, 1])], ["spot", "sequence_id", "offset"])

    # In this order a task that is run again packs the same way.
    ordered = dealt.sortWithinPartitions("run", F.desc("length"), "spot").select("spot", "length")
    return full.union(ordered.mapInArrow(pack, "spot long, sequence_id long, offset long"))


def packed(cut: DataFrame, **how) -> DataFrame:
    """The written pieces with their ``sequence_id`` and ``offset``."""
    return cut.join(written(placed(cut, **how), "placed"), "spot")


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """``sequence_id, ids, offsets``: the token ids of every sequence and where its pieces start, from pieces with their ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # a sequence's worth of ids at most
    whole = packed_pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda out, p: F.concat(out, p["ids"]))
    return whole.select("sequence_id", ids.alias("ids"), F.transform("parts", lambda p: p["offset"]).alias("offsets"))
