"""Near copies by chosen paths: set similarity join on word shingles, then one document per connected group.

A document's set holds its distinct runs of ``SHINGLE`` words. Equal sets collapse to one class first, so copies cost
nothing. Classes descend several independent trees: at a node each tree picks minwise lanes, and a class follows the
branches named by its minwise values there, so similar sets tend to stay together and others part. Small nodes are
compared exhaustively. A node that hardly parts is compared in blocks. Pairs that look alike by their minwise values are
confirmed on their full sets, and confirmed links become connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.llm.components import components
from gritmill.llm.shared import discard, whole_groups, written
from gritmill.llm.words import NOT_SPACE, Words, mix, sliced, windows, words_of

SHINGLE = 5
LANES = 64
TREES = 6
BRANCHES = 2  # lanes that a tree picks at a node; a pair stays together in one of them with probability 1 - (1 - s)^2
SMALL = 256  # classes that a node may hold to be compared at once
SMALL_WEIGHT = 4_000_000  # shingles of such a node
PARTS = 0.5  # a node whose largest branch keeps at least this share doesn't part any further
SLACK = 4.5  # standard errors that the estimated similarity may lie below the threshold
FILTER_BITS = 1 << 24

_rng = np.random.default_rng(911)
_MULTIPLY = _rng.integers(1, 2**63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1, 2**63, LANES, dtype=np.uint64)


def shingle_sets(words: Words, hashes: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingles; a text of fewer words has its whole sequence as the only one."""
    runs = windows(hashes, size)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        elif b > a:
            yield windows(hashes[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def minwise(values: np.ndarray) -> np.ndarray:
    """The least of ``LANES`` independent 32-bit hashes over a set."""
    least = np.full(LANES, 2**32 - 1, np.uint32)
    for part in range(0, len(values), 4096):
        spread = values[part : part + 4096, None] * _MULTIPLY + _ADD
        spread ^= spread >> np.uint64(29)
        least = np.minimum(least, ((spread * np.uint64(0x94D049BB133111EB)) >> np.uint64(32)).min(axis=0).astype(np.uint32))
    return least


_SIGNATURE = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("lanes", T.BinaryType())]
)


def _signatures(batches):
    from hashlib import blake2b

    for batch in sliced(batches, "text"):
        words = words_of(batch.column("text"), NOT_SPACE)
        n, digest, lanes = [], [], []
        for values in shingle_sets(words, words.hashes()):
            n.append(len(values))
            digest.append(blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
            lanes.append(minwise(values).tobytes() if len(values) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(lanes, pa.binary())], ["id", "n", "digest", "lanes"]
        )


def _lanes(column: pa.Array) -> np.ndarray:
    """The minwise values as rows of a matrix."""
    column = column.cast(pa.large_binary())
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64)[column.offset : column.offset + 1]
    return np.frombuffer(data, np.uint32, count=len(column) * LANES, offset=int(at[0])).reshape(len(column), LANES)


def _picked(node: np.ndarray) -> np.ndarray:
    """Lanes that each node's tree picks, one column for each branch."""
    seeds = mix(node[:, None] + np.arange(1, BRANCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = seeds % np.uint64(LANES)
    first[:, 1:] = (first[:, :1] + np.uint64(1) + seeds[:, 1:] % np.uint64(LANES - 1)) % np.uint64(LANES)
    return first.astype(np.int64)


def _roots(batches):
    """The first branches of all trees: lane ``k`` belongs to tree ``k // BRANCHES``."""
    lane = np.arange(TREES * BRANCHES)
    for batch in batches:
        values = _lanes(batch.column("lanes"))[:, lane]
        node = mix(values.astype(np.uint64) + (lane.astype(np.uint64) + np.uint64(1)) * np.uint64(1 << 33))
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(np.repeat(batch.column(c).to_numpy(), len(lane))) for c in ("rep", "n")),
                pa.array(np.tile(lane.astype(np.int32), batch.num_rows)),
                pa.array(node.ravel().view(np.int64)),
            ],
            ["rep", "n", "root", "node"],
        )


def _branches(batches):
    """What each class follows from its node."""
    for batch in batches:
        values, node = _lanes(batch.column("lanes")), batch.column("node").to_numpy().view(np.uint64)
        lane = _picked(node)
        chosen = np.take_along_axis(values, lane, axis=1).astype(np.uint64)
        child = mix(mix(node)[:, None] + chosen + (lane.astype(np.uint64) + np.uint64(1)) * np.uint64(1 << 40))
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(np.repeat(batch.column(c).to_numpy(), BRANCHES)) for c in ("node", "rows", "rep", "n")), pa.array(child.ravel().view(np.int64))],
            ["parent", "rows", "rep", "n", "node"],
        )


def _alike(threshold: float) -> int:
    """Matching lanes from which a pair is worth confirming."""
    return int(np.floor(LANES * (threshold - SLACK * np.sqrt(threshold * (1 - threshold) / LANES))))


def _worth_confirming(threshold: float):
    """Compare all classes within a (node, block pair) by their minwise values.

    A pair that another first branch has already compared is left to it: those branches whose nodes were compared
    as a whole are set in ``done``. ``half`` is 0 or 1 for the two blocks of a block pair, and only pairs
    across blocks count there; -1 compares all. Yields the members of each linked set of a node.
    """
    enough = _alike(threshold)
    n_roots = TREES * BRANCHES

    def compare(batches):
        for whole in whole_groups(batches, "key"):
            key = whole.column("key").to_numpy()
            rep, size, half = (whole.column(c).to_numpy() for c in ("rep", "n", "half"))
            root, done = whole.column("root").to_numpy(), whole.column("done").to_numpy()
            lanes = _lanes(whole.column("lanes").combine_chunks())
            earlier = np.where(root >= 0, (np.int64(1) << np.maximum(root, 0).astype(np.int64)) - 1, (1 << n_roots) - 1)
            parent = np.arange(len(key))

            def find(i):
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            _, counts = np.unique(key, return_counts=True)  # sorted already
            rows = np.arange(len(key))
            for gap in range(1, int(counts.max())):
                rows = rows[rows + gap < len(key)]
                rows = rows[key[rows] == key[rows + gap]]
                if not len(rows):
                    break
                i, j = rows, rows + gap
                keep = (np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])) & (rep[i] != rep[j])
                keep &= (half[i] < 0) | (half[i] != half[j])
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                met = ((lanes[i, :n_roots] == lanes[j, :n_roots]).astype(np.int64) << np.arange(n_roots)).sum(axis=1)
                keep = (met & done[i] & earlier[i]) == 0
                i, j = i[keep], j[keep]
                keep = (lanes[i] == lanes[j]).sum(axis=1) >= enough
                for x, y in zip(i[keep].tolist(), j[keep].tolist()):
                    parent[find(x)] = find(y)
            members = rows_with_links(parent)
            if len(members):
                top = np.array([find(i) for i in members.tolist()], np.int64)
                found = mix(key[top].view(np.uint64) + mix(rep[top].view(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(rep[members]), pa.array(half[members].astype(np.int32))], ["group", "rep", "half"]
                )

    return compare


def rows_with_links(parent: np.ndarray) -> np.ndarray:
    """Rows of a union-find forest that are not alone."""
    moved = np.flatnonzero(parent != np.arange(len(parent)))
    return np.union1d(moved, parent[moved]) if len(moved) else moved


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct values."""
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(few) < percent * len(many):
        return False
    at = np.searchsorted(many, few)
    at[at == len(many)] = 0
    both = int((many[at] == few).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int):
    """Links within each group, on full sets; pairs that earlier links already connect are not compared again."""

    def confirm(batches):
        for whole in whole_groups(batches, "group", most=256):
            group = whole.column("group").to_numpy()
            cuts = np.flatnonzero(np.diff(group)) + 1
            rep, half = whole.column("rep").to_numpy(), whole.column("half").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in whole.column("set").to_pylist()]
            a_out, b_out = [], []
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(group)]):
                top = list(range(lo, hi))

                def find(i):
                    while top[i - lo] != i:
                        top[i - lo] = top[top[i - lo] - lo]
                        i = top[i - lo]
                    return i

                for i in range(lo, hi):
                    for j in range(i + 1, hi):
                        if half[i] >= 0 and half[i] == half[j]:
                            continue
                        x, y = find(i), find(j)
                        if x != y and (rep[i] == rep[j] or similar(sets[i], sets[j], percent)):
                            top[max(x, y) - lo] = min(x, y)
                for i in range(lo, hi):
                    x = find(i)
                    if x != i:
                        a_out.append(int(rep[x]))
                        b_out.append(int(rep[i]))
            if a_out:
                yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])

    return confirm


def _sets_of(bits: bytes):
    """Full sets of the documents whose id passes the filter."""
    marks = np.frombuffer(bits, np.uint64)

    def sets(batches):
        for batch in sliced(batches, "text"):
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            place = mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(FILTER_BITS)
            keep = (marks[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
            if not keep.any():
                continue
            words = words_of(batch.column("text").filter(pa.array(keep)), NOT_SPACE)
            held = [x.tobytes() for x in shingle_sets(words, words.hashes())]
            yield pa.RecordBatch.from_arrays([pa.array(ids[keep].astype(np.int64)), pa.array(held, pa.binary())], ["rep", "set"])

    return sets


def _places(batches):
    for batch in batches:
        place = mix(batch.column("rep").to_numpy().view(np.uint64)) % np.uint64(FILTER_BITS)
        word, bit = (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], ["word", "bit"])


def _filter_of(ids: DataFrame) -> bytes:
    """A bit map of fixed size over hashed ids: 2 MB whatever the number of ids; it only saves shuffling."""
    marks = np.zeros(FILTER_BITS // 64, np.uint64)
    found = ids.mapInArrow(_places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    marks[found.column("word").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return marks.tobytes()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    * Words are runs of anything but ASCII white space, A-Z in lower case. Documents whose sets overlap by ``percent``
      of their union are linked; ``component_id`` is the smallest id reachable, ``kept`` marks it.
    * No text or no word: an empty set, linked with nothing. Null id: linked with nothing, component null, kept.
    * Repeated rows share their component. Rows of one id with several texts are each judged by their own text.
    * An empty table gives an empty result; other columns are not read.
    """
    threshold = percent / 100
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = written(source.mapInArrow(_signatures, _SIGNATURE), "signatures")
    classes = written(
        rows.filter("id is not null and n > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("lanes").alias("lanes")), "classes"
    )
    links = written(_confirmed(source, _together(classes, threshold), percent), "confirmed")
    found = written(components(links), "components")
    of_class = classes.select("digest", "rep").join(found, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("reached"))
    out = rows.select("id", "n", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("reached", "id"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )


def _together(classes: DataFrame, threshold: float) -> DataFrame:
    """``(group, rep, half)``: classes that some node finds alike, written."""
    level = written(classes.mapInArrow(_roots, "rep long, n long, root int, node long"), "level")
    compared: list[DataFrame] = []
    done = None
    while done is None or not level.isEmpty():
        sizes = level.groupBy("node").agg(F.count("*").alias("rows"), F.sum("n").alias("weight")).filter("rows > 1")
        sized = written(level.join(sizes, "node"), "sized")
        small = (F.col("rows") <= 2) | ((F.col("rows") <= SMALL) & (F.col("weight") <= SMALL_WEIGHT))
        large = sized.filter(~small).join(classes.select("rep", "lanes"), "rep")
        children = written(
            large.select("node", "rows", "rep", "n", "lanes").mapInArrow(_branches, "parent long, rows long, rep long, n long, node long"), "children"
        )
        branches = children.groupBy("parent", "rows", "node").count()
        tight = written(branches.groupBy("parent", "rows").agg(F.max("count").alias("most")).filter(F.col("most") >= PARTS * F.col("rows")), "tight")
        # Nodes compared as a whole: small ones at once, those that don't part in pairs of blocks.
        at_once = sized.filter(small).select("node", "rep", "n", "root", F.col("node").alias("key"), F.lit(-1).alias("half"))
        in_blocks = _block_pairs(sized.join(tight.select(F.col("parent").alias("node")), "node", "left_semi"))
        here = written(at_once.union(in_blocks), "compared")
        if done is None:
            done = written(here.groupBy("rep").agg(F.bit_or(F.expr("shiftleft(1L, root)")).alias("done")), "done")
        compared.append(here)
        after = written(children.join(tight, "parent", "left_anti").select("rep", "n", F.lit(-1).alias("root"), "node"), "level")
        for spent in (level, sized, children, tight):
            discard(spent)
        level = after
    every = compared[0]
    for more in compared[1:]:
        every = every.union(more)
    light = classes.select("rep", "lanes").join(done, "rep", "left").withColumn("done", F.coalesce("done", F.lit(0).cast("long")))
    full = every.join(light, "rep").select("key", "rep", "n", "half", "root", "done", "lanes")
    alike = full.repartition("key").sortWithinPartitions("key").mapInArrow(_worth_confirming(threshold), "group long, rep long, half int")
    return written(alike, "alike")


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Rows of large nodes, dealt to pairs of blocks of about twice ``SMALL`` rows so that any two of a node meet exactly once."""
    blocks = F.greatest(F.ceil(F.col("rows") / (2 * SMALL)), F.ceil(F.col("weight") / SMALL_WEIGHT)).cast("long")
    own = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    key = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    half = F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int"))
    return dealt.select("node", "rep", "n", "root", key.alias("key"), half.alias("half"))


def _confirmed(source: DataFrame, alike: DataFrame, percent: int) -> DataFrame:
    """Links that hold on full sets; only documents that look alike are read again."""
    marks = _filter_of(alike.select("rep").distinct())
    sets = source.filter("id is not null").mapInArrow(_sets_of(marks), "rep long, set binary")
    return alike.join(sets, "rep").repartition("group").sortWithinPartitions("group", "rep").mapInArrow(_confirm(percent), "a long, b long")
