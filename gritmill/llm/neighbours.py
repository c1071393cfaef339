"""Approximate nearest neighbours by inner product: NN-descent builds a graph, queries walk it greedily.

Vectors are dealt to shards of bounded size by a hash. In each shard the graph starts from the leaves of random hyperplanes; every
round of NN-descent joins the neighbour lists with themselves, so that each vector meets its neighbours' neighbours, and keeps
the nearest. Each query walks every shard's graph, always on from the best vectors not yet opened, until its list of the best ``WIDTH``
has none left. It enters at its own place, at the leaves of random hyperplanes that it falls into, at one vector of every leaf, and at one of
every part of the graph that these don't lead to, so that no group of vectors is closed to it. What the walks find is ranked by the exact
measure on the original vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gritmill.llm.shared import discard, whole_groups, written

SHARD_ROWS = 8_192
DEGREE = 16  # nearest neighbours kept in the graph
LEAF = 64
TREES = 4
ROUNDS = 3
WIDTH = 320  # best vectors that a walk keeps
OPENED = 24  # vectors that a walk opens in a step
QUERIES = 1_024  # queries of a block


def _packed(batches):
    """Vectors as bytes of single floats."""
    for batch in batches:
        lists = batch.column("vector")
        rows = [np.asarray(x, np.float32).tobytes() for x in lists.to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(rows, pa.binary())], ["vec_id", "vector"])


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector``: rows with an id whose vector has only finite components, and not all of them zero."""
    vector = F.col(vector_col).cast("array<float>")
    fine = F.expr("forall(vector, x -> x is not null and not isnan(x) and abs(x) < float('infinity')) and exists(vector, x -> x != 0)")
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).filter("vec_id is not null and vector is not null")
    return out.filter(fine).distinct()


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows; shorter ones count as filled up with zeros."""
    out = np.zeros((len(blobs), width), np.float32)
    for i, b in enumerate(blobs):
        v = np.frombuffer(b, np.float32)
        out[i, : len(v)] = v
    return out


def _best(owner: np.ndarray, other: np.ndarray, sim: np.ndarray, rows: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` nearest distinct others of each row: matrices of places and similarities, -1 where there are fewer."""
    order = np.lexsort((other, owner))
    owner, other, sim = owner[order], other[order], sim[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    owner, other, sim = owner[first], other[first], sim[first]
    order = np.lexsort((other, -sim, owner))
    owner, other, sim = owner[order], other[order], sim[order]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    near, how = np.full((rows, keep), -1, np.int64), np.full((rows, keep), -np.inf, np.float32)
    ok = place < keep
    near[owner[ok], place[ok]], how[owner[ok], place[ok]] = other[ok], sim[ok]
    return near, how


def _listed(shard: int, ids: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    lists = [ids[row[row >= 0]].tolist() for row in near]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), shard, np.int64)), pa.array(ids), pa.array(lists, pa.list_(pa.int64()))], ["shard", "rep", "near"]
    )


def _shards(batches):
    """Per shard its id, the ids in order, the matrix, and the rows of kinds above 0."""
    for whole in whole_groups(batches, "shard", most=1):
        key = whole.column("shard").to_numpy()
        for s in np.unique(key).tolist():
            rows = whole.filter(pa.array(key == s))
            kind = rows.column("kind").to_numpy()
            own = rows.filter(pa.array(kind == 0))
            yield s, own.column("rep").to_numpy(), own.column("vector").to_pylist(), rows.filter(pa.array(kind > 0)), own


def _started(width: int):
    """First neighbours of each vector: the nearest in its leaves, of about ``LEAF`` vectors split by random hyperplanes."""

    def start(batches):
        for s, ids, blobs, _, _ in _shards(batches):
            x = _matrix(blobs, width)
            rng = np.random.default_rng(s)
            parts = []
            for _ in range(TREES):
                leaves = [np.arange(len(ids))]
                while leaves:
                    rows = leaves.pop()
                    if len(rows) > LEAF:  # the median splits evenly, equal projections by their place
                        side = np.argsort(x[rows] @ rng.standard_normal(width).astype(np.float32), kind="stable")
                        leaves += [rows[side[: len(rows) // 2]], rows[side[len(rows) // 2 :]]]
                        continue
                    sim = x[rows] @ x[rows].T
                    a, b = np.nonzero(~np.eye(len(rows), dtype=bool))
                    parts.append((rows[a], rows[b], sim[a, b]))
            near, _ = _best(*(np.concatenate([p[i] for p in parts]) for i in range(3)), len(ids), DEGREE)
            yield _listed(s, ids, near)

    return start


def _descended(width: int):
    """Each vector's nearest among its neighbours and the lists that came with them."""

    def step(batches):
        for s, ids, blobs, lists, _ in _shards(batches):
            x = _matrix(blobs, width)
            order = np.argsort(ids)
            met = lists.column("near").combine_chunks()
            n = np.diff(met.offsets.to_numpy())
            owner = np.repeat(order[np.searchsorted(ids[order], lists.column("rep").to_numpy())], n)
            other = order[np.searchsorted(ids[order], met.flatten().to_numpy())]
            pairs = np.unique(owner * len(ids) + other)
            owner, other = pairs // len(ids), pairs % len(ids)
            owner, other = owner[owner != other], other[owner != other]
            sim = np.empty(len(owner), np.float32)
            for a in range(0, len(owner), 1 << 16):
                i, j = owner[a : a + (1 << 16)], other[a : a + (1 << 16)]
                sim[a : a + (1 << 16)] = np.einsum("ij,ij->i", x[i], x[j])
            near, _ = _best(owner, other, sim, len(ids), DEGREE)
            yield _listed(s, ids, near)

    return step


def _by_shard(vectors: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of each shard together, its vectors first."""
    rows = vectors.withColumn("kind", F.lit(0))
    for kind, other in enumerate(others, 1):
        rows = rows.unionByName(other.withColumn("kind", F.lit(kind)), allowMissingColumns=True)
    return rows.repartition("shard").sortWithinPartitions("shard", "kind", "rep")


def neighbour_lists(graph: DataFrame, most: int = 2 * DEGREE) -> DataFrame:
    """Both ends' neighbours of each vector: its own, and of those that it is one of as many as fit, by a hash."""
    out = graph.select("shard", "rep", F.explode("near").alias("other"))
    back = out.select("shard", F.col("other").alias("rep"), F.col("rep").alias("other"), F.lit(1).alias("back"))
    both = out.withColumn("back", F.lit(0)).unionByName(back).groupBy("shard", "rep", "other").agg(F.min("back").alias("back"))
    ranked = both.withColumn("place", F.row_number().over(Window.partitionBy("rep").orderBy("back", F.xxhash64("rep", "other"), "other")))
    return ranked.filter(F.col("place") <= most).groupBy("shard", "rep").agg(F.collect_list("other").alias("around"))


def built_graph(vectors: DataFrame, width: int) -> DataFrame:
    """``shard, rep, near``: the neighbour graph of all vectors ``shard, rep, vector``, by rounds of NN-descent."""
    schema = "shard long, rep long, near array<long>"
    graph = written(_by_shard(vectors).mapInArrow(_started(width), schema), "graph")
    for _ in range(ROUNDS):
        around = neighbour_lists(graph)
        edges = graph.select("shard", "rep", F.explode("near").alias("other"))
        met = edges.join(around.select(F.col("rep").alias("other"), "around"), "other").select("shard", "rep", F.col("around").alias("near"))
        after = written(_by_shard(vectors, graph.unionByName(met)).mapInArrow(_descended(width), schema), "graph")
        discard(graph)
        graph = after
    return graph


def _walked(width: int, keep: int):
    """Greedy walks of a block of queries over one shard's graph; the nearest ``keep`` of each, measured in double precision."""

    def walk(batches):
        for whole in whole_groups(batches, "part", most=1):
            key = whole.column("part").to_numpy()
            for part in np.unique(key).tolist():
                rows = whole.filter(pa.array(key == part))
                kind = rows.column("kind").to_numpy()
                own, asked = rows.filter(pa.array(kind == 0)), rows.filter(pa.array(kind == 1))
                ids, x = own.column("rep").to_numpy(), _matrix(own.column("vector").to_pylist(), width)
                order = np.argsort(ids)
                lists = own.column("around").combine_chunks().fill_null([])
                near = order[np.searchsorted(ids[order], lists.flatten().to_numpy())] if len(lists.flatten()) else np.zeros(0, np.int64)
                at = np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy()))))
                queries, y = asked.column("rep").to_numpy(), _matrix(asked.column("vector").to_pylist(), width)
                leaves, heads = _entered(x, y)
                shared = _covering(near, at, heads)
                out = []
                for query, q, own_leaves in zip(queries.tolist(), y, leaves):
                    place = order[slice(*np.searchsorted(ids, [query, query + 1], sorter=order))]
                    best = _walk(q, x, near, at, np.unique(np.concatenate((shared, place, *own_leaves))))
                    exact = (x[best].astype(np.float64) * q.astype(np.float64)).sum(axis=1)
                    first = np.lexsort((ids[best], -exact))[:keep]
                    out.append((np.full(len(first), query), ids[best[first]], exact[first]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], ["query_id", "rep", "score"])

    return walk


def _entered(x: np.ndarray, y: np.ndarray) -> tuple[list[list[np.ndarray]], np.ndarray]:
    """For each row of ``y`` the places in ``x`` of the leaves that it falls into, and the most central place of every leaf."""
    rng = np.random.default_rng(7)
    leaves, heads = [[] for _ in y], []
    for _ in range(TREES):
        todo = [(np.arange(len(x)), np.arange(len(y)))]
        while todo:
            rows, asked = todo.pop()
            if len(rows) <= LEAF:
                heads += [rows[np.argmax(x[rows] @ x[rows].mean(axis=0))]] if len(rows) else []
                for i in asked.tolist():
                    leaves[i].append(rows)
                continue
            plane = rng.standard_normal(x.shape[1]).astype(np.float32)
            at = x[rows] @ plane
            side, half = np.argsort(at, kind="stable"), len(rows) // 2
            low = y[asked] @ plane < at[side[half]]
            todo += [(rows[side[:half]], asked[low]), (rows[side[half:]], asked[~low])]
    return leaves, np.unique(np.array(heads, np.int64))


def _linked(near: np.ndarray, at: np.ndarray, places: np.ndarray) -> np.ndarray:
    n = at[places + 1] - at[places]
    return near[np.repeat(at[places] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def _covering(near: np.ndarray, at: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """``entries`` and, until links lead to every place, the first one that they don't lead to."""
    reached = np.zeros(len(at) - 1, bool)
    more, new = [entries], entries
    while True:
        while len(new):
            reached[new] = True
            met = _linked(near, at, new)
            new = np.unique(met[~reached[met]])
        if reached.all():
            return np.concatenate(more)
        new = np.argmin(reached)[None]
        more.append(new)


def _walk(q: np.ndarray, x: np.ndarray, near: np.ndarray, at: np.ndarray, entries: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(x), bool)
    seen[entries] = True
    best, sim, closed = entries, x[entries] @ q, np.ones(len(entries), bool)
    while True:
        todo = np.flatnonzero(closed)
        if not len(todo):
            return best
        todo = todo[np.argsort(-sim[todo], kind="stable")[:OPENED]]
        closed[todo] = False
        met = _linked(near, at, best[todo])
        met = np.unique(met[~seen[met]])
        seen[met] = True
        best, sim, closed = np.concatenate((best, met)), np.concatenate((sim, x[met] @ q)), np.concatenate((closed, np.ones(len(met), bool)))
        if len(best) > WIDTH:
            stay = np.argpartition(-sim, WIDTH)[:WIDTH]
            best, sim, closed = best[stay], sim[stay], closed[stay]


def nearest(rows: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product found for each row where ``is_query`` holds.

    ``is_query`` is a condition on ``vec_id``. Ties go to the smaller id; a query never finds itself. Vectors that are null or zero or hold
    null or non-finite components take no part, nor do rows without an id. Repeated rows count once. Equal vectors are one place of
    the graph that stands for their ``k + 1`` smallest ids. Of unequal lengths, the shorter vector counts as filled up with zeros.
    """
    fine = written(usable(rows, id_col, vector_col), "usable")
    width, n, asked = fine.agg(F.max(F.size("vector")), F.count("*"), F.count_if(is_query)).first()
    width, shards, blocks = width or 1, max(1, math.ceil(n / shard_rows)), max(1, math.ceil(asked / QUERIES))
    alike = Window.partitionBy("vector").orderBy("vec_id")
    members = fine.withColumn("place", F.row_number().over(alike)).filter(F.col("place") <= k + 1)
    members = written(members.withColumn("rep", F.first("vec_id").over(alike)), "members")
    packed = members.filter("place = 1").select("vec_id", "vector").mapInArrow(_packed, "vec_id long, vector binary")
    shard = F.pmod(F.xxhash64("rep"), F.lit(shards))
    vectors = written(packed.select(F.col("vec_id").alias("rep"), "vector").withColumn("shard", shard), "vectors")
    graph = built_graph(vectors, width)
    around = neighbour_lists(graph).select("rep", "around")
    # Each block of queries goes to each shard: a stated query set against all rows, in blocks.
    places = vectors.join(around, "rep", "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(0))
    queries = fine.filter(is_query).mapInArrow(_packed, "vec_id long, vector binary").select(F.col("vec_id").alias("rep"), "vector")
    queries = queries.withColumns({"block": F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(blocks)).cast("int"), "kind": F.lit(1), "around": F.lit(None).cast("array<long>")})
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    together = places.unionByName(queries).withColumn("part", F.col("shard") * blocks + F.col("block"))
    walks = together.repartition("part").sortWithinPartitions("part", "kind", "rep").mapInArrow(_walked(width, k + 1), "query_id long, rep long, score double")
    found = walks.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "rep"))).filter(F.col("place") <= k + 1)
    every = found.drop("place").join(members.select("rep", "vec_id"), "rep").filter("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
