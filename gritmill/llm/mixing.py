"""Mixing sources to target weights by entropy balancing.

Among all document rates that meet each source's target in words, entropy balancing takes those closest to the documents' prior
rates. Its dual has one variable for each source and is convex; Newton steps solve it, every step one aggregation of all
sources' masses. The solution tilts the prior exponentially, and the rates are then rounded into whole copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritmill.llm.shared import discard, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # words that the mix takes, as a share of all words
MOST = 2  # copies of a document
STRATUM = 2_000  # rows that are rounded together, about
TURNS = 16  # starts of rounding that each stratum tries
TOLERANCE = 1e-12
STEPS = 60
WORD = r"[^\x20\x09-\x0D]+"


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``rank`` of each source by code point, from 0, null last; sorted range by range, not in one task."""
    spark = sizes.sparkSession
    ranged = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    counts = ranged.groupBy("part").count()  # one row a range
    before = counts.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return ranged.join(F.broadcast(before), "part").withColumn("rank", F.col("before") + inside - 1).drop("part", "before")


def capped_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target``: targets by weight, none above ``most`` times its source, the excess reshared by weight."""
    which = F.array(*[F.lit(w) for w in weights])
    weighed = written(ranked_sources(sizes).withColumn("weight", F.get(which, F.pmod("rank", F.lit(len(weights))).cast("int"))), "weighed")
    capacity = F.col("source_size") * most
    total = (weighed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, held = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * level > capacity
        n, kept, rest = weighed.agg(F.count_if(full), F.sum(F.when(full, capacity)), F.sum(F.when(~full, F.col("weight")))).first()
        if n == held:
            break
        held = n
        level = (total - (kept or 0)) / rest if rest else 0.0
    target = F.col("weight") * F.lit(level)
    return weighed.select("source", "source_size", F.when(target > capacity, capacity.cast("double")).otherwise(target).alias("target"))


def balanced_rates(cells: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """``source, source_size, target, tilt``: log factors that bring every source's words to its target.

    ``cells`` has ``source, prior, mass``: the words of the documents of one source and prior rate. A document's rate is
    min(most, prior * exp(tilt)). The dual, sum of mass * rate - tilt * target, is convex in each tilt: its slope is the
    source's words less its target, its curvature the words of the documents below the limit.
    """
    duals = written(targets.withColumn("tilt", F.lit(0.0)), "duals")
    for _ in range(STEPS):
        rate = F.least(F.lit(float(most)), F.col("prior") * F.exp("tilt"))
        joined = cells.join(duals.select("source", "tilt"), cells["source"].eqNullSafe(duals["source"])).select(cells["source"], "mass", "prior", rate.alias("rate"))
        moments = joined.groupBy("source").agg(
            F.sum(F.col("mass") * F.col("rate")).alias("words"), F.sum(F.when(F.col("rate") < most, F.col("mass") * F.col("rate"))).alias("bend")
        )
        moments = moments.withColumnRenamed("source", "of")
        slope = F.col("words") - F.col("target")
        newton = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), slope / F.col("bend")))
        back = F.ln(F.col("words") / F.col("target"))  # where every document is at the limit, the dual has no curvature to go by
        step = F.when(F.abs(slope) > TOLERANCE * F.col("target"), F.when(F.col("bend") > 0, newton).otherwise(back)).otherwise(0.0)
        moved = duals.join(moments, duals["source"].eqNullSafe(F.col("of")), "left").select("source", "source_size", "target", F.col("tilt") - F.coalesce(step, F.lit(0.0)), F.coalesce(step, F.lit(0.0)))
        after = written(moved.toDF("source", "source_size", "target", "tilt", "step"), "duals")
        discard(duals)
        duals = after
        if not (duals.agg(F.max(F.abs("step"))).first()[0] or 0) > 1e-11:
            break
    return duals.select("source", "source_size", "target", "tilt")


def mixed_copies(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", prior: Column | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``keep``), ``size``, ``source_size``, ``target``, ``rate``, ``copies`` and ``taken``.

    A document's size is its number of words (null: 0); it is taken ``copies`` times, at most ``MOST``. Rounding goes by strata
    of about ``STRATUM`` rows of one source: in order of size a document is taken once more where the cumulated rate passes a whole
    number, so each stratum comes within its largest document of its share; of ``TURNS`` starts the one that comes nearest holds. A hash of id and text deals the strata, so reruns agree. Null sources are one source;
    an empty table gives an empty mix; where all texts are empty, so is every target.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.col(source_col).cast("string").alias("source"),
        size.alias("size"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("mark"),
        (F.lit(1.0) if prior is None else prior.cast("double")).alias("prior"),
    )
    if text_col not in keep:
        rows = written(rows, "sized")
    cells = written(rows.groupBy("source", "prior").agg(F.sum("size").alias("mass"), F.count("*").alias("rows")), "cells")
    targets = written(capped_targets(cells.groupBy("source").agg(F.sum("mass").alias("source_size"))), "targets")
    rates = balanced_rates(cells.select("source", "prior", "mass"), targets)
    strata = cells.groupBy("source").agg(F.ceil(F.sum("rows") / STRATUM).alias("strata")).join(rates, cells["source"].eqNullSafe(rates["source"]))
    of = strata.select(cells["source"].alias("of"), "strata", "source_size", "target", "tilt")
    joined = rows.join(of, rows["source"].eqNullSafe(F.col("of")))
    rate = F.round(F.least(F.lit(float(MOST)), F.col("prior") * F.exp("tilt")), 9)
    stratum = F.pmod("mark", "strata")
    dealt = joined.select("row", "source", "size", "source_size", "target", "mark", rate.alias("rate"), stratum.alias("stratum"))
    part = F.col("rate") - F.floor("rate")
    whole = Window.partitionBy("source", "stratum")
    run = F.sum(part).over(whole.orderBy(F.desc("size"), "mark").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    dealt = dealt.withColumns({"part": part, "upto": F.round(run, 6), "before": F.round(run - part, 6)})
    extras = [F.floor(F.col("upto") + (k + 0.5) / TURNS) - F.floor(F.col("before") + (k + 0.5) / TURNS) for k in range(TURNS)]
    goal = F.sum(F.col("part") * F.col("size")).over(whole)
    missed = F.array(*[F.round(F.abs(F.sum(x * F.col("size")).over(whole) - goal), 3) for x in extras])
    dealt = dealt.withColumns({"missed": missed, "extras": F.array(*extras)})
    extra = F.element_at("extras", F.array_position("missed", F.array_min("missed")).cast("int"))
    copies = F.least(F.lit(MOST), F.floor("rate") + extra).cast("int")
    return dealt.withColumn("copies", copies).select("row", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))
