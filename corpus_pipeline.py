"""The corpus pipeline: quality, near copies, benchmark leaks, personal data, mix; each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.llm import graded
from gritmill.llm.leaks import decontaminated
from gritmill.llm.mixing import mixed_copies
from gritmill.llm.near_copies import near_copies
from gritmill.llm.personal_data import redacted
from gritmill.llm.shared import table, written

#: No SQL form: the stages fit models, join on similarity and round by hashes.
ORACLE_SQL = None


def unused(docs: DataFrame, name: str) -> str:
    """``name``, or with as many underscores behind it as it takes to be no column of ``docs`` in any case of letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns(docs: DataFrame) -> list[Column]:
    """All columns by their literal names, dots included."""
    return [F.col(f"`{c}`") for c in docs.columns]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier selects; it learns from the ratings of documents that are there."""
    ratings = table(spark, sf_dir, "labels").select("doc_id", graded.rating_grade().alias("grade"))
    found = graded.graded(docs, graded.train(docs, ratings), docs.columns)
    return found.filter("selected").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id; rows that repeat both id and text stay once.

    Documents without an id belong to no group and stay.
    """
    gone = written(near_copies(docs).filter("not kept").select("doc_id").distinct(), "gone")
    named = docs.filter("doc_id is not null").join(gone, "doc_id", "left_anti").select(*columns(docs))
    return named.dropDuplicates(["doc_id", "text"]).unionByName(docs.filter("doc_id is null"))


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced; ``n_chars`` counts the new text where a text changed."""
    old = unused(docs, "before")
    after = redacted(docs.withColumn(old, F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col(old))
    return after.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*columns(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with ``copy`` counting from 1 (``copy_`` and so on where documents have such a column)."""
    mix = mixed_copies(docs, docs.columns).filter("copies > 0")
    number = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mix.select("row.*", number.alias(unused(docs, "copy")))


STAGES = [("quality", good), ("near_copies", distinct), ("leaks", unleaked), ("personal_data", private), ("mixing", mixed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
