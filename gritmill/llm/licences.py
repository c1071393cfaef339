"""Licence scan by canonical digests: a whole text, normalised, is looked up among the digests of known licences.

A-Z go to lower case, lines that state a copyright go, all signs but letters, digits and what lies beyond ASCII become spaces, and
equivalent spellings become one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.llm.licence_texts import LONG_TEXTS, SPELLINGS, TEXTS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What follows a bare "(c)" must hold a year or a claim of rights: clauses are numbered "(c)" as well, as in Apache-2.0 and MPL-2.0.
COPYRIGHT_LINE = (
    "(^|\n)[ \t#*/-]*(copyright( ?[(]c[)]| ?©)|copyright[ :]+([0-9]|<|\\[|the |by )|©"
    "|[(]c[)]( ?[0-9]|[^\n]*((19|20)[0-9][0-9]|all rights reserved)))[^\n]*"
    "|(^|\n)[ \t#*/-]*all rights reserved[.]?[ \t\r]*(?=\n|$)"
)
# For engines without a look-ahead: the same on a text whose line ends are doubled, so that a line that goes takes one of them along and leaves one to the next.
COPYRIGHT_LINE_SQL = COPYRIGHT_LINE.replace("(?=\n|$)", "(\n|$)")
SIGNS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# Words stand between two spaces, so a replaced word leaves its neighbours' spaces alone.
SPACED = [(f" {other.replace(' ', '  ')} ", f" {one.replace(' ', '  ')} ") for other, one in SPELLINGS]
SPELLED = "|".join(other for other, _ in SPACED)


def normalised(text: Column) -> Column:
    """The canonical form of a text."""
    plain = F.regexp_replace(F.translate(text, _UPPER, _LOWER), COPYRIGHT_LINE, "\n")
    plain = F.regexp_replace(F.concat(F.lit(" "), plain, F.lit(" ")), SIGNS, "  ")
    spelled = plain
    for other, one in SPACED:
        spelled = F.replace(spelled, F.lit(other), F.lit(one))
    return F.trim(F.when(plain.rlike(SPELLED), spelled).otherwise(plain))


def known_digests(spark: SparkSession, texts=TEXTS + LONG_TEXTS) -> DataFrame:
    """``licence, digest``: a small fixed table."""
    rows = spark.createDataFrame([(i, t) for i, t in texts], "licence string, text string")
    return rows.select("licence", F.sha2(normalised(F.col("text")), 256).alias("digest")).groupBy("digest").agg(F.min("licence").alias("licence"))


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts=TEXTS + LONG_TEXTS) -> DataFrame:
    """Per document ``doc_id``, the ``digest`` of its normalised text and the ``licence`` that has it, else null.

    A null text has no digest; an empty text and one of signs only share the digest of nothing, which is no licence's.
    Repeated rows are looked up each by itself. The known digests are a fixed list, so they are broadcast.
    """
    known = known_digests(docs.sparkSession, texts)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(F.col(text_col).cast("string")), 256).alias("digest"))
    return rows.join(F.broadcast(known), "digest", "left").select("doc_id", "digest", "licence")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def normalised_sql(text: str) -> str:
    """The canonical form as DuckDB SQL."""
    lines = f"replace(translate({text}, '{_UPPER}', '{_LOWER}'), chr(10), chr(10) || chr(10))"
    plain = f"regexp_replace({lines}, {_quoted(COPYRIGHT_LINE_SQL)}, chr(10), 'g')"
    out = f"regexp_replace(' ' || {plain} || ' ', {_quoted(SIGNS)}, '  ', 'g')"
    for other, one in SPACED:
        out = f"replace({out}, '{other}', '{one}')"
    return f"trim({out}, ' ')"


LICENCES_SQL = f"""
    WITH texts(licence, text) AS (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in TEXTS + LONG_TEXTS)}),
    known AS (SELECT sha256({normalised_sql("text")}) AS digest, min(licence) AS licence FROM texts GROUP BY 1),
    docs AS (SELECT doc_id, sha256({normalised_sql("text")}) AS digest FROM documents)
    SELECT doc_id, digest, licence FROM docs LEFT JOIN known USING (digest)
"""
