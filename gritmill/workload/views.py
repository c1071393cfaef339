"""Views over the given tables that play the roles of a dirty incident table.

No given column holds a null, so gaps are made by a fixed rule on the keys.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.operators.splitting import written_key_split
from gritmill.session import materialise

MIX = "(l_orderkey * 7 + l_linenumber * 3 + l_partkey)"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def gaps(rule: str, value: str) -> str:
    return f"CASE WHEN {MIX} {rule} THEN NULL ELSE {value} END"


# The same column expressions serve Spark and the SQL twins.
LINE_COLUMNS = {
    "order_key": "l_orderkey",
    "line_no": "l_linenumber",
    "part_key": "l_partkey",
    "End_Time": "l_shipdate",
    "Airport_Code": "concat('S', CAST(l_suppkey AS VARCHAR(20)))",
    "Month": "CAST(month(l_shipdate) AS INT)",
    "Temperature(F)": gaps("% 11 = 0", "l_quantity"),
    "Humidity(%)": gaps("% 23 = 0", "l_discount"),
    "Pressure(in)": gaps("% 3 = 0", "l_tax"),
    "Visibility(mi)": gaps("% 5 < 3", "l_extendedprice"),
    "Distance(mi)": "l_extendedprice",
    "Toll": "l_extendedprice * (1 + l_tax / 1000)",
    "Country": "'US'",
    "Flag_Label": "CASE WHEN l_linenumber % 2 = 0 THEN lower(l_returnflag) ELSE l_returnflag END",
    "Junction": "l_returnflag = 'R'",
    "Crossing": "l_linestatus = 'F'",
}
ORDER_COLUMNS = {
    "Severity": "CAST(substr(o_orderpriority, 1, 1) AS INT)",
    "high_severity": "CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INT) >= 4 THEN 1 ELSE 0 END",
    "Start_Time": "o_orderdate",
}
PART_COLUMNS = {
    "Wind_Direction": "p_type",
    "Street": "p_name",
    "Brand": "p_brand",
    "Stop": "p_size > 25",
}
FACT_COLUMNS = LINE_COLUMNS | ORDER_COLUMNS | PART_COLUMNS


def _listed(columns: dict[str, str], quote: str) -> str:
    return ", ".join(f"{expression} AS {quote}{name}{quote}" for name, expression in columns.items())


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order line, from ``lineitem`` alone."""
    return table(spark, sf, "lineitem").selectExpr(*[f"{e} AS `{n}`" for n, e in LINE_COLUMNS.items()])


def fact(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order line with its order and part."""
    joined = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return joined.selectExpr(*[f"{e} AS `{n}`" for n, e in FACT_COLUMNS.items()])


def written_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The same, joined once and written, for work that passes over it several times."""
    return materialise(fact(spark, sf), "fact")


def written_splits(spark: SparkSession, sf: str, without: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of the fact table, joined and written in one pass; columns named in ``without`` are neither joined nor written."""
    return written_key_split(fact(spark, sf).drop(*without), ["order_key", "line_no"])


def doc_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents: ``quality`` is the target."""
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")


LINES_SQL = f"lines AS (SELECT {_listed(LINE_COLUMNS, chr(34))} FROM lineitem)"
FACT_SQL = (
    f"fact AS (SELECT {_listed(FACT_COLUMNS, chr(34))} FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"
)
DOCS_SQL = "docs AS (SELECT * FROM documents JOIN labels USING (doc_id))"


def hash_sql(keys: str, digits: int = 8) -> str:
    """SQL twin of the key hash."""
    return f"CAST(CAST(concat('0x', substr(md5(concat_ws('|', {keys})), 1, {digits})) AS UBIGINT) AS BIGINT)"


def long_sql(source: str, columns: list[str], kind: str = "DOUBLE", name: str = "column_name") -> str:
    """One row per (column, value) of the listed columns."""
    parts = [f"SELECT '{c}' AS {name}, CAST(\"{c}\" AS {kind}) AS v FROM {source}" for c in columns]
    return " UNION ALL ".join(parts)
