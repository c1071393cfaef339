"""Types of a text table from all its rows, and the rows that don't fit their types.

A column's type is the narrowest one that every value has: whole number, long, decimal beyond that, double, date, timestamp, boolean, text. Each type is
a test on a cell, so one aggregate over the table decides all columns, nothing is sampled, and a late odd value widens its column instead of being lost.
Rows that don't fit a given schema are kept as they came, next to those that do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gritmill.functions.columns import col
from gritmill.session import materialise

RAW = "_raw"
WHOLE = r"^[+-]?[0-9]+$"
DOUBLE = r"^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$|^[+-]?(?:NaN|Inf|Infinity)$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:[.][0-9]{1,9})?(?:Z|[+-][0-9]{2}:[0-9]{2})?$"
DECIMAL_DIGITS = 38


def _tests(c: Column) -> dict[str, Column]:
    """What a present value must pass to be of each type."""
    whole = c.rlike(WHOLE)
    digits = F.length(F.regexp_replace(c, "^[+-]?0*", ""))
    return {
        "int": whole & c.try_cast("int").isNotNull(),
        "long": whole & c.try_cast("long").isNotNull(),
        "decimal": whole & (digits <= DECIMAL_DIGITS),
        "double": c.rlike(DOUBLE),
        "date": c.rlike(DATE) & c.try_cast("date").isNotNull(),
        "moment": (c.rlike(DATE) | c.rlike(MOMENT)) & c.try_cast("timestamp").isNotNull(),
        "boolean": F.lower(c).isin("true", "false"),
    }


def inferred_types(texts: DataFrame) -> T.StructType:
    """The schema that holds every value of a table of texts; a column without any value is text."""
    names = texts.columns
    aggregates = []
    for i, name in enumerate(names):
        c = F.when(col(name) != "", col(name))
        aggregates.append(F.count(c).alias(f"n{i}"))
        aggregates += [F.count_if(test).alias(f"{kind}{i}") for kind, test in _tests(c).items()]
        aggregates.append(F.max(F.when(c.rlike(WHOLE), F.length(F.regexp_replace(c, "^[+-]?0*", "")))).alias(f"digits{i}"))
        aggregates.append(F.count_if(c.rlike(r"(?:Z|[+-][0-9]{2}:[0-9]{2})$") & c.rlike(MOMENT)).alias(f"zoned{i}"))
    found = texts.agg(*aggregates).first()
    without_zone = texts.sparkSession.conf.get("spark.sql.timestampType") == "TIMESTAMP_NTZ"

    def kind(i: int) -> T.DataType:
        n = found[f"n{i}"]
        if not n:
            return T.StringType()
        fits = [k for k in ("int", "long", "decimal", "double", "date", "moment", "boolean") if found[f"{k}{i}"] == n]
        if not fits:
            return T.StringType()
        first = fits[0]
        if first == "decimal":
            return T.DecimalType(max(1, found[f"digits{i}"]), 0)
        if first == "moment":
            return T.TimestampNTZType() if without_zone and not found[f"zoned{i}"] else T.TimestampType()
        return {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "date": T.DateType(), "boolean": T.BooleanType()}[first]

    return T.StructType([T.StructField(name, kind(i)) for i, name in enumerate(names)])


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, every cell as text."""
    return spark.read.option("header", True).csv(path)


def infer_csv(spark: SparkSession, path: str) -> T.StructType:
    return inferred_types(read_texts(spark, path))


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV file that fit the schema, and the lines of those that don't, as they came.

    A line is rejected whole if any of its cells is no value of its column's type or if it has more or fewer cells than the schema. The file is parsed once.
    """
    marked = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
    both = materialise(reader.schema(marked).csv(path), "parsed")
    return both.filter(col(RAW).isNull()).drop(RAW), both.filter(col(RAW).isNotNull()).select(col(RAW).alias("line"))
